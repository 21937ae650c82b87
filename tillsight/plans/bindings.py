"""Binding of the operators' roles to the driver's TPC-H-like tables.

The operators expect the column names of a retail star schema (orders with
``channel``/``status``/``total``, items with ``product_variant_id``...). The
driver's tables carry TPC-H columns, so each role below is a projection (plus
a few aggregates) over them. Every derivation is deterministic and has a
DuckDB twin in ``tillsight.plans.oracle`` so the two engines see the same
inputs. Nothing here samples or caps rows.

Role map: orders <- orders; items <- lineitem; variant = product <- part;
category <- p_type (with one root parent); brand <- p_brand; customer <-
customer (+ nation, region for the primary address); location <- nation;
employee <- supplier; returned items <- lineitem rows flagged 'R'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.numeric import money
from tillsight.sources.tables import read_table

# Channel that plays the in-store role, and the statuses that count as
# realised revenue, for TPC-H data.
IN_STORE_CHANNEL = "1-URGENT"
REALISED_STATUSES = ("F", "O")
# Labels for the TPC-H value domains (the reference's own labels are the
# operators' defaults).
SEGMENT_LABELS = {"AUTOMOBILE": "Automotive", "BUILDING": "Construction"}
NATION_TYPE_LABELS = {"store": "Store", "warehouse": "Warehouse"}
PRIORITY_LABELS = {"1-URGENT": "Urgent", "2-HIGH": "High"}
STATUS_LABELS = {"F": "Finished", "O": "Open", "P": "Partial"}
ACTION_LABELS = {"refund": "Refund", "exchange": "Exchange"}
# Cleaning rules for the priority-derived reason text.
PRIORITY_EMPTY_VALUES = ("", "-", "?")
PRIORITY_RULES = (
    (("urg",), "Urgent"),
    (("high",), "High"),
    (("dium",), "Medium"),
    (("not sp",), "Not specified"),
    (("low",), "Low"),
)
PRIORITY_DEFAULT = "Not informed"


def _t(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, root, name)


def orders(spark: SparkSession, root: str) -> DataFrame:
    o = _t(spark, root, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        key.alias("id"),
        F.concat(F.lit("O-"), key.cast("string")).alias("order_number"),
        F.col("o_orderpriority").alias("channel"),
        cust.alias("customer_id"),
        F.when((F.col("o_orderpriority") == IN_STORE_CHANNEL) | (key % 3 == 0),
               cust % 15 + 1).alias("salesperson_id"),
        (cust % 25).cast("int").alias("location_id"),
        F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("placed_at"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def order_items(spark: SparkSession, root: str) -> DataFrame:
    li = _t(spark, root, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_variant_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("line_total"),
        money("l_discount").alias("discount_rate"),
    )


def orders_with_item_totals(spark: SparkSession, root: str) -> DataFrame:
    """Orders plus item-derived subtotal, discount and shipping dates.

    ``created_at`` is the order date, ``placed_at`` the first shipment and
    ``updated_at`` the last one, so the integrity panel's "updated before
    created" counts orders shipped before they were placed.
    """
    li = _t(spark, root, "lineitem")
    per_order = li.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum(money("l_extendedprice")).alias("subtotal"),
        F.sum(money("l_extendedprice") * money("l_discount")).alias("discount_amount"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )
    o = orders(spark, root).drop("placed_at", "updated_at")
    return (o.join(per_order, "id", "left")
            .withColumn("placed_at", F.col("first_ship"))
            .withColumn("updated_at", F.col("last_ship"))
            .drop("first_ship", "last_ship"))


def products(spark: SparkSession, root: str) -> DataFrame:
    p = _t(spark, root, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand_id"),
        F.col("p_type").alias("category_id"),
        F.concat(F.lit("NCM"), F.lpad(F.col("p_size").cast("string"), 4, "0")).alias("ncm_code"),
        F.lit("UN").alias("unit_of_measure"),
        (F.col("p_size") > 5).alias("is_active"),
    )


def product_variants(spark: SparkSession, root: str) -> DataFrame:
    p = _t(spark, root, "part")
    price = money("p_retailprice")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.lpad(F.col("p_partkey").cast("string"), 13, "0").alias("barcode_ean"),
        price.alias("sale_price"),
        (price - money(F.col("p_size"))).alias("cost_price"),
        F.col("p_size").cast("decimal(10,3)").alias("weight_kg"),
        (F.col("p_size") % 7 != 0).alias("is_active"),
    )


def categories(spark: SparkSession, root: str) -> DataFrame:
    """One category per part type under a single root category."""
    types = (_t(spark, root, "part").select(F.col("p_type").alias("id")).distinct()
             .select("id", F.col("id").alias("name"),
                     F.lit("ALL").alias("parent_category_id")))
    root_row = spark.createDataFrame(
        [("ALL", "All products", None)],
        "id string, name string, parent_category_id string")
    return types.unionByName(root_row)


def brands(spark: SparkSession, root: str) -> DataFrame:
    return (_t(spark, root, "part").select(F.col("p_brand").alias("id")).distinct()
            .select("id", F.col("id").alias("name"),
                    F.lit(None).cast("string").alias("country")))


def customers(spark: SparkSession, root: str) -> DataFrame:
    c = _t(spark, root, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("person_type"),
        F.col("c_name").alias("legal_name"),
        F.when(F.col("c_acctbal") > 5000,
               F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("c_name"))).alias("trade_name"),
        F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("tax_id"),
        F.lower(F.col("c_name")).alias("email"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        F.date_add(F.lit("1990-01-01").cast("date"),
                   (F.col("c_custkey") % 1000).cast("int")).alias("created_at"),
    )


def addresses(spark: SparkSession, root: str) -> DataFrame:
    """A primary address from the customer's nation and region, and a
    secondary one, so the primary-only join condition matters."""
    c = _t(spark, root, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, root, "nation")
    r = _t(spark, root, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    primary = c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.lit(True).alias("is_primary"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("postal_code"),
    )
    secondary = c.select(
        F.col("c_custkey").alias("customer_id"),
        F.lit(False).alias("is_primary"),
        F.lit("SECONDARY").alias("city"),
        F.lit("NONE").alias("state"),
        F.lit("00000").alias("postal_code"),
    )
    return primary.unionByName(secondary)


def locations(spark: SparkSession, root: str) -> DataFrame:
    n = _t(spark, root, "nation")
    r = _t(spark, root, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.when(F.col("n_nationkey") % 2 == 0, "store").otherwise("warehouse").alias("location_type"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("postal_code"),
        F.lit(True).alias("is_active"),
    )


def employees(spark: SparkSession, root: str) -> DataFrame:
    s = _t(spark, root, "supplier")
    return s.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("full_name"),
        F.when(F.col("s_acctbal") >= 0, "seller").otherwise("trainee").alias("role"),
        F.col("s_nationkey").alias("primary_location_id"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("s_suppkey").cast("int")).alias("hire_date"),
        (F.col("s_acctbal") > 0).alias("is_active"),
    )


def dirty_reason(priority, key):
    """Priority text with the kinds of noise a hand-typed reason carries."""
    v = key % 9
    return (F.when(v == 0, priority)
            .when(v == 1, F.lower(priority))
            .when(v == 2, F.concat(F.lit("  "), priority, F.lit("  ")))
            .when(v == 3, F.regexp_replace(priority, "-", "-   "))
            .when(v == 5, F.lit(""))
            .when(v == 6, F.lit("?"))
            .when(v == 7, F.regexp_replace(priority, "E", "EE"))
            .when(v == 8, F.lit("n/a")))


def returns(spark: SparkSession, root: str) -> DataFrame:
    """One return per order with returned items, dated by its last shipment."""
    li = _t(spark, root, "lineitem").filter(F.col("l_returnflag") == "R")
    per_order = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("created_at"))
    o = _t(spark, root, "orders")
    key = F.col("o_orderkey")
    return o.join(per_order, "o_orderkey").select(
        key.alias("id"),
        F.concat(F.lit("R-"), key.cast("string")).alias("return_number"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_custkey") % 25).cast("int").alias("received_at_location_id"),
        F.col("o_orderstatus").alias("status"),
        dirty_reason(F.col("o_orderpriority"), key).alias("reason"),
        "created_at",
    )


def return_items(spark: SparkSession, root: str) -> DataFrame:
    """Returned lines, refunded at the part's list price. They carry their
    order and variant, so the fact needs no hop through an item key (the
    driver's items have none)."""
    li = _t(spark, root, "lineitem").filter(F.col("l_returnflag") == "R")
    p = _t(spark, root, "part").select("p_partkey", "p_retailprice")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("return_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_variant_id"),
        F.when(F.col("l_linestatus") == "F", "refund").otherwise("exchange").alias("action"),
        F.col("l_quantity").cast("decimal(18,3)").alias("quantity"),
        money("p_retailprice").alias("unit_refund_amount"),
    )
