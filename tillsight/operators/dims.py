"""Customer, product (variant grain), location and employee dims."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.labels import (LOCATION_TYPE_LABELS, PERSON_TYPE_LABELS,
                                        UNKNOWN_EMPLOYEE, label_of)


def customer_dim(customers: DataFrame, addresses: DataFrame,
                 person_type_labels: Mapping[str, str] = PERSON_TYPE_LABELS) -> DataFrame:
    """One row per customer with the primary address flattened in.

    The ``is_primary`` test sits in the join condition, not in a later
    filter, so customers without a primary address keep their row.
    """
    c = customers.alias("c")
    a = addresses.alias("a")
    j = c.join(a, (F.col("a.customer_id") == F.col("c.id")) & F.col("a.is_primary"), "left")
    return j.select(
        F.col("c.id").alias("customer_id"),
        F.coalesce(F.col("c.trade_name"), F.col("c.legal_name")).alias("customer"),
        F.col("c.legal_name").alias("legal_name"),
        F.col("c.person_type").alias("person_type"),
        label_of(F.col("c.person_type"), person_type_labels).alias("person_type_label"),
        F.col("c.tax_id").alias("document"),
        F.col("c.email").alias("email"),
        F.col("c.is_active").alias("is_active"),
        F.col("a.city").alias("city"),
        F.col("a.state").alias("state"),
        F.col("a.postal_code").alias("postal_code"),
        F.to_date(F.col("c.created_at")).alias("signup_date"),
    )


def repair_all_caps(name: F.Column) -> F.Column:
    """Title-case a name only when it is entirely upper case.

    Spark's ``initcap`` splits words at spaces only; names with intended
    mixed case are left alone.
    """
    return F.when(name == F.upper(name), F.initcap(name)).otherwise(name)


def product_dim(variants: DataFrame, products: DataFrame, categories: DataFrame,
                brands: DataFrame) -> DataFrame:
    """Variant-grain product dimension: variant + product (inner), category,
    its parent and brand (left); gross margin; all-caps category repaired with
    the original kept beside it.

    Categories and brands are small dimension tables: the planner's size
    estimate (and AQE at run time) turns those joins into broadcasts, while
    the variant/product join stays a shuffle join if both are large.
    """
    v = variants.alias("v")
    p = products.alias("p")
    cat = categories.alias("cat")
    par = categories.alias("par")
    b = brands.alias("b")
    j = (v.join(p, F.col("p.id") == F.col("v.product_id"))
         .join(cat, F.col("cat.id") == F.col("p.category_id"), "left")
         .join(par, F.col("par.id") == F.col("cat.parent_category_id"), "left")
         .join(b, F.col("b.id") == F.col("p.brand_id"), "left"))
    return j.select(
        F.col("v.id").alias("variant_id"),
        F.col("v.sku").alias("sku"),
        F.col("v.barcode_ean").alias("barcode"),
        F.col("v.sale_price").alias("sale_price"),
        F.col("v.cost_price").alias("cost_price"),
        (F.col("v.sale_price") - F.col("v.cost_price")).alias("gross_margin"),
        F.col("v.weight_kg").alias("weight_kg"),
        F.col("v.is_active").alias("variant_active"),
        F.col("p.id").alias("product_id"),
        F.col("p.name").alias("product"),
        F.col("p.ncm_code").alias("ncm"),
        F.col("p.unit_of_measure").alias("unit"),
        F.col("p.is_active").alias("product_active"),
        F.col("cat.id").alias("category_id"),
        repair_all_caps(F.col("cat.name")).alias("category"),
        F.col("cat.name").alias("category_original"),
        F.col("par.name").alias("parent_category"),
        F.col("b.id").alias("brand_id"),
        F.col("b.name").alias("brand"),
        F.col("b.country").alias("brand_country"),
    )


def location_dim(locations: DataFrame,
                 type_labels: Mapping[str, str] = LOCATION_TYPE_LABELS) -> DataFrame:
    """Projection plus type label; stores and warehouses are both kept."""
    return locations.select(
        F.col("id").alias("location_id"),
        F.col("name").alias("location"),
        F.col("location_type").alias("type"),
        label_of(F.col("location_type"), type_labels).alias("type_label"),
        "city", "state", "postal_code", "is_active",
    )


def employee_dim(employees: DataFrame,
                 unknown: Mapping[str, object] = UNKNOWN_EMPLOYEE) -> DataFrame:
    """Employees plus one unknown member (id -1) for orders without one."""
    rows = employees.select(
        F.col("id").cast("long").alias("employee_id"),
        F.col("full_name").alias("employee"),
        F.col("role").alias("role"),
        F.col("primary_location_id").cast("int").alias("location_id"),
        F.col("hire_date").cast("date").alias("hire_date"),
        F.col("is_active").alias("is_active"),
    )
    schema = T.StructType([
        T.StructField("employee_id", T.LongType()),
        T.StructField("employee", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("location_id", T.IntegerType()),
        T.StructField("hire_date", T.DateType()),
        T.StructField("is_active", T.BooleanType()),
    ])
    member = employees.sparkSession.createDataFrame(
        [(int(unknown["employee_id"]), unknown["employee"], unknown["role"], None, None,
          bool(unknown["is_active"]))], schema)
    return member.unionByName(rows)
