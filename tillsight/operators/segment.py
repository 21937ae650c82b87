"""Elite customers by ticket among catalogue-wide buyers, and
their category mix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.numeric import mean_half_up
from tillsight.session import materialize

ITEMS_PER_TASK = 500_000


def _customer_categories(orders: DataFrame, items: DataFrame, variants: DataFrame,
                         products: DataFrame, category_col: str) -> DataFrame:
    """One row per customer and category with units and distinct orders. An
    order has one customer, so both add up over customers.

    Categories are attached first, then items are dealt by order, so many to a
    task: what a task sorts and counts doesn't grow with the tables."""
    tasks = max(1, -(-items.count() // ITEMS_PER_TASK))
    return (items.select("order_id", "product_variant_id", "quantity")
            .join(variants.select(F.col("id").alias("product_variant_id"), "product_id"),
                  "product_variant_id")
            .join(products.select(F.col("id").alias("product_id"),
                                  F.col(category_col).alias("category_id")), "product_id")
            .select("order_id", "category_id", "quantity").repartition(tasks, "order_id")
            .join(orders.select(F.col("id").alias("order_id"), "customer_id"), "order_id")
            .groupBy("customer_id", "category_id")
            .agg(F.sum("quantity").alias("units"), F.count_distinct("order_id").alias("orders")))


def _customer_metrics(orders: DataFrame, bought: DataFrame) -> DataFrame:
    """Order-grain revenue/frequency and category diversity, aggregated
    separately and then joined, so item rows never repeat an order's total
    (the fan-out trap)."""
    per_order = orders.groupBy("customer_id").agg(
        F.sum("total").alias("revenue"), F.count(F.lit(1)).alias("frequency"))
    diversity = bought.groupBy("customer_id").agg(
        F.count("category_id").alias("category_diversity"))
    return per_order.join(diversity, "customer_id")


def elite_customers(orders: DataFrame, items: DataFrame, variants: DataFrame,
                    products: DataFrame, min_categories: int = 13, n: int = 10,
                    category_col: str = "category_id", order_filter=None) -> DataFrame:
    """Customers with at least ``min_categories`` distinct categories,
    top ``n`` by ticket rounded to cents (ties broken by customer id).

    ``orderBy().limit(n)`` plans as TakeOrderedAndProject: every partition
    keeps its own top n and only those rows move. No status filter unless
    ``order_filter`` is given (the reference applies none).
    """
    if order_filter is not None:
        orders = orders.filter(order_filter)
    m = _customer_metrics(orders, _customer_categories(orders, items, variants, products,
                                                       category_col))
    ranked = (m.filter(F.col("category_diversity") >= min_categories)
              .select("customer_id", "revenue", "frequency",
                      mean_half_up(F.col("revenue"), F.col("frequency")).alias("ticket"),
                      "category_diversity"))
    # PostgreSQL order: NULLs last ascending, first descending (trap T1).
    return ranked.orderBy(F.col("ticket").desc_nulls_first(),
                          F.col("customer_id").asc_nulls_last()).limit(n)


def elite_category_mix(orders: DataFrame, items: DataFrame, variants: DataFrame,
                       products: DataFrame, categories: DataFrame,
                       min_categories: int = 13, n: int = 10,
                       category_col: str = "category_id",
                       rank_by_rounded: bool = False, order_filter=None) -> DataFrame:
    """Items bought and orders involved per category, for the top ``n``.

    The group is re-selected by the *unrounded* ticket (the reference's mix
    query), or by the rounded one with ``rank_by_rounded``; the two can pick
    different customers when tickets tie at two decimals. The elite list has
    at most ``n`` rows by construction, so it is broadcast.
    """
    if order_filter is not None:
        orders = orders.filter(order_filter)
    # Feeds the diversity and the mix: built once, so items are read once.
    bought = materialize(_customer_categories(orders, items, variants, products, category_col))
    m = _customer_metrics(orders, bought)
    qual = m.filter(F.col("category_diversity") >= min_categories)
    if rank_by_rounded:
        key = mean_half_up(F.col("revenue"), F.col("frequency"))
    else:
        key = F.col("revenue") / F.col("frequency")
    elite = (qual.orderBy(key.desc_nulls_first(), F.col("customer_id").asc_nulls_last())
             .limit(n).select("customer_id"))
    return (bought.join(F.broadcast(elite), "customer_id")
            .join(categories.select(F.col("id").alias("category_id"),
                                    F.col("name").alias("category")), "category_id")
            .groupBy("category_id", "category")
            .agg(F.sum("units").alias("items_bought"), F.sum("orders").alias("orders_involved"))
            .orderBy(F.col("items_bought").desc_nulls_first(), F.col("category_id")))
