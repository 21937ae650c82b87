"""Reports the documentation states (the report file is absent)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.numeric import mean_half_up, pct_half_up


def revenue_summary(order_fact: DataFrame, money_scale: int = 2) -> DataFrame:
    """Realised orders, revenue, discount and average ticket, beside the
    totals that ignore the status (the gap the flag exists to expose): the
    share of the summed value that is not realised, and how much an
    unfiltered sum overstates the realised revenue, both in percent."""
    real = F.col("is_realised")
    has_discount = "discount_amount" in order_fact.columns
    aggs = [
        F.count(F.lit(1)).alias("orders_all"),
        F.sum("total").alias("total_all"),
        F.count_if(real).alias("orders_realised"),
        F.sum(F.when(real, F.col("total"))).alias("revenue_realised"),
    ]
    if has_discount:
        aggs.append(F.sum(F.when(real, F.col("discount_amount"))).alias("discount_realised"))
    g = order_fact.agg(*aggs)
    cols = ["orders_all", "total_all", "orders_realised", "revenue_realised"]
    if has_discount:
        cols.append("discount_realised")
    unrealised = F.col("total_all") - F.col("revenue_realised")
    return g.select(*cols, mean_half_up(F.col("revenue_realised"), F.col("orders_realised"))
                    .alias("avg_ticket_realised"),
                    pct_half_up(unrealised, F.col("total_all"), in_scale=money_scale)
                    .alias("unrealised_share_pct"),
                    pct_half_up(unrealised, F.col("revenue_realised"), in_scale=money_scale)
                    .alias("overstatement_pct"))


def category_mix(item_fact: DataFrame, product_dim: DataFrame,
                 realised_only: bool = True) -> DataFrame:
    """Items, units, revenue and orders per category over the item
    fact (variant grain joins the variant-grain product dimension)."""
    f = item_fact.filter(F.col("is_realised")) if realised_only else item_fact
    j = f.join(product_dim.select("variant_id", "category_id", "category"), "variant_id", "left")
    return j.groupBy("category_id", "category").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("quantity").alias("units"),
        F.sum("line_total").alias("revenue"),
        F.count_distinct("order_id").alias("orders"))


def returns_by_reason(return_fact: DataFrame) -> DataFrame:
    """Returned items, refund value and distinct raw spellings per
    cleaned reason, plus how many rows no rule explained."""
    return return_fact.groupBy("reason").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("refund_value").alias("refund_value"),
        F.count_distinct(F.coalesce(F.col("reason_original"), F.lit("<null>")))
        .alias("raw_spellings"),
        F.count_if(~F.col("reason_matched")).alias("unmatched"))


def channel_location_crosstab(order_fact: DataFrame, location_dim: DataFrame) -> DataFrame:
    """Orders per (channel, location type); shows sales channels that
    point at locations of the wrong kind."""
    j = order_fact.join(location_dim.select("location_id", "type"), "location_id", "left")
    return j.groupBy("channel", F.col("type").alias("location_type")).agg(
        F.count(F.lit(1)).alias("orders"))


def item_order_reconcile(items: DataFrame, orders: DataFrame,
                         order_value: str = "subtotal") -> DataFrame:
    """Per order, the item sum against the order's stated value;
    summarised by outcome (match, mismatch, order without items, items
    without order)."""
    per = items.groupBy(F.col("order_id").alias("id")).agg(
        F.sum("line_total").alias("item_sum"))
    j = orders.select("id", F.col(order_value).alias("stated"),
                      F.lit(True).alias("_has_order")).join(per, "id", "full")
    status = (F.when(F.col("_has_order").isNull(), "items_without_order")
              .when(F.col("item_sum").isNull(), "order_without_items")
              .when(F.col("item_sum") == F.col("stated"), "match")
              .otherwise("mismatch"))
    return j.groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.abs(F.coalesce("item_sum", F.lit(0)) - F.coalesce("stated", F.lit(0))))
        .alias("abs_difference"))
