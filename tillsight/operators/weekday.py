"""Calendar-complete mean of daily sales per weekday."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.numeric import mean_half_up


def weekday_mean(orders: DataFrame, calendar: DataFrame, channel: str | None = "pos",
                 channel_col: str = "channel", date_col: str = "placed_at",
                 value_col: str = "total", sales_period_only: bool = True) -> DataFrame:
    """Daily totals of one channel, left-joined to the calendar so days
    without sales count as zero; per ISO weekday: days, days with and without
    sales, total, the true mean and the naive mean that skips empty days.

    The daily aggregate is combined map-side before its shuffle and has one
    row per day, and the calendar is bounded by the date span, so the join
    is small whatever the order volume; AQE broadcasts it at run time.
    """
    src = orders if channel is None else orders.filter(F.col(channel_col) == F.lit(channel))
    daily = src.groupBy(F.to_date(F.col(date_col)).alias("date")).agg(
        F.sum(value_col).alias("value"), F.lit(1).alias("sold"))
    cal = calendar.filter(F.col("in_sales_period")) if sales_period_only else calendar
    joined = cal.select("date", "iso_weekday", "weekday_name").join(daily, "date", "left")
    agg = joined.groupBy("iso_weekday", "weekday_name").agg(
        F.count(F.lit(1)).alias("days_in_period"),
        F.count("sold").alias("days_with_sales"),
        F.sum(F.coalesce(F.col("value"), F.lit(0))).alias("total_sold"),
        F.sum("value").alias("sales_sum"),
    )
    return agg.select(
        "iso_weekday", "weekday_name", "days_in_period", "days_with_sales",
        (F.col("days_in_period") - F.col("days_with_sales")).alias("days_without_sales"),
        "total_sold",
        mean_half_up(F.col("total_sold"), F.col("days_in_period")).alias("mean_daily"),
        mean_half_up(F.col("sales_sum"), F.col("days_with_sales")).alias("mean_sale_days_only"),
    ).orderBy(F.col("mean_daily").asc_nulls_last(), F.col("iso_weekday"))
