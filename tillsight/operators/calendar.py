"""Calendar dimension covering every fact's date range."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.dates import iso_week, iso_weekday, month_start
from tillsight.functions.labels import MONTH_NAMES, WEEKDAY_NAMES, label_of


def calendar_dim(sales: DataFrame, sales_date: str = "placed_at",
                 others: Sequence[tuple[DataFrame, str]] = (),
                 weekday_names: Mapping[int, str] = WEEKDAY_NAMES,
                 month_names: Mapping[int, str] = MONTH_NAMES) -> DataFrame:
    """One row per day from the first to the last date of any fact.

    ``sales`` sets the sales period (``in_sales_period``); ``others`` are
    further ``(frame, date column)`` facts, such as returns, that only widen
    the range. All date columns go through one union and one global
    aggregate (partial min/max per partition, so the shuffle is a handful of
    rows); bounds that are null on one side are skipped, as LEAST/GREATEST
    do. The day sequence is generated from that single row; its length is
    the date span, not the data size.
    """
    dates = sales.select(F.to_date(F.col(sales_date)).alias("d"), F.lit(True).alias("is_sale"))
    for frame, col in others:
        dates = dates.unionByName(
            frame.select(F.to_date(F.col(col)).alias("d"), F.lit(False).alias("is_sale")))
    bounds = dates.agg(
        F.min("d").alias("lo"), F.max("d").alias("hi"),
        F.min(F.when(F.col("is_sale"), F.col("d"))).alias("first_sale"),
        F.max(F.when(F.col("is_sale"), F.col("d"))).alias("last_sale"),
    )
    days = bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"),
        "first_sale", "last_sale")
    d = F.col("date")
    dow = iso_weekday(d)
    return days.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayofyear(d).alias("day_of_year"),
        iso_week(d).alias("week_of_year"),
        dow.alias("iso_weekday"),
        label_of(dow, weekday_names, F.lit(None).cast("string")).alias("weekday_name"),
        label_of(F.month(d), month_names, F.lit(None).cast("string")).alias("month_name"),
        (dow >= 6).alias("is_weekend"),
        d.between(F.col("first_sale"), F.col("last_sale")).alias("in_sales_period"),
        month_start(d).alias("first_day_of_month"),
    )
