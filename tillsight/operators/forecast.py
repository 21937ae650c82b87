"""Monthly demand series, moving-average forecast, evaluation.

All keys (product names) are processed in one job; pass ``name`` to restrict
to one. Forecast arithmetic stays in integers until one final division, so
results do not depend on the order in which partitions are summed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class ForecastError(ValueError):
    pass


def _month(s: str) -> str:
    return s if len(s) > 7 else f"{s}-01"


def monthly_demand(items: DataFrame, orders: DataFrame, variants: DataFrame,
                   products: DataFrame, name: str | None = None,
                   extend_to: str | None = None, order_filter=None) -> DataFrame:
    """Units per month of every product name (all variants of all
    products sharing it), zero-filled between the name's first and last
    month with sales (or up to ``extend_to``). No status filter unless
    ``order_filter`` (a Column over the orders) is given.

    Products are filtered first and semi-joined down to items, so a
    one-name series reads only that name's items; the gaps are filled from
    the monthly rows themselves, so the sales are read once.
    """
    if order_filter is not None:
        orders = orders.filter(order_filter)
    prods = products.select(F.col("id").alias("product_id"), "name")
    if name is not None:
        prods = prods.filter(F.col("name") == F.lit(name))
    var = variants.select(F.col("id").alias("product_variant_id"), "product_id").join(
        prods, "product_id")
    sold = (items.select("order_id", "product_variant_id", "quantity")
            .join(var.select("product_variant_id", "name"), "product_variant_id")
            .join(orders.select(F.col("id").alias("order_id"), "placed_at"), "order_id"))
    monthly = sold.groupBy("name", F.trunc(F.to_date("placed_at"), "month").alias("month")).agg(
        F.sum("quantity").cast("long").alias("units"))
    # Each month with sales stands for itself and the empty months up to the
    # name's next one, so the series needs no second pass over the sales.
    w = Window.partitionBy("name").orderBy("month")
    last = F.col("month") if extend_to is None else F.greatest(
        "month", F.lit(_month(extend_to)).cast("date"))
    until = F.coalesce(F.add_months(F.lead("month").over(w), -1), last)
    return (monthly.withColumn("until", until)
            .select("name", "units", F.posexplode(F.sequence("month", "until", F.expr("INTERVAL 1 MONTH")))
                    .alias("gap", "month"))
            .select("name", "month", F.when(F.col("gap") == 0, F.coalesce("units", F.lit(0)))
                    .otherwise(0).cast("long").alias("units")))


def moving_average_forecast(series: DataFrame, train_end: str, test_months: Sequence[str],
                            window: int = 3, strict: bool = False) -> DataFrame:
    """Mean of the last ``window`` training months (months up to
    ``train_end``, cut before anything is computed), repeated flat for every
    test month; predictions never feed back. Keys with fewer than ``window``
    training months come out with a NULL forecast and the status ``short``
    (``strict=True`` raises instead, as the reference does).

    One window partitioned by key, a few hundred rows each; no join.
    """
    end = F.lit(_month(train_end)).cast("date")
    train = F.col("month") <= end
    w = Window.partitionBy("name").orderBy(train.desc(), F.col("month").desc())
    per_key = series.withColumn("_rn", F.row_number().over(w)).groupBy("name").agg(
        F.count_if(train).alias("train_months"),
        F.sum(F.when(train & (F.col("_rn") <= window), F.col("units"))).alias("window_units"))
    enough = F.col("train_months") >= window
    if strict:
        bad = per_key.filter(~enough)
        few = [r["name"] for r in bad.orderBy("name").limit(20).collect()]
        if few:
            raise ForecastError(f"training series shorter than the window of {window}: "
                                f"{bad.count()} names, from {few}")
    units = F.when(enough, F.col("window_units"))
    return per_key.select(
        "name", F.explode(F.array(*[F.lit(_month(m)).cast("date") for m in test_months])).alias("month"),
        (units.cast("double") / F.lit(float(window))).alias("forecast"),
        units.alias("window_units"), F.lit(window).alias("window"),
        F.when(enough, "ok").otherwise("short").alias("status"))


def forecast_evaluation(series: DataFrame, forecast: DataFrame) -> DataFrame:
    """U29 detail: forecast, actual (missing month -> 0) and absolute error
    (NULL without a forecast) per key and test month."""
    j = forecast.join(series, ["name", "month"], "left")
    actual = F.coalesce(F.col("units"), F.lit(0)).cast("long")
    k = F.col("window").cast("long")
    return j.select(
        "name", "month", "forecast", actual.alias("actual"),
        # |actual - S/k| = |k*actual - S| / k: one exact division.
        (F.abs(k * actual - F.col("window_units")).cast("double") / k.cast("double"))
        .alias("abs_error"),
        "window_units", "window")


def forecast_summary(evaluation: DataFrame) -> DataFrame:
    """U29 summary per key: MAE, predicted total (and rounded half-even, as
    Python's ``round``), actual total."""
    g = evaluation.groupBy("name").agg(
        F.count(F.lit(1)).alias("months"),
        F.sum(F.abs(F.col("window").cast("long") * F.col("actual") - F.col("window_units")))
        .alias("_err_k"),
        F.sum("window_units").alias("_pred_k"),
        F.first("window").alias("_k"),
        F.sum("actual").alias("actual_total"))
    k = F.col("_k").cast("double")
    pred_total = F.col("_pred_k").cast("double") / k
    return g.select(
        "name", "months",
        (F.col("_err_k").cast("double") / (k * F.col("months").cast("double"))).alias("mae"),
        pred_total.alias("predicted_total"),
        F.bround(pred_total, 0).alias("predicted_total_rounded"),
        F.col("actual_total").cast("long").alias("actual_total"))


def series_summary(series: DataFrame) -> DataFrame:
    """Per key: first and last month, number of months and total units (the
    header the reference prints for a series)."""
    return series.groupBy("name").agg(
        F.min("month").alias("first_month"), F.max("month").alias("last_month"),
        F.count(F.lit(1)).alias("months"), F.sum("units").cast("long").alias("units"))


def training_window(series: DataFrame, train_end: str, window: int = 3) -> DataFrame:
    """The last ``window`` training months of every key (the values the
    moving average is taken over), newest first as ``position`` 1."""
    end = F.lit(_month(train_end)).cast("date")
    w = Window.partitionBy("name").orderBy(F.col("month").desc())
    return (series.filter(F.col("month") <= end)
            .withColumn("position", F.row_number().over(w))
            .filter(F.col("position") <= window)
            .select("name", "month", "units", F.col("position").cast("int").alias("position")))


def forecast_product(items: DataFrame, orders: DataFrame, variants: DataFrame,
                     products: DataFrame, name: str, train_end: str,
                     test_months: Sequence[str], window: int = 3) -> DataFrame:
    """U27-U29 for one product name, as the reference's script runs them:
    an unknown name or a training series shorter than ``window`` is an
    error; the result is the evaluation per test month. Products sharing the
    name are summed."""
    if products.filter(F.col("name") == F.lit(name)).limit(1).count() == 0:
        raise ForecastError(f"product not in the catalogue: {name!r}")
    series = monthly_demand(items, orders, variants, products, name=name)
    fc = moving_average_forecast(series, train_end, test_months, window, strict=True)
    return forecast_evaluation(series, fc)
