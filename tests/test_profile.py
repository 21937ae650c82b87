import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillsight.operators import profile

SCHEMA = ("id long, order_number string, channel string, salesperson_id long, status string, "
          "subtotal decimal(8,2), discount_amount decimal(7,2), total decimal(8,2), "
          "placed_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz")


def _orders(spark):
    t = dt.datetime
    rows = [
        (1, "A1", "pos", 7, "paid", Decimal("1.00"), Decimal("0.00"), Decimal("1.00"),
         t(2024, 1, 1), t(2024, 1, 1), t(2024, 1, 2)),
        (2, "A2", "ecommerce", None, "paid", Decimal("2.00"), Decimal("3.00"), Decimal("1.50"),
         t(2024, 1, 1), t(2024, 1, 2), t(2024, 1, 1)),
        (2, "A2", "ecommerce", None, "draft", Decimal("3.00"), Decimal("0.00"), Decimal("2.00"),
         t(2025, 1, 1), t(2025, 1, 1), t(2025, 1, 1)),
        (4, "A4", "pos", 3, "cancelled", Decimal("5.00"), Decimal("0.00"), Decimal("0.00"),
         t(2025, 6, 1), t(2025, 6, 1, 12), t(2025, 6, 2)),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_quartiles_are_continuous_on_doubles(spark):
    # 1.675 from DOUBLE interpolation (DuckDB on DECIMAL(8,2) would say 1.67).
    df = spark.createDataFrame([(Decimal(x),) for x in ("1.00", "1.50", "1.90", "2.00")],
                               "total decimal(8,2)")
    r = profile.numeric_distribution(df, "total").first()
    assert abs(r["q1"] - 1.375) < 1e-12 and abs(r["median"] - 1.7) < 1e-12
    assert abs(r["q3"] - 1.925) < 1e-12
    assert r["mean_value"] == 1.6 and r["min_value"] == Decimal("1.00")


def test_overview_and_column_profile(spark):
    o = _orders(spark)
    r = profile.table_overview(o, "created_at").first()
    assert (r["total_rows"], r["total_columns"]) == (4, 11)
    cp = {x["column"]: x for x in profile.column_profile(o).collect()}
    assert cp["salesperson_id"]["null_count"] == 2
    assert cp["salesperson_id"]["nullable"] and not cp["id"]["nullable"]
    assert cp["id"]["distinct_count"] == 3 and cp["id"]["ordinal"] == 1
    assert cp["id"]["data_type"] == "BIGINT" and cp["channel"]["data_type"] == "VARCHAR"
    for c in o.columns:
        assert cp[c]["distinct_count"] == o.select(c).dropna().distinct().count(), c
    dp = {x["column"]: x for x in profile.column_profile(o, distinct="approx").collect()}
    assert dp["id"]["distinct_count"] == 3  # few values: the sketch is exact
    none = profile.column_profile(o, distinct=None).collect()
    assert all(x["distinct_count"] is None for x in none)


def test_distinct_counts_of_awkward_columns(spark):
    df = spark.createDataFrame([(1, None, "a", [1]), (1, None, "", [1]), (2, None, None, None), (None, None, "a", [2, 1])],
                               "`a.b` int, empty string, s string, l array<int>")
    assert [r["distinct_count"] for r in profile.distinct_counts(df).orderBy("ordinal").collect()] == [2, 0, 2, 2]
    assert [r["distinct_count"] for r in profile.distinct_counts(df.limit(0)).collect()] == [0] * 4
    plan = spark._jvm.PythonSQLUtils.explainString(profile.column_profile(df)._jdf.queryExecution(), "simple")
    assert "Expand" not in plan


def test_null_pattern_and_share(spark):
    o = _orders(spark)
    npat = {r["channel"]: r for r in profile.null_pattern(o, "channel", "salesperson_id").collect()}
    assert npat["ecommerce"]["pct_null"] == 100.0 and npat["pos"]["nulls"] == 0
    share = profile.share_of_total(o, "status", "total").collect()
    assert abs(sum(r["pct_rows"] for r in share) - 100.0) < 0.2
    paid = [r for r in share if r["status"] == "paid"][0]
    assert paid["value_sum"] == Decimal("2.50") and paid["pct_value"] == 55.6


def test_yearly_future_uses_midnight(spark):
    # T5: a row later on the reference day counts as future.
    o = _orders(spark)
    rows = {r["year"]: r for r in profile.yearly_future(o, "created_at", "2025-06-01").collect()}
    assert rows[2025]["future_rows"] == 1 and rows[2024]["future_rows"] == 0


def test_integrity_panel(spark):
    o = _orders(spark)
    r = profile.integrity_panel(o, {"dup_ids": ["id"], "dup_numbers": ["order_number"]},
                                profile.order_checks()).first()
    assert r["rows"] == 4 and r["dup_ids"] == 1 and r["dup_numbers"] == 1
    assert r["total_non_positive"] == 1
    assert r["discount_gt_subtotal"] == 1
    assert r["arithmetic_broken"] == 3
    assert r["updated_before_created"] == 1
    assert r["placed_equals_created"] == 2


def test_iqr_outliers(spark):
    vals = [Decimal(str(x)) for x in (1, 2, 3, 4, 5, 6, 7, 8, 100)]
    df = spark.createDataFrame([(v,) for v in vals], "total decimal(8,2)")
    r = profile.iqr_outliers(df, "total").first()
    assert (r["q1"], r["q3"], r["iqr"]) == (3.0, 7.0, 4.0)
    assert r["upper_fence"] == 13.0 and r["lower_fence"] == -3.0 and r["outliers"] == 1
    for method in ("approx", "single"):
        assert profile.iqr_outliers(df, "total", method=method).first()["outliers"] == 1


def test_exact_quantiles_with_a_hot_value(spark):
    from tillsight.operators.quantiles import exact_quantiles
    vals = [float(v) for v in range(1, 301)] + [7.0] * 150
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    import numpy as np
    want = [float(np.quantile(vals, p)) for p in (0.25, 0.5, 0.75)]
    for size in (7, 20, 200_000):  # many ranges or one: the same steps and answers
        assert list(exact_quantiles(df, "v", [0.25, 0.5, 0.75], accuracy=10, small=size).first()) == want


def test_exact_quantiles_order_nan_last(spark):
    import math

    from tillsight.operators.quantiles import exact_quantiles
    nan = float("nan")
    df = spark.createDataFrame([(v,) for v in (1.0, nan, 3.0, 2.0, nan, 4.0, None)], "v double")
    for size in (1, 2, 200_000):
        q = list(exact_quantiles(df, "v", [0.0, 0.4, 0.5, 0.9], accuracy=10, small=size).first())
        assert q[:3] == [1.0, 3.0, 3.5] and math.isnan(q[3])
    none = df.filter("v IS NULL")
    assert list(exact_quantiles(none, "v", [0.5]).first()) == [None]


def test_multi_column_duplicates_count_rows_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a long, b long")
    r = profile.integrity_panel(df, {"dup_ab": ["a", "b"], "dup_b": ["b"]}, {}).first()
    assert r["dup_ab"] == 1      # (1, null) twice: one duplicate, as in SQL
    assert r["dup_b"] == 2       # single column: nulls are not values
