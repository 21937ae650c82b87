import datetime as dt

import pytest

from tillsight.operators import forecast as fc


def _frames(spark, sales):
    products = spark.createDataFrame([(1, "Bússola"), (2, "Bússola"), (3, "Remo")],
                                     "id long, name string")
    variants = spark.createDataFrame([(11, 1), (12, 2), (13, 3)], "id long, product_id long")
    orders = spark.createDataFrame([(i, dt.datetime.fromisoformat(d)) for i, (d, _, _) in enumerate(sales)],
                                   "id long, placed_at timestamp_ntz")
    items = spark.createDataFrame([(i, v, q) for i, (_, v, q) in enumerate(sales)],
                                  "order_id long, product_variant_id long, quantity int")
    return items, orders, variants, products


def test_series_sums_same_name_and_fills_gaps(spark):
    # Sales in January and April only: four months, two zeros (T23 range).
    items, orders, variants, products = _frames(spark, [
        ("2025-01-10 10:00:00", 11, 2), ("2025-01-20 10:00:00", 12, 3),
        ("2025-04-02 10:00:00", 11, 4)])
    s = fc.monthly_demand(items, orders, variants, products, name="Bússola").orderBy("month")
    assert [(r["month"], r["units"]) for r in s.collect()] == [
        (dt.date(2025, 1, 1), 5), (dt.date(2025, 2, 1), 0), (dt.date(2025, 3, 1), 0),
        (dt.date(2025, 4, 1), 4)]


def test_forecast_cut_before_average_and_evaluation(spark):
    items, orders, variants, products = _frames(spark, [
        ("2025-09-10 10:00:00", 11, 3), ("2025-10-10 10:00:00", 11, 6),
        ("2025-11-10 10:00:00", 11, 9), ("2025-12-10 10:00:00", 11, 1),
        ("2026-01-10 10:00:00", 11, 100), ("2026-03-10 10:00:00", 11, 4)])
    s = fc.monthly_demand(items, orders, variants, products)
    f = fc.moving_average_forecast(s, "2025-12", ["2026-01", "2026-02", "2026-03"], window=3)
    rows = f.orderBy("month").collect()
    assert [r["forecast"] for r in rows] == [16 / 3] * 3   # Jan 2026 (100) never leaks in
    ev = fc.forecast_evaluation(s, f).orderBy("month").collect()
    assert [r["actual"] for r in ev] == [100, 0, 4]
    summ = fc.forecast_summary(fc.forecast_evaluation(s, f)).first()
    assert summ["actual_total"] == 104 and summ["predicted_total"] == 16.0
    assert summ["predicted_total_rounded"] == 16.0
    expected_mae = (abs(100 - 16 / 3) + abs(0 - 16 / 3) + abs(4 - 16 / 3)) / 3
    assert abs(summ["mae"] - expected_mae) < 1e-12


def test_short_training_series(spark):
    items, orders, variants, products = _frames(spark, [
        ("2025-01-10 10:00:00", 11, 2), ("2025-04-02 10:00:00", 11, 4)])
    s = fc.monthly_demand(items, orders, variants, products)
    f = fc.moving_average_forecast(s, "2025-12", ["2026-01"], window=5)
    assert [(r["forecast"], r["status"]) for r in f.collect()] == [(None, "short")]
    ev = fc.forecast_evaluation(s, f).first()
    assert ev["abs_error"] is None and ev["actual"] == 0
    with pytest.raises(fc.ForecastError):
        fc.moving_average_forecast(s, "2025-12", ["2026-01"], window=5, strict=True)


def test_series_starting_after_training_end_is_short(spark):
    items, orders, variants, products = _frames(spark, [("2026-02-10 10:00:00", 11, 2)])
    s = fc.monthly_demand(items, orders, variants, products)
    assert [r["status"] for r in fc.moving_average_forecast(s, "2025-12", ["2026-01"], window=1).collect()] == ["short"]
    with pytest.raises(fc.ForecastError):
        fc.moving_average_forecast(s, "2025-12", ["2026-01"], window=1, strict=True)


def test_known_product_without_sales_is_empty(spark):
    # No crash, empty series.
    items, orders, variants, products = _frames(spark, [("2025-01-10 10:00:00", 11, 2)])
    assert fc.monthly_demand(items, orders, variants, products, name="Remo").count() == 0


def test_forecast_product_by_name(spark):
    items, orders, variants, products = _frames(spark, [
        ("2025-10-10 10:00:00", 11, 3), ("2025-11-10 10:00:00", 12, 6),
        ("2025-12-10 10:00:00", 11, 9), ("2026-01-10 10:00:00", 11, 1)])
    ev = fc.forecast_product(items, orders, variants, products, "Bússola", "2025-12",
                             ["2026-01", "2026-02"], window=3).orderBy("month").collect()
    assert [(r["forecast"], r["actual"]) for r in ev] == [(6.0, 1), (6.0, 0)]
    with pytest.raises(fc.ForecastError):
        fc.forecast_product(items, orders, variants, products, "Nada", "2025-12", ["2026-01"])
    # A known name without sales gives an empty result, not a crash.
    assert fc.forecast_product(items, orders, variants, products, "Remo", "2025-12",
                               ["2026-01"]).count() == 0


def test_extend_to_pads_the_series_to_the_training_end(spark):
    # By default the last k observed months are averaged; extend_to adds
    # zero months up to the training end first.
    items, orders, variants, products = _frames(spark, [
        ("2025-08-10 10:00:00", 11, 3), ("2025-09-10 10:00:00", 11, 6),
        ("2025-10-10 10:00:00", 11, 9)])
    plain = fc.monthly_demand(items, orders, variants, products)
    padded = fc.monthly_demand(items, orders, variants, products, extend_to="2025-12")
    assert plain.count() == 3 and padded.count() == 5
    f_plain = fc.moving_average_forecast(plain, "2025-12", ["2026-01"], window=3).first()
    f_padded = fc.moving_average_forecast(padded, "2025-12", ["2026-01"], window=3).first()
    assert f_plain["forecast"] == 6.0 and f_padded["forecast"] == 3.0


def test_sales_are_read_once(spark):
    """The executed plans scan lineitem once."""
    from tillsight.plans import registry as R
    for name in ("monthly_demand", "series_summary", "training_window", "moving_average_forecast"):
        df = R.queries()[name](spark, "/root/testdata/sf0.001")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("l_partkey") and sum(
            "FileScan" in line and "lineitem" in line for line in plan.splitlines()) == 1, name
