import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillsight.operators.calendar import calendar_dim
from tillsight.operators.weekday import weekday_mean

ORD = "id long, channel string, total decimal(18,2), placed_at timestamp_ntz"
RET = "id long, created_at timestamp_ntz"


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_calendar_spans_sales_and_returns(spark):
    orders = spark.createDataFrame(
        [(1, "pos", Decimal("10.00"), ts("2024-01-30 10:00:00")),
         (2, "pos", Decimal("5.00"), ts("2024-02-02 23:59:59"))], ORD)
    returns = spark.createDataFrame([(1, ts("2024-02-05 08:00:00"))], RET)
    cal = calendar_dim(orders, others=[(returns, "created_at")]).orderBy("date").collect()
    assert len(cal) == 7
    assert cal[0]["date"] == dt.date(2024, 1, 30) and cal[-1]["date"] == dt.date(2024, 2, 5)
    assert [r["in_sales_period"] for r in cal] == [True] * 4 + [False] * 3
    assert cal[0]["iso_weekday"] == 2 and cal[0]["weekday_name"] == "Terça-feira"
    assert cal[3]["first_day_of_month"] == dt.date(2024, 2, 1)


def test_calendar_without_returns_keeps_sales_bounds(spark):
    orders = spark.createDataFrame(
        [(1, "pos", Decimal("1.00"), ts("2024-01-30 10:00:00")),
         (2, "pos", Decimal("1.00"), ts("2024-02-02 10:00:00"))], ORD)
    empty = spark.createDataFrame([], RET)
    assert calendar_dim(orders, others=[(empty, "created_at")]).count() == 4


def test_iso_week_and_weekend(spark):
    orders = spark.createDataFrame([(1, "pos", Decimal("1.00"), ts("2021-01-03 00:00:00"))], ORD)
    row = calendar_dim(orders).first()
    assert row["week_of_year"] == 53 and row["iso_weekday"] == 7 and row["is_weekend"]


def test_calendar_has_no_gaps(spark):
    orders = spark.createDataFrame(
        [(1, "pos", Decimal("1.00"), ts("2023-12-25 00:00:00")),
         (2, "pos", Decimal("1.00"), ts("2024-03-10 00:00:00"))], ORD)
    cal = calendar_dim(orders)
    assert cal.count() == cal.select("date").distinct().count() == 77


def test_weekday_true_mean_counts_zero_days(spark):
    # Two Mondays in the period, sales on one: true mean 5, naive mean 10.
    # Sunday has no sale at all: true mean 0, naive mean null.
    orders = spark.createDataFrame(
        [(1, "pos", Decimal("10.00"), ts("2024-01-01 09:00:00")),   # Monday
         (2, "pos", Decimal("3.00"), ts("2024-01-06 09:00:00")),    # Saturday
         (3, "ecommerce", Decimal("99.00"), ts("2024-01-07 09:00:00")),  # Sunday, other channel
         (4, "pos", Decimal("1.00"), ts("2024-01-08 09:00:00"))],   # Monday
        ORD)
    orders = orders.filter(F.col("id") != 4).unionByName(
        spark.createDataFrame([(5, "ecommerce", Decimal("1.00"), ts("2024-01-08 09:00:00"))], ORD))
    cal = calendar_dim(orders)
    rep = {r["iso_weekday"]: r for r in weekday_mean(orders, cal, channel="pos").collect()}
    mon = rep[1]
    assert (mon["days_in_period"], mon["days_with_sales"], mon["days_without_sales"]) == (2, 1, 1)
    assert mon["mean_daily"] == 5.0 and mon["mean_sale_days_only"] == 10.0
    sun = rep[7]
    assert sun["mean_daily"] == 0.0 and sun["mean_sale_days_only"] is None
    assert sun["total_sold"] == Decimal("0.00")
