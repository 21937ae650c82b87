"""Property checks on the driver's tables and SQL over views."""

import os

import pytest
from pyspark.sql import functions as F

from tillsight.operators import facts, forecast, recommend, segment
from tillsight.operators.weekday import weekday_mean
from tillsight.plans import bindings as B
from tillsight.plans import registry as R
from tillsight.plans.views import register_star_schema

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


def test_item_fact_keeps_every_item(spark):
    items = B.order_items(spark, SF)
    assert facts.order_item_fact(items, B.orders(spark, SF)).count() == items.count()


def test_series_is_dense(spark):
    s = R._series(spark, SF)
    per = s.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("month").alias("lo"),
                                F.max("month").alias("hi"))
    bad = per.filter(F.col("n") != F.months_between("hi", "lo").cast("int") + 1)
    assert bad.count() == 0


def test_cosine_symmetric_bounded(spark):
    pairs = R._pairs(spark, SF)
    every = pairs.select("product_id").distinct()
    cos = recommend.item_cosine(pairs, every, checkpoint=False)
    r = cos.agg(F.min("similarity"), F.max("similarity"),
                F.count_if(F.col("product_a") == F.col("product_b"))).first()
    assert r[0] > 0 and r[1] <= 1.0 + 1e-12 and r[2] == 0
    turned = cos.selectExpr("product_b AS product_a", "product_a AS product_b", "common_buyers",
                            "buyers_b AS buyers_a", "buyers_a AS buyers_b", "similarity")
    assert cos.exceptAll(turned).count() == 0


def test_order_filter_restricts(spark):
    o, i, v, p = (B.orders(spark, SF), B.order_items(spark, SF), B.product_variants(spark, SF),
                  B.products(spark, SF))
    all_pairs = recommend.purchase_pairs(i, o, v).count()
    some = recommend.purchase_pairs(i, o, v, order_filter=F.col("status") == "F").count()
    assert 0 < some < all_pairs
    s_all = forecast.monthly_demand(i, o, v, p).agg(F.sum("units")).first()[0]
    s_f = forecast.monthly_demand(i, o, v, p, order_filter=F.col("status") == "F") \
        .agg(F.sum("units")).first()[0]
    assert s_f < s_all
    top = segment.elite_customers(o, i, v, p, min_categories=1, n=3,
                                  order_filter=F.col("status") == "F")
    assert top.count() == 3


def test_sql_over_registered_views(spark):
    names = register_star_schema(spark, SF)
    assert "dim_calendar" in names and "fct_returns" in names
    via_sql = spark.sql("""
        WITH daily AS (
          SELECT CAST(placed_at AS DATE) AS data, SUM(total) AS valor
          FROM raw_orders WHERE channel = '1-URGENT' GROUP BY CAST(placed_at AS DATE))
        SELECT c.iso_weekday, COUNT(*) AS days, COUNT(v.data) AS with_sales
        FROM dim_calendar c LEFT JOIN daily v ON v.data = c.date
        WHERE c.in_sales_period GROUP BY c.iso_weekday""")
    op = weekday_mean(spark.table("raw_orders"), spark.table("dim_calendar"), channel="1-URGENT")
    a = {r[0]: (r[1], r[2]) for r in via_sql.collect()}
    b = {r["iso_weekday"]: (r["days_in_period"], r["days_with_sales"]) for r in op.collect()}
    assert a == b
    assert spark.sql("SELECT COUNT(*) FROM fct_order_items").first()[0] == \
        spark.table("raw_order_items").count()
