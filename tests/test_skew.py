"""Hot-key correctness: a third of all orders moved to one customer.

The skewed orders are derived from the driver's tables; Spark results are
checked against DuckDB brute force over the same derivation.
"""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tillsight.operators import recommend, segment
from tillsight.plans import bindings as B

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
HOT = 0


def _skewed_orders(spark):
    o = B.orders(spark, SF)
    return o.withColumn("customer_id", F.when(F.col("id") % 3 == 0, F.lit(HOT))
                        .otherwise(F.col("customer_id")))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("orders", "lineitem", "part"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    c.execute(f"""CREATE VIEW pairs AS SELECT DISTINCT
                    CASE WHEN o.o_orderkey % 3 = 0 THEN {HOT} ELSE o.o_custkey END AS c,
                    l.l_partkey AS p
                  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""")
    return c


def test_hot_customer_pairs_and_cosine(spark, duck):
    pairs = recommend.purchase_pairs(B.order_items(spark, SF), _skewed_orders(spark),
                                     B.product_variants(spark, SF))
    got_pairs = {(r[0], r[1]) for r in pairs.collect()}
    exp_pairs = set(duck.execute("SELECT c, p FROM pairs").fetchall())
    assert got_pairs == exp_pairs
    hot_basket = {p for c, p in exp_pairs if c == HOT}
    assert hot_basket == {p for _, p in exp_pairs}   # the hot customer bought everything
    refs = pairs.filter("product_id % 10 = 0").select("product_id")
    got = {(r[0], r[1]): r[2] for r in recommend.item_cosine(pairs, refs).collect()}
    exp = dict(((a, b), n) for a, b, n in duck.execute(
        "SELECT x.p, y.p, COUNT(*) FROM pairs x JOIN pairs y ON x.c = y.c AND x.p <> y.p "
        "WHERE x.p % 10 = 0 GROUP BY 1, 2").fetchall())
    assert got == exp


def test_hot_customer_segmentation(spark, duck):
    o = _skewed_orders(spark)
    top = segment.elite_customers(o, B.order_items(spark, SF), B.product_variants(spark, SF),
                                  B.products(spark, SF), min_categories=1, n=500,
                                  category_col="brand_id")
    got = {r["customer_id"]: (r["frequency"], r["revenue"]) for r in top.collect()}
    exp = dict((c, (n, rev)) for c, n, rev in duck.execute(f"""
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN {HOT} ELSE o_custkey END AS c, COUNT(*),
               SUM(CAST(o_totalprice AS DECIMAL(18,2)))
        FROM orders GROUP BY 1""").fetchall())
    assert got[HOT] == exp[HOT]
    for c, v in got.items():
        assert v == exp[c]


def test_hot_customer_and_hot_variant_are_split(spark):
    """The executed plans cut the hot key's partition into several reads."""
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # A third of all rows on one key, against one row a key; both sides in many files.
        rows = spark.range(0, 60_000, numPartitions=8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 5000 END AS k", "id AS order_id",
            "CASE WHEN id % 3 = 1 THEN 11 ELSE id % 5000 END AS product_variant_id")
        names = spark.range(5000).selectExpr("id AS customer_id", "uuid() AS name")
        variants = spark.range(5000).selectExpr("id", "id % 40 AS product_id")
        for df in (rows.join(names, rows.k == names.customer_id),
                   rows.join(variants, rows.product_variant_id == variants.id)):
            df.write.format("noop").mode("overwrite").save()
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "skewed" in plan.split("Initial Plan")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_customer_categories_deal_items_by_order(spark, monkeypatch):
    """As many tasks as the items need, whatever the session's partitions are."""
    from tillsight.operators import segment
    orders = spark.createDataFrame([(1, 7), (1, 7), (2, 7), (3, 8), (None, 8)], "id long, customer_id long")
    items = spark.createDataFrame([(1, 5, 2), (1, 6, 1), (2, 5, 4), (3, 6, None), (None, 5, 9)], "order_id long, product_variant_id long, quantity int")
    variants = spark.createDataFrame([(5, 50), (6, 60)], "id long, product_id long")
    products = spark.createDataFrame([(50, "a"), (60, "b")], "id long, category_id string")
    monkeypatch.setattr(segment, "ITEMS_PER_TASK", 2)
    out = segment._customer_categories(orders, items, variants, products, "category_id")
    assert {tuple(r) for r in out.collect()} == {(7, "a", 8, 2), (7, "b", 2, 1), (8, "b", None, 1)}
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
