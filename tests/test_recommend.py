import random

import pytest
from pyspark.sql import functions as F

from tillsight.operators import recommend as rc


def _pairs(spark, buyers):
    rows = [(c, p) for p, cs in buyers.items() for c in cs]
    return spark.createDataFrame(rows, "customer_id long, product_id long")


def test_similarity_and_zero_overlap_padding(spark):
    # Buyers A={1,2,3,4}, B={1}, C={5}: sim(A,B)=0.5, C listed with 0 when N=2.
    pairs = _pairs(spark, {1: [1, 2, 3, 4], 2: [1], 3: [5]})
    top = rc.similar_items(pairs, 1, n=2).collect()
    assert [(r["product_id"], r["similarity"], r["common_buyers"], r["buyers"]) for r in top] == [
        (2, 0.5, 1, 1), (3, 0.0, 0, 1)]


def test_ties_go_to_lower_id_and_unknown_reference_is_empty(spark):
    pairs = _pairs(spark, {1: [1, 2], 5: [1, 2], 4: [1, 2], 9: [7]})
    top = rc.similar_items(pairs, 1, n=2).collect()
    assert [r["product_id"] for r in top] == [4, 5]
    assert rc.similar_items(pairs, 42, n=2).count() == 0


def _brute_force(pairs_list):
    by_c = {}
    for c, p in pairs_list:
        by_c.setdefault(c, set()).add(p)
    co = {}
    for ps in by_c.values():
        ps = sorted(ps)
        for i in range(len(ps)):
            for j in range(i + 1, len(ps)):
                co[(ps[i], ps[j])] = co.get((ps[i], ps[j]), 0) + 1
    return co


def test_item_cosine_equals_brute_force_for_any_id_type(spark):
    rnd = random.Random(5)
    pl = {(rnd.randrange(60), rnd.randrange(40)) for _ in range(700)}
    pl |= {(999, p) for p in range(40)}  # one customer who bought everything (hot key)
    want = _brute_force(pl)
    for cast in ("long", "string"):
        pairs = spark.createDataFrame(sorted(pl), "customer_id long, product_id long") \
            .withColumn("product_id", F.col("product_id").cast(cast))
        refs = pairs.filter("product_id IN (3, 17)").select("product_id")
        got = {(int(r[0]), int(r[1])): r[2] for r in rc.item_cosine(pairs, refs).collect()}
        assert got == {(a, b): want[min(a, b), max(a, b)] for a in (3, 17) for b in range(40)
                       if a != b and (min(a, b), max(a, b)) in want}


def test_item_cosine_is_bounded(spark):
    pairs = _pairs(spark, {1: [1, 2, 3], 2: [1, 2, 3], 3: [3, 4]})
    refs = spark.createDataFrame([(1,), (3,), (77,)], "ref long")
    sims = {(r["product_a"], r["product_b"]): r["similarity"] for r in rc.item_cosine(pairs, refs).collect()}
    assert abs(sims[(1, 2)] - 1.0) < 1e-12            # equal buyer sets
    assert set(sims) == {(1, 2), (1, 3), (3, 1), (3, 2)}
    assert all(0 < s <= 1.0 + 1e-12 for s in sims.values())


def test_name_resolution(spark):
    prods = spark.createDataFrame([(1, "Motor"), (2, "Boia"), (3, "Boia")], "id long, name string")
    assert rc.resolve_product(prods, "Motor") == 1
    with pytest.raises(rc.ProductNameError):
        rc.resolve_product(prods, "Boia")
    with pytest.raises(rc.ProductNameError):
        rc.resolve_product(prods, "Nada")
    st = {r["name"]: r["status"] for r in rc.name_resolution(prods).collect()}
    assert st == {"Motor": "unique", "Boia": "ambiguous"}


def test_similar_items_by_name(spark):
    pairs = _pairs(spark, {1: [1, 2, 3, 4], 2: [1], 3: [5]})
    prods = spark.createDataFrame([(1, "Motor"), (2, "Boia"), (3, "Remo"), (4, "Remo")],
                                  "id long, name string")
    top = rc.similar_items_by_name(pairs, prods, "Motor", n=2).collect()
    assert [(r["product_id"], r["product"]) for r in top] == [(2, "Boia"), (3, "Remo")]
    with pytest.raises(rc.ProductNameError):
        rc.similar_items_by_name(pairs, prods, "Remo")


def test_matrix_summary(spark):
    pairs = _pairs(spark, {1: [1, 2], 2: [1]})
    r = rc.matrix_summary(pairs).first()
    assert (r["customers"], r["products"], r["cells"]) == (2, 2, 3) and r["density"] == 0.75
