"""Top-N lists of all products, against brute force."""

import collections
import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from tillsight import session
from tillsight.operators import counting
from tillsight.operators import neighbours
from tillsight.operators import recommend


def brute(pairs, n):
    buyers = {}
    for c, p in pairs:
        buyers.setdefault(p, set()).add(c)
    out = set()
    for a in buyers:
        order = sorted((-len(buyers[a] & buyers[b]) / math.sqrt(float(len(buyers[a]) * len(buyers[b]))), b) for b in buyers if b != a)
        for i, (s, b) in enumerate(order[:n]):
            out.add((a, i + 1, b, round(-s, 4), len(buyers[a] & buyers[b]), len(buyers[b])))
    return out


def frame(spark, pairs):
    return spark.createDataFrame(sorted(pairs), "customer_id long, product_id long")


@pytest.mark.parametrize("seed, customers, products, n_pairs, hot", [(1, 60, 40, 400, 0), (2, 80, 60, 200, 1), (3, 30, 90, 60, 3)])
def test_lists_of_all_products(spark, seed, customers, products, n_pairs, hot):
    rng = random.Random(seed)
    pairs = {(rng.randrange(customers), rng.randrange(products)) for _ in range(n_pairs)}
    # A third of all rows and more belong to customers who bought nearly everything.
    pairs |= {(1000 + h, p) for h in range(hot) for p in range(products) if rng.random() < 0.9}
    want = brute(pairs, 4)
    for limit in (1000, 8):
        got = {tuple(r) for r in neighbours.similar_items_all(frame(spark, pairs), 4, list_limit=limit, first_slice=3).collect()}
        assert got == want, limit


def test_as_the_list_of_one_product(spark):
    rng = random.Random(7)
    pairs = frame(spark, {(rng.randrange(50), rng.randrange(30)) for _ in range(300)})
    lists = {}
    for r in neighbours.similar_items_all(pairs).orderBy("rank").collect():
        lists.setdefault(r["product_id"], []).append((r["similar_id"], r["similarity"], r["common_buyers"], r["buyers"]))
    for p in (0, 7, 29):
        one = [(r["product_id"], r["similarity"], r["common_buyers"], r["buyers"]) for r in recommend.similar_items(pairs, p, 5).collect()]
        assert lists[p] == one


def test_few_products_and_none(spark):
    assert neighbours.similar_items_all(frame(spark, {(1, 5)})).collect() == []
    got = neighbours.similar_items_all(frame(spark, {(1, 5), (2, 6), (2, 7)})).collect()
    assert {(r["product_id"], r["rank"], r["similar_id"], r["common_buyers"]) for r in got} == {
        (5, 1, 6, 0), (5, 2, 7, 0), (6, 1, 7, 1), (6, 2, 5, 0), (7, 1, 6, 1), (7, 2, 5, 0)}
    assert neighbours.similar_items_all(spark.createDataFrame([], "customer_id long, product_id long")).count() == 0


def test_long_lists_are_not_paired(spark):
    """One customer bought all products. With short lists and clear neighbours
    the pairs that only this customer makes are hardly counted."""
    pairs = {(9999, p) for p in range(400)} | {(p // 4, p) for p in range(400)} | {(1000 + p // 4, p) for p in range(400)}
    counted = []
    real = neighbours._meetings

    def spying(left, right):
        out = real(left, right)
        counted.append(left.join(right, "customer_id").filter("a != b").count())
        return out

    neighbours._meetings = spying
    try:
        got = {tuple(r) for r in neighbours.similar_items_all(frame(spark, pairs), 3, list_limit=50, first_slice=8).collect()}
    finally:
        neighbours._meetings = real
    assert got == brute(pairs, 3)
    assert sum(counted) < 400 * 400 / 10


def test_short_lists_are_counted_by_product(spark, monkeypatch):
    """Without long lists no table of pairs is dealt; with a limit on buyers only
    the products beyond it go the other way."""
    rng = random.Random(11)
    pairs = {(rng.randrange(40), rng.randrange(30)) for _ in range(250)} | {(c, 5) for c in range(40)}
    real, dealt = neighbours._meetings, []

    def spying(left, right):
        dealt.append({r[0] for r in left.select("a").distinct().collect()})
        return real(left, right)

    monkeypatch.setattr(neighbours, "_meetings", spying)
    monkeypatch.setattr(neighbours, "COUNTS_PER_TASK", 500)
    assert {tuple(r) for r in neighbours.similar_items_all(frame(spark, pairs), 3).collect()} == brute(pairs, 3)
    assert dealt == []
    monkeypatch.setattr(neighbours, "MANY_BUYERS", 30)
    assert {tuple(r) for r in neighbours.similar_items_all(frame(spark, pairs), 3).collect()} == brute(pairs, 3)
    assert dealt == [{5}]


def shuffled(spark):
    """Bytes of the shuffle files that the session holds."""
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


@pytest.mark.parametrize("hot", [0, 2])
def test_lists_go_in_rounds_that_leave_no_shuffle_files(spark, monkeypatch, hot):
    rng = random.Random(13)
    pairs = {(rng.randrange(70), rng.randrange(50)) for _ in range(500)} | {(1000 + h, p) for h in range(hot) for p in range(50)}
    pairs |= {(c, 3) for c in range(40)}
    real, dealt = neighbours.met_counter, []
    monkeypatch.setattr(neighbours, "met_counter", lambda n: (dealt.append(n), real(n))[1])
    monkeypatch.setattr(neighbours, "CELLS_PER_ROUND", 600)
    monkeypatch.setattr(neighbours, "CELLS_PER_PURCHASE", 2)
    monkeypatch.setattr(neighbours, "MANY_BUYERS", 30)
    spark._jvm.System.gc()
    before = shuffled(spark)
    out = neighbours.similar_items_all(frame(spark, pairs), 4, list_limit=20 if hot else 1000, first_slice=3)
    for _ in range(100):  # files go a moment after their job
        left = shuffled(spark) - before
        if left <= 0:
            break
        time.sleep(0.1)
    assert left <= 0
    assert len(dealt) > 3
    assert {tuple(r) for r in out.collect()} == brute(pairs, 4)
    assert spark.conf.get(session.DROP_SHUFFLES) == "false"


def test_rounds_follow_the_purchases():
    """What a round deals grows with the purchases, not with the length of lists."""
    few, per = neighbours.CELLS_PER_ROUND, neighbours.CELLS_PER_PURCHASE
    assert [neighbours._rounds(w, p) for w, p in ((0, 0), (few, 10), (few + 1, 10))] == [1, 1, 2]
    for length in (10, 40, 256):
        for purchases in (10 ** 8, 10 ** 10):
            assert length * purchases / neighbours._rounds(length * purchases, purchases) <= per * purchases


@pytest.mark.parametrize("kind", ["string", "wide", "repeated"])
def test_ids_of_other_kinds_and_repeated_pairs(spark, kind):
    rng = random.Random(17)
    pairs = {(rng.randrange(40), rng.randrange(30)) for _ in range(250)}
    name = {"string": lambda p: f"p{p}", "wide": lambda p: p * 2 ** 58 - 2 ** 62, "repeated": lambda p: p}[kind]
    pairs = [(c, name(p % 30 if kind != "wide" else p % 20)) for c, p in pairs]
    pairs = sorted(set(pairs)) if kind != "repeated" else sorted(pairs) + sorted(pairs)[:90]
    df = spark.createDataFrame(pairs, f"customer_id long, product_id {'string' if kind == 'string' else 'long'}")
    got = {tuple(r) for r in neighbours.similar_items_all(df, 3).collect()}
    if kind != "repeated":
        assert got == brute(set(pairs), 3)
        return
    # Each row counts, as in a join of the rows with themselves.
    buyers, met = collections.Counter(p for _, p in pairs), collections.Counter()
    for c, p in pairs:
        met.update((p, q) for d, q in pairs if c == d and p != q)
    want = set()
    for a in buyers:
        order = sorted((-met[a, b] / math.sqrt(float(buyers[a] * buyers[b])), b) for b in buyers if b != a)
        want |= {(a, i + 1, b, round(-s, 4), met[a, b], buyers[b]) for i, (s, b) in enumerate(order[:3])}
    assert got == want


def test_counting_at_once_or_a_little_at_a_time():
    rng = random.Random(19)
    lists = [sorted(rng.sample(range(40), rng.randrange(1, 9))) for _ in range(60)]
    rows = sorted((p, at) for at, x in enumerate(lists) for p in x)
    buyers = collections.Counter(p for p, _ in rows)
    batches = []
    for i in range(0, len(rows), 7):
        part = rows[i:i + 7]
        batches.append(pa.RecordBatch.from_pydict({
            "a": [p for p, _ in part], "na": [buyers[p] for p, _ in part], "p": [lists[at] for _, at in part],
            "n": [[buyers[q] for q in lists[at]] for _, at in part], "edge": [2 ** 63 - 1] * len(part)}))
    met = collections.Counter((p, q) for p, at in rows for q in lists[at] if q != p)
    want = {(a, b, m, buyers[a], buyers[b]) for (a, b), m in met.items()}
    for at_once in (1, 50, 10 ** 6):
        out = [tuple(r.values()) for b in counting.met_counter(None, at_once)(iter(batches)) for r in b.to_pylist()]
        assert len(out) == len(want)
        assert {x[:5] for x in out} == want
        assert {x[5:] for x in out} == {(0, 0)}
        best = [tuple(r.values()) for b in counting.met_counter(2, at_once)(iter(batches)) for r in b.to_pylist()]
        assert max(x[-1] for x in best) == 2
        for a in buyers:
            order = sorted((-m / math.sqrt(float(na * nb)), b) for x, b, m, na, nb in want if x == a)
            assert [x[1] for x in sorted(best, key=lambda x: x[-1]) if x[0] == a] == [b for _, b in order[:2]]
    assert list(counting.met_counter(2)(iter([]))) == []
    # Keys too large to sort with their places.
    keys = np.array([5, 2 ** 62, 5, 7])
    for most in (8, 2 ** 62 + 1):
        given = keys % 8 if most == 8 else keys
        key, place, times = counting.grouped(given, most)
        assert given[place].tolist() == key.tolist()
        assert dict(zip(key.tolist(), times.tolist())) == ({5: 2, 0: 1, 7: 1} if most == 8 else {5: 2, 2 ** 62: 1, 7: 1})
