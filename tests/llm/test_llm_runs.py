"""Operator 12: runs with a period, against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from llm_cases import docs, empty, rows
from tillsight.llm import periodic

SF = "/root/testdata/sf0.001"


def brute_runs(words, min_length=6, min_repeats=4):
    """Every stretch of every period, with the periods below checked."""
    out = set()
    n = len(words)
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            e = i + q
            if e - s >= max(min_length, min_repeats * q) and not any(
                    all(words[x] == words[x + r] for x in range(s, e - r)) for r in range(1, q)):
                out.add((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def told(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = told(doc_id, text)
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def key(r):
    return tuple((x is None, x) for x in r)


def test_runs_of_random_words():
    rng = random.Random(4)
    texts = []
    for _ in range(400):
        words = [rng.choice(b"ab" if rng.random() < 0.5 else b"abcdefgh") for _ in range(rng.randrange(0, 60))]
        while rng.random() < 0.6:  # a repeated stretch, nested ones too
            p = rng.randrange(1, 12)
            part = [rng.choice(b"abc") for _ in range(p)]
            at = rng.randrange(len(words) + 1)
            words[at:at] = (part * rng.randrange(2, 9))[:rng.randrange(1, 60)]
        texts.append([bytes([w]) for w in words])
    got = periodic.runs_of(texts)
    assert got == [brute_runs(t) for t in texts] and sum(map(len, got)) > 200
    assert periodic.runs_of(texts, 3, 3) == [brute_runs(t, 3, 3) for t in texts]
    for t, r in zip(texts, got):  # alone as in a batch
        assert periodic.runs_of([t]) == [r]
    assert periodic.runs_of([]) == [] and periodic.runs_of([[], []]) == [[], []]


def test_long_runs():
    word = [b"%d" % i for i in range(700)]
    texts = [word * 5, [b"x"] * 5000, word + word[::-1], (word[:3] * 50 + [b"!"]) * 6]
    assert periodic.runs_of(texts) == [[(0, 3500, 700)], [(0, 5000, 1)], [], [
        *sorted([(151 * k, 150, 3) for k in range(6)] + [(0, 906, 151)], key=lambda r: (r[0], r[2]))]]


def test_registered_query_on_the_small_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    data = [(r.doc_id, r.text) for r in table.collect() if len(r.text or "") < 12_000]
    got = periodic.report(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(expected(*r) for r in data)
    assert sum(r.n_runs for r in got) > 10


def test_awkward_rows(spark):
    data = docs(spark)
    out, names = periodic.find_runs(data)
    assert out.columns == [*data.columns, names["runs"], names["collapsed"]]
    got = out.collect()
    assert len(got) == len(rows()) and sum(len(r[names["runs"]]) for r in got) >= 3
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        if len(words) < 1000:
            assert [tuple(x) for x in r[names["runs"]]] == brute_runs(words)
        if len(words) == 400:
            assert r[names["collapsed"]] == "aaaa"
    small = [(r[0], r[1]) for r in rows() if len(r[1] or "") < 20_000]
    report = periodic.report(spark.createDataFrame(small, "doc_id long, text string")).collect()
    assert sorted(map(tuple, report), key=key) == sorted((expected(*r) for r in small), key=key)
    assert periodic.report(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(data, min_repeats=2)
