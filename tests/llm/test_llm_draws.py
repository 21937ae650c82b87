"""Operators 11 and 13, against direct computations."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import docs, empty, prose, rows
from tillsight.llm import packing, resample

SF = "/root/testdata/sf0.001"


def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.default_tokenizer())
    t.encode_special_tokens = True
    return t


def check_pieces(sizes, pieces, length):
    """Every token in one piece, sequences without gaps or padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for d, start, n, sequence, offset in pieces:
        assert n > 0
        by_doc[d].append((start, n))
        by_sequence[sequence].append((offset, n))
    for parts, size in [(by_doc[d], n) for d, n in enumerate(sizes)] + [(x, None) for x in by_sequence.values()]:
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == size if size is not None else at == length or (at < length and at & (at - 1) == 0)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert sum(sum(n for _, n in x) < length for x in by_sequence.values()) <= length.bit_length() - 1


def test_pack():
    rng = random.Random(2)
    for length in (1, 2, 8, 64, 2048):
        for _ in range(40):
            sizes = [rng.choice([1, 1, length, length // 2 + 1, rng.randrange(1, 3 * length + 1), rng.randrange(1, 40)])
                     for _ in range(rng.randrange(0, 80))]
            check_pieces(sizes, list(packing.pack(sizes, length)), length)
    assert list(packing.pack([], 8)) == []
    # Documents are cut only where a gap is filled, at a sequence's size, or at the end.
    sizes = [rng.randrange(1, 2000) for _ in range(3000)]
    pieces = list(packing.pack(sizes))
    assert len(pieces) < 3000 + sum(sizes) // 2048 + 12


def test_first_fit():
    rng = random.Random(3)
    for _ in range(200):
        length = rng.randrange(1, 30)
        sizes = [rng.randrange(1, length + 1) for _ in range(rng.randrange(0, 50))]
        room, want = [], []
        for s in sizes:
            b = next((i for i, r in enumerate(room) if r >= s), len(room))
            room += [length] * (b == len(room))
            room[b] -= s
            want.append(b)
        assert packing.first_fit(sizes, length) == want


def test_ids_of_words_are_ids_of_texts():
    rng = random.Random(8)
    chars = [*"abcXYZ 's't\n\t09.,!?<|>", "\u00e9", "e\u0301", "\u0301", "\u00a0", "\u2003", "\u0130", "\u03a3", "\u65e5", "\U0001f600", "\x00", "\x1c", "\u1100\u1161"]
    texts = ["".join(rng.choices(chars, k=rng.randrange(0, 60))) for _ in range(3000)]
    latin = [chr(c) for c in range(0x21, 0x250)]  # beyond the Latin letters too
    texts += ["".join(rng.choices(latin, k=rng.randrange(1, 12))) for _ in range(5000)] + [c + "x" + c for c in latin]
    texts += ["<|endoftext|> x", "it's I'LL we'Ve 'S's !'s x'sy", "a" * 100 + " b", "\u65e5" * 300, "", " \n"]
    plain = [np.array(e.ids, "<u4").tobytes() for e in tokenizer().encode_batch_fast(texts, add_special_tokens=False)]
    assert packing.Encoder(None).encode([t.encode() for t in texts]) == plain


def check_packed(got, data, length=2048):
    t = tokenizer()
    ids = [[*t.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in data]
    want = Counter((r[0], len(x)) for r, x in zip(data, ids))
    by_sequence, tokens = defaultdict(list), Counter()
    pieces = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        tokens[(r.doc_id, r.doc_tokens)] += r.length
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
    assert tokens == Counter({k: k[1] * n for k, n in want.items()})
    for parts in by_sequence.values():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == length or (at < length and at & (at - 1) == 0)
    once = Counter(r[0] for r in data)
    for r, x in zip(data, ids):
        if once[r[0]] == 1:
            at = 0
            for start, n, crc in sorted(pieces[r[0]]):
                assert start == at and crc == zlib.crc32(np.array(x[start:start + n], "<u4").tobytes())
                at += n
            assert at == len(x)


def test_packing_registered(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    check_packed(packing.report(table).collect(), [(r.doc_id, r.text) for r in table.collect()])


def test_packing_awkward_rows(spark):
    check_packed(packing.report(docs(spark)).collect(), rows())
    small = packing.packed(docs(spark), length=16, group_bytes=2000)
    assert {c for c, _ in small.dtypes} == {"doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"}
    check_packed(small.withColumn("ids_crc32", F.crc32("ids")).collect(), rows(), 16)
    assert packing.report(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        packing.packed(docs(spark), length=100)


def test_packing_spreads_equal_rows(spark):
    """A third of all rows are one row; no group holds them."""
    data = [(7, "same text")] * 1000 + [(i, prose(random.Random(i), 10)) for i in range(2000)]
    got = packing.packed(spark.createDataFrame(data, "doc_id long, text string"), group_bytes=4000).collect()
    groups = Counter(r.sequence_id >> 32 for r in got if r.doc_id == 7)
    assert len(groups) > 20 and max(groups.values()) < 100


def brute_draw(data, target, percent=25, min_words=20, seed=7):
    def features(text):
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
        return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10000 for n in (1, 2) for i in range(len(words) - n + 1)]

    source, wanted = [features(r[1]) for r in data], [features(t) for t in target]
    s, t = Counter(b for _, x in source for b in x), Counter(b for _, x in wanted for b in x)
    S, T = sum(s.values()), sum(t.values())
    out = []
    for r, (n, x) in zip(data, source):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in x) // len(x) if x else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    order = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {id(r): i + 1 for i, r in enumerate(order[:percent * len(order) // 100])}
    return [(*r[:4], drawn.get(id(r))) for r in out]


def compare_draw(got, want):
    """Rows with one id and score may share their ranks among them."""
    unranked = lambda x: Counter((r[0], r[1], r[2], r[3]) for r in x)
    assert unranked(got) == unranked(want)
    by_rank = lambda x: {r[4]: (r[0], r[3]) for r in x if r[4] is not None}
    assert by_rank(got) == by_rank(want) and len(by_rank(got)) == sum(r[4] is not None for r in got)


def test_draw_registered(spark):
    table, bench = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    got = [tuple(r) for r in resample.report(table, bench).collect()]
    want = brute_draw([(r.doc_id, r.text) for r in table.collect()], [r.text for r in bench.collect()])
    assert sorted(got) == sorted(want) and sum(r[4] is not None for r in got) > 20


def test_draw_awkward_rows(spark):
    bench = spark.createDataFrame([("Alpha1 beta2 alpha1",), (None,), ("",)], "text string")
    got = [tuple(r) for r in resample.report(docs(spark), bench).collect()]
    compare_draw(got, brute_draw(rows(), ["Alpha1 beta2 alpha1"]))
    for percent in (0, 60, 100):
        out, names = resample.resample(docs(spark), bench.limit(0), percent=percent, min_words=1, pivots=2, per_range=4)
        assert names["rank"] == "_rank" and set(docs(spark).columns) - {"text"} < set(out.columns)
        got = [tuple(r) for r in out.select("doc_id", *(names[c] for c in ("n_features", "weight", "score", "rank"))).collect()]
        compare_draw(got, brute_draw(rows(), [], percent, 1))
    assert resample.report(empty(spark), bench).count() == 0


def test_quickselect_with_ties(spark):
    """A third of the rows share their score and id."""
    rng = random.Random(9)
    data = [(5, 1)] * 400 + [(rng.randrange(50), rng.randrange(9)) for _ in range(800)]
    table = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "score long, id long, row long")
    key = F.struct((-F.col("score")).alias("a"), F.col("id").alias("b"), F.col("row").alias("c"))
    order = sorted((-s, d, i) for i, (s, d) in enumerate(data))
    for k in (1, 2, 401, 700, 1199, 1200):
        assert tuple(resample.quickselect(table, key, k, pivots=5)) == order[k - 1]
    ranked = resample.ranked(table, [-F.col("score"), F.col("id"), F.col("row")], "rank", 100).collect()
    assert {r["rank"]: (-r.score, r.id, r.row) for r in ranked} == dict(enumerate(order, 1))
