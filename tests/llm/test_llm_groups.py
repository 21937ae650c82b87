"""Operators 3, 5 and 6 and the pipeline, against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from llm_cases import docs, empty, prose, rows
from tillsight.llm import mixing, near_dedup, suffix_dedup

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        left, w = total - sum(full.values()), sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / w > most * sizes[s]]
        if not over:
            return full | {s: left * weight[s] / w for s in rest}
        full |= {s: most * sizes[s] for s in over}


def check_mix(got, data):
    size = lambda r: len(SPACES.findall(r[1] or ""))
    sizes = defaultdict(int)
    for r in data:
        sizes[r[3]] += size(r)
    want = brute_targets(sizes) if data else {}
    taken = defaultdict(int)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((r[0] is None, r[0] or 0, size(r)) for r in data)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1


def test_mixing(spark):
    got = mixing.mix(docs(spark)).collect()
    check_mix(got, rows())
    again = mixing.mix(docs(spark, rows()[::-1]).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(empty(spark)).count() == 0


def test_mixing_many_levels(spark):
    rng = random.Random(1)
    data = [(i, "w " * rng.randrange(0, 9), "en", "hot" if i % 3 else f"s{i % 4}", 0) for i in range(3000)]
    data = [(*r, *(["c"] * (len(rows()[0]) - 5))) for r in data]
    got = mixing.mix(docs(spark, data)).collect()
    check_mix(got, data)
    # Copies are whole but for one document a source, and drawn with the expected share.
    odd = [r for r in got if r.size and r.taken % r.size]
    assert len(odd) <= len({r.source for r in got})


def test_rounding_keeps_expectations(spark):
    """Each document's chance of a copy is its fraction, and no more words move
    than there are."""
    data = [("s", i, 1, 1 + i % 3, 0.3) for i in range(3000)]
    units = spark.createDataFrame(data, "source string, id long, nth long, size long, part double")
    got = mixing.round_fractions(units).collect()
    for size in (1, 2, 3):
        share = np.mean([r.part for r in got if r.size == size])
        assert abs(share - 0.3) < 0.04
    assert sum(r.part * r.size for r in got) == pytest.approx(0.3 * sum(x[3] for x in data))


def test_rounding_keeps_expectations_of_all_sizes(spark):
    """Also a small fraction where sizes spread over three orders of magnitude."""
    rng = np.random.default_rng(6)
    data = [("s", i, 1, int(10 ** x), 0.1) for i, x in enumerate(rng.uniform(0.5, 3.5, 6000))]
    units = spark.createDataFrame(data, "source string, id long, nth long, size long, part double")
    got = sorted((r["size"], r["id"], r.part) for r in mixing.round_fractions(units).collect())
    for fifth in np.array_split([p for _, _, p in got], 5):
        assert abs(fifth.mean() - 0.1) < 0.03
    assert sum(n * p for n, _, p in got) == pytest.approx(0.1 * sum(x[3] for x in data))


def brute_suffix(data):
    """Bytes that go, with rows of one id in the order of their hash left out."""
    seen, out = set(), []
    for i, text in data:
        t = (text or "").encode()
        edge = np.zeros(len(t) + 1, int)
        own = []
        for s in range(len(t) - 99):
            w = t[s:s + 100]
            if w in seen:
                edge[s] += 1
                edge[s + 100] -= 1
            seen.add(w)
        out.append((i, np.cumsum(edge)[:-1] > 0 if t else np.zeros(0, bool)))
    return out


@pytest.mark.parametrize("local,group", [(64, 512), (1, 512), (64, 1)])
def test_suffix_dedup(spark, monkeypatch, local, group):
    """Also with every group taken for a hot one, in a batch or altogether."""
    monkeypatch.setattr(suffix_dedup, "LOCAL", local)
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rng = random.Random(9)
    shared = prose(rng, 60)
    data = [(r[0], r[1]) for r in rows() if r[0] is not None and len(r[1] or "") < 50_000][:27]
    data = [x for k, x in enumerate(data) if x[0] not in [y[0] for y in data[:k]]]
    data += [(100 + i, prose(rng, 6) + " " + shared[i % 7:len(shared) - i % 11] + prose(rng, 5)) for i in range(40)]
    data += [(200, "xyz" * 500), (201, "yzx" * 300 + "é" * 200), (202, shared * 3)]
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in suffix_dedup.report(frame).collect()}
    assert len(got) == len(data)
    for (i, gone), (_, text) in zip(brute_suffix(sorted(data)), sorted(data)):
        t = (text or "").encode()
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == \
            (len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), i


def test_suffix_dedup_awkward_rows(spark):
    out, name = suffix_dedup.suffix_dedup(docs(spark))
    assert out.columns == [*docs(spark).columns, name] and name != "removed"
    got = out.collect()
    assert len(got) == len(rows())
    # Rows that repeat id and text tie; a null id comes last and repeats earlier text.
    assert {len(r[name]) for r in got if r.doc_id == 3 and r.text == rows()[3][1]} == {0}
    assert all(r[name] == [0, len(r.text)] for r in got if r.doc_id is None)
    assert suffix_dedup.suffix_dedup(empty(spark))[0].count() == 0


def test_longest_previous_factors():
    rng = np.random.default_rng(4)
    for text in (b"abracadabra" * 4, bytes(rng.integers(97, 99, 120, dtype=np.uint8)), b"a" * 60):
        data, n = np.frombuffer(text, np.uint8), 12
        starts = np.arange(len(text) - n + 1)
        place = rng.permutation(len(starts))
        got, first = suffix_dedup.longest_previous(data, starts, place, n)
        for i in starts:
            best = 0
            for j in starts[place < place[i]]:
                k = 0
                while k < n and text[i + k] == text[j + k]:
                    k += 1
                best = max(best, k)
            assert got[i] == best, (i, got[i], best)
            if best == n:
                same = [j for j in starts if text[j:j + n] == text[i:i + n]]
                assert first[i] == min(same, key=lambda j: place[j])


def brute_groups(data, width, percent=80):
    sets = []
    for _, text in data:
        w = SPACES.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append(frozenset(zip(*(w[k:] for k in range(width)))) if len(w) >= width else frozenset([tuple(w)] if w else []))
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(data):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return [(len(sets[a]), least.get(find(a)) if sets[a] else data[a][0]) for a in range(len(data))]


@pytest.mark.parametrize("blocks", [{}, {"held": 2, "passed": 3}])
def test_near_groups(spark, blocks):
    """Also with buckets cut into very small blocks."""
    rng = random.Random(2)
    data = [(r[0], r[1]) for r in rows()]
    base = prose(rng, 60).split()
    chain = list(base)
    for i in range(30):  # a chain of copies, each near the one before
        chain[rng.randrange(60)] = f"new{i}"
        data.append((300 - i, " ".join(chain)))
    for i in range(25):  # copies of an original that isn't the first
        w = list(base)
        for _ in range(1 + i % 5):
            w[rng.randrange(60)] = f"edit{i}"
        data.append((i * 10 + 41, " ".join(w)))
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = near_dedup.near_groups(frame, **blocks).collect()
    key = lambda x: tuple((y is None, y) for y in x)
    want = sorted(((i, *g, i == g[1]) for (i, _), g in zip(data, brute_groups(data, 2))), key=key)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=key) == want


def test_near_groups_keep_one(spark):
    out = near_dedup.keep_one(docs(spark), width=5)
    assert out.columns == docs(spark).columns
    groups = brute_groups([(r[0], r[1]) for r in rows()], 5)
    want = {(r[0], r[1]) for r, g in zip(rows(), groups) if r[0] == g[1]}
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert near_dedup.near_groups(empty(spark)).count() == 0


def test_components_of_long_paths_and_stars(spark):
    links = [(f"{i:04d}", f"{i + 1:04d}") for i in range(0, 60)] + [("x", f"y{i}") for i in range(50)] + [("q", "q")]
    got = {r.node: r.root for r in near_dedup.components(spark.createDataFrame(links, ["a", "b"])).collect()}
    assert {got[f"{i:04d}"] for i in range(61)} == {"0000"} and {got[f"y{i}"] for i in range(50)} == {"x"}
    assert len(got) == 61 + 51


def test_near_groups_writes_small_tables_as_few_files(spark, monkeypatch):
    """Every file costs a local executor child processes, so a table of few rows
    must not have one a partition; the groups stay the same."""
    files, staged = {}, near_dedup.staged

    def counted(df, purpose, *args):
        out = staged(df, purpose, *args)
        files.setdefault(purpose, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(near_dedup, "staged", counted)
    base = " ".join(f"w{k}" for k in range(60))
    data = [(i, f"{base} end{i}") for i in range(40)] + [(100 + i, f"other{i} text{i} of its{i} own{i}") for i in range(40)]
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        got = {r.doc_id: r.component_id for r in
               near_dedup.near_groups(spark.createDataFrame(data, "doc_id long, text string").repartition(4)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: 0 if i < 100 else i for i, _ in data}
    assert {"near-shared", "near-members", "near-texts", "near-pairs", "near-left", "components"} <= set(files)
    assert {k: max(v) for k, v in files.items() if k not in ("near-signatures", "near-links") and max(v) > 1} == {}


def test_staged_keeps_rows_in_fewer_files(spark):
    from tillsight.llm.common import staged
    df = spark.range(0, 1000, 1, 20)
    assert len(staged(df, "t").inputFiles()) == 20
    for bound, a_file, want in ((1000, 50_000, 1), (1000, 250, 4), (0, 250, 1), (10_000, 10, 20)):
        out = staged(df, "t", bound, a_file)
        assert len(out.inputFiles()) == want and sorted(r.id for r in out.collect()) == list(range(1000))


def test_pipeline(spark):
    import corpus_pipeline as P
    from tillsight.llm import decontaminate, line_dedup, toxicity
    from tillsight.llm.common import table
    sf = "/root/testdata/sf0.001"
    source = table(spark, sf, "documents")
    columns, done, before = source.columns, source, None
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontaminate", "mixing"]
    for name, stage in P.STAGES:
        before, done = done, P.staged(stage(spark, done, sf), "test-pipeline")
        a, b = ({r.doc_id: r for r in x.collect()} for x in (before, done))
        assert set(b) <= set(a)
        if name != "mixing":
            assert done.columns == columns
        if name == "toxicity":
            model = toxicity.train(before, table(spark, sf, "labels"), toxicity.learnable())
            scores = toxicity.Scorer(model).texts([(a[i].text or "").encode() for i in sorted(a)])
            assert set(b) == {i for i, s in zip(sorted(a), scores) if s < 0.5}
        elif name == "line_dedup":
            assert set(a) == set(b) and all(b[i].n_chars == len(b[i].text) for i in b if b[i].text != a[i].text)
        elif name == "near_dedup":
            data = [(i, a[i].text) for i in sorted(a)]
            assert set(b) == {i for (i, _), g in zip(data, brute_groups(data, 5)) if g[1] == i}
        elif name == "decontaminate":
            items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
            from test_llm_exact import brute_hits
            assert set(a) - set(b) == {i for i in a if brute_hits(a[i].text, items)[1]}
        else:
            check_mix(mixing.mix(before).collect(), [tuple(r) for r in before.collect()])
            mixed = {r.doc_id: r.taken for r in mixing.mix(before).collect() if r.taken}
            assert mixed == {i: r.taken for i, r in b.items()}
    assert P.run(spark, sf).exceptAll(done).count() == 0


def test_pipeline_stages_on_awkward_rows(spark):
    import corpus_pipeline as P
    sf = "/root/testdata/sf0.001"
    for data in (docs(spark), empty(spark)):
        done, columns = P.staged(data, "test-awkward"), data.columns
        for name, stage in P.STAGES:
            done = P.staged(stage(spark, done, sf), "test-awkward")
            if name != "mixing":
                assert done.columns == columns
        assert done.columns[:len(columns)] == columns and len(done.columns) == len(columns) + 2
        assert done.count() <= data.count()
        # Columns that only pass through keep their values.
        for r in done.collect():
            assert list(r)[5:len(columns)] == ["c"] * (len(columns) - 5)
