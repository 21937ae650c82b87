"""Operators 4, 9, 10 and 2 on awkward rows, against brute force."""

import hashlib
import re

import pytest

from llm_cases import docs, empty, rows
from tillsight.llm import decontaminate, exact_dedup, line_dedup, line_hash

SPACE = re.compile("[\x20\x09-\x0D]")


def test_exact_dedup(spark):
    got = exact_dedup.exact_dedup(docs(spark), capacity=2).collect()
    assert len(got) == len(rows())
    groups = {}
    for r in rows():
        groups.setdefault(SPACE.sub("", r[1] or ""), []).append((-len(r[1] or ""), r[0] is None, r[0]))
    want = {}
    for norm, g in groups.items():
        want[hashlib.sha256(norm.encode()).hexdigest()] = (min(g)[2], len(g))
    for r in got:
        assert (r.keep_id, r.group_size) == want[r.text_sha256]
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_directory_splits_until_nothing_is_overfull(spark):
    keys = spark.range(500).selectExpr("xxhash64(id) AS key").unionAll(spark.range(3).selectExpr("7L AS key"))
    got = exact_dedup.routed(keys, exact_dedup.directory(keys, capacity=8)).collect()
    assert len(got) == 503
    buckets = {}
    for r in got:
        bits = (r.key % (1 << 64)) >> (64 - r.depth) if r.depth else 0
        assert (r.bucket % (1 << 64)) == (bits << (64 - r.depth) if r.depth else 0)
        buckets.setdefault((r.depth, r.bucket), []).append(r.key)
    assert all(len(b) <= 8 for b in buckets.values())
    # Keys that are the same can't be split: they share a bucket of full depth if they overfill it.
    same = spark.range(5).selectExpr("7L AS key")
    assert {r.depth for r in exact_dedup.routed(same, exact_dedup.directory(same, capacity=2)).collect()} == {64}


def test_the_directory_routes_rows_and_look_ups(spark, monkeypatch):
    """Slots carry the bucket that the directory says; a row whose key the
    directory doesn't know finds nothing."""
    data = spark.createDataFrame([(i, f"text {i % 40}") for i in range(120)], "doc_id long, text string")
    index, rounds = exact_dedup.build_index(data, capacity=4)
    slots = index.collect()
    assert len(slots) == 40 and len({(r.depth, r.bucket) for r in slots}) > 8
    want = {r.key: r.bucket for r in exact_dedup.routed(index.select("key"), rounds).collect()}
    assert all(want[r.key] == r.bucket for r in slots)
    real = exact_dedup.directory
    monkeypatch.setattr(exact_dedup, "directory", lambda keys, capacity: [x.filter("cell % 2 = 0") for x in real(keys, capacity)])
    assert 0 < exact_dedup.exact_dedup(data, capacity=4).count() < 120


@pytest.mark.parametrize("least", [1, 5])
def test_line_hash(spark, least):
    out, names = line_hash.line_hash_dedup(docs(spark), **({} if least == 1 else {"min_words": least}))
    got = out.collect()
    assert out.columns[:len(docs(spark).columns)] == docs(spark).columns and len(got) == len(rows())
    first = {}
    for r in sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows()}):
        for start, _, norm in line_hash.units_of(r[2], "\n", least):
            first.setdefault(norm, (r[0], r[1], r[2], start))
    same_id = {3}  # rows of one id with different texts rank by a hash
    for r in got:
        if r.doc_id in same_id or r.doc_id is None:
            continue
        text = {x[0]: x[1] for x in rows()}[r.doc_id]
        if text is None:
            assert r.text is None
            continue
        spans = [(s, e) for s, e, norm in line_hash.units_of(text, "\n", least)
                 if first[norm][1:] != (r.doc_id, text, s)]
        assert [(s.start, s.end) for s in r[names["spans"]]] == spans
        kept, at = "", 0
        for s, e in spans:
            kept, at = kept + text[at:s], e
        assert r.text == kept + text[at:]
    assert line_hash.line_hash_dedup(empty(spark))[0].count() == 0


def test_paragraphs(spark):
    para = "one two three four five six"
    data = spark.createDataFrame([(1, f"{para}\n\nshort\n\n{para}"), (2, f"own words of this one here\n\n{para}")], ["doc_id", "text"])
    got = {r.doc_id: r.text for r in line_hash.line_hash_dedup(data, separator="\n\n")[0].collect()}
    assert got == {1: f"{para}\n\nshort\n\n", 2: "own words of this one here\n\n"}


def test_line_hash_registered_compares_every_line(spark):
    data = [(1, "Yes\n\nnur hier\n日本語の文章です"), (2, "yes\n\nown\n \n日本語の文章です"), (3, "own"), (4, "\n\n"), (5, None)]
    got = {r.doc_id: (r.n_units, r.n_units_removed, r.n_removed, r.removed_spans, r.kept_sha256)
           for r in line_hash.report(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {1: (3, 0, 0, "", sha(data[0][1])), 2: (3, 2, 12, "0-4,11-19", sha("\nown\n \n")),
                   3: (1, 1, 3, "0-3", sha("")), 4: (0, 0, 0, "", sha("\n\n")), 5: (0, 0, 0, "", sha(""))}


def brute_hits(text, items):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, found = fold(text), set(), set()
    for item_id, item in items:
        w = fold(item)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            for at in range(len(words) - n + 1):
                if words[at:at + n] == w[k:k + n]:
                    hit |= set(range(at, at + n))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(words), len(hit), sorted(found)


def test_decontaminate(spark):
    data = rows()
    items = [(1, " ".join((data[0][1] or "").split()[5:17])), (2, "É, x!"), (3, None), (4, " ... "),
             (None, "Siete1"), (10, "x"), (10, "x"), (2, "é x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    short = [r for r in data if len(r[1] or "") < 50_000]
    for options in ({}, {"block_chars": 60}):  # one automaton, and several
        found, names = decontaminate.find_benchmark(docs(spark, short), bench, **options)
        found = found.withColumn("hit", decontaminate.hit_words(found[names["spans"]]))
        assert found.columns[:len(data[0])] == docs(spark).columns
        got = found.collect()
        assert len(got) == len(short)
        for r in got:
            assert (r[names["words"]], r.hit, r[names["items"]]) == brute_hits(r.text, items), r.doc_id
    clean = decontaminate.decontaminate(docs(spark, short), bench)
    assert clean.columns == docs(spark).columns
    assert clean.count() == sum(brute_hits(r[1], items)[1] == 0 for r in short)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs(spark), none).count() == len(data)
    assert decontaminate.decontaminate(empty(spark), bench).count() == 0


def test_char_offsets_of_hits(spark):
    bench = spark.createDataFrame([(1, "schön ist die Welt")], "item_id long, text string")
    text = "Ach — wie SCHÖN! ist... die welt? Ja. schön; ist, die Welt"
    data = spark.createDataFrame([(1, text.replace("SCHÖN", "schön"))], "doc_id long, text string")
    found, names = decontaminate.find_benchmark(data, bench)
    spans = found.select(decontaminate.char_spans(found.text, found[names["spans"]]).alias("s"), "text").first()
    assert [spans.text[x.start:x.end] for x in spans.s] == ["schön! ist... die welt", "schön; ist, die Welt"]


def test_line_dedup(spark):
    out, n_lines, n_dropped = line_dedup.line_dedup(docs(spark), "source", "text", ratio=0.15, min_pages=2)
    got = out.collect()
    assert len(got) == len(rows())
    sites = {}
    for r in rows():
        if r[3] is not None:
            sites.setdefault(r[3], []).append({x.strip(" ") for x in (r[1] or "").split("\n")} - {""})
    drop = {s: {x for p in pages for x in p if sum(x in q for q in pages) >= 2
                and sum(x in q for q in pages) > 0.15 * len(pages)} for s, pages in sites.items()}
    assert any(drop.values())
    want = []
    for r in rows():
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if x.strip(" ") not in drop.get(r[3], ())]
        want.append((r[0], r[3], None if r[1] is None else "\n".join(kept), sum(bool(x.strip(" ")) for x in lines), len(lines) - len(kept)))
    key = lambda x: tuple((y is None, str(y)) for y in x)
    assert sorted(((r.doc_id, r.source, r.text, r[n_lines], r[n_dropped]) for r in got), key=key) == sorted(want, key=key)
    assert line_dedup.line_dedup(empty(spark), "source", "text")[0].count() == 0


def test_line_dedup_of_small_hosts(spark):
    """The registered defaults drop by share alone, once a line repeats."""
    page = "<p>{0}</p><p>own line {1}</p>"
    pages = [(i, f"http://few.org/{i}", page.format("menu" if i < 3 else "x", i)) for i in range(4)]
    pages += [(10 + i, f"http://more.org/{i}", page.format("news" if i < 3 else "tag" if i < 5 else f"y{i}", i)) for i in range(24)]
    pages.append((40, "http://one.org/", page.format("alone", 40)))
    got = {r.page_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.report(
        spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    want = {}
    for i, url, _ in pages:
        # 3 of 4 and 3 of 24 pages are above a tenth, 2 of 24 are not.
        first = "menu" if i < 3 else "x" if i < 4 else "alone" if i == 40 else "news" if i < 13 else "tag" if i < 15 else f"y{i - 10}"
        own = f"own line {i - 10 if 10 <= i < 40 else i}"
        want[i] = (2, 1, own) if first in ("menu", "news") else (2, 0, f"{first}\n{own}")
    assert got == want


def test_host_and_html(spark):
    from pyspark.sql import functions as F
    data = spark.createDataFrame([("HTTPS://u:p@WWW.Ex.org:80/a?b", "<p>A &amp;  b<br>c</p><!-- x --><script>y<p></script>\n<i>d</i>"),
                                  ("nothing", None), (None, "")], "url string, html string")
    got = data.select(line_dedup.host_of(F.col("url")), line_dedup.text_of_html(F.col("html"))).collect()
    assert [tuple(r) for r in got] == [("www.ex.org", "A & b\nc\nd"), (None, None), (None, "")]
