"""Operator 10, benchmark decontamination by one Aho-Corasick automaton.

Items (test questions and answers) and documents are normalised alike:
A-Z in lower case, words of ASCII letters and digits and of everything beyond
ASCII. A window is ``window`` consecutive words of an item, or the whole item
if it is shorter. The automaton holds every distinct window and reads each
text once; a hit word is one inside any occurrence.

Bounds: an automaton holds at most ``block_chars`` characters of windows (about 44
bytes a character in each worker, measured) and is what the executors get by
broadcast. A larger benchmark is cut into several
automata, applied one after another to all documents, with the same result.

Defined cases: null and empty texts have no words and no hits; items without
words have no windows; items without an id mark words but are not listed;
repeated items and ids count once; every document row is kept, repeated rows
alike, and an empty benchmark hits nothing.
"""

from __future__ import annotations

from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, fresh, mapped, quoted, staged, texts_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
BLOCK_CHARS = 4_000_000

# Byte table of the normaliser: upper to lower case, other ASCII to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
            window: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: ``pattern`` (words between single
    spaces, a space at both ends) and ``items``, the sorted ids that have it."""
    words = F.regexp_extract_all(ascii_lower(quoted(text_col)), F.lit(WORD), 0)
    n = F.size("words")
    return (items.select(quoted(id_col).cast("string").alias("item"), words.alias("words"))
            .filter(n > 0)
            .select("item", "words", F.explode(F.sequence(
                F.lit(1), F.greatest(n - F.lit(window - 1), F.lit(1)))).alias("at"))
            .select("item", F.concat(F.lit(" "), F.array_join(
                F.slice("words", F.col("at"), F.lit(window)), " "), F.lit(" ")).alias("pattern"))
            .groupBy("pattern").agg(F.array_sort(F.collect_set("item")).alias("items")))


def _scanner(patterns):
    """A function from the texts of a batch and the finds of earlier blocks to
    the finds with this block's added."""

    def work():
        automaton = ahocorasick.Automaton()
        for k, (pattern, _) in enumerate(patterns.value):
            automaton.add_word(pattern.encode().decode("latin-1"), k)
        ready = len(automaton) > 0
        if ready:
            automaton.make_automaton()
        sizes = [len(p.encode()) for p, _ in patterns.value]

        def scan(columns: list[pa.Array]) -> list[pa.Array]:
            texts, before, known = columns
            counts, spans, found = [], [], []
            for text, old, ids in zip(texts_of(texts), before, known):
                words = text.translate(_FOLD).split()
                counts.append(len(words))
                old, ids = old.as_py() or [], set(ids.as_py() or [])
                if ready and words:
                    line = b" " + b" ".join(words) + b" "
                    hits = list(automaton.iter(line.decode("latin-1")))
                    if hits:
                        stop, which = np.array(hits, np.int64).T
                        start = stop + 1 - np.array(sizes, np.int64)[which]
                        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, np.searchsorted(gaps, start), 1)
                        np.add.at(edge, np.searchsorted(gaps, stop), -1)
                        for a, b in zip(old[::2], old[1::2]):
                            edge[a] += 1
                            edge[b] -= 1
                        turn = np.diff((np.cumsum(edge) > 0).astype(np.int8), prepend=0)
                        old = np.flatnonzero(turn).tolist()
                        for k in np.unique(which).tolist():
                            ids.update(patterns.value[k][1])
                spans.append(old)
                found.append(sorted(ids))
            return [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int32())),
                    pa.array(found, pa.list_(pa.string()))]

        return scan

    return work


def find_benchmark(docs: DataFrame, items: DataFrame, text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                   block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, dict[str, str]]:
    """Every row and column of ``docs`` with three columns more, and the names
    that these got: ``words`` (how many), ``spans`` (hit runs of words, as
    flat pairs of first word and word after the last) and ``items``."""
    spark = docs.sparkSession
    pats = staged(windows(items, item_id, item_text, window), "decontaminate-windows")
    size = F.length("pattern") + F.size("items") * 12
    total = pats.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-int(total) // block_chars))
    names = {k: fresh(f"benchmark_{k}", docs.columns) for k in ("words", "spans", "items")}
    spans_in, items_in = (fresh(c, [*docs.columns, *names.values()]) for c in ("_spans_in", "_items_in"))
    out = docs.select("*", F.lit(None).cast("array<int>").alias(spans_in), F.lit(None).cast("array<string>").alias(items_in))
    fields = [T.StructField(names["words"], T.LongType()),
              T.StructField(names["spans"], T.ArrayType(T.IntegerType())),
              T.StructField(names["items"], T.ArrayType(T.StringType()))]
    for k in range(blocks):
        own = pats if blocks == 1 else pats.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k)
        held = spark.sparkContext.broadcast([(r.pattern, r["items"]) for r in own.toLocalIterator()])
        out = mapped(out, [text_col, spans_in, items_in], fields, _scanner(held))
        if k + 1 < blocks:
            out = staged(out, "decontaminate-block").drop(names["words"])
            out = out.select(*[quoted(c) for c in docs.columns],
                             quoted(names["spans"]).alias(spans_in),
                             quoted(names["items"]).alias(items_in))
    return out.drop(spans_in, items_in), names


def hit_words(spans):
    """Number of words in the hit runs."""
    return F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                       F.lit(0).cast("long"), lambda s, x: s + x)


def char_spans(text, spans):
    """The hit runs as character offsets [start, end) in the original text."""

    @F.pandas_udf("array<struct<start:long,end:long>>")
    def offsets(texts, runs):
        out = []
        for t, r in zip(texts, runs):
            r = [] if r is None else list(r)
            if t is None or not r:
                out.append([])
                continue
            raw = np.frombuffer(t.encode(), np.uint8)
            word = np.frombuffer(t.encode().translate(_FOLD), np.uint8) != 32
            edge = np.diff(word.astype(np.int8), prepend=0, append=0)
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            char = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            out.append([{"start": int(char[first[a]]), "end": int(char[last[b - 1]])}
                        for a, b in zip(r[::2], r[1::2])])
        return __import__("pandas").Series(out)

    return offsets(text, spans)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, columns unchanged."""
    found, names = find_benchmark(docs, items, text_col, **options)
    clean = F.size(quoted(names["spans"])) == 0
    return reduce(DataFrame.drop, names.values(), found.filter(clean))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: its words, hit words, items, their digest, the verdict
    and the hit passages as character offsets."""
    found, names = find_benchmark(docs.select("doc_id", "text"), items)
    spans, ids = quoted(names["spans"]), quoted(names["items"])
    return found.select(
        "doc_id", quoted(names["words"]).alias("n_words"), hit_words(spans).alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size(spans) > 0).alias("contaminated"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), p AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS pattern
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM p
), dw AS (
  SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS pattern
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)
), hit AS (SELECT dw.doc_id, dw.k, dw.n, p.item_id FROM dw JOIN p ON dw.n = p.n AND dw.pattern = p.pattern
), words AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM hit) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
