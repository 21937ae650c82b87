"""Operator 12, runs of words that repeat with a period.

A run is a stretch of consecutive words with smallest period q (words q apart
are the same), at least ``min_length`` words and ``min_repeats`` * q long, that no
neighbouring word extends. Found by a dictionary of basic factors:

1. Level k names each factor of 2**k words of a text; a name of level k + 1 is a
   pair of names of level k. Factors that occur once in their text have no
   successor, neither has any factor that holds them: they leave the dictionary.
2. A factor's next occurrence at a distance p, 2**(k-1) < p <= 2**k (its window
   is twice the factor's length), proposes the period p. In a run of four periods
   or more such occurrences form an arithmetic progression from every start, so
   neighbouring positions with one distance are one proposal.
3. A proposal that is long enough is extended word by word both ways and kept
   once. Four periods make p the smallest: a shorter one would divide it and have
   been the nearer occurrence.

All levels of a text cost O(n log n) sorting steps; a batch of about
``BATCH_BYTES`` goes through together. Texts stay in their task; nothing is
shuffled. Memory follows the longest text (about 200 bytes a word).

``min_repeats`` of less than 3 is refused, since step 3 needs it. Defined cases:
null and blank texts have no words and no runs, and collapse to an empty text;
runs don't cross texts; repeated rows get the same runs; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, mapped, pieces, quoted, texts_of

MIN_LENGTH, MIN_REPEATS = 6, 4
BATCH_BYTES = 1 << 20
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def proposals(words: np.ndarray, size: np.ndarray, min_length: int, min_repeats: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of stretches that hold a run, from the factors of
    texts laid end to end: ``words`` are numbers, ``size`` counts them a text."""
    n = len(words)
    doc = np.repeat(np.arange(len(size)), size)
    longest = (size // min_repeats)[doc]  # the longest period that fits
    pos, width = np.arange(n), 1
    key = doc * (int(words.max()) + 1) + words if n else words
    while len(pos):
        # Order by factor, then position: neighbours of one name are successors.
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        name = np.empty(len(pos), np.int64)
        name[order] = np.concatenate([[0], np.cumsum(~same)])
        gap = np.zeros(len(pos), np.int64)
        gap[order[:-1][same]] = (pos[order[1:]] - pos[order[:-1]])[same]
        # Neighbouring positions at one distance within the window.
        near = (gap > width // 2) & (gap <= width)
        joined = near[1:] & near[:-1] & (gap[1:] == gap[:-1]) & (pos[1:] == pos[:-1] + 1)
        first = np.flatnonzero(near & np.concatenate([[True], ~joined]))
        last = np.flatnonzero(near & np.concatenate([~joined, [True]]))
        for s, e, p in zip(pos[first].tolist(), (pos[last] + gap[last] + width).tolist(), gap[first].tolist()):
            if e - s >= max(min_length, min_repeats * p):
                yield s, e, p
        # Factors of twice the width, where both halves recur in their text.
        often = np.zeros(len(pos), bool)
        often[order[1:][same]] = often[order[:-1][same]] = True
        often &= longest[pos] > width  # the next level proposes periods above this width
        at, keep = np.full(n + 1, -1, np.int64), pos[often]
        at[keep] = name[often]
        behind = np.minimum(keep + width, n)
        both = (at[behind] >= 0) & (doc[np.minimum(behind, n - 1)] == doc[keep])
        pos = keep[both]
        key = at[pos] * (int(name.max()) + 1) + at[pos + width]
        width *= 2


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH,
            min_repeats: int = MIN_REPEATS) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs (start, length, period), in order."""
    known: dict[bytes, int] = {}
    words = np.array([known.setdefault(w, len(known)) for t in texts for w in t], np.int64)
    size = np.array([len(t) for t in texts], np.int64)
    base = np.cumsum(size) - size
    found: list[set] = [set() for _ in texts]
    for s, e, p in proposals(words, size, min_length, min_repeats):
        d = int(np.searchsorted(base, s, "right")) - 1
        low, high = int(base[d]), int(base[d] + size[d])
        while s > low and words[s - 1] == words[s - 1 + p]:
            s -= 1
        while e < high and words[e] == words[e - p]:
            e += 1
        found[d].add((s - low, e - s, p))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that any run holds after its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def find_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH,
              min_repeats: int = MIN_REPEATS) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with two columns more, and their names: ``runs`` (start, length
    and period in words, by start and period) and ``collapsed``, the text with
    one period of each run."""
    if min_repeats < 3:
        raise ValueError("min_repeats must be 3 or more")
    names = {c: fresh(c, docs.columns) for c in ("runs", "collapsed")}

    def work():
        def find(columns: list[pa.Array]) -> list[pa.Array]:
            runs, short = [], []
            for a, b in pieces(columns[0], BATCH_BYTES):
                texts = [t.split() for t in texts_of(columns[0].slice(a, b - a))]
                got = runs_of(texts, min_length, min_repeats)
                runs += [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in got]
                short += [collapsed(t, r).decode() for t, r in zip(texts, got)]
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            return [pa.array(runs, kind), pa.array(short, pa.string())]

        return find

    return mapped(docs, [text_col], [T.StructField(names["runs"], RUNS),
                                     T.StructField(names["collapsed"], T.StringType())], work), names


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period (compared exactly, by cross
    products), then the smallest start, then the smallest period; null of none."""
    def better(best: Column, x: Column) -> Column:
        ahead = x["length"] * best["period"] - best["length"] * x["period"]
        tie = (x["start"] < best["start"]) | ((x["start"] == best["start"]) & (x["period"] < best["period"]))
        return F.when(best.isNull() | (ahead > 0) | ((ahead == 0) & tie), x).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUNS.elementType), better)


def planted(doc_id: Column, text: Column) -> Column:
    """The text with a period planted where the registered query asks for it:
    h = crc32 of the id in decimal; of a tenth of the ids (h % 10 = 0; never a
    null one) each word i from a on becomes word a + (i - a) % p, with
    g = h // 10, a = g % n, p = 1 + (n - a) // (3 + g % 8)."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.greatest(F.size(words), F.lit(1))
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    told = F.slice(F.concat(F.slice(words, 1, a), F.flatten(F.array_repeat(F.slice(words, a + 1, p), times))), 1, n)
    return F.when((h % 10 == 0) & (F.size(words) > 0), F.array_join(told, " ")).otherwise(text)


def report(docs: DataFrame) -> DataFrame:
    """Per document: how many runs, the strongest one, and digests of all runs
    and of the text that is left."""
    out, names = find_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    runs = quoted(names["runs"])
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    best = F.col("best")
    return out.withColumn("best", strongest(runs)).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2(quoted(names["collapsed"]), 256).alias("collapsed_sha256"))
