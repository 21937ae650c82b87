"""Operator 9, substring dedup by line or paragraph hashing.

Units are the pieces of a text between separators: lines ("\\n", the default)
or paragraphs ("\\n\\n"). A unit is normalised (A-Z in lower case, runs of ASCII
white space as one space, trimmed) and hashed to 128 bits; over all documents
the earliest ranked occurrence (smallest document id, then the earliest unit)
keeps its text and every later one goes. Every unit that isn't empty is
compared; with the option ``min_words`` units of fewer words stay. The offsets
[start, end) of what goes are kept, in characters of the original.

The earliest occurrence is an aggregate that combines inside each task, so a
line on a third of all documents costs a row a task; the look-up of a hot key
is a join that Spark splits; removed spans gather by document.

Defined cases: null text has no units and stays null; empty units stay; rows
with a null id rank last, by a hash of their text; rows that repeat id and text
tie, so both keep what is first in either; an empty table gives no rows. A
removed unit goes with the separator after it.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, UPPER, fresh, mapped, quoted, small, staged

MIN_WORDS = 1  # every unit that isn't empty
_SPACE = " \t\n\x0b\x0c\r"
_FOLD = str.maketrans(UPPER + _SPACE, LOWER + " " * len(_SPACE))


def units_of(text: str, separator: str, min_words: int):
    """(start, end, normalised) of the units long enough to compare; the end
    lies behind the separator."""
    start = 0
    while start <= len(text):
        stop = text.find(separator, start)
        end = len(text) if stop < 0 else stop
        words = [w for w in text[start:end].translate(_FOLD).split(" ") if w]
        if len(words) >= min_words:
            yield start, min(end + len(separator), len(text)), " ".join(words)
        start = end + len(separator)


def later_units(docs: DataFrame, id_col: str, text_col: str, separator: str = "\n",
                min_words: int = MIN_WORDS) -> DataFrame:
    """For each document (``id`` and ``hash`` of its text) with any: ``gone``,
    the sorted [start, end) of its units that repeat an earlier one."""
    rows = docs.select(quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("hash"),
                       quoted(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("hash", T.LongType()),
                           T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                           T.StructField("digest", T.BinaryType())])

    def run(batches):
        for batch in small(batches, 2):
            at, starts, ends, digests = [], [], [], []
            for i, text in enumerate(batch.column(2)):
                for start, end, norm in units_of(text.as_py() or "", separator, min_words):
                    at.append(i)
                    starts.append(start)
                    ends.append(end)
                    digests.append(hashlib.blake2b(norm.encode(), digest_size=16).digest())
            where = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(where), batch.column(1).take(where), pa.array(starts, pa.int64()),
                 pa.array(ends, pa.int64()), pa.array(digests, pa.binary())], names=schema.names)

    units = staged(rows.mapInArrow(run, schema), "line-units")
    rank = F.struct(F.col("id").isNull().alias("last"), "id", "hash", "start")
    # Written, so that both sides of the join are dealt anew and a hot digest's
    # rows can be split.
    first = staged(units.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("uses"))
                   .filter("uses > 1").select("digest", "first"), "line-first")
    return (units.join(first, "digest").filter(rank != F.col("first"))
            .groupBy("id", "hash").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("gone")))


def line_hash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", separator: str = "\n",
                    min_words: int = MIN_WORDS) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with ``text_col`` rewritten, and the names of two columns more:
    ``units`` (how many were compared) and ``spans`` (what went)."""
    gone = later_units(docs, id_col, text_col, separator, min_words)
    names = {k: fresh(k, [*docs.columns, "id", "hash", "gone"]) for k in ("_id", "_hash", "_kept", "units", "spans")}
    gone = gone.select(F.col("id").alias(names["_id"]), F.col("hash").alias(names["_hash"]),
                       F.col("gone").alias(names["spans"]))
    joined = docs.join(gone, quoted(id_col).eqNullSafe(F.col(names["_id"]))
                       & (F.xxhash64(quoted(text_col)) == F.col(names["_hash"])), "left") \
        .drop(names["_id"], names["_hash"])

    def work():
        def cut(columns: list[pa.Array]) -> list[pa.Array]:
            kept, counts = [], []
            for text, spans in zip(*columns):
                text, spans = text.as_py(), spans.as_py() or []
                counts.append(sum(1 for _ in units_of(text or "", separator, min_words)))
                if spans:
                    edges = [0, *(x for s in spans for x in (s["start"], s["end"])), len(text)]
                    text = "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                kept.append(text)
            return [pa.array(kept, pa.string()), pa.array(counts, pa.int64())]

        return cut

    done = mapped(joined, [text_col, names["spans"]],
                  [T.StructField(names["_kept"], T.StringType()), T.StructField(names["units"], T.LongType())], work)
    spans = F.coalesce(quoted(names["spans"]), F.array().cast("array<struct<start:bigint,end:bigint>>"))
    return done.select(*[quoted(names["_kept"]).alias(c) if c == text_col else quoted(c) for c in docs.columns],
                       quoted(names["units"]), spans.alias(names["spans"])), names


def report(docs: DataFrame) -> DataFrame:
    """Per document: lines compared, lines removed, how many characters went
    with them (``n_removed``, line breaks included), the lines' offsets and the
    digest of the text that stays."""
    out, names = line_hash_dedup(docs.select("doc_id", "text"))
    spans = quoted(names["spans"])
    return out.select(
        "doc_id", quoted(names["units"]).alias("n_units"), F.size(spans).cast("long").alias("n_units_removed"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))),
                     ",").alias("removed_spans"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), u AS (
  SELECT doc_id, text, unnest(range(1, len(parts) + 1)) AS n, unnest(parts) AS unit FROM t
), o AS (
  SELECT doc_id, n, unit, length(text) AS total,
         sum(length(unit) + 1) OVER (PARTITION BY doc_id ORDER BY n) - length(unit) - 1 AS start,
         trim(regexp_replace(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM u
), r AS (
  SELECT *, norm <> '' AS long, least(start + length(unit) + 1, total) AS stop,
         row_number() OVER (PARTITION BY norm ORDER BY doc_id, n) AS rank
  FROM o
)
SELECT doc_id, CAST(count(*) FILTER (WHERE long) AS BIGINT) AS n_units,
       CAST(count(*) FILTER (WHERE long AND rank > 1) AS BIGINT) AS n_units_removed,
       CAST(coalesce(sum(stop - start) FILTER (WHERE long AND rank > 1), 0) AS BIGINT) AS n_removed,
       coalesce(string_agg(CAST(start AS BIGINT) || '-' || CAST(stop AS BIGINT), ',' ORDER BY n)
                FILTER (WHERE long AND rank > 1), '') AS removed_spans,
       sha256(coalesce(string_agg(unit || CASE WHEN start + length(unit) < total THEN chr(10) ELSE '' END, ''
                                  ORDER BY n) FILTER (WHERE NOT (long AND rank > 1)), '')) AS kept_sha256
FROM r GROUP BY doc_id
"""
