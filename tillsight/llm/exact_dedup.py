"""Operator 4, exact dedup by an extendible-hash index on shared files.

Native: DataFrame functions only.

1. A text's key is a 64-bit hash of its normalised form. The directory starts as
   one bucket and doubles: a bucket of more than ``capacity`` keys splits by the
   next bit of the key, all others keep their local depth. Counts of the distinct
   keys per 16 bits (65,536 rows at most, whatever the data) are refined for the
   overfull cells only, 16 more bits a round, until nothing is overfull or 64 bits
   are used. Buckets hold at least twice the mean of those cells, so that the
   directory of any table is about its first round, which tasks get by broadcast.
2. The directory sends every row to its bucket. Within a bucket rows meet by key
   and by the text itself, byte by byte; copies collapse inside each task before
   anything is shuffled, so one text that holds a third of all rows costs one row a
   task. Different texts of one key follow each other as a chain, told apart by
   their digest.
3. Slots are written to files of the shared folder by ranges of buckets, in key
   order: each file is the range of one owner task.
4. Every row looks its slot up by bucket and key and walks the chain by digest. A
   hot key's rows are split by the adaptive skew join: the slot side has one row
   for each text.

Defined cases: null counts as empty text; equal length and doc_id (a repeated
row) are the same document and both count as staying; a null doc_id comes
after all others; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted, staged, without_spaces

CAPACITY = 4096
_STEP = 16


def _cell(base: int):
    """The bits of ``key`` before ``base`` and the 16 behind them."""
    above = F.shiftrightunsigned("key", 64 - base) if base else F.lit(0).cast("long")
    return above.alias("above"), F.shiftrightunsigned("key", 64 - _STEP - base).bitwiseAND((1 << _STEP) - 1).alias("cell")


def directory(keys: DataFrame, capacity: int) -> list[DataFrame]:
    """The directory for a column ``key`` of distinct keys: for each round of 16
    bits the cells (``above``, ``cell``) that end there, with the local depth ``d``
    beyond the round's first bit."""
    rounds = []
    todo = keys.select("key")
    for base in range(0, 64, _STEP):
        counts = staged(todo.select(*_cell(base)).groupBy("above", "cell").agg(F.count("*").alias("slots")), "exact-cells")
        # A bucket at depth d of a cell is the sum of the cells that share
        # its first d bits; the local depth is the first that fits.
        levels = (counts.select("above", "slots", F.explode(F.sequence(F.lit(0), F.lit(_STEP))).alias("d"), "cell")
                  .select("above", "d", F.expr(f"shiftright(cell, {_STEP} - d)").alias("prefix"), "slots")
                  .groupBy("above", "d", "prefix").agg(F.sum("slots").alias("filled")))
        fits = levels.filter((F.col("filled") <= capacity) | ((F.col("d") == _STEP) & F.lit(base + _STEP == 64)))
        leaf = (counts.select("above", "cell", F.explode(F.sequence(F.lit(0), F.lit(_STEP))).alias("d"))
                .withColumn("prefix", F.expr(f"shiftright(cell, {_STEP} - d)"))
                .join(fits, ["above", "d", "prefix"])
                .groupBy("above", "cell").agg(F.min("d").alias("d")))
        rounds.append(staged(leaf, "exact-directory"))
        if counts.join(rounds[-1], ["above", "cell"], "left_anti").isEmpty():
            break
        todo = todo.select("key", *_cell(base)).join(rounds[-1], ["above", "cell"], "left_anti").select("key")
    return rounds


def routed(rows: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """``rows`` (with a column ``key``) with their ``bucket``, the key's first
    ``depth`` bits aligned to 64, as the directory says; rows of a key that it
    doesn't know have none."""
    out = rows
    for k, leaf in enumerate(rounds):
        above, cell = _cell(k * _STEP)
        leaf = leaf.withColumnRenamed("d", f"d{k}")
        out = out.withColumn("above", above).withColumn("cell", cell).join(
            F.broadcast(leaf) if k == 0 else leaf, ["above", "cell"], "left").drop("above", "cell")
    depth = F.coalesce(*(F.col(f"d{k}") + k * _STEP for k in range(len(rounds))))
    bits = F.expr("shiftleft(shiftrightunsigned(key, 64 - depth), 64 - depth)")
    return (out.withColumn("depth", depth).withColumn("bucket", F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(bits))
            .filter("bucket IS NOT NULL").drop(*(f"d{k}" for k in range(len(rounds)))))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY) -> tuple[DataFrame, list[DataFrame]]:
    """The index files: one row a slot with ``bucket``, ``depth``, ``key``,
    ``digest``, ``keep_id``, ``keep_length`` and ``group_size``; and its directory."""
    text = F.coalesce(quoted(text_col), F.lit(""))
    rows = docs.select(quoted(id_col).alias("id"), F.length(text).alias("n"), without_spaces(text).alias("norm")) \
        .withColumn("key", F.xxhash64("norm"))
    keys = staged(rows.select("key").distinct(), "exact-keys")
    rounds = directory(keys, max(capacity, 2 * keys.count() >> _STEP))
    same = routed(rows, rounds).groupBy("bucket", "depth", "key", "norm", "n").agg(F.min("id").alias("id"), F.count("*").alias("rows"))
    slots = (same.select("bucket", "depth", "key", F.sha2("norm", 256).alias("digest"), "n", "id", "rows")
             .groupBy("bucket", "depth", "key", "digest")
             .agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("last"), "id")).alias("keep"),
                  F.sum("rows").alias("group_size"))
             .select("bucket", "depth", "key", "digest", F.col("keep.id").alias("keep_id"),
                     (-F.col("keep.n")).alias("keep_length"), "group_size"))
    index = slots.repartitionByRange(F.shiftrightunsigned("bucket", 1), "key").sortWithinPartitions("key", "digest")
    return staged(index, "exact-index"), rounds


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY) -> DataFrame:
    """One row for each row of ``docs``: its id, the id that stays for its
    text, the size of the group, whether it stays, and the text's digest."""
    index, rounds = build_index(docs, id_col, text_col, capacity)
    text = F.coalesce(quoted(text_col), F.lit(""))
    rows = (docs.select(quoted(id_col).alias("id"), F.length(text).alias("n"), without_spaces(text).alias("norm"))
            .select("id", "n", F.xxhash64("norm").alias("key"), F.sha2("norm", 256).alias("digest")))
    return (routed(rows, rounds).drop("depth").join(index, ["bucket", "key", "digest"])
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_length"))).alias("kept"),
                    F.col("digest").alias("text_sha256")))


SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
  FROM t WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
