"""Operator 13, importance resampling towards a target distribution.

1. Features of a text are its runs of one and two consecutive words (A-Z in lower
   case, joined by a blank), each hashed by crc32 into ``BUCKETS`` buckets. Texts
   are read once; a document's buckets, two bytes each, are kept in a table.
2. An array of gains holds, for each bucket, 1000 times the log-ratio of its
   smoothed share of the target's features to that of the documents', floored. A
   document's weight is the floored mean of the gains of its features.
3. A score adds Gumbel noise to the weight, drawn from a hash of seed and id, so
   the highest scores are a weighted draw without replacement and reruns agree.
4. Of the documents with enough words the highest ``floor(share * N)`` scores are
   found by a distributed quickselect: random pivot keys among the rows still in
   question, exact counts of the rows below, at and above each, and the range that
   holds the wanted rank is written and goes on, about a fiftieth of it a round.
   Keys are (score, id, digest of the text, row number), so no two are equal.
5. Winners alone are sorted, by ranges in parallel; a rank is a row's place in its
   range behind the rows of the ranges before.

Bounds: 10,000 gains and ``PIVOTS`` keys a round are all that meets on the driver;
counts are combined in each task.

Defined cases: null and wordless texts have no features and weight 0; a null id
scores as the text "null" would and ranks after all ids; repeated rows score
alike and take ranks of their own; an empty target leaves the smoothing alone;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, fresh, mapped, pieces, quoted, small, staged, texts_of

BUCKETS = 10_000
SHARE_PERCENT, MIN_WORDS, SEED = 25, 20, 7
PIVOTS = 48
RANGE_ROWS = 10_000  # winners in a range of the final sort, about
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def features_of(words: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of the single words, then of the neighbouring pairs."""
    hashes = [crc32(w) for w in words]
    hashes += [crc32(b, crc32(b" ", h)) for h, b in zip(hashes[:-1], words[1:])]  # crc32 of "a b" goes on from that of "a"
    return np.array(hashes, np.uint32) % np.uint32(buckets)


def featurised(docs: DataFrame, text_col: str, buckets: int = BUCKETS) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with two columns more: how many words, and the buckets of the
    features as little-endian 16-bit numbers."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must fit 16 bits")
    names = {c: fresh(c, docs.columns) for c in ("n_words", "features")}

    def work():
        def hashed(columns: list[pa.Array]) -> list[pa.Array]:
            counts, found = [], []
            for a, b in pieces(columns[0], 1 << 20):
                for text in texts_of(columns[0].slice(a, b - a)):
                    words = words_of(text)
                    counts.append(len(words))
                    found.append(features_of(words, buckets).astype("<u2").tobytes())
            return [pa.array(counts, pa.int64()), pa.array(found, pa.binary())]

        return hashed

    return mapped(docs, [text_col], [T.StructField(names["n_words"], T.LongType()),
                                     T.StructField(names["features"], T.BinaryType())], work), names


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in the binary column of ``features``."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in small(batches, 0):
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u2"), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in features.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains_of(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, a bucket."""
    k, t_all, s_all = len(target), int(target.sum()), int(source.sum())
    return np.array([math.floor(1000 * math.log(float((int(t) + 1) * (s_all + k)) / float((int(s) + 1) * (t_all + k))))
                     for t, s in zip(target, source)], np.int64)


def noise(doc_id: str, seed: int = SEED) -> int:
    """floor(1000 * Gumbel noise) from the first 32 bits of a sha256."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, id_col: str, column: str, gains: np.ndarray, seed: int = SEED) -> tuple[DataFrame, dict[str, str]]:
    """``features`` with three columns more: how many features, weight, score."""
    held = features.sparkSession.sparkContext.broadcast(gains)
    names = {c: fresh(c, features.columns) for c in ("n_features", "weight", "score")}
    ids = fresh("_id_text", features.columns)

    def work():
        gains = held.value

        def score(columns: list[pa.Array]) -> list[pa.Array]:
            sizes, weights = [], []
            for x in columns[0]:
                own = np.frombuffer(x.as_py(), "<u2")
                sizes.append(len(own))
                weights.append(int(gains[own].sum()) // len(own) if len(own) else 0)
            scores = [w + noise(i.as_py(), seed) for w, i in zip(weights, columns[1])]
            return [pa.array(c, pa.int64()) for c in (sizes, weights, scores)]

        return score

    rows = features.withColumn(ids, F.coalesce(quoted(id_col).cast("string"), F.lit("null")))
    out = mapped(rows, [column, ids], [T.StructField(names[c], T.LongType()) for c in ("n_features", "weight", "score")], work)
    return out.drop(ids), names


def quickselect(rows: DataFrame, key: Column, k: int, pivots: int = PIVOTS, seed: int = SEED):
    """The key of rank ``k`` (from 1) in the order of ``key``, a struct that no
    two rows share, as a row of its fields; ``rows`` must hold ``k`` rows."""
    keys, spent = rows.select(key.alias("key")), None
    for turn in range(10_000):
        drawn = keys.orderBy(F.xxhash64(F.lit(seed + turn), "key"), "key").limit(pivots)
        marks = [r["key"] for r in drawn.orderBy("key").collect()]
        # Cell 2i lies before mark i, cell 2i + 1 holds the mark itself.
        ladder = F.array(*(_literal(m, keys.schema["key"].dataType) for m in marks))
        below = F.size(F.filter(ladder, lambda m: m < F.col("key"))) + F.size(F.filter(ladder, lambda m: m <= F.col("key")))
        cells = {r["cell"]: r["count"] for r in keys.groupBy(below.alias("cell")).count().collect()}
        for cell in sorted(cells):
            if k <= cells[cell]:
                break
            k -= cells[cell]
        if cell % 2:
            if spent is not None:
                discard(spent)
            return marks[cell // 2]
        after = F.lit(True) if cell == 0 else F.col("key") > _literal(marks[cell // 2 - 1], keys.schema["key"].dataType)
        before = F.lit(True) if cell == 2 * len(marks) else F.col("key") < _literal(marks[cell // 2], keys.schema["key"].dataType)
        keys, done = staged(keys.filter(after & before), "select-range"), spent
        if done is not None:
            discard(done)
        spent = keys
    raise RuntimeError("no rank found")


def _literal(row, kind: T.StructType) -> Column:
    return F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, kind.fields)))


def ranked(rows: DataFrame, order: list[Column], name: str, per_range: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with their place (from 1) in ``order``, as column ``name``."""
    n = rows.count()
    part = fresh("_part", rows.columns)
    dealt = staged(rows.repartitionByRange(max(1, -(-n // per_range)), *order).withColumn(part, F.spark_partition_id()), "ranges")
    behind, before = 0, []
    for r in dealt.groupBy(part).count().orderBy(part).collect():
        before.append((r[0], behind))
        behind += r["count"]
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order)).cast("long")
    starts = dealt.sparkSession.createDataFrame(before, T.StructType(
        [T.StructField(part, T.IntegerType()), T.StructField(name, T.LongType())]))
    return dealt.join(starts, part).select(*[quoted(c) for c in rows.columns], (quoted(name) + place).alias(name))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             percent: int = SHARE_PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             pivots: int = PIVOTS, per_range: int = RANGE_ROWS) -> tuple[DataFrame, dict[str, str]]:
    """Every row of ``docs`` (without its text) with columns more, by name:
    ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``, the place
    in the draw (null outside it)."""
    own, digest = fresh("_own", docs.columns), fresh("_digest", docs.columns)
    rest = [c for c in docs.columns if c != text_col]
    found, f = featurised(docs.select("*", F.monotonically_increasing_id().alias(own),
                                      F.xxhash64(quoted(text_col)).alias(digest)), text_col)
    found = staged(found.drop(text_col), "resample-features")
    wanted, t = featurised(target.select(quoted(target_col).alias("text")), "text")
    gains = gains_of(bucket_counts(wanted.select(t["features"])), bucket_counts(found.select(quoted(f["features"]))))
    rows, names = scored(found, id_col, f["features"], gains, seed)
    rows = staged(rows.drop(f["features"]), "resample-scores")
    discard(found)
    names = {"n_words": f["n_words"], **names, "rank": fresh("rank", rows.columns)}
    fields = [-quoted(names["score"]), quoted(id_col).isNull(), quoted(id_col), quoted(digest), quoted(own)]
    key = F.struct(*(c.alias(f"k{i}") for i, c in enumerate(fields)))
    enough = quoted(names["n_words"]) >= min_words
    k = percent * rows.filter(enough).count() // 100
    kept = [*rest, *(names[c] for c in ("n_words", "n_features", "weight", "score"))]
    nowhere = F.lit(None).cast("long").alias(names["rank"])
    if k == 0:
        return rows.select(*[quoted(c) for c in kept], nowhere), names
    last = quickselect(rows.filter(enough), key, k, pivots, seed)
    bound = _literal(last, rows.select(key.alias("k")).schema["k"].dataType)
    drawn = enough & (key <= bound)
    won = ranked(rows.filter(drawn), fields, names["rank"], per_range)
    return (won.select(*[quoted(c) for c in [*kept, names["rank"]]])
            .unionAll(rows.filter(~drawn).select(*[quoted(c) for c in kept], nowhere))), names


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every document's features, weight, score and rank in a draw of a quarter
    of the documents of 20 words or more, towards the benchmark's texts."""
    out, names = resample(docs.select("doc_id", "text"), benchmark)
    return out.select("doc_id", *(quoted(names[c]).alias(c) for c in ("n_features", "weight", "score", "rank")))


# crc32 byte by byte: a table of 256 remainders, made by its rule.
_CRC_TABLE = ("list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], "
              "lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))")
_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
SQL = rf"""
WITH d AS (
  SELECT doc_id, {_WORDS} AS words FROM documents
), b AS (
  SELECT {_WORDS} AS words FROM benchmark
), df AS (
  SELECT doc_id, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM d
), bf AS (
  SELECT unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM b
), known AS (
  SELECT feature, hex(encode(feature)) AS h FROM (SELECT feature FROM df UNION SELECT feature FROM bf)
), table_of AS (
  SELECT {_CRC_TABLE} AS crc
), hashed AS (
  SELECT feature, xor(list_reduce(list_concat([4294967295], list_transform(range(0, length(h) // 2),
           lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT))), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295)
         % {BUCKETS} AS bucket
  FROM known, table_of
), s AS (
  SELECT bucket, count(*) AS n FROM df JOIN hashed USING (feature) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS n FROM bf JOIN hashed USING (feature) GROUP BY bucket
), g AS (
  SELECT s.bucket, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM df) + {BUCKETS}) AS DOUBLE)
           / CAST((s.n + 1) * ((SELECT count(*) FROM bf) + {BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)
), w AS (
  SELECT doc_id, count(*) AS n_features, sum(gain) AS total
  FROM df JOIN hashed USING (feature) JOIN g USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, len(d.words) AS n_words, coalesce(n_features, 0) AS n_features,
         CAST(coalesce(floor(total / n_features), 0) AS BIGINT) AS weight,
         CAST('0x' || sha256('{SEED}:' || d.doc_id)[1:8] AS BIGINT) AS h
  FROM d LEFT JOIN w USING (doc_id)
), drawn AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, {SHARE_PERCENT} * count(*) OVER () // 100 AS k
  FROM drawn WHERE n_words >= {MIN_WORDS}
)
SELECT drawn.doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CAST(CASE WHEN place <= k THEN place END AS BIGINT) AS rank
FROM drawn LEFT JOIN r USING (doc_id)
"""
