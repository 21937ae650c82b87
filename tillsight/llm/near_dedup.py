"""Operator 6, near-duplicate documents by min-max hashing.

A document's set is its distinct shingles of ``width`` words (A-Z in lower
case, words between ASCII white space; a shorter text is one shingle). Under
each of ``PERMUTATIONS`` hash orders both the smallest and the largest shingle
are signature values, twice as many as hash evaluations. ``BANDS`` bands of
``ROWS`` values put documents into buckets; a pair at similarity 0.8 misses all
of them with a chance of 5e-8 (of 6e-7 for sets of five with four in common, where
the smallest and the largest depend on each other). Links are confirmed on the full
sets.

1. Documents with the same set form a class; only classes go on.
2. In each bucket one leader, the class whose buckets are the fullest, is
   compared with all others. That settles a group of copies of one document:
   its original leads, and what is connected needs no further test.
3. Of a bucket that isn't connected then, the members outside its largest
   component are compared with all members, in blocks of at most ``HELD``
   against ``PASSED``: the first are held in a task, the others stream past.
   Every pair of a bucket that could add a link is compared (the work is square
   in what isn't connected, as it must be to rule every link out), no pair is a
   row, and a group yields fewer links than it has members.
4. Components are the fixed point of large-star and small-star steps over the
   links, as joins and aggregates on written tables.

Defined cases: null, empty and wordless texts have an empty set, are linked
with nothing and are their own component; repeated rows share a class; rows
with a null id join a component but never name it while another can; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, discard, fresh, quoted, small, staged

PERMUTATIONS, BANDS, ROWS = 64, 32, 4
HELD, PASSED = 512, 512
WIDTH, PERCENT = 2, 80
SEED = 5
KNOWN_WORDS = 100_000
BATCH_ROWS = 1000  # of texts handed to Python at a time
TEXTS_A_FILE = 4000
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sorted distinct shingle hashes (64 bits) of texts; remembers the hashes
    of a bounded number of words."""

    def __init__(self, width: int):
        self.width = width
        rng = np.random.default_rng(SEED)
        self.factors = rng.integers(1, 1 << 63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known, hashes = self.known, []
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest(w)
            hashes.append(h)
        h = np.array(hashes, np.uint64)
        if len(words) < self.width:
            return np.array([xxhash.xxh64_intdigest(h.tobytes(), seed=len(words))], np.uint64)
        n = len(h) - self.width + 1
        total = h[:n] * self.factors[0]
        for j in range(1, self.width):
            total = total + h[j:j + n] * self.factors[j]
        return np.unique(_mixed(total))


def _signer():
    rng = np.random.default_rng(SEED + 1)
    factor = rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offset = rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
    fold = rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def bands(shingles: np.ndarray) -> np.ndarray:
        """Band keys of a non-empty set."""
        low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(PERMUTATIONS, np.uint64)
        for k in range(0, len(shingles), 1024):
            x = np.multiply.outer(factor, shingles[k:k + 1024]) + offset[:, None]
            low, high = np.minimum(low, x.min(1)), np.maximum(high, x.max(1))
        values = np.stack([low, high], 1).reshape(BANDS, ROWS)
        return _mixed((_mixed(values) * fold).sum(1)).view(np.int64)

    return bands


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id``, ``row`` (hash of id and text), ``n`` (size of the set), ``node``
    (digest of the set, null for an empty one) and ``bands`` of every row."""
    rows = _rows(docs, id_col, text_col)
    schema = T.StructType([rows.schema["id"], T.StructField("row", T.LongType()), T.StructField("n", T.LongType()), T.StructField("node", T.BinaryType()),
                           T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        shingles, sign = Shingles(width), _signer()
        for batch in small(batches, 2):
            sizes, nodes, bands = [], [], []
            for text in batch.column(2):
                s = shingles((text.as_py() or "").encode())
                sizes.append(len(s))
                nodes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(sign(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], names=schema.names)

    return rows.mapInArrow(run, schema)


_LINK = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def compare(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (``a``, ``b``) between roots: of each ``key``, rows of ``side`` 0
    are held and those of side 1 compared with all of them. ``root`` tells what
    is connected already; a link that connects nothing new is left out."""

    def run(batches):
        shingles = Shingles(width)
        key, roots, sets, joined = None, [], [], {}
        flat = owner = sizes = None

        def find(x):
            while x in joined:
                x = joined[x]
            return x

        for batch in small(batches, 3):
            links = []
            for k, side, root, text in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    key, roots, sets, joined, flat = k, [], [], {}, None
                s = shingles((text or "").encode())
                if side == 0:
                    roots.append(root)
                    sets.append(s)
                    continue
                if not sets:
                    continue
                if flat is None:
                    sizes = np.array([len(x) for x in sets])
                    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
                    order = np.argsort(flat, kind="stable")
                    flat, owner = flat[order], owner[order]
                low, high = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
                n = high - low
                at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(sizes))
                for i in np.flatnonzero(100 * both >= percent * (sizes + len(s) - both)).tolist():
                    x, y = find(roots[i]), find(root)
                    if x != y:
                        joined[x] = y
                        links.append((roots[i], root))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*links)], names=["a", "b"])

    dealt = rows.select("key", "side", "root", "text").repartition("key").sortWithinPartitions("key", "side")
    return dealt.mapInArrow(run, _LINK)


def components(links: DataFrame, first: str = "a", second: str = "b", rows: int | None = None) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node in
    ``links``, by alternating large-star and small-star steps. ``rows``, if
    known, is the number of links."""
    edges = staged(links.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
                   .filter("u != v").distinct(), "components", rows)
    mark = None
    while True:
        size = mark[0] if mark else rows  # a step reads two rows an edge
        size = None if size is None else 2 * size
        # Large star: every node's larger neighbours hang on its smallest one.
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that the rows of a node with very many links can be split.
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components", size)
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: every node and its smaller neighbours hang on the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = staged(small.unionAll(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), "components", size)
        before, mark = mark, tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        discard(edges, low)
        edges = new
        if mark == before or not mark[0]:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                percent: int = PERCENT, held: int = HELD, passed: int = PASSED) -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, ``n_shingles``,
    ``component_id`` and ``kept``."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        signed = staged(signatures(docs, id_col, text_col, width), "near-signatures")
    n_docs = signed.count()
    classes = signed.filter("node IS NOT NULL").groupBy("node").agg(
        F.first("n").alias("n"), F.first("bands").alias("bands"))
    entries = classes.select("node", "n", F.posexplode("bands").alias("band", "key")) \
        .select("node", "n", F.xxhash64("band", "key").alias("bucket"))
    shared = staged(entries.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1"),
                    "near-shared", BANDS * n_docs)
    n_members = shared.agg(F.sum("members")).first()[0] or 0
    members = staged(entries.join(shared, "bucket"), "near-members", BANDS * n_docs)
    rank = members.groupBy("node").agg(F.sum("members").alias("rank"))
    members = staged(members.join(rank, "node"), "near-ranked", n_members)
    texts = staged(_texts(docs, signed, members.select("node").distinct(), id_col, text_col), "near-texts", n_docs, TEXTS_A_FILE)
    leaders = staged(members.groupBy("bucket").agg(F.max(F.struct("rank", "node", "n")).alias("lead"))
                     .select("bucket", F.col("lead.node").alias("lead"), F.col("lead.n").alias("lead_n")), "near-leaders", n_members)
    followers = members.select("bucket", "node", "n").join(leaders, "bucket").filter("node != lead")

    # The leader of a bucket against the others, each pair once.
    pairs = staged(followers.filter(100 * F.least("n", "lead_n") >= percent * F.greatest("n", "lead_n"))
                   .select("lead", "node").distinct(), "near-pairs", n_members)
    blocks = pairs.groupBy("lead").agg(F.ceil(F.count("*") / passed).cast("int").alias("blocks"))
    led = pairs.join(staged(blocks, "near-blocks", n_members), "lead").select(
        F.xxhash64("lead", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).alias("key"), F.lit(1).alias("side"), "node")
    lead = blocks.select("lead", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block")).select(
        F.xxhash64("lead", "block").alias("key"), F.lit(0).alias("side"), F.col("lead").alias("node"))
    own = led.unionAll(lead).join(texts, "node").withColumn("root", F.col("node"))
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        links = staged(compare(own, width, percent), "near-links")
    roots = components(links, rows=links.count())

    # What is left of a bucket: members outside its largest component against all.
    left = staged(followers.select("bucket", "node").join(roots, "node", "left")
                  .select("bucket", "node", F.coalesce("root", "node").alias("root")), "near-left", n_members)
    parts = left.groupBy("bucket", "root").agg(F.count("*").alias("members"))
    split = staged(parts.groupBy("bucket").agg(F.max(F.struct("members", "root")).alias("main"), F.sum("members").alias("all"))
                   .filter("main.members < all")
                   .select("bucket", F.col("main.root").alias("main"),
                           F.ceil((F.col("all") - F.col("main.members")) / held).cast("int").alias("rows"),
                           F.ceil(F.col("all") / passed).cast("int").alias("columns")), "near-split", n_members)
    todo = left.join(split, "bucket")
    row, column = F.pmod(F.xxhash64("node"), F.col("rows")).cast("int"), F.pmod(F.xxhash64("node"), F.col("columns")).cast("int")
    outside = todo.filter("root != main").select("bucket", "node", "root", row.alias("row"), F.explode(
        F.expr("sequence(0, columns - 1)")).alias("column"), F.lit(0).alias("side"))
    everyone = todo.select("bucket", "node", "root", F.explode(F.expr("sequence(0, rows - 1)")).alias("row"),
                           column.alias("column"), F.lit(1).alias("side"))
    blocks = outside.unionAll(everyone).select(F.xxhash64("bucket", "row", "column").alias("key"), "side", "node", "root")
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        more = staged(compare(blocks.join(texts, "node"), width, percent), "near-links")
    # These links are between roots, so the components of the few roots that
    # they join are enough.
    above = components(more, rows=more.count()).select(F.col("node").alias("root"), F.col("root").alias("above"))
    named = signed.groupBy("node").agg(F.min("id").alias("id")).filter("node IS NOT NULL").join(roots, "node", "left") \
        .select("node", "id", F.coalesce("root", "node").alias("root")).join(above, "root", "left") \
        .select(F.col("node").alias("_node"), "id", F.coalesce("above", "root").alias("_root"))
    least = staged(named.groupBy("_root").agg(F.min("id").alias("least")), "near-least", n_docs)
    final = staged(named.join(least, "_root").select("_node", "least"), "near-final", n_docs)
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("least"))
    return (signed.select("id", "n", "node").join(final, F.col("node") == F.col("_node"), "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                    F.col("id").eqNullSafe(component).alias("kept")))


def _rows(docs, id_col, text_col):
    return docs.select(quoted(id_col).alias("id"), F.xxhash64(quoted(id_col), quoted(text_col)).alias("row"),
                       quoted(text_col).alias("text"))


def _texts(docs, signed, candidates, id_col, text_col):
    """One text of each class that has anything to compare with."""
    # Aggregated before the join: a class of very many copies costs a row a task.
    chosen = signed.filter("node IS NOT NULL").groupBy("node").agg(F.min("row").alias("row")) \
        .join(candidates.select("node"), "node")
    return _rows(docs, id_col, text_col).select("row", "text").join(chosen, "row").dropDuplicates(["row"]) \
        .select("node", "text")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group; a row that repeats
    id and text counts once."""
    name = fresh("_kept_id", docs.columns)
    kept = near_groups(docs, id_col, text_col, **options).filter("kept").select(quoted(id_col).alias(name)).distinct()
    return docs.join(kept, quoted(id_col).eqNullSafe(F.col(name)), "left_semi").dropDuplicates([id_col, text_col])


def report(docs: DataFrame) -> DataFrame:
    return near_groups(docs)


SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < 2 THEN words
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS shingle FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), sized AS (
  SELECT doc_id, shingle, n FROM s JOIN n USING (doc_id)
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sized a JOIN sized b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
                           AND 100 * a.n >= {PERCENT} * b.n AND 100 * b.n >= {PERCENT} * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM w
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), c AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""
