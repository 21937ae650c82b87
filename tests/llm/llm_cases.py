"""Small tables with every awkward case, for the tests of this folder."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Columns that the operators use as names of their own.
    *(T.StructField(c, T.StringType()) for c in (
        "id", "node", "key", "row", "n", "units", "spans", "removed", "quality_score", "toxicity_score",
        "benchmark_words", "taken", "target", "size", "lines", "n_dropped", "rendered", "_own", "_keys", "_spans_in",
        "_items_in", "_kept_id", "ids", "runs", "collapsed", "n_words", "features", "weight", "score", "rank", "_part", "a.b")),
])
EXTRA = len(SCHEMA) - 5


def prose(rng, words):
    return " ".join(rng.choice("alpha beta gamma delta eins zwei drei quatre cinq siete ocho".split()) +
                    str(rng.randrange(40)) for _ in range(words))


def rows():
    rng = random.Random(3)
    base = [prose(rng, 80) for _ in range(12)]
    texts = [*base, None, "", " \t\n", "é", "x", base[0], base[0].upper(), base[1].replace(" ", "  ") + "\n",
             "aaaa " * 400, ("ab\ncd " * 300), base[2] + "\n" + base[3], "prefix " + base[4] + " suffix",
             prose(rng, 30_000), base[5].rsplit(" ", 1)[0] + " changed", "same line here to see\n" * 30,
             "same line here to see\nand another", " ends\x0b\x0c\r"]
    out = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    out += [out[3], out[3], (None, base[6], "en", "s0", 1), (None, base[6], None, None, None), (3, base[7], "en", "s1", 5)]
    return [(*r, *(["c"] * EXTRA)) for r in out]


def docs(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
