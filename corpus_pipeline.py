"""Corpus pipeline: five stages from raw documents to a training mix.

Each stage is a function of (spark, docs, sf_dir); ``run`` writes what a stage
returns as Parquet in the shared folder and reads it again as the next one's
documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillsight.llm import decontaminate, line_dedup, mixing, near_dedup, toxicity
from tillsight.llm.common import fresh, quoted, staged, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the
    labels of these documents."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.learnable())
    return toxicity.remove_toxic(docs, model)


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than a tenth of a source's documents leave them; every
    document stays. ``n_chars`` follows where a text changes."""
    out, n_lines, n_dropped = line_dedup.line_dedup(docs, "source", "text")
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(quoted(n_dropped) > 0, size).otherwise(F.col("n_chars")))
    return out.select(*[quoted(c) for c in docs.columns])


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose sets of five-word shingles are
    similar to 0.8 or more: the one with the smallest id."""
    return near_dedup.keep_one(docs, width=5)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents that it takes, with ``taken`` words of each (repeats
    counted) and their source's ``target``."""
    names = {k: fresh(k, docs.columns) for k in ("taken", "target", "_id", "_source", "_size", "_nth", "_own")}
    share = mixing.mix(docs).filter("taken > 0").select(
        F.col("doc_id").alias(names["_id"]), F.col("source").alias(names["_source"]), F.col("size").alias(names["_size"]),
        F.col("nth").alias(names["_nth"]), F.col("taken").alias(names["taken"]), F.col("target").alias(names["target"]))
    own = F.struct(F.col("doc_id"), F.col("source"), mixing.words(F.col("text")),
                   F.row_number().over(Window.partitionBy("doc_id", "source", mixing.words(F.col("text")))
                                       .orderBy(F.xxhash64("text"))).cast("long"))
    return (docs.withColumn(names["_own"], own)
            .join(share, quoted(names["_own"]).eqNullSafe(F.struct(*(quoted(names[k]) for k in ("_id", "_source", "_size", "_nth")))))
            .select(*[quoted(c) for c in docs.columns], quoted(names["taken"]), quoted(names["target"])))


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_boilerplate),
    ("near_dedup", remove_near_copies),
    ("decontaminate", remove_contaminated),
    ("mixing", mix_sources),
]

# The trained model and the random rounding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
