"""Incremental raw load of a CSV landing folder (U05/U07, streaming form).

``readStream`` over the folder picks up files that were not seen before (the
file source records them in the query checkpoint). Each micro-batch is typed
with the catalog schema and written by ``foreachBatch`` to
``dest/<table>/batch=<id>``, overwriting that folder, so a batch retried after
a failure replaces its own output instead of duplicating it. The batch's
source and loaded row counts go to ``dest/_batches/<table>/batch=<id>`` in the
same way, the per-batch form of the load reconciliation. Columns are bound by
the names in each file's header; a header that differs from the schema fails
the batch before anything of it is published.

``trigger(availableNow=True)`` processes everything present and stops, which
suits scheduled loads; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillsight.session import new_run_dir
from tillsight.sources.csv_files import EMPTY_SENTINEL
from tillsight.sources.load import typed_frame


def stream_raw_load(spark: SparkSession, landing_dir: str, table: str,
                    schema: T.StructType, dest: str, checkpoint: str | None = None,
                    available_now: bool = True,
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental load of ``landing_dir`` into ``dest/<table>``.

    ``schema`` is the typed schema (from ``struct_from_catalog``); the files
    are read as text with its column names and cast per batch.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    reader = (spark.readStream.schema(text_schema).option("header", True)
              .option("quote", '"').option("escape", '"').option("mode", "FAILFAST")
              .option("emptyValue", EMPTY_SENTINEL).option("pathGlobFilter", "*.csv")
              .option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(landing_dir)
    text = raw.select(*[F.when(F.col(f"`{c}`") == EMPTY_SENTINEL, F.lit(""))
                        .otherwise(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    base = dest.rstrip("/")
    name = table.lower()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = f"{base}/{name}/batch={batch_id}"
        # Source rows are counted on the pass that writes them (the batch's
        # files are read once); loaded rows come from the Parquet footers.
        seen = Observation(f"{name}_{batch_id}")
        typed_frame(batch.observe(seen, F.count(F.lit(1)).alias("n")), schema) \
            .write.mode("overwrite").parquet(out)
        loaded = batch.sparkSession.read.parquet(out).count()
        source = int(seen.get["n"])
        status = "ok" if source == loaded else "divergent"
        (batch.sparkSession.createDataFrame(
            [(name, batch_id, source, loaded, status)],
            "table string, batch_id long, source_rows long, loaded_rows long, status string")
         .write.mode("overwrite").parquet(f"{base}/_batches/{name}/batch={batch_id}"))

    ckpt = checkpoint or new_run_dir(spark, f"stream-{name}")
    writer = text.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def loaded_table(spark: SparkSession, dest: str, table: str) -> DataFrame:
    """All batches loaded so far (``batch`` is a partition column)."""
    return spark.read.parquet(f"{dest.rstrip('/')}/{table.lower()}")


def batch_report(spark: SparkSession, dest: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{dest.rstrip('/')}/_batches/{table.lower()}").drop("batch")
