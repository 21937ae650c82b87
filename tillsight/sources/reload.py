"""U05 for a folder whose files change: a ledger of what each file held.

The file source of a stream knows files by name, so a file that is replaced under
its name is never read again. ``reload_changed`` compares the folder with a ledger of
(file, fingerprint of its lines, load that holds its rows) instead:

* files that the ledger doesn't know, or knows with another fingerprint, are
  validated and loaded, together, into a folder of this load;
* the new ledger points these files at this load and leaves the others where they
  are, so a replaced file's old rows are gone for readers in the same moment;
* the ledger's version is created only if it is absent (``snapshots.commit``):
  a reader sees the folder as of one load, and a repeated call changes nothing.

A file that has left the folder keeps its rows (landing folders are cleaned);
``drop_missing`` takes them out. Fingerprints cost one scan of the text, the order
of lines within a file doesn't count.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.session import stage
from tillsight.sources.csv_files import stage_csv, validation_of
from tillsight.sources.load import DivergentLoadError, typed_frame
from tillsight.sources.snapshots import commit, latest

LEDGER = "file string, fingerprint string, records long, load string"


def file_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """``file, fingerprint`` of every CSV file of a folder, from its lines."""
    lines = (spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.csv").text(folder)
             .select(F.input_file_name().alias("file"), "value"))
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), "value").cast("decimal(38,0)")).cast("string")
    return lines.groupBy("file").agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), total(1), total(2)).alias("fingerprint"))


def _ledger(spark: SparkSession, dest: str) -> tuple[dict, DataFrame]:
    found = latest(spark, dest)
    content = found[1] if found else {"ledger": None, "loads": []}
    path = content["ledger"]
    return content, spark.read.schema(LEDGER).parquet(path) if path else spark.createDataFrame([], LEDGER)


def reload_changed(spark: SparkSession, folder: str, table: str, schema: T.StructType, dest: str,
                   drop_missing: bool = False) -> DataFrame:
    """Bring ``dest`` up to date with the CSV files of ``folder``; one row a file:
    ``file, action`` (``new``, ``replaced``, ``unchanged``, ``missing``,
    ``dropped``) and ``records``. ``schema`` is the typed schema of the table. A
    changed file with bad records stops the load, and nothing of it is visible."""
    base = f"{dest.rstrip('/')}/{table.lower()}"
    content, ledger = _ledger(spark, base)
    old = ledger.select("file", F.col("fingerprint").alias("old"), F.col("records").alias("old_records"), "load")
    action = (F.when(F.col("fingerprint").isNull(), "dropped" if drop_missing else "missing").when(F.col("old").isNull(), "new")
              .when(F.col("old") != F.col("fingerprint"), "replaced").otherwise("unchanged"))
    plan = stage(file_fingerprints(spark, folder).join(old, "file", "full").withColumn("action", action), "reload-plan")
    todo = [r["file"] for r in plan.filter("action IN ('new', 'replaced')").select("file").orderBy("file").collect()]
    gone = drop_missing and plan.filter("action = 'dropped'").limit(1).count() > 0
    if not todo and not gone:
        return plan.select("file", "action", F.col("old_records").alias("records"))
    load = uuid.uuid4().hex[:12]
    records = spark.createDataFrame([], "file string, n long")
    if todo:
        staged = stage_csv(spark, todo, table.lower())
        if staged.columns != schema.fieldNames():
            raise ValueError(f"{table}: header {staged.columns} differs from the schema")
        seen = validation_of(staged)
        if seen["status"] != "ok":
            raise DivergentLoadError(f"{table}: {seen['status']}, first bad record {seen['first_bad_in_file']} of {seen['first_bad_file']}")
        text = staged.text("file")
        typed = typed_frame(text, T.StructType([T.StructField("file", T.StringType()), *schema.fields]))
        path = f"{base}/loads/{load}"
        typed.withColumnRenamed("file", "_file").write.mode("errorifexists").parquet(path)
        records = spark.read.parquet(path).groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    done = plan.join(records, "file", "left")
    changed = F.col("action").isin("new", "replaced")
    now = done.filter("action != 'dropped'").select(
        "file", F.coalesce("fingerprint", "old").alias("fingerprint"),
        F.when(changed, F.coalesce("n", F.lit(0))).otherwise(F.col("old_records")).alias("records"),
        F.when(changed, F.lit(load)).otherwise(F.col("load")).alias("load"))
    where = f"{base}/ledgers/{load}"
    now.write.parquet(where)
    loads = sorted({r["load"] for r in spark.read.schema(LEDGER).parquet(where).filter("records > 0").select("load").distinct().collect()})
    commit(spark, base, {"ledger": where, "loads": loads})
    report = done.select("file", "action", F.when(changed, F.coalesce("n", F.lit(0))).otherwise(F.col("old_records")).alias("records"))
    return spark.createDataFrame(report.collect(), "file string, action string, records long")


def current_rows(spark: SparkSession, table: str, schema: T.StructType, dest: str) -> DataFrame:
    """The table's rows as the newest ledger has them."""
    base = f"{dest.rstrip('/')}/{table.lower()}"
    content, ledger = _ledger(spark, base)
    if not content["loads"]:
        return spark.createDataFrame([], schema)
    rows = None
    for load in content["loads"]:
        part = spark.read.parquet(f"{base}/loads/{load}").withColumn("_load", F.lit(load))
        rows = part if rows is None else rows.unionByName(part)
    held = ledger.select(F.col("file").alias("_file"), F.col("load").alias("_load"))
    return rows.join(held, ["_file", "_load"], "left_semi").select(*[F.col(f"`{c}`") for c in schema.fieldNames()])
