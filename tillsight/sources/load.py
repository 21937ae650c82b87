"""Repeatable raw load with reconciliation and stage-then-publish.

Flow per run: the records of every file are found and parsed once (``stage_csv``)
and kept as a text table, which validation, inference and load share. A file with
ragged records, blank lines or an open quote is ``invalid`` and not loaded. The
others are typed with the inferred catalog (casts fail loudly under ANSI mode, as
COPY would) and written as Parquet to a fresh folder of the run, beside a note of
what the source holds: its record count and a fingerprint of its typed records.
``reconcile_run`` reads the stored tables back and compares both, so a lost row, a
row too many and a changed value are all ``divergent``. Only when every table is
``ok`` is the run published, all tables at once, as the next version
(``tillsight.sources.snapshots``); a failed or partial run is never visible, and a
reader that holds a snapshot never mixes two runs.

Re-running loads into a new run folder, so repeating a load never duplicates
rows (the reference truncates and reloads).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.session import side_by_side
from tillsight.sources.csv_files import fingerprint, stage_csv, table_name, validation_of
from tillsight.sources.infer import infer_schema, struct_from_catalog
from tillsight.sources.snapshots import commit, open_snapshot


def typed_frame(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast an all-text frame to ``schema``; empty text becomes NULL. Text
    booleans such as ``T``/``f`` cast fine; an invalid value raises."""
    cols = []
    for f in schema.fields:
        raw = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            cols.append(raw.alias(f.name))
        else:
            cols.append(F.when(raw == "", F.lit(None)).otherwise(raw).cast(f.dataType)
                        .alias(f.name))
    return text.select(*cols)


def reconcile(expected: Sequence[str], source_counts: DataFrame,
              loaded_counts: DataFrame) -> DataFrame:
    """U06 + U07: one row per table with source and loaded counts and a
    status: ``ok``, ``divergent``, ``missing`` (a file without an expected
    table), ``not_loaded`` (an expected table without a file) or ``invalid``
    (a file that failed validation). Counts must be equal, and fingerprints
    too where both sides have them (``source_content``, ``loaded_content``)."""
    spark = source_counts.sparkSession
    same = F.col("source_rows") == F.col("loaded_rows")
    if "source_content" in source_counts.columns and "loaded_content" in loaded_counts.columns:
        same &= F.coalesce(F.col("source_content") == F.col("loaded_content"), F.lit(False))
    exp = spark.createDataFrame([(t.lower(),) for t in expected], "table string").withColumn(
        "_expected", F.lit(True))
    j = (source_counts.join(loaded_counts, "table", "full").join(exp, "table", "full"))
    status = (F.when(F.col("_expected").isNull(), "missing")
              .when(F.col("source_rows").isNull(), "not_loaded")
              .when(F.col("loaded_rows").isNull(), "invalid")
              .when(same, "ok")
              .otherwise("divergent"))
    return j.select("table", "source_rows", "loaded_rows", status.alias("status"))


class MissingTablesError(RuntimeError):
    pass


class DivergentLoadError(RuntimeError):
    pass


def missing_tables(files: Sequence[str], declared: Sequence[str]) -> list[str]:
    """Tables of the given files that are not declared, sorted."""
    known = {d.lower() for d in declared}
    return sorted({table_name(p) for p in files} - known)


def load_run(spark: SparkSession, files: Sequence[str], dest: str,
             expected: Sequence[str] | None = None, catalog: DataFrame | None = None,
             publish: bool = True,
             require_declared: bool = False,
             raise_on_divergence: bool = False,
             bucket_by: Mapping[str, tuple[str, int]] | None = None,
             database: str = "raw") -> tuple[DataFrame, str]:
    """Load CSV files into a staging run under ``dest``; returns the
    reconciliation report (materialised) and the run folder.

    ``expected`` lists the tables that must exist (default: one per file);
    ``catalog`` is a U03 catalog (default: inferred from the files in the
    same run). With ``require_declared`` every file must have a declared
    table (in ``expected``), checked before anything is read or written, as
    the reference's prerequisite check does. With ``raise_on_divergence``
    any table that is not ``ok`` aborts the load (nothing is published), as
    the reference's single transaction does.

    ``bucket_by`` maps a table to ``(key column, buckets)``: such tables are
    written with ``bucketBy(...).sortBy(key)`` as external catalog tables
    (files in the run folder, metadata in ``database``, itself located in
    ``dest``). Two tables bucketed on their join key with the same count
    join without an exchange; at 100 TB this takes the shuffle out of the
    items x orders join. The catalog must persist between sessions (a
    metastore) for later jobs to see the bucketing.
    """
    if require_declared and expected is not None:
        missing = missing_tables(files, expected)
        if missing:
            raise MissingTablesError(f"no declared table for: {', '.join(missing)}")
    run = f"{dest.rstrip('/')}/_runs/{uuid.uuid4().hex[:12]}"
    def check(path: str):
        text = stage_csv(spark, path)
        return text, validation_of(text)

    both = side_by_side(check, sorted(files))
    staged = {t.table: t for t, _ in both}
    checked = {t.table: r for t, r in both}
    valid = {t for t, r in checked.items() if r["status"] in ("ok", "divergent")}
    texts = {t: staged[t].text() for t in valid}
    if catalog is None and texts:
        catalog = infer_schema(texts)
    expected = list(expected) if expected is not None else list(checked)
    known = set() if catalog is None else {
        r["table"] for r in catalog.select("table").distinct().collect()}
    wanted = {e.lower() for e in expected}
    names = sorted(valid & known & wanted)
    if bucket_by and set(names) & set(bucket_by):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} "
                  f"LOCATION '{dest.rstrip('/')}/_catalog'")

    def load(name: str) -> tuple:
        typed = typed_frame(texts[name], struct_from_catalog(catalog, name))
        # What the source holds is noted on the pass that writes it.
        noted = Observation(f"source_{name}")
        typed = typed.observe(noted, fingerprint(typed).alias("content"))
        path, table = f"{run}/{name}", None
        if bucket_by and name in bucket_by:
            key, buckets = bucket_by[name]
            table = f"{database}.{name}_{run.rsplit('/', 1)[-1]}"
            (typed.write.mode("errorifexists").bucketBy(int(buckets), key).sortBy(key)
             .option("path", path).saveAsTable(table))
        else:
            typed.write.mode("errorifexists").parquet(path)
        return path, table, noted.get["content"]

    loaded = dict(zip(names, side_by_side(load, names)))
    source = [(t, r["source_records"], *loaded.get(t, (None, None, None))) for t, r in checked.items()]
    spark.createDataFrame(source, SOURCE).coalesce(1).write.mode("errorifexists").json(f"{run}/_source")
    report = reconcile_run(spark, run, expected)
    rows = report.collect()  # one row per table
    bad = [r for r in rows if r["status"] != "ok"]
    if raise_on_divergence and bad:
        detail = ", ".join(f"{r['table']}: {r['status']} ({r['source_rows']} -> {r['loaded_rows']})"
                           for r in bad)
        raise DivergentLoadError(f"load aborted, nothing published: {detail}")
    if publish and rows and not bad:
        commit(spark, dest, {"run": run, "tables": {t: {"path": x[0], "catalog_table": x[1]} for t, x in loaded.items()}})
    return report, run


SOURCE = "table string, source_rows long, path string, catalog_table string, source_content string"


def reconcile_run(spark: SparkSession, run: str, expected: Sequence[str]) -> DataFrame:
    """U07 for the tables of a run as they are stored now, at any time after
    their load: counts and fingerprints against those of the source. One row per
    table, computed eagerly."""
    source = spark.read.schema(SOURCE).json(f"{run}/_source")

    def count(r) -> tuple:
        df = spark.table(r["catalog_table"]) if r["catalog_table"] else spark.read.parquet(r["path"])
        found = df.agg(F.count(F.lit(1)).alias("n"), fingerprint(df).alias("f")).first()
        return r["table"], found["n"], found["f"]

    stored = side_by_side(count, source.filter("path IS NOT NULL").collect())
    loaded = spark.createDataFrame(stored, "table string, loaded_rows long, loaded_content string")
    report = reconcile(expected, source, loaded)
    return spark.createDataFrame(report.collect(), report.schema)


def published_table(spark: SparkSession, dest: str, table: str) -> DataFrame:
    """A table of the newest version. To read several tables of one version,
    hold ``open_snapshot(spark, dest)`` and ask it for each."""
    return open_snapshot(spark, dest).table(table)
