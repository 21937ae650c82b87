"""Versioned commits of a load: one number for all its tables.

A commit is a small file ``_published/<number>.json`` that names the folder of
every table. Its number is the next one that nobody has taken: the file is created
only if it is absent, so two loads that finish together get different numbers, and
no clock takes part (HDFS creates files so in one step; on a store that doesn't, let
one loader run at a time). Files are never changed or replaced. A reader opens one
version and reads every table through it, so it never mixes two loads, whatever is
published meanwhile. A file that a dying writer left unfinished is passed over.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

FOLDER = "_published"


def _file(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it exists; whether it was written."""
    files, where = _file(spark, path)
    try:
        out = files.create(where, False)
    except Py4JJavaError:
        if files.exists(where):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def versions(spark: SparkSession, dest: str) -> list[int]:
    """Numbers of the commits under ``dest``, ascending."""
    files, where = _file(spark, f"{dest.rstrip('/')}/{FOLDER}")
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def commit(spark: SparkSession, dest: str, content: dict) -> int:
    """Add a version that holds ``content`` (plain values); its number."""
    number = max(versions(spark, dest), default=0) + 1
    text = json.dumps({"content": content, "complete": True})
    while not create_if_absent(spark, f"{dest.rstrip('/')}/{FOLDER}/{number:012d}.json", text):
        number += 1
    return number


def content_of(spark: SparkSession, dest: str, version: int) -> dict | None:
    """What a version holds; None if there is none or it was never finished."""
    if version not in versions(spark, dest):
        return None
    rows = spark.read.text(f"{dest.rstrip('/')}/{FOLDER}/{version:012d}.json", wholetext=True).collect()
    try:
        found = json.loads(rows[0][0]) if rows else {}
    except ValueError:
        return None
    return found["content"] if found.get("complete") else None


def latest(spark: SparkSession, dest: str) -> tuple[int, dict] | None:
    """The newest finished version and what it holds."""
    for number in reversed(versions(spark, dest)):
        found = content_of(spark, dest, number)
        if found is not None:
            return number, found
    return None


@dataclass(frozen=True)
class Snapshot:
    """One version, held by a reader for all its tables."""

    spark: SparkSession
    version: int
    run: str
    entries: dict

    @property
    def tables(self) -> list[str]:
        return sorted(self.entries)

    def table(self, name: str) -> DataFrame:
        """A table as this version holds it (through the catalog when it was
        written bucketed, so that the planner sees the bucketing)."""
        entry = self.entries[name.lower()]
        return self.spark.table(entry["catalog_table"]) if entry.get("catalog_table") else self.spark.read.parquet(entry["path"])


def open_snapshot(spark: SparkSession, dest: str, version: int | None = None) -> Snapshot:
    """The given version, or the newest."""
    if version is None:
        found = latest(spark, dest)
    else:
        held = content_of(spark, dest, version)
        found = None if held is None else (version, held)
    if found is None:
        raise LookupError(f"{dest}: nothing published" if version is None else f"{dest}: no version {version}")
    number, content = found
    return Snapshot(spark, number, content["run"], content["tables"])
