"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.session import new_run_dir

# ASCII white space, as the contracts of the operators name it (fixed values).
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
ROWS_A_FILE = 50_000  # of narrow rows, in staged tables of few rows
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str, rows: int | None = None, rows_a_file: int = ROWS_A_FILE) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor reads the files again and does not
    repeat the work behind them. The folder goes when the session's file
    systems are closed.

    ``rows`` is a bound on the rows that the last stage of ``df`` reads. With
    it, a small table goes to a file for each ``rows_a_file`` of them instead of
    one a partition; never to more. Without Hadoop's native library a local file
    costs the executor child processes of its own.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // rows_a_file)))
    path = f"{new_run_dir(spark, purpose)}/data"
    df.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where.getParent())
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_in = where.getParent()
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the folders of staged tables that nothing reads any more."""
    for df in frames:
        df.staged_in.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(df.staged_in, True)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Within it, jobs hand their Python workers at most ``rows`` rows at a
    time (fewer bytes off the heap, where rows are long texts)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, prefixed until no column of ``taken`` has it."""
    lowered = {c.lower() for c in taken}
    while name.lower() in lowered:
        name = "_" + name
    return name


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def without_spaces(text: Column) -> Column:
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def texts_of(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """UTF-8 of each text of an Arrow column; null counts as empty."""
    for x in column.cast(pa.large_binary()):
        yield x.as_py() or b""


def pieces(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes of text (one row at
    least), so that the arrays made of a batch stay small."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = filled = 0
    for i, n in enumerate(sizes):
        if i > start and filled + n > limit:
            yield start, i
            start, filled = i, 0
        filled += int(n)
    if start < len(sizes):
        yield start, len(sizes)


def small(batches: Iterable[pa.RecordBatch], column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of the given text
    column, one row at least, so that a task holds little at a time."""
    for batch in batches:
        for a, b in pieces(batch.column(column), limit):
            yield batch.slice(a, b - a)


def mapped(df: DataFrame, inputs: list[str], outputs: list[T.StructField],
           work: Callable[[], Callable[[list[pa.Array]], list[pa.Array]]]) -> DataFrame:
    """Append ``outputs`` to every row of ``df`` from its ``inputs`` columns.

    ``work()`` runs once in each Python worker task and returns a function
    from the input arrays to the output arrays of a batch. All columns of
    ``df`` pass through untouched. The names of ``outputs`` must be new.
    """
    # By position inside, so that names with dots in them pass as well.
    at = [df.columns.index(c) for c in inputs]
    names = [f"c{i}" for i in range(len(df.columns) + len(outputs))]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, [*df.schema.fields, *outputs])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        do = work()
        for batch in small(batches, at[0]):
            yield pa.RecordBatch.from_arrays([*batch.columns, *do([batch.column(i) for i in at])], names=names)

    return df.toDF(*names[:len(df.columns)]).mapInArrow(run, schema).toDF(*df.columns, *(f.name for f in outputs))
