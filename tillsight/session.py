"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Settings every job relies on. Time stamps are zone-less (TIMESTAMP_NTZ), so
# the session zone is pinned to UTC to keep date casts stable across hosts.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Bytes of input per initial shuffle partition when sizing from the input.
BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024


def get_session(master: str | None = None, app: str = "tillsight",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None,
                input_bytes: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster leave ``master`` unset and let the launcher decide. Give
    ``shuffle_partitions``, or ``input_bytes`` (the size of the largest
    table a job reads) to start from about 256 MB of input per shuffle
    partition; AQE then coalesces partitions by their advisory size rather
    than by parallelism, and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if input_bytes and not shuffle_partitions:
        shuffle_partitions = max(200, -(-int(input_bytes) // BYTES_PER_SHUFFLE_PARTITION))
        settings["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
        settings["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(128 * 1024 * 1024)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate() ignores static settings on a live session; the SQL ones
    # can still be applied.
    for key, value in settings.items():
        if key.startswith("spark.sql.") and key != "spark.sql.warehouse.dir":
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf of a running session
                pass
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder for staged tables and lineage cuts.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint directory).
    Without either, a fresh local folder is used where the whole session is
    one machine (a ``local`` master, as in tests) and removed at its end;
    elsewhere other executors could not see it, so that is an error.
    """
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share "
                             f"(master {master or 'unknown'})")
        root = tempfile.mkdtemp(prefix="tillsight-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # not settable at run time on every deployment
            pass
        if sc is not None:
            sc.setCheckpointDir(root)
    elif sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused sub-folder of the shared folder. It is removed
    when the session's file systems close."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
    if _context(spark) is not None:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(where)
        files.deleteOnExit(where)
    return path


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where one derived frame feeds several branches of a plan (Spark
    does not reuse those exchanges): it is computed once, written to
    ``spark.checkpoint.dir``, and a lost executor re-reads it instead of
    recomputing its joins. Never a local checkpoint.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def side_by_side(work, items) -> list:
    """``work`` of each item, as a list in their order. Their jobs run beside each
    other, so that tables with few tasks don't leave the cores idle in turn."""
    items = list(items)
    with ThreadPoolExecutor(max(1, len(items))) as pool:
        return list(pool.map(work, items))


def stage(df, purpose: str):
    """Write ``df`` as Parquet in a fresh sub-folder of the shared folder and read
    it back: computed once, columns pruned by its readers, and a lost executor
    reads the files again."""
    spark = df.sparkSession
    path = f"{new_run_dir(spark, purpose)}/data"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_in = path.removesuffix("/data")
    return out


def discard(*frames) -> None:
    """Delete the folders of staged tables that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        if _context(spark) is not None:
            where = spark._jvm.org.apache.hadoop.fs.Path(df.staged_in)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it, the shuffle files of a job go as soon as the job has ended, not
    when the driver happens to collect its garbage. For jobs that end in a staged
    table, whose readers don't need them."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
