"""Session settings, the shared scratch folder and scoped caching."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when a later aggregate then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Join partitions whose smaller side turns out this small by hash, without sorting.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITIONS_PER_CORE = 4
SPARK_DEFAULT_PARTITIONS = 200

# Set to true where spark.checkpoint.dir is a file: path that all machines mount, so that no job looks.
MOUNTED = "spark.shelfrank.checkpointDirIsMounted"

_local_folders: dict[str, str] = {}
_mounted: dict[tuple[str, str], bool] = {}
_owned: list[list[str]] = []


def build_session(app_name: str = "shelfrank", **settings: str) -> SparkSession:
    """Session for a job; memory, cores and spark.checkpoint.dir come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    options = {
        **ADAPTIVE,
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        # Delete checkpoint files of frames that are no longer referenced.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**options, **settings}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Turn on run-time replanning for a session somebody else built.

    On a large cluster shuffles start with several partitions per core, which
    are merged again where the data turns out small.
    """
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    wanted = PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    if wanted > SPARK_DEFAULT_PARTITIONS and INITIAL_PARTITIONS not in spark.conf.getAll:
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: spark.checkpoint.dir or the context's checkpoint folder, else
    the warehouse, or a local one in local mode. The warehouse also stands in where the first lies on the
    disks of single machines."""
    named = [spark.conf.get("spark.checkpoint.dir", None)]
    context = spark.sparkContext
    one_machine = context.master.startswith("local")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        named = [named[0] or _context_folder(context), spark.conf.get("spark.sql.warehouse.dir", None)]
    folders = [_qualified(spark, folder.rstrip("/")) for folder in named if folder]
    for folder in folders:
        if one_machine or not _is_machine_local(spark, folder):
            return folder
    if folders:
        raise RuntimeError(
            f"spark.checkpoint.dir or the warehouse, {' and '.join(folders)}, lies on the disks of single "
            f"machines: files that executors write there are not all seen by the driver; set {MOUNTED} to "
            "true to use it unseen"
        )
    if not one_machine:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = "file:" + tempfile.mkdtemp(prefix="shelfrank-")
    return _local_folders[app]


def _context_folder(context) -> str | None:
    """The folder that setCheckpointDir was called with."""
    found = getattr(context, "getCheckpointDir", lambda: None)()
    # Spark makes a folder of its own below it.
    return found.rstrip("/").rpartition("/")[0] if found else None


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system: a bare path is one of the cluster's own, for Spark and
    for tasks that write files of their own alike."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", folder):
        return folder
    system = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return f"{system.rstrip('/')}/{folder.lstrip('/')}"


def _is_machine_local(spark: SparkSession, folder: str) -> bool:
    if not folder.startswith("file:") or spark.conf.get(MOUNTED, "false") == "true":
        return False
    key = (spark.sparkContext.applicationId, folder)
    if key not in _mounted:
        _mounted[key] = _holds_all_files(spark, folder)
    return not _mounted[key]


def _holds_all_files(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds what tasks on all executors write to a folder, as on a mount."""
    path = f"{folder}/shelfrank-{uuid.uuid4().hex}/probe"
    try:
        tasks = 2 * spark.sparkContext.defaultParallelism
        rows = spark.range(0, tasks, 1, tasks)
        rows.write.parquet(path)
        found = spark.read.schema(rows.schema).parquet(path).count()
        delete_scratch(spark, path)
    except Exception:  # a folder that cannot be written and read is none to share
        return False
    return found == tasks


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never handed out twice."""
    path = f"{shared_folder(spark)}/shelfrank-{uuid.uuid4().hex}/{name}"
    if _owned:
        _owned[-1].append(path)
    return path


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Delete what lies at a scratch path, with the folder that was made for it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block all scratch tables made in it.

    For jobs whose result is a file; a frame that reads such a table is of no use
    after the block.
    """
    _owned.append([])
    try:
        yield
    finally:
        for path in _owned.pop():
            delete_scratch(spark, path)


def use_checkpoints(spark: SparkSession) -> None:
    """Make reliable checkpoints available to DataFrame.checkpoint and to ALS."""
    context = spark.sparkContext
    now = _context_folder(context)
    # Spark itself takes spark.checkpoint.dir unseen.
    if now is None or not context.master.startswith("local") and _is_machine_local(spark, _qualified(spark, now)):
        context.setCheckpointDir(shared_folder(spark))


def checkpointed(df: DataFrame) -> DataFrame:
    """Fix rows and their order in the shared folder, so that a lost executor changes nothing."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def _write_scratch(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as a Parquet table in the shared folder and read it back."""
    return _write_scratch(df, name)[0]


@contextmanager
def stored_for_now(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The same for an intermediate step: the table is deleted at the end of the block."""
    spark = df.sparkSession
    table, path = _write_scratch(df, name)
    try:
        yield table
    finally:
        delete_scratch(spark, path)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps now: Spark deletes them when the driver's collector
    finds that nothing refers to them, which in a long job may be hours later."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Persist a frame for several uses and release it afterwards."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
