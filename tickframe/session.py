"""Session set-up and the shared folder for intermediate data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_DEFAULTS = {
    # Event time is naive UTC text, so dates and hours must not follow the machine's zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows written to cut a lineage are removed once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}


def build_session(app: str = "tickframe", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate data: the one the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used only when the session itself runs on one machine.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tickframe-"))
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base or context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nobody else uses."""
    return f"{shared_dir(spark).rstrip('/')}/tickframe/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def remove_own(spark: SparkSession, path: str) -> None:
    """Delete a path that ``new_path`` gave out; anything else is refused."""
    if not path.startswith(f"{shared_dir(spark).rstrip('/')}/tickframe/"):
        raise ValueError(f"not a path of this library: {path}")
    system, target = _file_system(spark, path)
    system.delete(target, True)


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number of files and bytes below a path, as its file system counts them."""
    system, target = _file_system(spark, path)
    summary = system.getContentSummary(target)
    return summary.getFileCount(), summary.getLength()


def remove_folder(spark: SparkSession, path: str, inside: str) -> None:
    """Delete a folder that lies inside another one of this library; anything else is refused."""
    if not path.startswith(f"{inside.rstrip('/')}/") or "/.." in path:
        raise ValueError(f"{path} does not lie inside {inside}")
    system, target = _file_system(spark, path)
    system.delete(target, True)


_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Frames made and tables written in this block remove their shuffle files as soon as their action ends.

    Otherwise Spark keeps the files of a finished query for as long as anything still refers to its plan. For frames
    that are run once: a second action on the same frame has to make them anew.
    """
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Actions in this block hand at most ``rows`` rows at once to Python and back.

    With whole texts the default of 10,000 is a batch of a hundred megabytes, held on both sides of every task.
    """
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, so later steps see the same rows after an executor is lost.

    The shuffle files made for it go with that; ``df`` itself can be used again.
    """
    shared_dir(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        once = df.select("*")
    return once.checkpoint(eager=True)


def cut_and_measure(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """``cut_lineage(df)`` and aggregates of its rows, taken while they are written and not by a job of their own."""
    observed = Observation()
    cut = cut_lineage(df.observe(observed, *[measure.alias(name) for name, measure in measures.items()]))
    return cut, {name: observed.get[name] for name in measures}


# Rows of a join side that may be sent to every executor: some tens of megabytes of keys and numbers.
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A derived table for the small side of a join: written once, counted, and broadcast only up to ``max_rows`` rows.

    Spark cannot foresee the size of a derived table and would start to shuffle the large side before it is known.
    Larger tables are joined by shuffle.
    """
    written, measured = cut_and_measure(df, rows=F.count(F.lit(1)))
    return F.broadcast(written) if measured["rows"] <= max_rows else written
