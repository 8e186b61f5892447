"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
import threading
import uuid
import weakref
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "loamfold", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the plans in this package are written for."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        # Work submitted by several threads shares the executors instead of queueing behind the first.
        "spark.scheduler.mode": "FAIR",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a skewed side even where that costs one more shuffle afterwards.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Wide projections generate methods the JIT refuses (8000 bytes); run those without fusing stages.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Read files in parts of this size, and small ones in as many parts as there are cores.
        "spark.sql.files.maxPartitionBytes": "134217728",
        "spark.sql.files.openCostInBytes": "1048576",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only on a local master; a cluster without the
    setting is an error, because tables written to one machine would be lost.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Paths that ``stored`` has written to and neither ``drop_stored`` nor ``clear_stored`` has removed.
_STORED: list[str] = []
#: The path of each frame that ``stored`` returned.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
#: With this setting, shuffle files go when the query that wrote them ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING = threading.Lock()


def clear_stored(spark: SparkSession) -> int:
    """Remove the tables that ``stored`` wrote in this process, and return how many there were.

    Results are lazy and read these tables, so write a result out before calling this. Tables of other processes in the
    shared folder, and the folder itself, are left alone.
    """
    removed = 0
    while _STORED:
        removed += _removed(spark, _STORED.pop())
    return removed


def _removed(spark: SparkSession, at: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


def drop_stored(*frames: DataFrame) -> None:
    """Remove the tables that ``stored`` returned as ``frames``, once all that was made of them is itself stored."""
    for frame in frames:
        path = _PATHS.pop(frame)
        if path in _STORED:
            _STORED.remove(path)
            _removed(frame.sparkSession, path)


def stored(df: DataFrame, label: str, partition_by: Sequence[str] = (), **options: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, pins whatever a
    sketch or a partition id evaluated to, and gives the planner the true size
    of the table: a later join is broadcast only if the files are below
    ``spark.sql.autoBroadcastJoinThreshold`` and is a shuffle join otherwise.
    Shuffle files of the write are removed with its end. ``options`` are those
    of the Parquet writer.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    _STORED.append(path)
    # read when the write begins; one thread at a time sets it, so that each finds what was set outside
    with _CLEANING:
        before = spark.conf.get(CLEANUP, "false")
        spark.conf.set(CLEANUP, "true")
        try:
            df.write.options(**options).partitionBy(*partition_by).parquet(path)
        finally:
            spark.conf.set(CLEANUP, before)
    written = spark.read.schema(df.schema).parquet(path)
    _PATHS[written] = path
    return written


#: Spark jobs that independent pieces of work, such as the fits of many models, submit at a time.
PARALLEL_JOBS = 8


def side_by_side[A, B](spark: SparkSession, work: Callable[[A], B], items: Sequence[A], parallelism: int = PARALLEL_JOBS) -> list[B]:
    """Results of ``work`` per item, in order; each call submits its Spark jobs from a thread and a scheduler pool of its own."""

    def pooled(numbered: tuple[int, A]) -> B:
        number, item = numbered
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"side-{number % parallelism}")
        return work(item)

    # wrapped once per call: the threads of one wrapper share their local properties, and a query of one would end that of another
    calls = [inheritable_thread_target(spark)(partial(pooled, numbered)) for numbered in enumerate(items)]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(lambda call: call(), calls))
