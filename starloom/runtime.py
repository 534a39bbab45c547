"""Session and lineage helpers shared by the flows, the tests and the bench."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_lock = threading.Lock()
_steps = threading.local()


def local_session(cpus: int | str = 8, app: str = "starloom", memory: str = "12g") -> SparkSession:
    """Session for tests and the bench; on a cluster the caller brings a session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    It comes from ``spark.checkpoint.dir``. A temporary folder stands in only
    for local masters, where driver and executors see the same disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    with _lock:
        if context.applicationId not in _local_dirs:
            _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="starloom-")
        return _local_dirs[context.applicationId]


#: Whether the files of a query's shuffles go as it ends; otherwise they stay until the driver collects its garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: What the planner multiplies the size of files by to tell whether their rows fit a broadcast.
_FACTOR = "spark.sql.sources.fileCompressionFactor"
#: Keys of 16 bytes a row take 1 to 5 in compressed files, as measured, and 45 to 55 in a table of keys that is sent to the tasks.
UNPACKED = 10.0


@contextmanager
def unpacked_sizes(spark: SparkSession) -> Iterator[None]:
    """Joins planned inside take stored tables for as large as their rows are, not as their compressed files.

    Otherwise a table of millions of keys, whose files are small, goes through the driver's memory to be broadcast.
    """
    before = spark.conf.get(_FACTOR, "1.0")
    spark.conf.set(_FACTOR, str(max(float(before), UNPACKED)))
    try:
        yield
    finally:
        spark.conf.set(_FACTOR, before)


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Frames made inside leave no shuffle files behind, so that a flow of many queries needs the disk of one of them at a time."""
    before = spark.conf.get(_TIDY, "false")
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(_TIDY, before)


@contextmanager
def step(spark: SparkSession) -> Iterator[None]:
    """A step that leaves its results in tables: what ``cut_lineage`` writes on the way is deleted at its end.

    It holds for the calling thread; a step inside another one is part of it. No frame that reads such files may leave the step.
    """
    if getattr(_steps, "open", None):
        yield
        return
    _steps.open = [[]]
    try:
        yield
    finally:
        jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _steps.open.pop():
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(hadoop).delete(folder, True)


def cut_lineage(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later uses see the very same rows, a lost executor does not start the work
    over, and the planner knows the real size of the result. With ``by`` the files are
    bucketed by that column, one bucket for each shuffle partition: joins and windows by it do not shuffle these rows again.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/starloom/{uuid.uuid4().hex}"
    for made in getattr(_steps, "open", [])[-1:]:
        made.append(path)
    spark = df.sparkSession
    if by is None:
        df.write.parquet(path, compression="zstd")
        return spark.read.schema(df.schema).parquet(path)
    # only a table can have buckets; its entry goes as soon as it is read, the files of an external table stay
    name = f"starloom_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").options(path=path, compression="zstd").bucketBy(buckets, by).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored
