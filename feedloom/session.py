"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# UTC; projections too long for the JVM's compiler are split instead of fused, which matters for layouts of many
# fields; and batches of rows for Python are small enough to hold long texts.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


#: Codec of scratch tables and snapshots. Hashes as hexadecimal text take half the room they take with Spark's default.
COMPRESSION = "zstd"

# Spark derives the split size from the number of live cores, which changes when executors come and go. Line numbers
# need two scans to cut the files alike, so the number at the start is made explicit.
_MIN_SPLITS = "spark.sql.files.minPartitionNum"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators count on to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if spark.conf.get(_MIN_SPLITS, None) is None:
        spark.conf.set(_MIN_SPLITS, str(spark.sparkContext.defaultParallelism))
    return spark


def build_session(app: str = "feedloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with these settings; everything else stays at Spark's defaults or the caller's values."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return configure(builder.getOrCreate())


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a temporary one only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="feedloom-")
        atexit.register(shutil.rmtree, _LOCAL_DIRS[app], ignore_errors=True)
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffles of the statements made within go when these end, else they stay until the driver collects its garbage.

    A frame made within that is collected again outside computes its shuffles again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def tidy(spark: SparkSession) -> None:
    """Collect the driver's garbage: plans of finished statements, and what Spark keeps on the driver as long as they are there.

    Broadcast tables and map outputs are among it; left alone, the heap grows to its limit before they go.
    """
    gc.collect()
    spark._jvm.System.gc()


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, read by every later use, safe from lost executors.

    What it shuffled is not needed then and goes.
    """
    path = scratch_path(df.sparkSession, label)
    with released(df.sparkSession):
        df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_WRITTEN: dict[tuple, str] = {}


def written_once(spark: SparkSession, key: tuple, write: Callable[[], str]) -> str:
    """The path that ``write`` returned for this key in this session, while the files are there."""
    full = (spark.sparkContext.applicationId, *key)
    path = _WRITTEN.get(full)
    if path is not None:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            return path
    _WRITTEN[full] = write()
    return _WRITTEN[full]


def require_pinned_splits(spark: SparkSession) -> None:
    """Refuse a session in which two scans of a file may cut it differently."""
    if spark.conf.get(_MIN_SPLITS, None) is None:
        raise ValueError(f"set {_MIN_SPLITS}, or call feedloom.session.configure")
