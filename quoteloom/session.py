"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed join sides, coalesces small shuffle partitions and picks broadcast sides by
# measured size; dynamic overwrite keeps untouched partitions of a table.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # Without it every Column call also records its Python call site.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "quoteloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's settings; extra settings as ``**{"spark.x": "v"}``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only ever used in local mode (tests), where it is set once per session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    known = _LOCAL_DIRS.get(spark.sparkContext.applicationId)
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    known = tempfile.mkdtemp(prefix="spark-quoteloom-")
    _LOCAL_DIRS[spark.sparkContext.applicationId] = known
    return known


_LOCAL_DIRS: dict[str, str] = {}


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so a retried job starts clean."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = work_path(df.sparkSession, name)
    if (open_stages := _OPEN_STAGES.get()) is not None:
        open_stages.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever file system its path names."""
    system, where = _hadoop(spark, path)
    system.delete(where, True)


def release_shuffles(spark: SparkSession) -> None:
    """Frees disks of shuffles that no data frame needs any more: Spark deletes them when the driver collects garbage."""
    spark._jvm.System.gc()


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match; marker files are found too, which readers leave out."""
    system, where = _hadoop(spark, pattern)
    return sorted(f.getPath().toString() for f in system.globStatus(where) or [])


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Stages written inside are deleted at the end, also after a failure; nothing lazy may outlive them."""
    own: list[str] = []
    token = _OPEN_STAGES.set(own)
    try:
        yield
    finally:
        _OPEN_STAGES.reset(token)
        for path in own:
            remove(spark, path)


_OPEN_STAGES: ContextVar[list[str] | None] = ContextVar("open_stages", default=None)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file; missing folders above the new place are made."""
    system, where = _hadoop(spark, new)
    system.mkdirs(where.getParent())
    if not system.rename(_hadoop(spark, old)[1], where):
        raise OSError(f"{old} can't be moved to {new}")
