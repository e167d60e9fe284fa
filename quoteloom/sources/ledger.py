"""Which landed files were taken in already (S3, Q11).

The ledger is a table of path, size and time. A folder is listed without reading its files; those that the ledger
does not hold as they are now count as changed. They are read by one scan of the folder with a bound on the time, by
which Spark leaves older files out before it reads them. Only where files of the ledger are as new as the oldest
changed one does the scan meet the changed paths in a join.

Rows are only appended, after the rows of the files were stored: a run that fails between takes its files again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.schemas import empty
from quoteloom.session import stage
from quoteloom.sources.files import exists, file_path, literal, read_table

LEDGER = "path string, size bigint, modified timestamp"


def landed_files(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """(path, size, modified) of the files of a folder; their content is not read."""
    pattern = f"{literal(folder.rstrip('/'))}/{glob}"
    if not exists(spark, pattern):
        return empty(spark, LEDGER)
    files = spark.read.format("binaryFile").load(pattern)
    return files.select(file_path().alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def changed_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger lacks, or has with another size or time."""
    return files.join(ledger, ["path", "size", "modified"], "left_anti")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, LEDGER)


def record(files: DataFrame, path: str) -> None:
    files.select("path", "size", "modified").write.mode("append").parquet(path)


def pending(spark: SparkSession, files: DataFrame, ledger_path: str) -> tuple[DataFrame, Column, DataFrame | None] | None:
    """The changed ones of ``files``, the condition that prunes the scan, and the paths it must meet besides.

    None when nothing changed.
    """
    files = stage(files, "landed-files")
    changed = stage(changed_files(files, read_ledger(spark, ledger_path)), "changed-files")
    oldest = changed.agg(F.min(F.unix_micros("modified"))).first()[0]
    if oldest is None:
        return None
    since = F.timestamp_micros(F.lit(oldest))
    as_new = files.where(F.col("modified") >= since).join(changed, ["path", "size", "modified"], "left_anti")
    return changed, F.col("_metadata.file_modification_time") >= since, None if as_new.isEmpty() else changed
