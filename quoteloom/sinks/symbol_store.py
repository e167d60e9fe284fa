"""Bars kept together by symbol, of which a delivery rewrites only the touched part (K2, K3).

The store is ``data/version=V/bucket=B`` and a manifest that names the version of each bucket. A merge reads the
buckets that hold delivered symbols, writes them anew under the next version and then writes the next manifest; its
completion is the switch. Before it readers see the store as it was, whatever was written; a merge that failed is run
again and overwrites what it left. Buckets that neither this manifest nor the one before names are deleted.

Delivered bars, and stored ones of the delivered dates, are dealt once, by bucket and a slice of its symbols; a task then
merges and sorts its slices and writes each as a part of its bucket. Stored bars of touched buckets that are older or newer
than the whole delivery are copied file by file; a bucket that has got many files by that is dealt whole and has few again.

The list of buckets is the only thing the driver sees, and ``buckets`` bounds it. One merge at a time: two at once would
take the same version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quoteloom.schemas import BARS, empty
from quoteloom.session import glob, remove, stage
from quoteloom.sinks.tables import replace_state
from quoteloom.sources.files import literal, read_table, versions

MANIFEST = "bucket int, version bigint, buckets int"
# Parts of a bucket that are merged apart; at most so many files each.
SLICES = 8
# Files of a bucket from which on it is dealt whole.
MANY_FILES = 32


def bucket_of(symbol: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(buckets)).cast("int")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per bucket that has bars."""
    return read_table(spark, f"{path}/manifest", MANIFEST)


def _read_buckets(spark: SparkSession, path: str, where: dict[int, int], schema: str) -> DataFrame:
    """The bars of some buckets, by bucket and version; with the column ``bucket``."""
    if not where:
        return empty(spark, f"{schema}, bucket int")
    folders = [f"{path}/data/version={v}/bucket={b}" for b, v in sorted(where.items())]
    rows = spark.read.schema(f"{schema}, version bigint, bucket int").option("basePath", f"{path}/data").parquet(*folders)
    return rows.drop("version")


def read_store(spark: SparkSession, path: str, symbols: list[str] | None = None, schema: str = BARS) -> DataFrame:
    """All bars, or those of a few symbols, for which only their buckets are read."""
    manifest = read_manifest(spark, path).collect()
    if symbols is not None and manifest:
        asked = spark.createDataFrame([(s,) for s in symbols], "symbol string")
        hit = {r[0] for r in asked.select(bucket_of(F.col("symbol"), manifest[0]["buckets"])).collect()}
        manifest = [r for r in manifest if r["bucket"] in hit]
    rows = _read_buckets(spark, path, {r["bucket"]: r["version"] for r in manifest}, schema).drop("bucket")
    return rows if symbols is None else rows.where(F.col("symbol").isin(symbols))


def merge_store(
    spark: SparkSession, delivered: DataFrame, path: str, buckets: int = 256, new_wins: bool = True,
    keys: list[str] = ["symbol", "date"], schema: str = BARS, on_disk: bool = False,
) -> list[int]:
    """Merge bars, one per key, and return the buckets that were rewritten.

    Equal keys go to the delivered bar if ``new_wins``, else the stored one stays. ``buckets`` counts for the first
    merge; the store keeps its number. Bars with a NULL in their key are not stored. ``on_disk`` says that the bars come
    from files that don't change meanwhile, so they are not written once more before the merge reads them twice.
    """
    manifest = {r["bucket"]: r for r in read_manifest(spark, path).collect()}
    buckets = next(iter(manifest.values()))["buckets"] if manifest else buckets
    names = [f.split()[0] for f in schema.split(",")]
    new = delivered.dropna(subset=[*keys]).select(*names, bucket_of(F.col("symbol"), buckets).alias("bucket"))
    new = new if on_disk else stage(new, "delivered")
    found = new.groupBy("bucket").agg(F.min("date").alias("since"), F.max("date").alias("until")).collect()
    touched = sorted(r["bucket"] for r in found)
    if not touched:
        return []
    old = _read_buckets(spark, path, {b: manifest[b]["version"] for b in touched if b in manifest}, schema)
    few = [b for b in touched if b in manifest and len(glob(spark, f"{literal(path)}/data/version={manifest[b]['version']}/bucket={b}/*.parquet")) < MANY_FILES]
    since, until = min(r["since"] for r in found), max(r["until"] for r in found)
    aside = F.col("bucket").isin(few) & ~F.col("date").between(F.lit(since), F.lit(until))
    version = max(versions(spark, f"{path}/manifest"), default=0) + 1
    both = old.where(~aside).withColumn("_turn", F.lit(1)).unionByName(new.withColumn("_turn", F.lit(0 if new_wins else 2)))
    dealt = both.withColumn("_slice", F.pmod(F.xxhash64("symbol", F.lit("slice")), F.lit(SLICES))).repartition("bucket", "_slice")
    # The window sorts by bucket, slice and key, which is also the order of the files.
    first = F.lag("_turn").over(Window.partitionBy("bucket", "_slice", *keys).orderBy("_turn")).isNull()
    merged = dealt.withColumn("_first", first).where("_first").drop("_turn", "_slice", "_first")
    (
        merged.write.partitionBy("bucket").mode("overwrite").option("partitionOverwriteMode", "static")
        .parquet(f"{path}/data/version={version}")
    )
    if few:
        old.where(aside).write.partitionBy("bucket").mode("append").parquet(f"{path}/data/version={version}")
    named = {b: version if b in touched else manifest[b]["version"] for b in {*touched, *manifest}}
    switch(spark, path, named, buckets)
    before = {(b, r["version"]) for b, r in manifest.items()}
    _clear(spark, path, before | set(named.items()))
    return touched


def switch(spark: SparkSession, path: str, named: dict[int, int], buckets: int) -> None:
    """The next manifest; from its completion on readers see these versions."""
    rows = spark.createDataFrame([(b, v, buckets) for b, v in sorted(named.items())], MANIFEST)
    replace_state(rows.coalesce(1), f"{path}/manifest")


def _clear(spark: SparkSession, path: str, used: set[tuple[int, int]]) -> None:
    """Delete buckets that no kept manifest names, and versions of which none is left."""
    kept = {v for _, v in used}
    for folder in glob(spark, f"{literal(path)}/data/version=*"):
        version = int(folder.rsplit("=", 1)[1])
        if version not in kept:
            remove(spark, folder)
            continue
        for bucket in glob(spark, f"{literal(folder)}/bucket=*"):
            if (int(bucket.rsplit("=", 1)[1]), version) not in used:
                remove(spark, bucket)
