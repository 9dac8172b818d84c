"""Keyed merges that rewrite only the files a batch can touch.

A table is a set of Parquet files laid out by ranges of its first key, and a
manifest of them: (file, lo, hi, has_null, n), the bounds of the first key in each file.
A merge reads the files whose bounds the batch's keys fall into, writes them anew
with the batch, and publishes a manifest with the new files in their place. The
manifest is a snapshot of its own (`sinks.write_snapshot`), so a merge is one atomic
step: until the new pointer is there, readers see the old files, and a batch that is
lost before leaves only files that nothing names. Keys that grow with time (dates,
running numbers) make a batch touch the newest files only, however large the table is."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.operators.upsert import insert_if_absent, upsert_replace
from pitlane.sources.sinks import has_snapshot, read_snapshot, write_snapshot

#: A batch's keys are known by so many ranges at most when files are picked.
BATCH_RANGES = 200
#: Rows that a written file holds, about.
FILE_ROWS = 1_000_000


def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    """(file, lo, hi, has_null, n) of the table's files; a table that was never published is an error."""
    return read_snapshot(spark, f"{base.rstrip('/')}/manifest")


def read_table(spark: SparkSession, base: str) -> DataFrame:
    """All rows of the files that the newest manifest names."""
    return _read(spark, base, read_manifest(spark, base))


def _read(spark: SparkSession, base: str, files: DataFrame) -> DataFrame:
    names = [r.file for r in files.select("file").collect()]  # paths, as a reader needs them
    schema = spark.read.parquet(f"{base.rstrip('/')}/schema").schema
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)


def _write(rows: DataFrame, base: str, keys: Sequence[str], n_rows: int) -> DataFrame:
    """The manifest lines of `rows`, written in ranges of the keys."""
    spark, path = rows.sparkSession, f"{base.rstrip('/')}/data/{uuid.uuid4().hex}"
    parts = max(1, -(-n_rows // FILE_ROWS))
    rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).write.parquet(path)
    k = F.col(keys[0])
    return spark.read.schema(rows.schema).parquet(path).groupBy(F.input_file_name().alias("file")).agg(
        F.min(k).alias("lo"), F.max(k).alias("hi"), F.max(k.isNull()).alias("has_null"), F.count("*").alias("n"))


def _marked(manifest: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """`manifest` plus `_hit`, whether a file may hold a key of the batch: its bounds meet one of the batch's ranges, BATCH_RANGES at most."""
    spread = batch.select(F.col(key).alias("_k")).distinct().repartitionByRange(BATCH_RANGES, "_k").groupBy(F.spark_partition_id().alias("_p"))
    ranges = spread.agg(F.min("_k").alias("a"), F.max("_k").alias("b"), F.max(F.col("_k").isNull()).alias("z"))
    one = ranges.agg(F.collect_list(F.struct("a", "b", "z")).alias("_r"))
    meets = F.exists("_r", lambda x: F.coalesce((x["a"] <= F.col("hi")) & (x["b"] >= F.col("lo")), F.lit(False)) | (x["z"] & F.col("has_null")))
    return manifest.crossJoin(F.broadcast(one)).withColumn("_hit", meets).drop("_r")


def merge_batch(base: str, batch: DataFrame, keys: Sequence[str], how: str = "replace") -> dict[str, int]:
    """Merge one batch into the table at `base`; {"read", "kept", "written"}: files read, files left alone, rows written.

    `how` is "replace" (U1) or "insert" (U3, the first write wins). A batch that was
    merged before changes nothing. A null key is a key; an empty batch leaves the table alone."""
    spark, keys, base = batch.sparkSession, list(keys), base.rstrip("/")
    new = not has_snapshot(spark, f"{base}/manifest")
    if new:
        batch.limit(0).write.mode("overwrite").parquet(f"{base}/schema")  # nothing is published yet
        old, left = batch.limit(0), None
        files = 0
    else:
        manifest = _marked(read_manifest(spark, base), batch, keys[0])
        hit = manifest.where("_hit").drop("_hit")
        left, files = manifest.where(~F.col("_hit")).drop("_hit"), hit.count()
        old = _read(spark, base, hit)
        batch = batch.select(*old.columns)
    merged = insert_if_absent(old, batch, keys) if how == "insert" or new else upsert_replace(old, batch, keys)
    size = old.count() + batch.count()
    if not size or (not new and not batch.limit(1).count()):
        return {"read": 0, "kept": 0 if new else files + left.count(), "written": 0}
    lines = _write(merged, base, keys, size)
    whole = lines if left is None else left.unionByName(lines)
    write_snapshot(whole.coalesce(1), f"{base}/manifest")
    return {"read": files, "kept": 0 if left is None else left.count(), "written": lines.agg(F.sum("n")).first()[0]}


def expire_files(spark: SparkSession, base: str) -> int:
    """Delete the data folders of which the newest manifest names no file; frames that still read them fail then."""
    base = base.rstrip("/")
    named = {r.d for r in read_manifest(spark, base).select(F.regexp_extract("file", r"/data/([0-9a-f]+)/", 1).alias("d")).distinct().collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in fs.listStatus(path(f"{base}/data")) if s.getPath().getName() not in named]
    for p in gone:
        fs.delete(p, True)
    return len(gone)


def manifest_stream(spark: SparkSession, source_dir: str, schema, base: str, keys: Sequence[str], checkpoint: str, how: str = "insert", fmt: str = "parquet") -> DataFrame:
    """One availableNow pass: files landed in `source_dir` since the last one are merged batch by batch; the table as it is then."""
    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)
    run = lambda batch, epoch: merge_batch(base, batch, keys, how) and None
    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return read_table(spark, base)
