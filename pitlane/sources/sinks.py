"""Sinks.

Every sink writes under a folder the caller names (on a cluster: the shared
folder in `spark.checkpoint.dir`, see `scratch_dir`).  Snapshots are written
to a NEW versioned folder and then published by a new small pointer; the newest
pointer wins, and nothing published is ever overwritten (A8)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """A4: header CSV (one file per task; no coalesce to a single writer)."""
    df.write.mode(mode).option("header", "true").csv(path)
    return path


def day_documents(games: DataFrame, date: str, game_fields, props: DataFrame | None = None,
                  prop_fields=None, prop_order=None, top_k: int = 5, max_items: int = 5000) -> DataFrame:
    """A5: one nested document per day: `games[]` sorted, plus the day's `top_k`
    props.

    A day of more than `max_items` games is cut into `part`s by the games' places
    in their order, so the parts' arrays follow each other, nothing is dropped,
    and part 0 exists for every day with a game; it carries the props.  An
    ordinary day is part 0 alone.  Props are cut to top_k per day by a
    WindowGroupLimit before they are gathered."""
    from pyspark.sql import Window

    from pitlane.operators.positions import row_positions
    g = row_positions(games, [date], list(game_fields), "_pos").withColumn("part", F.floor(F.col("_pos") / max_items).cast("int"))
    g = g.groupBy(date, "part").agg(F.array_sort(F.collect_list(F.struct(*game_fields))).alias("games"))
    if props is None:
        return g
    w = Window.partitionBy(date).orderBy(*prop_order)
    top = props.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top_k)
    p = top.groupBy(date).agg(F.array_sort(F.collect_list(F.struct(F.col("_rn").alias("rank"), *prop_fields))).alias("top_props"))
    return merge_documents(g, p.withColumn("part", F.lit(0)), [date, "part"], "top_props")


def merge_documents(first: DataFrame, second: DataFrame, key, field: str) -> DataFrame:
    """Attach the second document's array as `field`; empty array if absent."""
    keys = [key] if isinstance(key, str) else list(key)
    j = first.join(second.select(*keys, field), keys, "left")
    empty = F.array().cast(second.schema[field].dataType)
    return j.withColumn(field, F.coalesce(F.col(field), empty))


def write_json_documents(docs: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """A5 sink: newline-delimited JSON, one document per line."""
    docs.write.mode(mode).json(path)
    return path


def payload_rows(df: DataFrame, category: str, date_col: str, cols) -> DataFrame:
    """(date, category, JSON payload) rows; nulls kept as JSON null."""
    payload = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return df.select(F.col(date_col).alias("prediction_date"), F.lit(category).alias("category"), payload.alias("payload"))


def append_payloads(rows: DataFrame, path: str) -> str:
    """A7 sink: append, partitioned by category (no read-modify-write)."""
    rows.write.mode("append").partitionBy("category").parquet(path)
    return path


def _pointers(spark: SparkSession, base: str) -> list[str]:
    """Names of the published pointers, oldest first; none if nothing was published."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/_pointers")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = [s.getPath() for s in fs.listStatus(path)]
    return sorted(p.getName() for p in done if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def has_snapshot(spark: SparkSession, base: str) -> bool:
    """Whether a version was ever published under `base`."""
    return bool(_pointers(spark, base))


def write_snapshot(df: DataFrame, base: str, fmt: str = "parquet") -> str:
    """A8/U*: write `df` to a new version folder, then publish it by a new
    pointer whose name sorts after all others.  Nothing published is ever
    changed or absent, so readers see either the old or the new version."""
    spark = df.sparkSession
    base = base.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    df.write.format(fmt).save(f"{base}/{version}")
    last = _pointers(spark, base)
    number = int(last[-1].split("-")[1]) + 1 if last else 0
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.text(f"{base}/_pointers/p-{number:012d}-{uuid.uuid4().hex}")
    return f"{base}/{version}"


def read_snapshot(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """Read the version that the newest pointer names."""
    base = base.rstrip("/")
    pointers = _pointers(spark, base)
    if not pointers:
        raise FileNotFoundError(f"no snapshot was published under {base}")
    version = spark.read.text(f"{base}/_pointers/{pointers[-1]}").first()[0]
    return spark.read.format(fmt).load(f"{base}/{version}")


def expire_snapshots(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Delete all but the newest `keep` versions (1 at least) with their pointers;
    returns how many went.  Frames that still read an old version fail then."""
    base = base.rstrip("/")
    old = _pointers(spark, base)[:-max(1, keep)]
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in old:
        version = spark.read.text(f"{base}/_pointers/{name}").first()[0]
        fs.delete(path(f"{base}/_pointers/{name}"), True)
        fs.delete(path(f"{base}/{version}"), True)
    return len(old)


def refresh_snapshot(df: DataFrame, base: str, fmt: str = "parquet") -> DataFrame:
    """Recompute a derived table, publish it as a new snapshot, return the published data."""
    write_snapshot(df, base, fmt)
    return read_snapshot(df.sparkSession, base, fmt)
