"""Readers.  Every reader takes a declared schema: no
inference on the hot path, so a file drifting from the contract fails or
nulls instead of silently retyping a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_landed(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                bad_rows: str = "PERMISSIVE", **options) -> DataFrame:
    """A1: landed team/player log extracts (parquet, json or csv) with a declared
    schema.  For text formats `bad_rows` is the parser mode (PERMISSIVE,
    DROPMALFORMED or FAILFAST)."""
    r = spark.read.schema(schema)
    if fmt in ("json", "csv"):
        r = r.option("mode", bad_rows)
    if fmt == "csv":
        r = r.option("header", "true")
    for k, v in options.items():
        r = r.option(k, v)
    return r.format(fmt).load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, bad_rows: str = "PERMISSIVE") -> DataFrame:
    """A2: header CSV with pinned types (the reference inferred them)."""
    return read_landed(spark, path, schema, fmt="csv", bad_rows=bad_rows)


def read_table(spark: SparkSession, query_or_table: str, **frames: DataFrame) -> DataFrame:
    """A3: a table or a query result.  `frames` bind `{name}` placeholders in the
    SQL text to DataFrames (no global temp view is created)."""
    if " " not in query_or_table.strip():
        return spark.table(query_or_table)
    return spark.sql(query_or_table, **frames)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
              partitions: int, properties: dict | None = None) -> DataFrame:
    """A3 (database form): a partitioned JDBC read -- `partitions` parallel range
    queries on `partition_column` instead of one connection reading everything.
    Not exercised here: no database may be started in this environment."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})
