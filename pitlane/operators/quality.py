"""Data-quality checks: one aggregate pass per table, long form
(table, check, value, ok).  Keys are a contract Spark does not enforce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quality_checks(df: DataFrame, table: str, keys: Sequence[str], date: str | None = None, as_of=None,
                   recent_days: int = 7, expected_columns: Sequence[str] | None = None) -> DataFrame:
    """Row total, emptiness, NULL keys, duplicate keys, recent rows and column
    parity against `expected_columns`.  The duplicate count is a second
    aggregate over the key groups (partial aggregation, no collect)."""
    keys = list(keys)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(null_key).alias("null_keys")]
    if date is not None:
        a = F.lit(as_of).cast("date") if isinstance(as_of, str) else F.max(date)
        aggs.append(F.count_if(F.col(date) >= F.date_sub(a, recent_days)).alias("recent_rows") if isinstance(as_of, str)
                    else F.max(date).alias("_max_date"))
    one = df.agg(*aggs)
    dups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).cast("bigint").alias("duplicate_keys"))
    j = one.crossJoin(dups)
    checks = [("row_count", F.col("rows"), F.col("rows") >= 0), ("non_empty", F.col("rows"), F.col("rows") > 0),
              ("null_keys", F.col("null_keys"), F.col("null_keys") == 0),
              ("duplicate_keys", F.col("duplicate_keys"), F.col("duplicate_keys") == 0)]
    if date is not None and isinstance(as_of, str):
        checks.append(("recent_rows", F.col("recent_rows"), F.col("recent_rows") > 0))
    n_cols = len(df.columns)
    checks.append(("column_count", F.lit(n_cols).cast("bigint"), F.lit(True)))
    if expected_columns is not None:
        missing = len(set(expected_columns) - set(df.columns)) + len(set(df.columns) - set(expected_columns))
        checks.append(("column_parity", F.lit(missing).cast("bigint"), F.lit(missing == 0)))
    rows = [F.struct(F.lit(table).alias("table"), F.lit(n).alias("check"), v.cast("bigint").alias("value"), ok.alias("ok"))
            for n, v, ok in checks]
    return j.select(F.inline(F.array(*rows)))
