"""Exact positions of values and rows in an order within groups, at every size
by one plan: no size check, no window over a whole group.

Values are counted per (group, value) first.  A monotone coarse key cuts a
group into ordered buckets; running totals over a group's buckets and over the
values inside one bucket add up to the exact position.  The coarse key is a
fixed function of the value (nothing is sampled or fitted), so an outlier, a
narrow range far from zero and infinities all keep small buckets.  Buckets are
totalled in levels: a long's by 18 more bits each, a float's by 14, a string's
by fewer first characters, so no window runs over all buckets of a large group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Buckets per factor e of a float's size; 1e9 + i has 3,800 integers in one bucket.
FLOAT_BUCKETS = 1 << 18
# Low bits of an integer that share a bucket.
INT_BITS = 12
# Days that share a bucket.
DATE_DAYS = 16
# First characters of a string that name its bucket, and the shorter beginnings of the levels above.
STRING_CHARS = 48
STRING_LEVELS = (32, 24, 16, 12, 8, 4)
# Bits of a long's or timestamp's bucket number, and of a float's, that one level takes.
LONG_LEVEL, FLOAT_LEVEL = 18, 14


def coarse_key(c: Column, dtype: T.DataType) -> Column:
    """A key that never falls as the value rises (NULL for NULL)."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.shiftright(c.cast("long"), INT_BITS)
    if isinstance(dtype, T.StringType):
        return F.substring(c, 1, STRING_CHARS)
    if isinstance(dtype, T.TimestampType):
        return F.shiftright(F.unix_micros(c), 26)  # about a minute
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        x = c.cast("double")
        scaled = F.signum(x) * F.floor(F.log1p(F.abs(x)) * FLOAT_BUCKETS)
        return F.when(F.isnan(x), F.lit((1 << 63) - 1)).otherwise(scaled.cast("long"))  # in the bucket of infinity, after it
    if isinstance(dtype, T.DateType):
        return F.floor(F.unix_date(c) / DATE_DAYS)
    return c  # booleans: two values


def coarser_keys(key: Column, dtype: T.DataType) -> list[Column]:
    """The levels above a coarse key, each a monotone function of the one before, the widest last."""
    if isinstance(dtype, T.StringType):
        return [F.substring(key, 1, n) for n in STRING_LEVELS]
    if isinstance(dtype, T.LongType):  # 52 bits are left of 64
        return [F.shiftright(key, LONG_LEVEL), F.shiftright(key, 2 * LONG_LEVEL)]
    if isinstance(dtype, T.TimestampType):  # 38 bits
        return [F.shiftright(key, LONG_LEVEL)]
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return [F.shiftright(key, FLOAT_LEVEL)]
    return []  # integers of 32 bits have 2^20 buckets at most, dates one for 16 days


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the right side's keys are dropped."""
    names = {k: f"_ns_{i}" for i, k in enumerate(keys)}
    right = right.select(*[F.col(k).alias(n) for k, n in names.items()], *[c for c in right.columns if c not in names])
    cond = None
    for k, n in names.items():
        e = F.col(k).eqNullSafe(F.col(n))
        cond = e if cond is None else cond & e
    return left.join(right, cond, how).drop(*names.values())


def _running(name: str, w) -> Column:
    return F.coalesce(F.sum(name).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def bucket_totals(buckets: DataFrame, group: Sequence[str], dtype: T.DataType, total: bool = False) -> DataFrame:
    """(group, _k, _kb and, if asked, _total) of buckets (group, _k, _kn): the group's rows in buckets before, and all of them.

    The buckets are summed up level by level; a window runs over the children of one
    bucket of the level above, and that bucket's own total before is added by a join."""
    group = list(group)
    levels = ["_k"]
    for i, key in enumerate(coarser_keys(F.col("_k"), dtype)):
        levels.append(f"_k{i}")
        buckets = buckets.withColumn(levels[-1], key)
    extra = ["_total"] if total else []

    def before(t: DataFrame, names: list[str]) -> DataFrame:
        fine, above = names[0], names[1:]
        if not above:
            w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
            sums = [F.sum("_kn").over(w).alias("_total")] if total else []
            return t.select(*group, fine, _running("_kn", w.orderBy(fine)).alias("_kb"), *sums)
        up = before(t.groupBy(*group, *above).agg(F.sum("_kn").alias("_kn")), above)
        j = null_safe_join(t, up.withColumnRenamed("_kb", "_ub"), [*group, above[0]])
        inside = Window.partitionBy(*group, above[0]).orderBy(fine)
        return j.select(*group, fine, (F.col("_ub") + _running("_kn", inside)).alias("_kb"), *extra)

    return before(buckets, levels)


def value_positions(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """(group, value, _n, _before, _total): each distinct non-NULL value with its
    rows, the group's rows with smaller values, and all its non-NULL rows."""
    group, dtype = list(group), df.schema[value].dataType
    counts = (df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_k", coarse_key(F.col(value), dtype)))
    per_key = bucket_totals(counts.groupBy(*group, "_k").agg(F.sum("_n").alias("_kn")), group, dtype, total=True)
    j = null_safe_join(counts, per_key, [*group, "_k"])
    inside = Window.partitionBy(*group, "_k").orderBy(value)
    return j.select(*group, value, "_n", (F.col("_kb") + _running("_n", inside)).alias("_before"), "_total")


def row_positions(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Adds `out`, the row's 0-based position in `order` within its group (NULLs first).

    The first order column's coarse key cuts a group into buckets; rows are
    numbered inside a bucket, after the running total of the buckets before."""
    group, order = list(group), list(order)
    dtype = df.schema[order[0]].dataType
    rows = df.withColumn("_k", coarse_key(F.col(order[0]), dtype))
    per_key = bucket_totals(rows.groupBy(*group, "_k").agg(F.count(F.lit(1)).alias("_kn")), group, dtype)
    j = null_safe_join(rows, per_key, [*group, "_k"])
    inside = F.row_number().over(Window.partitionBy(*group, "_k").orderBy(*order))
    return j.withColumn(out, F.col("_kb") + inside - 1).drop("_k", "_kb")


def chunked(df: DataFrame, group: Sequence[str], order: str, size: int, reach: int, out: str, own: str) -> DataFrame:
    """Adds `out`, the chunk of a group that a row is in, and copies of the rows that later chunks reach back to.

    The coarse key of `order` cuts a group into ordered buckets; a running total over the
    buckets' counts puts buckets that begin in the same `size` positions into one chunk. A
    bucket that ends less than `reach` rows before a later chunk begins is copied into it;
    `own` is false on copies. A group of few rows is one chunk without copies. What is joined
    to the rows is a count for each bucket, and the rows then move once, by (group, chunk)."""
    group = list(group)
    rows = df.withColumn("_k", coarse_key(F.col(order), df.schema[order].dataType))
    whole = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy("_k")
    b = rows.groupBy(*group, "_k").agg(F.count(F.lit(1)).alias("_kn")).withColumn("_kb", _running("_kn", whole))
    b = b.withColumn("_c", F.floor(F.col("_kb") / size))
    later = F.collect_list(F.struct("_kb", "_c")).over(whole.rowsBetween(1, reach)) if reach else F.array().cast("array<struct<_kb:bigint,_c:bigint>>")
    near = F.filter(later, lambda x: (x["_kb"] < F.col("_kb") + F.col("_kn") + reach) & (x["_c"] != F.col("_c")))
    chunks = F.array_distinct(F.concat(F.array("_c"), F.transform(near, lambda x: x["_c"])))
    j = null_safe_join(rows, b.select(*group, "_k", F.col("_c").alias("_own"), chunks.alias("_in")), [*group, "_k"])
    j = j.withColumn(out, F.explode("_in"))
    return j.withColumn(own, F.col(out) == F.col("_own")).drop("_k", "_own", "_in")
