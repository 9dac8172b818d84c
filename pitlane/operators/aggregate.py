"""Aggregations.  All are groupBy/agg plans: partial aggregation
runs map-side before the shuffle, so a hot group ships one partial row per
map task.  Exact percentiles (`percentile`, `median`) are used where the
reference computes exact values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.operators.positions import null_safe_join, value_positions

from pitlane.operators.joins import semi_join_aggregate


def bridge_average(matches: DataFrame, bridge: DataFrame, profiles: DataFrame, match_id: str = "game_id",
                   member: str = "official_id", metrics: Sequence[str] = ("pf_bias", "home_bias_delta", "timing_factor"),
                   out_names: Sequence[str] = ("pf_bias", "home_bias", "timing"),
                   defaults: Sequence[float] = (0.0, 0.0, 0.5)) -> DataFrame:
    """Per match, average of its bridged profiles; all defaults when the
    match has none (one batch job instead of one query per match)."""
    avg = semi_join_aggregate(bridge, profiles, match_id, member, metrics, out_names)
    j = matches.join(avg, match_id, "left")
    first = out_names[0]
    return j.select(*matches.columns, *[
        F.when(F.col(first).isNull(), F.lit(d)).otherwise(F.col(o)).alias(o) for o, d in zip(out_names, defaults)])


def group_mean(df: DataFrame, keys, value: str, out: str = "mean", digits: int | None = None) -> DataFrame:
    """Mean per group, optionally rounded like pandas (half-even on the binary value)."""
    from pitlane.functions.scalars import round_half_even_binary
    m = F.avg(value)
    g = df.groupBy(*([keys] if isinstance(keys, str) else keys)).agg(m.alias(out))
    if digits is not None:
        g = g.withColumn(out, round_half_even_binary(F.col(out), digits))
    return g


def group_mean_std_count(df: DataFrame, keys, value: str) -> DataFrame:
    """Mean, sample std and count per group (sorted by mean)."""
    return (df.groupBy(*([keys] if isinstance(keys, str) else keys))
            .agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("count"))
            .orderBy("mean"))


def _stack(df: DataFrame, id_cols, names, value_fields: dict[str, list]) -> DataFrame:
    """Wide -> long: one row per name with the listed per-name expressions."""
    rows = [F.struct(F.lit(n).alias("feature"), *[exprs[i].alias(k) for k, exprs in value_fields.items()])
            for i, n in enumerate(names)]
    return df.select(*id_cols, F.inline(F.array(*rows)))


def binary_split_means(df: DataFrame, flag: Column | str, features: Sequence[str]) -> DataFrame:
    """E5: per feature, mean over flagged rows and over unflagged rows (long form).
    One aggregate pass; the long form is built from its single row."""
    f = F.col(flag) if isinstance(flag, str) else flag
    agg = df.agg(*[F.avg(F.when(~f, F.col(c))).alias(f"h_{c}") for c in features],
                 *[F.avg(F.when(f, F.col(c))).alias(f"m_{c}") for c in features])
    return _stack(agg, [], features, {"avg_hit": [F.col(f"h_{c}") for c in features],
                                      "avg_miss": [F.col(f"m_{c}") for c in features]})


def segment_residuals(df: DataFrame, flags: Sequence[str], residual: str = "residual") -> DataFrame:
    """Per 0/1 flag column: count and mean residual where 1, mean where 0;
    flags taking a single value are omitted.  Flags are stacked to long form
    and aggregated in one pass (partial aggregation before the shuffle)."""
    long = df.select(F.col(residual).alias("_r"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("hook"), F.col(c).cast("int").alias("_f")) for c in flags])))
    g = long.groupBy("hook").agg(
        F.count(F.when(F.col("_f") == 1, F.col("_r"))).alias("count_if_1"),
        F.avg(F.when(F.col("_f") == 1, F.col("_r"))).alias("mean_resid_if_1"),
        F.avg(F.when(F.col("_f") == 0, F.col("_r"))).alias("mean_resid_if_0"),
        F.max(F.when(F.col("_f") == 1, 1)).alias("_has1"), F.max(F.when(F.col("_f") == 0, 1)).alias("_has0"))
    return g.where(F.col("_has1").isNotNull() & F.col("_has0").isNotNull()).drop("_has1", "_has0")


def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """Frequency per value (NULL counted as its own value), most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out)).orderBy(F.col(out).desc(), F.col(col).asc_nulls_last())


def rows_per_date(df: DataFrame, date: str, out: str = "n_rows") -> DataFrame:
    """Row count per date."""
    return df.groupBy(date).agg(F.count(F.lit(1)).alias(out))


def group_median_mode(df: DataFrame, keys, median_cols: Sequence[str], mode_cols: Sequence[str]) -> DataFrame:
    """Exact median per column and the most frequent value (smallest on a
    tie) per group; a NULL group is a group. The median columns are stacked as
    (column, value) and ranked once, all modes come from one count each."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = df.select(*keys).distinct()
    if median_cols:
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).cast("double").alias("_x")) for i, c in enumerate(median_cols)]))
        long = df.select(*keys, pairs.alias("_p")).select(*keys, "_p.*")
        mid = exact_quantiles(long, [*keys, "_i"], "_x", [0.5], ["_m"])
        wide = mid.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.col("_m"))).alias(f"median_{c}") for i, c in enumerate(median_cols)])
        out = null_safe_join(out, wide, keys, "left")
    for c in mode_cols:
        out = null_safe_join(out, group_mode(df, keys, c), keys, "left")
    return out


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact 25/50/75% (linear interpolation,
    as pandas) and max per numeric column, one row per column.  All columns
    are stacked as (column, value) once: one aggregate gives the moments and one
    ranking of the stacked values all quartiles."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("column"), F.col(c).cast("double").alias("x"))
                                for i, c in enumerate(cols)]))
    long = df.select(pairs.alias("p")).select("p.*")
    x = F.col("x")
    seeds = df.sparkSession.createDataFrame(list(enumerate(cols)), "i int, column string")  # a row per column, also of an empty table
    moments = long.groupBy("column").agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                                         F.min(x).alias("min"), F.max(x).alias("max"))
    quart = exact_quantiles(long, ["column"], "x", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    out = seeds.join(moments, "column", "left").join(quart, "column", "left")
    return out.select("column", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min", "p25", "p50", "p75", "max")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, max_nulls: int = 0) -> DataFrame:
    """NULL count per column (long form) and whether it is within `max_nulls`."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    out = _stack(one, [], cols, {"n_null": [F.col(c) for c in cols]}).withColumnRenamed("feature", "column")
    return out.withColumn("ok", F.col("n_null") <= max_nulls)


def skew_profile(df: DataFrame, cols: Sequence[str], limit: float = 0.75) -> DataFrame:
    """Population skewness (scipy's default, Spark's `skewness`) per column, kept if > limit."""
    one = df.agg(*[F.skewness(F.col(c).cast("double")).alias(c) for c in cols])
    out = _stack(one, [], cols, {"skew": [F.col(c) for c in cols]}).withColumnRenamed("feature", "column")
    return out.where(F.col("skew") > limit)


def segment_vs_overall(profile: DataFrame, segment: str, metrics: Sequence[str]) -> DataFrame:
    """Each segment's metric against the unweighted mean of the segment
    means (mean of group means, not of rows).  The overall row is a one-row
    aggregate crossed in as a broadcast."""
    overall = profile.agg(*[F.avg(m).alias(f"overall_{m}") for m in metrics])
    j = profile.select(segment, *metrics).crossJoin(F.broadcast(overall))
    return j.select(segment, *metrics, *[F.col(f"overall_{m}") for m in metrics],
                    *[(F.col(m) - F.col(f"overall_{m}")).alias(f"delta_{m}") for m in metrics])


# ---------------------------------------------------------------------------
# Scale-safe exact mode and quantiles
# ---------------------------------------------------------------------------

def group_mode(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """Most frequent non-NULL value per group, smallest on a tie; without keys
    exactly one row, NULL if there is no value.

    Values are counted over (group, value), so a hot group is spread by its
    values; the winner is a minimum, partially aggregated on the map side."""
    keys = list(keys)
    c = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(col).alias("v"))).alias("_best")
    top = c.groupBy(*keys).agg(best) if keys else c.agg(best)
    return top.select(*keys, F.col("_best.v").alias(out or f"mode_{col}"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], col: str, probs: Sequence[float],
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles per group with linear interpolation (percentile_cont /
    pandas / numpy default), NULLs ignored; one output column per prob.  A NULL
    group is a group; a group without values, and an empty table without keys,
    give NULLs.

    The values at the floor and ceil positions are read off
    `positions.value_positions`, so no task holds a group's values."""
    keys = list(keys)
    names = list(names or [f"q{i}" for i in range(len(probs))])
    base = df.select(*keys, F.col(col).cast("double").alias("_qx"))
    pos = value_positions(base, keys, "_qx")
    picks = []
    for i, p in enumerate(probs):
        at = (F.col("_total") - 1) * float(p)
        for side, k in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            held = (F.col("_before") <= k) & (k < F.col("_before") + F.col("_n"))
            picks.append(F.max(F.when(held, F.col("_qx"))).alias(f"_{side}{i}"))
    agg = [F.max("_total").alias("_qn"), *picks]
    g = pos.groupBy(*keys).agg(*agg) if keys else pos.agg(*agg)
    if keys:
        g = null_safe_join(base.select(*keys).distinct(), g, keys, "left")
    cols = []
    for i, (p, name) in enumerate(zip(probs, names)):
        at = (F.col("_qn") - 1) * float(p)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        cols.append(F.when(lo == hi, lo).otherwise(lo + (at - F.floor(at)) * (hi - lo)).alias(name))
    return g.select(*keys, *cols)
