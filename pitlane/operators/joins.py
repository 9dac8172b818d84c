"""Joins.  Broadcasts are left to AQE, which converts a join to a
broadcast only when the measured runtime size of a side is under
`spark.sql.adaptive.autoBroadcastJoinThreshold` -- a checked bound, with the
shuffle join as the fallback beyond it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Right rows of a key that or_key_join hands to its left rows at once.
LIST = 256
#: Tasks for each core that or_key_join deals its lists to.
TASKS = 8


def dual_side_join(matches: DataFrame, per_entity: DataFrame, cols: Sequence[str], match_id: str = "game_id",
                   home: str = "home_team_id", away: str = "away_team_id", entity: str = "team_id",
                   how: str = "inner") -> DataFrame:
    """Attach an entity-level table (keyed by match and entity) twice, as
    `home_<c>` and `away_<c>`.

    Contract, asserted while the job runs: a match id is one row of `matches`,
    and an entity has one row for a match.  One shuffle on the match id: the
    per-entity rows are joined on the match only and folded back to one row per
    match; the aggregate reuses the join's partitioning, so no second exchange.
    `how='inner'` keeps matches with both sides present, `'left'` keeps all."""
    pe = per_entity.select(F.col(match_id).alias("_mid"), F.col(entity).alias("_ent"),
                           F.struct(*[F.col(c) for c in cols]).alias("_v"))
    keys = matches.columns
    j = matches.join(pe, matches[match_id] == pe["_mid"], "left")
    at_home, is_away = F.col("_ent") == F.col(home), F.col("_ent") == F.col(away)
    agg = j.groupBy(match_id).agg(
        F.first(F.struct(*keys)).alias("_m"), F.first(F.when(at_home, F.col("_v")), ignorenulls=True).alias("_h"),
        F.first(F.when(is_away, F.col("_v")), ignorenulls=True).alias("_a"),
        F.greatest(F.count_if(at_home), F.count_if(is_away)).alias("_n"))
    msg = F.concat(F.lit("more than one row of an entity in match "), F.col(match_id).cast("string"))
    agg = agg.where(F.when(F.col("_n") > 1, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True)))
    if how == "inner":
        agg = agg.where(F.col("_h").isNotNull() & F.col("_a").isNotNull())
    return agg.select(*[F.col(f"_m.{c}").alias(c) for c in keys], *[F.col(f"_h.{c}").alias(f"home_{c}") for c in cols],
                      *[F.col(f"_a.{c}").alias(f"away_{c}") for c in cols])


def left_attach_default(df: DataFrame, other: DataFrame, on, defaults: dict) -> DataFrame:
    """Left outer attach, then COALESCE each attached column to its default."""
    j = df.join(other, on, "left")
    for c, d in defaults.items():
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit(d)))
    return j


def or_key_join(left: DataFrame, right: DataFrame, left_key: str, right_keys: Sequence[str],
                out_cols: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    """`SELECT DISTINCT ... ON left.key = right.k1 OR left.key = right.k2`
    without a nested-loop join.

    The right side is exploded to one row per distinct key value it offers
    (array_distinct: an entity on both sides matches once), then an equi join.
    DISTINCT is applied to the two (small) inputs instead of the (large) join
    output: with duplicate-free inputs every (left row, right row) pair occurs
    once, so the output is already distinct if it keeps the left key and all
    right keys; otherwise it is made distinct.

    The right rows of a key are dealt into lists of about LIST rows, and lists
    are joined and unfolded: a join of so many fewer rows, and a result in which
    a left row stands beside each list's rows in the same order, which columnar
    files store in a fraction of the bytes that single rows take. Lists are dealt
    to TASKS tasks for each core: by their few bytes Spark would give the
    work of all the rows that they unfold to to a task or two.

    `where` picks right rows before the join (the daily job asks for one date):
    without it the output is every pair of all dates, which grows as the left
    rows of a key times its right rows."""
    right = right if where is None else right.where(where)
    lcols = [c for c in (out_cols or left.columns) if c in left.columns]
    if left_key not in lcols:
        lcols.append(left_key)
    rcols = [c for c in (out_cols or right.columns) if c in right.columns and c not in lcols]
    rcols += [k for k in right_keys if k not in rcols]
    l = left.select(*lcols).distinct()
    r = right.select(*rcols).distinct()
    r = r.withColumn("_jk", F.explode(F.array_distinct(F.array(*[F.col(k) for k in right_keys])))).where("_jk IS NOT NULL")
    n = r.groupBy("_jk").agg(F.ceil(F.count("*") / LIST).alias("_lists"))
    names = [*right_keys, *[c for c in rcols if c not in right_keys]]  # rows of equal keys side by side
    row = F.struct(*[F.col(c) for c in names])
    dealt = r.join(n, "_jk").withColumn("_list", F.pmod(F.xxhash64(*rcols), "_lists"))
    dealt = dealt.repartition(TASKS * left.sparkSession.sparkContext.defaultParallelism, "_jk", "_list")
    lists = dealt.groupBy("_jk", "_list").agg(F.sort_array(F.collect_list(row)).alias("_rows")).drop("_list")
    j = lists.join(l, l[left_key] == lists["_jk"], "inner").select(*lcols, F.inline("_rows"))
    cols = list(out_cols) if out_cols is not None else [*lcols, *[c for c in rcols if c not in lcols]]
    out = j.select(*cols)
    return out if {left_key, *right_keys} <= set(cols) else out.distinct()


def missing_or_zero(ids: DataFrame, table: DataFrame, key: str, metric: str) -> DataFrame:
    """Keys with no row in `table`, or a row whose metric is 0 (needs refresh)."""
    t = table.select(F.col(key).alias("_k"), F.col(metric).alias("_m"))
    j = ids.select(key).join(t, F.col(key) == F.col("_k"), "left")
    return j.where(F.col("_k").isNull() | (F.col("_m") == 0)).select(key).distinct()


def semi_join_aggregate(bridge: DataFrame, profiles: DataFrame, group_key: str, member_key: str,
                        metrics: Sequence[str], out_names: Sequence[str] | None = None) -> DataFrame:
    """Per group, AVG of the profile rows whose member is IN the group's
    bridge rows.  IN semantics: a member listed twice counts once."""
    out_names = list(out_names or metrics)
    b = bridge.select(group_key, member_key).distinct()
    j = b.join(profiles, member_key, "inner")
    return j.groupBy(group_key).agg(*[F.avg(m).alias(o) for m, o in zip(metrics, out_names)])


def double_dimension_join(df: DataFrame, dim: DataFrame, dim_key: str, dim_value: str,
                          keys: dict[str, str]) -> DataFrame:
    """Look a name up once per key column, e.g. home and away team names."""
    out = df
    for key_col, out_name in keys.items():
        d = dim.select(F.col(dim_key).alias(f"_k_{out_name}"), F.col(dim_value).alias(out_name))
        out = out.join(d, out[key_col] == d[f"_k_{out_name}"], "left").drop(f"_k_{out_name}")
    return out


def delta_after_watermark(source: DataFrame, target: DataFrame, date: str, floor: str = "0001-01-01") -> DataFrame:
    """Source rows later than the target's latest date; all rows if the
    target is empty.  The watermark is a scalar subquery (a one-row aggregate
    with map-side partial max) used in a plain filter -- no join."""
    wm = target.select(F.coalesce(F.max(date).cast("date"), F.lit(floor).cast("date"))).scalar()
    return source.where(F.col(date) > wm)


def pending_before(games: DataFrame, as_of, status: str = "status", date: str = "game_date_et",
                   match_id: str = "game_id", pending: str = "scheduled") -> DataFrame:
    """Scheduled rows dated before `as_of`, oldest first (total order)."""
    from pitlane.functions.scalars import norm_status
    return (games.where((norm_status(F.col(status)) == pending) & (F.col(date) < F.lit(as_of).cast("date")))
            .orderBy(date, match_id))
