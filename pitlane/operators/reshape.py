"""Reshape, filters, scalar cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def match_to_team_rows(games: DataFrame, match_id: str = "game_id", date: str = "game_date_et",
                       home: str = "home_team_id", away: str = "away_team_id",
                       home_pts: str = "home_pts", away_pts: str = "away_pts",
                       points: bool = True, keep=()) -> DataFrame:
    """One match row -> two team rows (for/against swapped).

    `inline(array(struct, struct))` reads the match table once, where the
    reference's UNION ALL scans it twice.
    """
    def side(team, opp, is_home, pf, pa):
        fields = [F.col(team).alias("team_id"), F.col(opp).alias("opp_team_id"), F.lit(is_home).alias("is_home")]
        if points:
            fields += [F.col(pf).alias("pts_for"), F.col(pa).alias("pts_against")]
        return F.struct(*fields)

    sides = F.inline(F.array(side(home, away, True, home_pts, away_pts),
                             side(away, home, False, away_pts, home_pts)))
    return games.select(match_id, date, *keep, sides)


def _side_flags(matchup: str, home_marker: str, away_marker: str):
    m = F.col(matchup)
    return m.contains(home_marker), m.contains(away_marker)


def pair_rows_to_match(log: DataFrame, match_id: str = "game_id", date: str = "game_date", team: str = "team_id",
                       matchup: str = "matchup", pts: str = "pts", home_marker: str = "vs.",
                       away_marker: str = "@") -> DataFrame:
    """B1: two team rows -> one match row; the side comes from a marker in the
    matchup text.  Matches missing either side are dropped.  One shuffle:
    conditional aggregation per match (largest (team, pts) wins if a side repeats)."""
    is_home, is_away = _side_flags(matchup, home_marker, away_marker)
    g = log.groupBy(match_id).agg(
        F.max(F.when(is_home, F.struct(F.col(team).alias("t"), F.col(pts).alias("p"), F.col(date).alias("d")))).alias("_h"),
        F.max(F.when(is_away, F.struct(F.col(team).alias("t"), F.col(pts).alias("p")))).alias("_a"),
    )
    return g.where(F.col("_h").isNotNull() & F.col("_a").isNotNull()).select(
        match_id, F.col("_h.d").alias(date), F.col("_h.t").alias("home_team_id"), F.col("_a.t").alias("away_team_id"),
        F.col("_h.p").alias("home_pts"), F.col("_a.p").alias("away_pts"))


def pair_rows_exactly_two(log: DataFrame, match_id: str = "game_id", date: str = "game_date", team: str = "team_id",
                          matchup: str = "matchup", pts: str = "pts", home_marker: str = "vs.",
                          order_by: str = "team_id") -> DataFrame:
    """B2: groups of exactly two rows; the first row (by `order_by`, then team)
    decides: if it carries the home marker it is home, otherwise it is away and
    the second row is home whatever its text says."""
    row = F.struct(F.col(order_by).alias("o"), F.col(team).alias("t"), F.col(matchup).alias("m"),
                   F.col(pts).alias("p"), F.col(date).alias("d"))
    g = log.groupBy(match_id).agg(F.count(F.lit(1)).alias("_n"), F.min(row).alias("_r0"), F.max(row).alias("_r1"))
    first_home = F.col("_r0.m").contains(home_marker)
    h = F.when(first_home, F.col("_r0")).otherwise(F.col("_r1"))
    a = F.when(first_home, F.col("_r1")).otherwise(F.col("_r0"))
    return g.where(F.col("_n") == 2).select(
        match_id, h["d"].alias(date), h["t"].alias("home_team_id"), a["t"].alias("away_team_id"),
        h["p"].alias("home_pts"), a["p"].alias("away_pts"))


def pair_rows_nullable(log: DataFrame, match_id: str = "game_id", date: str = "game_date", team: str = "team_id",
                       matchup: str = "matchup", pts: str = "pts", home_marker: str = "vs.",
                       away_marker: str = "@") -> DataFrame:
    """As B1 but points may be NULL; status is 'final' iff both points exist.
    The home marker takes precedence when a text carries both."""
    is_home, is_away = _side_flags(matchup, home_marker, away_marker)
    is_away = is_away & ~is_home
    g = log.groupBy(match_id).agg(
        F.max(F.when(is_home, F.struct(F.col(team).alias("t"), F.col(pts).alias("p")))).alias("_h"),
        F.max(F.when(is_away, F.struct(F.col(team).alias("t"), F.col(pts).alias("p")))).alias("_a"),
        F.max(date).alias(date),
    )
    out = g.where(F.col("_h.t").isNotNull() & F.col("_a.t").isNotNull()).select(
        match_id, date, F.col("_h.t").alias("home_team_id"), F.col("_a.t").alias("away_team_id"),
        F.col("_h.p").alias("home_pts"), F.col("_a.p").alias("away_pts"))
    both = F.col("home_pts").isNotNull() & F.col("away_pts").isNotNull()
    return out.withColumn("status", F.when(both, "final").otherwise("scheduled"))


def completed_only(log: DataFrame, outcome: str = "wl", pts: str = "pts", date: str = "game_date") -> DataFrame:
    """Rows with an outcome, points and a parseable date (date re-typed)."""
    d = F.to_date(F.col(date).cast("string"))
    parsed = F.try_to_timestamp(F.col(date).cast("string"))
    return (log.where(F.col(outcome).isNotNull() & F.col(pts).isNotNull() & parsed.isNotNull())
            .withColumn(date, d))


def normalise_status(df: DataFrame, status: str = "status", mapping: dict | None = None) -> DataFrame:
    """lower(trim(status)), then an optional value mapping."""
    from pitlane.functions.scalars import norm_status
    c = norm_status(F.col(status))
    if mapping:
        m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
        c = F.coalesce(m[c], c)
    return df.withColumn(status, c)


def fill_and_flag(stats: DataFrame, matches: DataFrame, metrics, match_id: str = "game_id", team: str = "team_id",
                  home: str = "home_team_id") -> DataFrame:
    """NULL metrics -> 0.0 and the side flag derived from the match table."""
    m = matches.select(match_id, home)
    out = stats.join(m, match_id, "left")
    return out.select(
        match_id, team, (F.col(team) == F.col(home)).alias("is_home"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in metrics])


def map_with_fallback(df: DataFrame, lookup: DataFrame, key: str, value: str, name: str,
                      out: str = "abbr", fallback: str | None = None) -> DataFrame:
    """Dictionary lookup with a literal fallback, or the first three
    letters of `name` upper-cased.  The lookup is a left join: AQE turns it
    into a broadcast when the lookup's measured size is under the threshold."""
    lk = lookup.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    j = df.join(lk, df[key].eqNullSafe(lk["_k"]) & df[key].isNotNull(), "left")
    fb = F.lit(fallback) if fallback is not None else F.upper(F.substring(F.col(name), 1, 3))
    return j.withColumn(out, F.coalesce(F.col("_v"), fb)).drop("_k", "_v")


def outlier_filter(df: DataFrame, cond) -> DataFrame:
    """Drop rows meeting `cond`; a NULL condition never matches."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def stack_frames(train: DataFrame, test: DataFrame, origin: str = "_origin") -> DataFrame:
    """Concat by column name, missing columns NULL, origin recorded."""
    return train.withColumn(origin, F.lit("train")).unionByName(
        test.withColumn(origin, F.lit("test")), allowMissingColumns=True)


def split_back(df: DataFrame, part: str, origin: str = "_origin") -> DataFrame:
    """Recover one slice after shared preprocessing (by origin, not position)."""
    return df.where(F.col(origin) == part).drop(origin)


def date_spine(df: DataFrame, date: str, out: str = "day", before: int = 0, after: int = 0) -> DataFrame:
    """One row per calendar day from min(date) - before to max(date) + after.
    The spine has one row per day, bounded by the calendar."""
    bounds = df.agg(F.date_sub(F.min(date), before).alias("_lo"), F.date_add(F.max(date), after).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(out))


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop the listed columns that exist."""
    have = set(df.columns)
    return df.drop(*[c for c in cols if c in have])
