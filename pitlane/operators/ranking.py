"""Season-rank study operators, ordering and top-k.

Ranks are positions among counted values (`positions`), whatever the size of a
season.
Global top-k uses `orderBy(...).limit(k)` (TakeOrderedAndProject: per-task
top-k, then a k-row merge), never an unpartitioned window (trap T8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.operators.positions import null_safe_join, value_positions

# Outcome categories in their declared order (best first) and the
# substring rules that map a playoff text to them; checked in this order.
OUTCOME_ORDER = ["Finals Winner", "Finals Loser", "Conference Finals", "Playoffs Round 2", "Playoffs Round 1",
                 "Missed Playoffs"]
OUTCOME_RULES = [("Won Finals", "Finals Winner"), ("Lost Finals", "Finals Loser"),
                 ("Conf. Finals", "Conference Finals"), ("Conf. Semis", "Playoffs Round 2"),
                 ("1st Rnd.", "Playoffs Round 1")]
OUTCOME_DEFAULT = "Missed Playoffs"
CONTENDER_MARKERS = ["Won Finals", "Lost Finals", "Conf. Finals"]


def rank_in_group(df: DataFrame, group: str, metric: str, out: str, ascending: bool = True) -> DataFrame:
    """pandas rank(method='min') per group = SQL rank() (NULLs first when
    ascending, last when descending, as Spark orders them).

    The rank of a value is its exact position among the group's counted values
    (`positions.value_positions`): ties share it, NULL groups are groups, and
    the metric keeps its own type."""
    pos = value_positions(df, [group], metric)
    sizes = df.groupBy(group).agg(F.count(metric).alias("_nval"), F.count_if(F.col(metric).isNull()).alias("_nnull"))
    j = null_safe_join(null_safe_join(df, sizes, [group]), pos.drop("_total"), [group, metric], "left")
    if ascending:
        r = F.when(F.col(metric).isNull(), F.lit(1)).otherwise(F.col("_nnull") + F.col("_before") + 1)
    else:
        r = F.when(F.col(metric).isNull(), F.col("_nval") + 1).otherwise(F.col("_nval") - F.col("_before") - F.col("_n") + 1)
    return j.withColumn("_rank", r.cast("int")).select(*df.columns, F.col("_rank").alias(out))


def outcome_label(text: Column, rules=OUTCOME_RULES, default: str = OUTCOME_DEFAULT) -> Column:
    """First matching substring rule wins; NULL text -> default category."""
    e = None
    for needle, label in rules:
        cond = F.coalesce(text.contains(needle), F.lit(False))
        e = F.when(cond, label) if e is None else e.when(cond, label)
    return e.otherwise(default)


def contains_any(text: Column, needles: Sequence[str] = CONTENDER_MARKERS) -> Column:
    """J6 binary label: 1 if the text contains any of the needles, else 0."""
    cond = F.lit(False)
    for n in needles:
        cond = cond | F.coalesce(text.contains(n), F.lit(False))
    return cond.cast("int")


def ordinal(c: Column, order: Sequence[str] = OUTCOME_ORDER) -> Column:
    """Position of a category in its declared order (unknown -> NULL)."""
    e = None
    for i, v in enumerate(order):
        e = F.when(c == v, i) if e is None else e.when(c == v, i)
    return e


def composite_rank_score(off_rank: Column, def_rank: Column, base: int = 31) -> Column:
    """J4 (V7): 10 * ((base - off) + (base - def)) / 60."""
    return 10 * ((base - off_rank) + (base - def_rank)) / 60.0


def elite_flag(off_rank: Column, def_rank: Column, threshold: int = 5) -> Column:
    """Both ranks within the threshold."""
    return ((off_rank <= threshold) & (def_rank <= threshold)).cast("int")


def season_ranks(records: DataFrame, season: str = "season", ortg: str = "rel_ortg", drtg: str = "rel_drtg",
                 playoffs: str = "playoffs", min_finish_year: int | None = None, base: int = 31) -> DataFrame:
    """Rank-study frame: drop rows missing a rating, finish year from the label,
    optional era filter, offence rank (desc), defence rank (asc), composite
    score, elite flag, outcome label and contender label."""
    r = records.where(F.col(ortg).isNotNull() & F.col(drtg).isNotNull())
    r = r.withColumn("finish_year", F.substring(F.col(season), 1, 4).cast("int") + 1)
    if min_finish_year is not None:
        r = r.where(F.col("finish_year") >= min_finish_year)
    r = rank_in_group(r, "finish_year", ortg, "off_rank", ascending=False)
    r = rank_in_group(r, "finish_year", drtg, "def_rank", ascending=True)
    return r.select("finish_year", "team", ortg, drtg, "off_rank", "def_rank",
                    composite_rank_score(F.col("off_rank"), F.col("def_rank"), base).alias("contender_score"),
                    elite_flag(F.col("off_rank"), F.col("def_rank")).alias("elite"),
                    outcome_label(F.col(playoffs)).alias("outcome"),
                    contains_any(F.col(playoffs)).alias("is_contender"))


def top1_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """best row per group under a total order (row_number = 1 -> WindowGroupLimit)."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def group_report(df: DataFrame, group: str, label: str, top_label: str, name: str, out: str = "champion") -> DataFrame:
    """Every row with its group's winner attached (no loop per group).  The
    winner is a per-group aggregate (partial, map-side) joined back, not a
    window over the whole group."""
    win = df.groupBy(group).agg(F.max(F.when(F.col(label) == top_label, F.col(name))).alias(out))
    return null_safe_join(df, win, [group], "left")


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """Global top-k under a total order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def latest_distinct(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k latest distinct values."""
    return df.select(col).distinct().orderBy(F.col(col).desc()).limit(k)
