"""Point-in-time features: as-of lookups, last-N form, rolling windows.

Scale notes shared by every operator here:

* A window partitioned only by an entity sends all of that entity's rows to
  one task, so a hot entity (a third of all rows) would serialise the job.
  As-of lookups therefore first reduce both sides to distinct
  (entity, time) keys -- bounded by the calendar, not by the row count --
  and join the answers back with an equi join (AQE splits a skewed side).
* Per-row rolling frames use `trailing`: an entity's rows are cut into chunks
  by counts of ordered buckets, and the window runs per (entity, chunk) with
  the rows that frames reach back into copied into the later chunk.
* Every order is total: the match id is the last sort key (trap T7).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.functions.scalars import norm_status
from pitlane.operators.positions import chunked, coarse_key, null_safe_join
from pitlane.operators.reshape import match_to_team_rows


def _cols(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# ---------------------------------------------------------------------------
# D3: as-of "last event strictly before"
# ---------------------------------------------------------------------------

def asof_last_before(
    requests: DataFrame,
    events: DataFrame,
    entity: str | Sequence[str],
    req_time: str,
    evt_time: str,
    values: Sequence[str] = (),
    out_time: str = "last_event_time",
    inclusive: bool = False,
    bucket: str | None = "auto",
) -> DataFrame:
    """Attach to every request row the latest event of the same entity before it.

    `values` are event columns carried along (taken from the latest event;
    when several events share the latest time, the one with the largest
    value struct wins, so the answer is deterministic).  Strict `<` unless
    `inclusive`.  Requests without a prior event get NULLs.

    Plan: one row for each (entity, time) of either side, by one aggregate over
    their union -> one fill window -> equi join back.  For DATE times the keys per entity are bounded
    by the calendar.  For finer times (`bucket='auto'` on a timestamp, or an
    explicit bucket such as 'day' / 'hour') the fill window is partitioned by
    (entity, time bucket), and the last event of all earlier buckets is
    carried in from a running fill over per-bucket summaries (one row per
    bucket), so a hot entity is spread over its buckets."""
    ent = _cols(entity)
    vals = list(values)
    # one row for each (entity, time) of either side: whether events or requests have it, and the events' values
    val = F.struct(*[F.col(v) for v in vals]) if vals else F.lit(None).cast("boolean")
    ev = events.select(*[F.col(c) for c in ent], F.col(evt_time).alias("_t"), F.lit(True).alias("_e"), F.lit(False).alias("_r"), val.alias("_v"))
    rq = requests.select(*[F.col(c) for c in ent], F.col(req_time).alias("_t"), F.lit(False).alias("_e"), F.lit(True).alias("_r"),
                         F.lit(None).cast(ev.schema["_v"].dataType).alias("_v"))
    keys = ev.unionByName(rq).groupBy(*ent, "_t").agg(F.max("_e").alias("_e"), F.max("_r").alias("_r"), *([F.max("_v").alias("_v")] if vals else []))
    payload = F.struct(F.col("_t").cast(ev.schema["_t"].dataType).alias("_t"), *([F.col("_v")] if vals else []))
    keys = keys.select(*ent, "_t", "_e", "_r", F.when(F.col("_e"), payload).alias("_payload"))
    upto = Window.currentRow if inclusive else -1

    if bucket == "auto":
        bucket = None if dict(requests.dtypes)[req_time] == "date" else "day"
    if bucket is None:
        w = Window.partitionBy(*ent).orderBy("_t").rowsBetween(Window.unboundedPreceding, upto)
        filled = keys.withColumn("_last", F.last("_payload", ignorenulls=True).over(w))
    else:
        keys = keys.withColumn("_bk", F.date_trunc(bucket, F.col("_t")))
        wb = Window.partitionBy(*ent, "_bk").orderBy("_t").rowsBetween(Window.unboundedPreceding, upto)
        inner = keys.withColumn("_in", F.last("_payload", ignorenulls=True).over(wb))
        # last event of each bucket, carried to later buckets (rows per entity = buckets)
        per_b = keys.groupBy(*ent, "_bk").agg(F.max_by("_payload", F.when(F.col("_e"), F.col("_t"))).alias("_blast"))
        wc = Window.partitionBy(*ent).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
        carry = per_b.select(*ent, "_bk", F.last("_blast", ignorenulls=True).over(wc).alias("_carry"))
        filled = inner.join(carry, [*ent, "_bk"], "left").withColumn("_last", F.coalesce("_in", "_carry"))
    filled = (filled.where("_r")
              .select(*ent, F.col("_t").alias("_rt"), F.col("_last._t").alias(out_time),
                      *[F.col(f"_last._v.{v}").alias(v) for v in vals]))
    cond = [requests[c].eqNullSafe(filled[c]) for c in ent] + [requests[req_time] == filled["_rt"]]
    out = requests.join(filled, cond, "left")
    return out.drop(*[filled[c] for c in ent]).drop("_rt")


# ---------------------------------------------------------------------------
# Team-row views over a match table
# ---------------------------------------------------------------------------

def _finished_team_rows(games: DataFrame, status: str, date: str, season_type: str | None,
                        need_points: bool = True) -> DataFrame:
    g = games.withColumn("_status", norm_status(F.col(status)))
    cond = F.col("_status") == "final"
    if need_points:
        cond = cond & F.col("home_pts").isNotNull() & F.col("away_pts").isNotNull()
    if season_type is not None:
        cond = cond & (F.col("season_type") == season_type)
    return match_to_team_rows(g.where(cond), date=date)


def _scheduled_team_rows(games: DataFrame, status: str, date: str, season_type: str | None,
                         requests: str = "scheduled") -> DataFrame:
    g = games.withColumn("_status", norm_status(F.col(status)))
    cond = (F.col("_status") == "scheduled") if requests == "scheduled" else F.lit(True)
    if season_type is not None:
        cond = cond & (F.col("season_type") == season_type)
    rows = match_to_team_rows(g.where(cond), date=date, points=False)
    return rows.select("game_id", F.col(date).alias("scheduled_date_et"), "team_id", "is_home")


# ---------------------------------------------------------------------------
# rest days before each scheduled match
# ---------------------------------------------------------------------------

def rest_days(games: DataFrame, season_type: str | None = "regular", status: str = "status",
              date: str = "game_date_et", requests: str = "scheduled") -> DataFrame:
    """Scheduled (game, team) rows with the last finished match date strictly
    before, `rest_days = gap - 1` (NULL if none) and `rest_days_missing` (V3)."""
    finals = _finished_team_rows(games, status, date, season_type, need_points=False)
    sched = _scheduled_team_rows(games, status, date, season_type, requests)
    out = asof_last_before(sched, finals, "team_id", "scheduled_date_et", date, out_time="last_final_date_et")
    return out.select(
        "game_id", "scheduled_date_et", "team_id", "is_home", "last_final_date_et",
        (F.datediff("scheduled_date_et", "last_final_date_et") - 1).alias("rest_days"),
        F.col("last_final_date_et").isNull().alias("rest_days_missing"),
    )


# ---------------------------------------------------------------------------
# average and count of the last N finished margins strictly before
# ---------------------------------------------------------------------------

def last_n_form(games: DataFrame, ns: Sequence[int] = (5, 10), season_type: str | None = None,
                status: str = "status", date: str = "game_date_et", prefix: str = "rolling_pd",
                requests: str = "scheduled") -> DataFrame:
    """Per scheduled (game, team): `{prefix}_{n}` = AVG of the last n finished
    margins with date < scheduled date, as decimal(10,3) (NULL if none), and
    `{prefix}_{n}_n` = how many there were (0 if none).  `requests='all'`
    computes the same pre-match features for every match (training rows).

    Plan (no correlated subquery, trap T1):
      1. finished team rows; keep the n_max latest per (team, date) -- Spark
         plans `row_number() <= k` as a WindowGroupLimit on both sides of the
         shuffle, so a hot (team, date) is cut before it moves;
      2. trailing `rowsBetween(-n+1, 0)` avg/count over those rows (all n share
         one sort); the last row of each date then summarises "last n up to d";
      3. as-of fill of those per-(team, date) summaries strictly before each
         scheduled date (D3), joined back.
    """
    ns = sorted(set(int(n) for n in ns))
    nmax = ns[-1]
    fin = _finished_team_rows(games, status, date, season_type).select(
        "team_id", F.col(date).alias("_d"), "game_id", (F.col("pts_for") - F.col("pts_against")).alias("_m"))
    w_day = Window.partitionBy("team_id", "_d").orderBy(F.col("game_id").desc())
    fin = fin.withColumn("_rn", F.row_number().over(w_day)).where(F.col("_rn") <= nmax)
    w_trail = Window.partitionBy("team_id").orderBy("_d", "game_id")
    stats = []
    for n in ns:
        wn = w_trail.rowsBetween(-(n - 1), 0)
        stats += [F.avg("_m").over(wn).alias(f"_a{n}"), F.count("_m").over(wn).alias(f"_c{n}")]
    summ = fin.select("team_id", "_d", "_rn", *stats).where(F.col("_rn") == 1).drop("_rn")

    sched = _scheduled_team_rows(games, status, date, season_type, requests)
    vals = [c for n in ns for c in (f"_a{n}", f"_c{n}")]
    out = asof_last_before(sched, summ, "team_id", "scheduled_date_et", "_d", values=vals, out_time="_last_d")
    cols = []
    for n in ns:
        cols += [F.col(f"_a{n}").cast("decimal(10,3)").alias(f"{prefix}_{n}"),
                 F.coalesce(F.col(f"_c{n}"), F.lit(0).cast("bigint")).alias(f"{prefix}_{n}_n")]
    return out.select("game_id", "scheduled_date_et", "team_id", "is_home", *cols)


def scheduled_form_and_rest(games: DataFrame, ns: Sequence[int] = (5, 10), season_type: str | None = "regular") -> DataFrame:
    """Flagship: F2 for every scheduled team row plus F1 rest days (F1 restricted
    to `season_type`, as the reference's rest view)."""
    form = last_n_form(games, ns)
    rest = rest_days(games, season_type=season_type).select("game_id", "team_id", "rest_days", "rest_days_missing")
    return form.join(rest, ["game_id", "team_id"], "left")


# ---------------------------------------------------------------------------
# Trailing-row frames over chunks of positions
# ---------------------------------------------------------------------------

# Rows of an entity that one window task takes (plus the rows its frames reach back into).
CHUNK_ROWS = 100_000


def trailing(df: DataFrame, entity: str | Sequence[str], order: Sequence[str],
             aggs: dict[str, tuple[str, Column | str, int, int]]) -> DataFrame:
    """Add per-row trailing ROWS-frame aggregates, at every size by one plan.

    `aggs` maps output name -> (fn, value column, start, end) with start <= end <= 0,
    i.e. `fn(value) over (partition by entity order by order rows between start and end)`
    where fn is one of avg, sum, count, min, max, stddev_samp, stddev_pop.

    Buckets of the first order column are gathered to chunks of about CHUNK_ROWS rows
    (`positions.chunked`); buckets at a chunk's end that frames of a later one reach are
    copied there.  The window runs per (entity, chunk) on the columns' own types, and
    the copies are dropped: a busy entity is spread over its chunks, a NULL entity is
    an entity."""
    ent, order = _cols(entity), list(order)
    fns = {"avg": F.avg, "sum": F.sum, "count": F.count, "min": F.min, "max": F.max,
           "stddev_samp": F.stddev_samp, "stddev_pop": F.stddev_pop}
    reach = max(-spec[2] for spec in aggs.values())
    rows = chunked(df, ent, order[0], max(CHUNK_ROWS, reach), reach, "_chunk", "_is_own")
    w = Window.partitionBy(*ent, "_chunk").orderBy(*order)
    out = rows.select("*", *[fns[fn](F.col(v) if isinstance(v, str) else v).over(w.rowsBetween(s, e)).alias(name)
                             for name, (fn, v, s, e) in aggs.items()])
    return out.where("_is_own").select(*df.columns, *aggs)


def rolling_rows(df: DataFrame, entity, order: Sequence[str], metrics: dict[str, str], n: int,
                 include_current: bool = True, full_only: bool = False, fn: str = "avg") -> DataFrame:
    """per-row mean (or `fn`) of the last `n` rows per entity.

    include_current=True  -> rows between n-1 preceding and current (F3)
    include_current=False -> rows between n preceding and 1 preceding (F4, V4)
    full_only=True        -> NULL until the frame holds n non-null values (F5,
                             pandas `rolling(n).mean()`).
    `metrics` maps output name -> input column."""
    s, e = (-(n - 1), 0) if include_current else (-n, -1)
    aggs = {}
    for out, c in metrics.items():
        aggs[out] = (fn, c, s, e)
        if full_only:
            aggs[f"_cnt_{out}"] = ("count", c, s, e)
    res = trailing(df, entity, order, aggs)
    if full_only:
        for out in metrics:
            res = res.withColumn(out, F.when(F.col(f"_cnt_{out}") == n, F.col(out))).drop(f"_cnt_{out}")
    return res


def cumulative_prior(df: DataFrame, entity, order: Sequence[str], value: str, out: str = "volatility",
                     stat: str = "stddev_samp", default: float | None = 11.0) -> DataFrame:
    """F8: statistic over ALL prior rows of the entity (rows unbounded preceding
    to 1 preceding), e.g. sample std of points, with a default when undefined.

    Rows before the row's bucket (the first order column's coarse key) come from
    running totals over the entity's buckets, rows before it inside the bucket
    from a window, and the two are merged.  Second moments are kept around means:
    the buckets' are centred on the entity's mean, so values far from zero lose
    nothing.  A NULL entity is an entity."""
    ent, order = _cols(entity), list(order)
    base = df.withColumn("_b", coarse_key(F.col(order[0]), df.schema[order[0]].dataType)).withColumn("_x", F.col(value).cast("double"))
    per_b = base.groupBy(*ent, "_b").agg(F.count("_x").alias("_n"), F.coalesce(F.avg("_x"), F.lit(0.0)).alias("_m"),
                                         F.coalesce(F.var_pop("_x") * F.count("_x"), F.lit(0.0)).alias("_m2"))
    whole = Window.partitionBy(*ent)
    per_b = per_b.withColumn("_ref", F.sum(F.col("_m") * F.col("_n")).over(whole) / F.greatest(F.sum("_n").over(whole), F.lit(1)))
    d = F.col("_m") - F.col("_ref")
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    run = lambda e: F.coalesce(F.sum(e).over(before), F.lit(0))
    per_b = per_b.select(*ent, "_b", "_ref", run(F.col("_n")).alias("_n0"), run(F.col("_n") * d).alias("_s0"), run(F.col("_m2") + F.col("_n") * d * d).alias("_q0"))
    j = null_safe_join(base, per_b, [*ent, "_b"])
    inside = Window.partitionBy(*ent, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    n0, n1 = F.col("_n0"), F.count("_x").over(inside)
    mean0 = F.when(n0 > 0, F.col("_s0") / n0).otherwise(0.0)
    mean1 = F.coalesce(F.avg("_x").over(inside) - F.col("_ref"), F.lit(0.0))
    m20 = F.when(n0 > 0, F.greatest(F.lit(0.0), F.col("_q0") - F.col("_s0") * F.col("_s0") / n0)).otherwise(0.0)
    m21 = F.coalesce(F.var_pop("_x").over(inside) * n1, F.lit(0.0))
    j = j.withColumn("_N", n0 + n1).withColumn("_M2", m20 + m21 + F.when((n0 > 0) & (n1 > 0), F.pow(mean1 - mean0, 2) * n0 * n1 / (n0 + n1)).otherwise(0.0))
    j = j.withColumn("_MEAN", F.col("_ref") + (n0 * mean0 + n1 * mean1) / F.greatest(F.col("_N"), F.lit(1)))
    v = {"stddev_samp": F.when(F.col("_N") > 1, F.sqrt(F.col("_M2") / (F.col("_N") - 1))),
         "stddev_pop": F.when(F.col("_N") > 0, F.sqrt(F.col("_M2") / F.col("_N"))),
         "avg": F.when(F.col("_N") > 0, F.col("_MEAN")), "count": F.col("_N")}[stat]
    if default is not None:
        v = F.coalesce(v, F.lit(default))
    return j.withColumn("_v", v).select(*df.columns, F.col("_v").alias(out))


def current_last_n(df: DataFrame, entity, order: Sequence[str], metrics: dict[str, tuple[str, int]],
                   min_rows: int = 0) -> DataFrame:
    """per entity, mean of its latest k rows for each (column, k); a short
    history uses what exists.  `row_number() <= kmax` becomes a WindowGroupLimit
    (partial top-k before the shuffle), so a hot entity ships only kmax rows per
    map task.  `min_rows` drops entities with fewer rows than that."""
    ent = _cols(entity)
    kmax = max(k for _, k in metrics.values())
    w = Window.partitionBy(*ent).orderBy(*[F.col(c).desc() for c in order])
    top = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= kmax)
    out = top.groupBy(*ent).agg(F.count(F.lit(1)).alias("n_rows"),
                                *[F.avg(F.when(F.col("_rn") <= k, F.col(c))).alias(name) for name, (c, k) in metrics.items()])
    if min_rows:
        out = out.where(F.col("n_rows") >= min_rows)
    return out


def team_rows_final(games: DataFrame, season_type: str | None = None) -> DataFrame:
    """Final team rows with margin (B4 over finished matches)."""
    return _finished_team_rows(games, "status", "game_date_et", season_type).withColumn(
        "margin", F.col("pts_for") - F.col("pts_against"))


def team_features_with_rest(games: DataFrame, ns: Sequence[int] = (5, 10)) -> DataFrame:
    """F6 [definition ours; the reference queries this view without defining it]:
    every finished team row with the mean margin of its previous n finished
    rows (current excluded), rest days since its previous match (gap - 1) and
    a back-to-back flag (rest = 0)."""
    rows = team_rows_final(games)
    order = ["game_date_et", "game_id"]
    aggs = {f"rolling_pd_{n}": ("avg", "margin", -n, -1) for n in ns}
    aggs["prev_date"] = ("max", "game_date_et", -1, -1)
    res = trailing(rows, "team_id", order, aggs)
    rd = F.datediff("game_date_et", "prev_date") - 1
    return res.select("game_id", "team_id", "opp_team_id", "is_home", "game_date_et", "margin",
                      *[f"rolling_pd_{n}" for n in ns], rd.alias("rest_days"),
                      F.when(rd == 0, 1).otherwise(0).alias("back_to_back"))


def strength_of_schedule(games: DataFrame, n: int = 10, f6: DataFrame | None = None) -> DataFrame:
    """F7 [definition ours]: mean over the team's previous n matches of the
    opponent's prior 10-match form at that match (opponent's F6 value joined on
    match and team).  Pass an existing F6 frame to reuse it."""
    if f6 is None:
        f6 = team_features_with_rest(games, ns=(10,))
    opp = f6.select("game_id", F.col("team_id").alias("opp_team_id"), F.col("rolling_pd_10").alias("opp_form"))
    rows = f6.select("game_id", "team_id", "opp_team_id", "game_date_et").join(opp, ["game_id", "opp_team_id"], "left")
    res = trailing(rows, "team_id", ["game_date_et", "game_id"], {f"rolling_sos_{n}": ("avg", "opp_form", -n, -1)})
    return res.select("game_id", "team_id", "game_date_et", f"rolling_sos_{n}")


def time_decay_weight(df: DataFrame, date: str, as_of, half_life_days: float = 365.0) -> DataFrame:
    """exp(-ln 2 * age / half_life), age in days before `as_of` (a Column or date text)."""
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    age = F.datediff(a, F.col(date))
    return df.withColumn("age_days", age).withColumn("weight", F.exp(-F.log(F.lit(2.0)) * age / half_life_days))
