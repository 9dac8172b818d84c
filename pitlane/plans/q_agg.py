"""Aggregation queries."""

from pyspark.sql import functions as F

from pitlane.functions.scalars import dow_sun0, norm_status
from pitlane.operators import aggregate as A
from pitlane.operators import pit
from pitlane.operators.joins import dual_side_join
from pitlane.operators.ranking import season_ranks
from pitlane.plans.q_pit import _F6_SQL, side
from pitlane.plans.registry import register

_HOUSE_NUM = ["lot_frontage", "total_bsmt_sf", "gr_liv_area", "overall_qual", "year_built", "yr_sold", "sale_price"]

_E1_BODY = f"""
met AS (SELECT game_id, any_value(game_date_et) AS day, {side("margin", True)} AS margin, {side("rest_days", True)} AS home_rest, {side("rest_days", False)} AS away_rest
  FROM f6 GROUP BY game_id HAVING count(*) = 2),
e1 AS (SELECT CAST(dayofweek(day) AS INTEGER) AS day_of_week, count(*) AS game_count, avg(CAST(margin > 0 AS DOUBLE)) AS home_win_pct,
    avg(home_rest) AS avg_home_rest, avg(away_rest) AS avg_away_rest,
    avg(CAST(coalesce(home_rest = 0, FALSE) AS DOUBLE)) AS home_b2b_pct, avg(CAST(coalesce(away_rest = 0, FALSE) AS DOUBLE)) AS away_b2b_pct,
    avg(abs(margin)) AS avg_margin, avg(home_pts + away_pts) AS avg_total_points
  FROM met JOIN (SELECT game_id, home_pts, away_pts FROM fx_games) USING (game_id) GROUP BY day_of_week)"""


def _e1(T):
    g = T.fx_games.where(norm_status(F.col("status")) == "final")
    f6 = pit.team_features_with_rest(T.fx_games).select("game_id", "team_id", "rest_days")
    m = dual_side_join(g.select("game_id", "game_date_et", "home_team_id", "away_team_id", "home_pts", "away_pts"),
                       f6, ["rest_days"])
    hw = F.when(F.col("home_pts") > F.col("away_pts"), 1.0).otherwise(0.0)
    return m.groupBy(dow_sun0(F.col("game_date_et")).alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("game_count"), F.avg(hw).alias("home_win_pct"),
        F.avg("home_rest_days").alias("avg_home_rest"), F.avg("away_rest_days").alias("avg_away_rest"),
        F.avg(F.when(F.col("home_rest_days") == 0, 1.0).otherwise(0.0)).alias("home_b2b_pct"),
        F.avg(F.when(F.col("away_rest_days") == 0, 1.0).otherwise(0.0)).alias("away_b2b_pct"),
        F.avg(F.abs(F.col("home_pts") - F.col("away_pts"))).alias("avg_margin"),
        F.avg(F.col("home_pts") + F.col("away_pts")).alias("avg_total_points"))


@register("profile_by_weekday", _F6_SQL + "," + _E1_BODY + " SELECT * FROM e1")
def q_e1(T):
    """Match profile per weekday (0 = Sunday, V9)."""
    return _e1(T)


_E2_METRICS = ["home_win_pct", "home_b2b_pct", "avg_total_points"]


@register("segment_vs_overall", _F6_SQL + "," + _E1_BODY + """,
o AS (SELECT AVG(home_win_pct) AS overall_home_win_pct, AVG(home_b2b_pct) AS overall_home_b2b_pct,
             AVG(avg_total_points) AS overall_avg_total_points FROM e1)
SELECT day_of_week, home_win_pct, home_b2b_pct, avg_total_points,
  overall_home_win_pct, overall_home_b2b_pct, overall_avg_total_points,
  home_win_pct - overall_home_win_pct AS delta_home_win_pct, home_b2b_pct - overall_home_b2b_pct AS delta_home_b2b_pct,
  avg_total_points - overall_avg_total_points AS delta_avg_total_points
FROM e1 CROSS JOIN o""")
def q_e2(T):
    """Each weekday against the unweighted mean of weekday means."""
    return A.segment_vs_overall(_e1(T), "day_of_week", _E2_METRICS)


@register("group_mean", """SELECT home_team_id, round_even(AVG(home_pts), 1) AS mean_home_pts
FROM fx_games WHERE lower(trim(status)) = 'final' GROUP BY home_team_id""")
def q_e3(T):
    g = T.fx_games.where(norm_status(F.col("status")) == "final")
    return A.group_mean(g, "home_team_id", "home_pts", out="mean_home_pts", digits=1)


@register("group_mean_std_count", """SELECT neighborhood, AVG(sale_price) AS mean, stddev_samp(sale_price) AS std,
  COUNT(sale_price) AS count FROM fx_houses GROUP BY neighborhood ORDER BY mean""")
def q_e4(T):
    return A.group_mean_std_count(T.fx_houses, "neighborhood", "sale_price")


_E5_FEATS = ["pred_home_prob", "pred_home_score", "pred_away_score", "total_error"]


@register("binary_split_means", """WITH p AS (
  SELECT *, abs((pred_home_score + pred_away_score) - (actual_home_score + actual_away_score)) AS total_error
  FROM fx_prediction_history WHERE actual_home_score IS NOT NULL),
f AS (SELECT *, total_error > 15 AS is_big_miss FROM p)
SELECT 'pred_home_prob' AS feature, AVG(pred_home_prob) FILTER (WHERE NOT is_big_miss) AS avg_hit, AVG(pred_home_prob) FILTER (WHERE is_big_miss) AS avg_miss FROM f
UNION ALL SELECT 'pred_home_score', AVG(pred_home_score) FILTER (WHERE NOT is_big_miss), AVG(pred_home_score) FILTER (WHERE is_big_miss) FROM f
UNION ALL SELECT 'pred_away_score', AVG(pred_away_score) FILTER (WHERE NOT is_big_miss), AVG(pred_away_score) FILTER (WHERE is_big_miss) FROM f
UNION ALL SELECT 'total_error', AVG(total_error) FILTER (WHERE NOT is_big_miss), AVG(total_error) FILTER (WHERE is_big_miss) FROM f""")
def q_e5(T):
    p = T.fx_prediction_history.where(F.col("actual_home_score").isNotNull())
    p = p.withColumn("total_error", F.abs((F.col("pred_home_score") + F.col("pred_away_score"))
                                          - (F.col("actual_home_score") + F.col("actual_away_score"))))
    return A.binary_split_means(p, F.col("total_error") > 15, _E5_FEATS)


_E6_FLAGS_SQL = """WITH tr AS (SELECT * FROM fx_houses WHERE sale_price IS NOT NULL),
m AS (SELECT AVG(ln(sale_price)) AS mu FROM tr),
r AS (SELECT tr.*, ln(sale_price) - m.mu AS residual,
  CAST(COALESCE(year_built >= 2000, FALSE) AS INTEGER) AS is_new,
  CAST(COALESCE(lot_frontage > 40, FALSE) AS INTEGER) AS big_lot,
  CAST(COALESCE(total_bsmt_sf > 0, FALSE) AS INTEGER) AS has_bsmt,
  CAST(COALESCE(overall_qual >= 9, FALSE) AS INTEGER) AS top_qual,
  1 AS always FROM tr CROSS JOIN m)"""
_E6_FLAGS = ["is_new", "big_lot", "has_bsmt", "top_qual", "always"]


def _e6_frame(T):
    tr = T.fx_houses.where(F.col("sale_price").isNotNull())
    mu = tr.agg(F.avg(F.log("sale_price")).alias("_mu"))
    c = F.col
    r = tr.crossJoin(F.broadcast(mu)).withColumn("residual", F.log("sale_price") - c("_mu")).drop("_mu")
    flags = {"is_new": c("year_built") >= 2000, "big_lot": c("lot_frontage") > 40, "has_bsmt": c("total_bsmt_sf") > 0,
             "top_qual": c("overall_qual") >= 9, "always": F.lit(True)}
    return r.select("residual", *[F.coalesce(e, F.lit(False)).cast("int").alias(k) for k, e in flags.items()])


@register("segment_residuals", _E6_FLAGS_SQL + " " + " UNION ALL ".join(
    f"""SELECT '{f}' AS hook, COUNT(*) FILTER (WHERE {f} = 1) AS count_if_1, AVG(residual) FILTER (WHERE {f} = 1) AS mean_resid_if_1,
  AVG(residual) FILTER (WHERE {f} = 0) AS mean_resid_if_0 FROM r HAVING COUNT(*) FILTER (WHERE {f} = 1) > 0 AND COUNT(*) FILTER (WHERE {f} = 0) > 0"""
    for f in _E6_FLAGS))
def q_e6(T):
    return A.segment_residuals(_e6_frame(T), _E6_FLAGS)


_RANKS_SQL = """r AS (SELECT *, CAST(substr(season, 1, 4) AS INTEGER) + 1 AS finish_year FROM fx_team_records
   WHERE rel_ortg IS NOT NULL AND rel_drtg IS NOT NULL),
k AS (SELECT finish_year, team, rel_ortg, rel_drtg, playoffs,
  CAST(rank() OVER (PARTITION BY finish_year ORDER BY rel_ortg DESC) AS INTEGER) AS off_rank,
  CAST(rank() OVER (PARTITION BY finish_year ORDER BY rel_drtg ASC) AS INTEGER) AS def_rank FROM r WHERE finish_year >= 1994),
sr AS (SELECT finish_year, team, rel_ortg, rel_drtg, off_rank, def_rank,
  10 * ((31 - off_rank) + (31 - def_rank)) / 60.0 AS contender_score,
  CASE WHEN off_rank <= 5 AND def_rank <= 5 THEN 1 ELSE 0 END AS elite,
  CASE WHEN contains(playoffs, 'Won Finals') THEN 'Finals Winner' WHEN contains(playoffs, 'Lost Finals') THEN 'Finals Loser'
       WHEN contains(playoffs, 'Conf. Finals') THEN 'Conference Finals' WHEN contains(playoffs, 'Conf. Semis') THEN 'Playoffs Round 2'
       WHEN contains(playoffs, '1st Rnd.') THEN 'Playoffs Round 1' ELSE 'Missed Playoffs' END AS outcome,
  CASE WHEN contains(playoffs, 'Won Finals') OR contains(playoffs, 'Lost Finals') OR contains(playoffs, 'Conf. Finals') THEN 1 ELSE 0 END AS is_contender
FROM k)"""


def _ranks(T):
    return season_ranks(T.fx_team_records, min_finish_year=1994)


@register("value_counts", f"WITH {_RANKS_SQL} SELECT outcome, COUNT(*) AS count FROM sr GROUP BY outcome")
def q_e8(T):
    return A.value_counts(_ranks(T), "outcome")


@register("rows_per_date", """SELECT game_date, COUNT(*) AS n_rows FROM fx_team_log
WHERE wl IS NOT NULL AND pts IS NOT NULL GROUP BY game_date""")
def q_e9(T):
    from pitlane.operators.reshape import completed_only
    return A.rows_per_date(completed_only(T.fx_team_log), "game_date")


def _mode_sql(col):
    return f"""(SELECT {col} FROM (SELECT {col}, COUNT(*) AS n FROM fx_houses x WHERE x.neighborhood = h.neighborhood AND {col} IS NOT NULL
     GROUP BY {col} ORDER BY n DESC, {col} ASC LIMIT 1)) AS mode_{col}"""


@register("group_median_mode", f"""SELECT h.neighborhood, median(lot_frontage) AS median_lot_frontage, median(gr_liv_area) AS median_gr_liv_area,
  {_mode_sql('bsmt_qual')}, {_mode_sql('sale_type')}
FROM fx_houses h GROUP BY h.neighborhood""")
def q_e10(T):
    return A.group_median_mode(T.fx_houses, "neighborhood", ["lot_frontage", "gr_liv_area"], ["bsmt_qual", "sale_type"])


_DESC_COLS = ["lot_frontage", "total_bsmt_sf", "gr_liv_area", "overall_qual", "sale_price"]


@register("describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT({c}) AS count, AVG({c}) AS mean, stddev_samp({c}) AS std, CAST(MIN({c}) AS DOUBLE) AS min,
  quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM fx_houses"""
    for c in _DESC_COLS))
def q_e11(T):
    return A.describe(T.fx_houses, _DESC_COLS)


_ALL_HOUSE = ["id", "neighborhood", "lot_frontage", "bsmt_qual", "sale_type", "total_bsmt_sf", "gr_liv_area",
              "overall_qual", "year_built", "yr_sold", "sale_price"]


@register("null_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null, COUNT(*) FILTER (WHERE {c} IS NULL) <= 0 AS ok FROM fx_houses"""
    for c in _ALL_HOUSE))
def q_e12(T):
    return A.null_profile(T.fx_houses, _ALL_HOUSE)


@register("skew_profile", "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", (SELECT AVG(POWER({c} - m.mu, 3)) / POWER(AVG(POWER({c} - m.mu, 2)), 1.5)
        FROM fx_houses, (SELECT AVG({c}) AS mu FROM fx_houses) m) AS skew"""
    for c in _HOUSE_NUM) + ") WHERE skew > 0.75")
def q_e13(T):
    return A.skew_profile(T.fx_houses, _HOUSE_NUM, limit=0.75)
