"""Scoring, grading and evaluation queries."""

from pyspark.sql import functions as F

from pitlane.operators import evaluate as V
from pitlane.operators import pit
from pitlane.operators.aggregate import bridge_average
from pitlane.operators.joins import dual_side_join
from pitlane.operators.quality import quality_checks
from pitlane.operators.upsert import insert_if_absent
from pitlane.plans.q_features import _TE_SQL, _te
from pitlane.plans.q_pit import _TEAM_ROWS_SQL
from pitlane.plans.registry import register

c = F.col
_PH = "fx_prediction_history"


def _raw(T):
    p = T.fx_prediction_history
    return p.select("game_id", (c("pred_home_score") + c("pred_away_score")).alias("pred_total"),
                    (c("pred_home_score") - c("pred_away_score")).alias("pred_margin"), "pred_home_prob")


@register("split_scores", f"""SELECT game_id, ((pred_home_score + pred_away_score) + (pred_home_score - pred_away_score)) / 2 AS pred_home,
  ((pred_home_score + pred_away_score) - (pred_home_score - pred_away_score)) / 2 AS pred_away FROM {_PH}""")
def q_l1(T):
    r = _raw(T)
    h, a = V.split_scores(c("pred_total"), c("pred_margin"))
    return r.select("game_id", h.alias("pred_home"), a.alias("pred_away"))


_CREW = """(SELECT AVG({m}) FROM fx_ref_profiles WHERE official_id IN (SELECT official_id FROM fx_game_officials o WHERE o.game_id = p.game_id))"""


@register("adjust_by_bridge", f"""WITH b AS (SELECT p.game_id, p.pred_home_score + p.pred_away_score AS t, p.pred_home_score - p.pred_away_score AS m,
  {_CREW.format(m='pf_bias')} AS pf, {_CREW.format(m='home_bias_delta')} AS hb FROM {_PH} p)
SELECT game_id, t + CASE WHEN pf IS NULL THEN 0.0 ELSE pf END * 0.85 AS adj_total,
  m + CASE WHEN pf IS NULL THEN 0.0 ELSE hb END * 10.0 AS adj_margin FROM b""")
def q_l2(T):
    r = _raw(T)
    crew = bridge_average(T.fx_games.select("game_id"), T.fx_game_officials, T.fx_ref_profiles)
    j = r.join(crew, "game_id", "left")
    t, m = V.adjust_by_bridge(c("pred_total"), c("pred_margin"), c("pf_bias"), c("home_bias"))
    return j.select("game_id", t.alias("adj_total"), m.alias("adj_margin"))


@register("composite_sigma", f"""WITH {_TEAM_ROWS_SQL},
vol AS (SELECT game_id, team_id, COALESCE(stddev_samp(pts_for) OVER (PARTITION BY team_id ORDER BY game_date_et, game_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 11.0) AS vol FROM team_rows)
SELECT g.game_id, hv.vol * ((h.pace_est + a.pace_est) / 2.0 / 100.0) * (a.drtg / 115.0) AS sigma_home,
  av.vol * ((h.pace_est + a.pace_est) / 2.0 / 100.0) * (h.drtg / 115.0) AS sigma_away
FROM fx_games g
JOIN fx_team_game_stats h ON h.game_id = g.game_id AND h.team_id = g.home_team_id
JOIN fx_team_game_stats a ON a.game_id = g.game_id AND a.team_id = g.away_team_id
JOIN vol hv ON hv.game_id = g.game_id AND hv.team_id = g.home_team_id
JOIN vol av ON av.game_id = g.game_id AND av.team_id = g.away_team_id""")
def q_l3(T):
    rows = pit.team_rows_final(T.fx_games).select("game_id", "team_id", "game_date_et", "pts_for")
    vol = pit.cumulative_prior(rows, "team_id", ["game_date_et", "game_id"], "pts_for", "vol").select("game_id", "team_id", "vol")
    per_team = T.fx_team_game_stats.select("game_id", "team_id", "pace_est", "drtg").join(vol, ["game_id", "team_id"])
    m = dual_side_join(T.fx_games.select("game_id", "home_team_id", "away_team_id"), per_team, ["pace_est", "drtg", "vol"])
    return m.select("game_id",
                    V.composite_sigma(c("home_vol"), c("home_pace_est"), c("away_pace_est"), c("away_drtg")).alias("sigma_home"),
                    V.composite_sigma(c("away_vol"), c("home_pace_est"), c("away_pace_est"), c("home_drtg")).alias("sigma_away"))


@register("risk_flags", f"""SELECT game_id, list_filter([CASE WHEN pred_home_prob > 0.45 AND pred_home_prob < 0.55 THEN 'COIN FLIP' END,
  CASE WHEN abs(pred_home_score - pred_away_score) < 3.0 THEN 'CLOSE MARGIN' END], lambda x: x IS NOT NULL) AS risks FROM {_PH}""")
def q_l4(T):
    p = T.fx_prediction_history
    return p.select("game_id", V.risk_flags(c("pred_home_prob"), c("pred_home_score") - c("pred_away_score")).alias("risks"))


_SD = (V.SIGMA_TOTAL ** 2 + V.SIGMA_MARGIN ** 2) ** 0.5 / 2.0


@register("interval_normal", f"""SELECT game_id, pred_home_score - {V.Z95} * {_SD!r} AS home_lo, pred_home_score + {V.Z95} * {_SD!r} AS home_hi,
  pred_away_score - {V.Z95} * {_SD!r} AS away_lo, pred_away_score + {V.Z95} * {_SD!r} AS away_hi FROM {_PH}""")
def q_l5(T):
    r = _raw(T)
    iv = V.interval_normal(c("pred_total"), c("pred_margin"))
    return r.select("game_id", *[e.alias(k) for k, e in iv.items()])


@register("interval_empirical", f"""WITH g AS (SELECT pred_home_score, actual_home_score, actual_home_score - pred_home_score AS res FROM {_PH} WHERE actual_home_score IS NOT NULL),
q AS (SELECT quantile_cont(res, 0.025) AS lo, quantile_cont(res, 0.975) AS hi FROM g)
SELECT q.lo AS resid_lo, q.hi AS resid_hi,
  AVG(CASE WHEN actual_home_score >= pred_home_score + q.lo AND actual_home_score <= pred_home_score + q.hi THEN 1.0 ELSE 0.0 END) AS coverage,
  AVG(q.hi - q.lo) AS avg_width, COUNT(*) AS n FROM g CROSS JOIN q GROUP BY q.lo, q.hi""")
def q_l6(T):
    g = T.fx_prediction_history.where(c("actual_home_score").isNotNull())
    return V.interval_empirical(g, "pred_home_score", "actual_home_score")


@register("back_transform", f"WITH {_TE_SQL} SELECT id, exp(te) - 1 AS price_pred FROM te")
def q_l7(T):
    return _te(T).select("id", V.back_transform(c("te")).alias("price_pred"))


_M1_SQL = f"""g AS (SELECT game_id, home_pts, away_pts FROM fx_games WHERE lower(trim(status)) = 'final'),
graded AS (SELECT p.game_id, p.prediction_date_et, p.model_version, p.pred_home_prob, p.pred_home_score, p.pred_away_score,
  CASE WHEN g.game_id IS NOT NULL AND p.actual_home_score IS NULL THEN g.home_pts ELSE p.actual_home_score END AS actual_home_score,
  CASE WHEN g.game_id IS NOT NULL AND p.actual_home_score IS NULL THEN g.away_pts ELSE p.actual_away_score END AS actual_away_score,
  CASE WHEN g.game_id IS NOT NULL AND p.actual_home_score IS NULL THEN
    CASE WHEN p.pred_home_prob > 0.5 AND g.home_pts > g.away_pts THEN TRUE WHEN p.pred_home_prob < 0.5 AND g.home_pts < g.away_pts THEN TRUE ELSE FALSE END
  END AS correct_winner,
  CASE WHEN g.game_id IS NOT NULL AND p.actual_home_score IS NULL THEN
    CAST((p.pred_home_score - p.pred_away_score) - (g.home_pts - g.away_pts) AS DOUBLE) END AS error_margin
FROM {_PH} p LEFT JOIN g ON p.game_id = g.game_id)"""


def _graded(T):
    return V.grade_predictions(T.fx_prediction_history, T.fx_games)


@register("grade_predictions", f"WITH {_M1_SQL} SELECT * FROM graded")
def q_m1(T):
    return _graded(T)


@register("evaluation_report", f"""WITH {_M1_SQL}
SELECT COUNT(*) AS n_games, AVG(CASE WHEN (pred_home_score > pred_away_score) = (actual_home_score > actual_away_score) THEN 1.0 ELSE 0.0 END) * 100 AS accuracy_pct,
  AVG(abs(pred_home_score - actual_home_score)) AS mae_home,
  AVG(abs((pred_home_score + pred_away_score) - (actual_home_score + actual_away_score))) AS mae_total
FROM graded WHERE actual_home_score IS NOT NULL AND prediction_date_et >= DATE '1998-08-02' - INTERVAL 365 DAY""")
def q_m2(T):
    return V.evaluation_report(_graded(T), "1998-08-02", 365)


@register("miss_analysis", f"""WITH {_TEAM_ROWS_SQL},
f6 AS (SELECT game_id, team_id, CAST(game_date_et - LAG(game_date_et) OVER (PARTITION BY team_id ORDER BY game_date_et, game_id) - 1 AS INTEGER) AS rest_days FROM team_rows),
pace AS (SELECT game_id, team_id, avg(pace_est) OVER ten AS pace, avg(ortg) OVER ten AS ortg FROM fx_team_game_stats JOIN (SELECT game_id, game_date_et FROM fx_games) USING (game_id)
  WINDOW ten AS (PARTITION BY team_id ORDER BY game_date_et, game_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
side_rows AS (SELECT game_id, team_id, rest_days, pace, ortg FROM f6 FULL JOIN pace USING (game_id, team_id)),
sides AS (SELECT g.game_id, max(rest_days) FILTER (WHERE team_id = home_team_id) AS home_rest, max(rest_days) FILTER (WHERE team_id = away_team_id) AS away_rest,
    max(pace) FILTER (WHERE team_id = home_team_id) AS rolling_pace_10, max(ortg) FILTER (WHERE team_id = home_team_id) AS rolling_ortg_10
  FROM (SELECT game_id, home_team_id, away_team_id FROM fx_games) g LEFT JOIN side_rows USING (game_id) GROUP BY g.game_id),
missed AS (SELECT game_id, abs((pred_home_score + pred_away_score) - (actual_home_score + actual_away_score)) AS total_error FROM {_PH} WHERE actual_home_score IS NOT NULL)
SELECT game_id, total_error, total_error > 15 AS is_big_miss, home_rest - away_rest AS rest_diff, home_rest, rolling_pace_10, rolling_ortg_10 FROM missed JOIN sides USING (game_id)""")
def q_m4(T):
    """M4: graded predictions with match context and the big-miss flag (> 15)."""
    games = T.fx_games
    f6 = pit.team_features_with_rest(games).select("game_id", "team_id", "rest_days")
    adv_rows = T.fx_team_game_stats.join(games.select("game_id", "game_date_et"), "game_id")
    adv = pit.rolling_rows(adv_rows.select("game_id", "team_id", "game_date_et", "pace_est", "ortg"), "team_id",
                           ["game_date_et", "game_id"], {"rolling_pace_10": "pace_est", "rolling_ortg_10": "ortg"}, 10)
    per_team = f6.join(adv.select("game_id", "team_id", "rolling_pace_10", "rolling_ortg_10"), ["game_id", "team_id"], "full_outer")
    p = T.fx_prediction_history.where(c("actual_home_score").isNotNull()).join(
        games.select("game_id", "home_team_id", "away_team_id"), "game_id")
    m = dual_side_join(p, per_team, ["rest_days", "rolling_pace_10", "rolling_ortg_10"], how="left")
    err = F.abs((c("pred_home_score") + c("pred_away_score")) - (c("actual_home_score") + c("actual_away_score")))
    return m.select("game_id", err.alias("total_error"), (err > 15).alias("is_big_miss"),
                    (c("home_rest_days") - c("away_rest_days")).alias("rest_diff"), c("home_rest_days").alias("home_rest"),
                    c("home_rolling_pace_10").alias("rolling_pace_10"), c("home_rolling_ortg_10").alias("rolling_ortg_10"))


def _labelled(T):
    g = _graded(T).where(c("actual_home_score").isNotNull())
    return g.select("game_id", "pred_home_prob", "pred_home_score", "actual_home_score",
                    (c("actual_home_score") > c("actual_away_score")).cast("int").alias("home_win"))


_LAB_SQL = f"""{_M1_SQL}, lab AS (SELECT game_id, pred_home_prob, pred_home_score, actual_home_score,
  CAST(actual_home_score > actual_away_score AS INTEGER) AS home_win FROM graded WHERE actual_home_score IS NOT NULL)"""


def _cm_sql(thr, group=""):
    return f"""SELECT {group} count(*) FILTER (WHERE pred_home_prob > {thr} AND home_win = 1) AS tp,
  count(*) FILTER (WHERE pred_home_prob > {thr} AND home_win <> 1) AS fp, count(*) FILTER (WHERE NOT pred_home_prob > {thr} AND home_win <> 1) AS tn,
  count(*) FILTER (WHERE NOT pred_home_prob > {thr} AND home_win = 1) AS fn"""


_CM_RATIOS = """, CASE WHEN tp + fp + tn + fn > 0 THEN (tp + tn) / (tp + fp + tn + fn) END AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall"""


@register("class_metrics", f"""WITH {_LAB_SQL}, cm AS ({_cm_sql(0.5)} FROM lab) SELECT *{_CM_RATIOS} FROM cm""")
def q_m5(T):
    return V.class_metrics(_labelled(T), "home_win", "pred_home_prob", 0.5)


_THRS = [0.3, 0.4, 0.5, 0.6, 0.7]


@register("threshold_sweep", f"""WITH {_LAB_SQL}, t AS (SELECT lab.*, CAST(thr AS DOUBLE) AS threshold FROM lab CROSS JOIN (SELECT unnest({_THRS}) AS thr)),
cm AS ({_cm_sql('threshold', 'threshold,')} FROM t GROUP BY threshold) SELECT *{_CM_RATIOS} FROM cm""")
def q_m9(T):
    return V.threshold_sweep(_labelled(T), "home_win", "pred_home_prob", _THRS)


@register("prob_metrics", f"""WITH {_LAB_SQL},
r AS (SELECT *, rank() OVER (ORDER BY pred_home_prob) AS lo_rank, count(*) OVER (PARTITION BY pred_home_prob) AS ties FROM lab),
m AS (SELECT *, lo_rank + (ties - 1) / 2.0 AS mid_rank FROM r),
s AS (SELECT COUNT(*) AS n, SUM(home_win) AS npos, COUNT(*) - SUM(home_win) AS nneg, SUM(CASE WHEN home_win = 1 THEN mid_rank END) AS rank_sum,
  AVG(-(home_win * ln(least(greatest(pred_home_prob, 1e-15), 1 - 1e-15)) + (1 - home_win) * ln(1 - least(greatest(pred_home_prob, 1e-15), 1 - 1e-15)))) AS log_loss,
  AVG(power(pred_home_prob - home_win, 2)) AS brier FROM m)
SELECT n, log_loss, brier, (rank_sum - npos * (npos + 1) / 2.0) / (npos * nneg) AS auc FROM s""")
def q_m6(T):
    return V.prob_metrics(_labelled(T), "home_win", "pred_home_prob")


@register("regression_metrics", f"""WITH {_LAB_SQL}
SELECT COUNT(*) AS n, AVG(abs(pred_home_score - actual_home_score)) AS mae, sqrt(AVG(power(pred_home_score - actual_home_score, 2))) AS rmse,
  1 - SUM(power(pred_home_score - actual_home_score, 2)) / (var_pop(actual_home_score) * COUNT(*)) AS r2,
  sqrt(AVG(power(ln(1 + pred_home_score) - ln(1 + actual_home_score), 2))) AS rmsle FROM lab""")
def q_m7(T):
    return V.regression_metrics(_labelled(T), "pred_home_score", "actual_home_score")


@register("residual_frame", f"""WITH {_TE_SQL}
SELECT h.*, exp(te.te) - 1 AS price_pred, h.sale_price - (exp(te.te) - 1) AS residual, abs(h.sale_price - (exp(te.te) - 1)) AS abs_residual
FROM te JOIN fx_houses h ON te.id = h.id WHERE te.origin = 'train'""")
def q_m8(T):
    t = _te(T).where(c("origin") == "train").select("id", V.back_transform(c("te")).alias("price_pred"))
    return V.residual_frame(t, T.fx_houses, "id", "price_pred", "sale_price")


_NEWPRED_SQL = f"""src AS (
  SELECT game_id, prediction_date_et, 'v1' AS model_version, pred_home_prob + 0.01 AS pred_home_prob, pred_home_score, pred_away_score,
    CAST(NULL AS INTEGER) AS actual_home_score, CAST(NULL AS INTEGER) AS actual_away_score FROM {_PH} WHERE prediction_date_et >= DATE '1998-01-01'
  UNION ALL
  SELECT game_id, prediction_date_et, 'v2', 1 - pred_home_prob, pred_away_score, pred_home_score, NULL, NULL FROM {_PH})"""


@register("prediction_log", f"""WITH {_NEWPRED_SQL}
SELECT * FROM {_PH} UNION ALL
SELECT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM {_PH} t WHERE t.game_id = s.game_id AND t.model_version = s.model_version)""")
def q_m10(T):
    """Append predictions with a model version; the first write of a (match, version) wins."""
    p = T.fx_prediction_history
    null_i = F.lit(None).cast("int")
    v1 = p.where(c("prediction_date_et") >= F.lit("1998-01-01").cast("date")).select(
        "game_id", "prediction_date_et", "model_version", (c("pred_home_prob") + 0.01).alias("pred_home_prob"),
        "pred_home_score", "pred_away_score", null_i.alias("actual_home_score"), null_i.alias("actual_away_score"))
    v2 = p.select("game_id", "prediction_date_et", F.lit("v2").alias("model_version"), (1 - c("pred_home_prob")).alias("pred_home_prob"),
                  c("pred_away_score").alias("pred_home_score"), c("pred_home_score").alias("pred_away_score"),
                  null_i.alias("actual_home_score"), null_i.alias("actual_away_score"))
    return insert_if_absent(p, v1.unionByName(v2), ["game_id", "model_version"])


@register("blend_search", f"""WITH {_TEAM_ROWS_SQL},
f4 AS (SELECT game_id, team_id, AVG(pts_for) OVER (PARTITION BY team_id ORDER BY game_date_et, game_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS form FROM team_rows),
d AS (SELECT p.pred_home_score AS a, f.form AS b, p.actual_home_score AS y FROM {_PH} p JOIN fx_games g ON p.game_id = g.game_id
      JOIN f4 f ON f.game_id = g.game_id AND f.team_id = g.home_team_id WHERE p.actual_home_score IS NOT NULL AND f.form IS NOT NULL),
r AS (SELECT CAST(w AS DOUBLE) AS weight, sqrt(AVG(power(w * a + (1 - w) * b - y, 2))) AS rmse FROM d CROSS JOIN (SELECT unnest([0.4, 0.5, 0.6]) AS w) GROUP BY w)
SELECT weight, rmse, weight = (SELECT weight FROM r ORDER BY rmse, weight LIMIT 1) AS is_best FROM r""")
def q_k9(T):
    rows = pit.team_rows_final(T.fx_games).select("game_id", "team_id", "game_date_et", "pts_for")
    f4 = pit.rolling_rows(rows, "team_id", ["game_date_et", "game_id"], {"form": "pts_for"}, 5, include_current=False)
    g = T.fx_games.select("game_id", c("home_team_id").alias("team_id"))
    d = (T.fx_prediction_history.where(c("actual_home_score").isNotNull()).join(g, "game_id")
         .join(f4.select("game_id", "team_id", "form"), ["game_id", "team_id"]).where(c("form").isNotNull()))
    return V.blend_search(d.select(c("pred_home_score").alias("a"), c("form").alias("b"), c("actual_home_score").alias("y")),
                          "a", "b", "y")


@register("quality_checks", """WITH s AS (SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE game_id IS NULL) AS null_keys,
    COUNT(*) FILTER (WHERE game_date_et >= DATE '1998-08-02' - INTERVAL 7 DAY) AS recent_rows FROM fx_games),
d AS (SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_keys FROM (SELECT game_id, COUNT(*) AS n FROM fx_games GROUP BY game_id HAVING COUNT(*) > 1)),
p AS (SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE game_id IS NULL OR player_id IS NULL) AS null_keys FROM fx_player_logs),
pd AS (SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_keys FROM (SELECT game_id, player_id, COUNT(*) AS n FROM fx_player_logs GROUP BY 1, 2 HAVING COUNT(*) > 1))
SELECT 'games' AS "table", 'row_count' AS "check", rows AS value, rows >= 0 AS ok FROM s
UNION ALL SELECT 'games', 'non_empty', rows, rows > 0 FROM s
UNION ALL SELECT 'games', 'null_keys', null_keys, null_keys = 0 FROM s
UNION ALL SELECT 'games', 'duplicate_keys', duplicate_keys, duplicate_keys = 0 FROM d
UNION ALL SELECT 'games', 'recent_rows', recent_rows, recent_rows > 0 FROM s
UNION ALL SELECT 'games', 'column_count', 8, TRUE
UNION ALL SELECT 'player_logs', 'row_count', rows, rows >= 0 FROM p
UNION ALL SELECT 'player_logs', 'non_empty', rows, rows > 0 FROM p
UNION ALL SELECT 'player_logs', 'null_keys', null_keys, null_keys = 0 FROM p
UNION ALL SELECT 'player_logs', 'duplicate_keys', duplicate_keys, duplicate_keys = 0 FROM pd
UNION ALL SELECT 'player_logs', 'column_count', 8, TRUE
UNION ALL SELECT 'player_logs', 'column_parity', 0, TRUE""")
def q_n1(T):
    """Integrity checks on the match table and the player log, long form."""
    g = quality_checks(T.fx_games, "games", ["game_id"], date="game_date_et", as_of="1998-08-02")
    p = quality_checks(T.fx_player_logs, "player_logs", ["game_id", "player_id"],
                       expected_columns=T.fx_player_logs.columns)
    return g.unionByName(p)
