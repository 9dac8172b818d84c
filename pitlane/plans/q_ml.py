"""Model-job queries.  Linear and logistic
models are checked against SQL that solves them anew over the plain rows
(sql_models); trees have rows-only checks and tests on held-out rows."""

from hashlib import md5

from pyspark.sql import functions as F

from pitlane.functions.scalars import fold_of, norm_status
from pitlane.operators import gram
from pitlane.operators import ml as M
from pitlane.operators import pit
from pitlane.operators.evaluate import split_scores
from pitlane.operators.features import robust_scale, stratified_split
from pitlane.operators.joins import or_key_join
from pitlane.operators.ranking import top_k
from pitlane.operators.logit import logit_inference, newton_logit
from pitlane.plans import sql_models as S
from pitlane.plans.q_features import _AS_OF_SQL as AS_OF_SQL, _J1_SQL, _TE_SQL, _te, day_matrix, match_matrix, q_j2, scoring_day
from pitlane.plans.q_agg import _RANKS_SQL, _ranks
from pitlane.plans.registry import REGISTRY, register
from pitlane.session import materialize

c = F.col
BASELINE_SQL, DAY_SQL = REGISTRY["baseline_matrix"][1], REGISTRY["day_matrix"][1]
# feature names as the reference has them (fixed values)
WIN_FEATURES = ["rolling_pd_5_diff", "rolling_pd_10_diff", "rest_days_diff", "home_back_to_back", "home_advantage",
                "sos_diff", "pace_metric", "home_glass_advantage"]
HOUSE_FEATURES = ["lot_frontage", "total_bsmt_sf", "gr_liv_area", "overall_qual", "year_built", "yr_sold", "te"]


def _split_matrix(T):
    m = match_matrix(T)
    return materialize(stratified_split(m, "home_win", "game_id", test_share=0.2))


# the match matrix with its split, features as a list
_WIN_X = "[" + ", ".join(WIN_FEATURES) + "]::DOUBLE[]"
_SPLIT_SQL = f"""mm AS ({_J1_SQL}),
sp AS (SELECT *, {_WIN_X} AS x, CASE WHEN row_number() OVER (PARTITION BY home_win ORDER BY CAST(('0x' || substr(md5(game_id), 1, 8)) AS BIGINT), game_id)
    <= count(*) OVER (PARTITION BY home_win) - ceil(count(*) OVER (PARTITION BY home_win) * 0.2) THEN 'train' ELSE 'test' END AS split FROM mm)"""


@register("fit_win", f"""WITH RECURSIVE {_SPLIT_SQL}, w_src AS (SELECT 0 AS model, x, home_win::DOUBLE AS y FROM sp WHERE split = 'train'),
{S.penalised_logit("w", len(WIN_FEATURES))}
SELECT game_id, home_win, 1 / (1 + exp(-{S.value("x")})) AS p, CAST({S.value("x")} > 0 AS INTEGER) AS prediction FROM sp, w_fit WHERE split = 'test'""")
def q_k1(T):
    """K1: balanced logistic regression with a penalised intercept on the match matrix; test-split probabilities."""
    m = _split_matrix(T)
    fit = newton_logit(m.where(c("split") == "train"), WIN_FEATURES, "home_win", balanced=True, C=1.0)
    return m.where(c("split") == "test").select("game_id", "home_win", fit.probability().alias("p"), (fit.linear() > 0).cast("int").alias("prediction"))


@register("fit_ridge", f"""WITH RECURSIVE {_SPLIT_SQL}, w_src AS (SELECT 0 AS model, x, margin::DOUBLE AS y FROM sp WHERE split = 'train'), w_cand AS (SELECT 0 AS cand, 1.0 AS alpha),
{S.ridge("w", len(WIN_FEATURES))}
SELECT game_id, margin, {S.value("x")} AS prediction FROM sp, w_fit WHERE split = 'test'""")
def q_k2(T):
    """K2: ridge (alpha 1) for the margin; test-split predictions."""
    m = _split_matrix(T)
    models = gram.fit_linear(m.where(c("split") == "train"), WIN_FEATURES, ["margin"], [gram.ridge(1.0)])
    test = m.where(c("split") == "test").select("game_id", "margin", *WIN_FEATURES)
    return gram.score_linear(test, WIN_FEATURES, models, ["prediction"]).select("game_id", "margin", "prediction")


@register("fit_gbt")
def q_k3(T):
    """K3: boosted trees for the total; test-split predictions."""
    m = _split_matrix(T)
    model = M.fit_gbt(m.where(c("split") == "train"), WIN_FEATURES, "total", max_iter=20)
    return M.score_batch(model, m.where(c("split") == "test"), ["game_id", "total"])


def _house_frame(T):
    h = _te(T)
    h = robust_scale(h, ["gr_liv_area"], h.where(c("origin") == "train"))
    return materialize(h)


_HOUSE_X = "[lot_frontage, d.total_bsmt_sf, d.gr_liv_area, overall_qual, year_built, yr_sold, te.te]::DOUBLE[]"
_HOUSE_SQL = f"""{_TE_SQL}, hs AS (SELECT te.id, te.origin, te.fold, d.y, {_HOUSE_X} AS x FROM te JOIN d USING (id))"""
_P = len(HOUSE_FEATURES)


@register("fit_lasso_enet", f"""WITH RECURSIVE {_HOUSE_SQL}, l_src AS (SELECT 0 AS model, x, y FROM hs WHERE origin = 'train'),
l_cand AS (SELECT * FROM (VALUES (0, 0.0005, 0.0), (1, 0.00045, 0.00005)) v(cand, l1, l2)),
{S.elastic_net("l", _P)}
SELECT id, max({S.value("x")}) FILTER (WHERE cand = 0) AS lasso, max({S.value("x")}) FILTER (WHERE cand = 1) AS enet FROM hs, l_fit WHERE origin = 'test' GROUP BY id""")
def q_k4(T):
    """K4: lasso and elastic net (0.9) on the log price by coordinate descent on one Gram aggregate; predictions for the test slice."""
    h = _house_frame(T)
    models = gram.fit_linear(h.where(c("origin") == "train"), HOUSE_FEATURES, ["y"], [gram.elastic_net(0.0005, 1.0), gram.elastic_net(0.0005, 0.9)])
    return gram.score_linear(h.where(c("origin") == "test"), HOUSE_FEATURES, models, ["lasso", "enet"]).select("id", "lasso", "enet")


_Z5 = "b[1] * rel_ortg + b[2] * rel_drtg + b[3]"
# Newton steps for three coefficients with the inverse of the 3 x 3 information written out
_LOGIT_SQL = f"""{_RANKS_SQL},
lr AS (SELECT rel_ortg::DOUBLE AS rel_ortg, rel_drtg::DOUBLE AS rel_drtg, is_contender AS y FROM sr),
nt AS (SELECT 0 AS it, [0.0, 0.0, 0.0]::DOUBLE[] AS b
  UNION ALL SELECT it + 1, [b[1] + (c11 * g1 + c12 * g2 + c13 * g3) / det, b[2] + (c12 * g1 + c22 * g2 + c23 * g3) / det, b[3] + (c13 * g1 + c23 * g2 + c33 * g3) / det]
  FROM (SELECT *, h22 * h33 - h23 * h23 AS c11, h13 * h23 - h12 * h33 AS c12, h12 * h23 - h13 * h22 AS c13, h11 * h33 - h13 * h13 AS c22, h12 * h13 - h11 * h23 AS c23, h11 * h22 - h12 * h12 AS c33,
          h11 * (h22 * h33 - h23 * h23) - h12 * (h12 * h33 - h23 * h13) + h13 * (h12 * h23 - h22 * h13) AS det
    FROM (SELECT any_value(it) AS it, any_value(b) AS b, sum((y - p) * rel_ortg) AS g1, sum((y - p) * rel_drtg) AS g2, sum(y - p) AS g3,
            sum(p * (1 - p) * rel_ortg * rel_ortg) AS h11, sum(p * (1 - p) * rel_ortg * rel_drtg) AS h12, sum(p * (1 - p) * rel_ortg) AS h13,
            sum(p * (1 - p) * rel_drtg * rel_drtg) AS h22, sum(p * (1 - p) * rel_drtg) AS h23, sum(p * (1 - p)) AS h33
      FROM (SELECT *, 1 / (1 + exp(-({_Z5}))) AS p FROM nt, lr WHERE it < 25) HAVING count(*) > 0))),
fin AS (SELECT *, h22 * h33 - h23 * h23 AS c11, h11 * h33 - h13 * h13 AS c22, h11 * h22 - h12 * h12 AS c33, h11 * (h22 * h33 - h23 * h23) - h12 * (h12 * h33 - h23 * h13) + h13 * (h12 * h23 - h22 * h13) AS det
  FROM (SELECT any_value(b) AS b, sum(CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) AS ll, avg(y) AS share, count(*) AS n,
      sum(p * (1 - p) * rel_ortg * rel_ortg) AS h11, sum(p * (1 - p) * rel_ortg * rel_drtg) AS h12, sum(p * (1 - p) * rel_ortg) AS h13,
      sum(p * (1 - p) * rel_drtg * rel_drtg) AS h22, sum(p * (1 - p) * rel_drtg) AS h23, sum(p * (1 - p)) AS h33
    FROM (SELECT *, 1 / (1 + exp(-({_Z5}))) AS p FROM nt, lr WHERE it = 25))),
terms AS (SELECT 'rel_ortg' AS term, b[1] AS coef, sqrt(c11 / det) AS std_err FROM fin UNION ALL SELECT 'rel_drtg', b[2], sqrt(c22 / det) FROM fin UNION ALL SELECT 'intercept', b[3], sqrt(c33 / det) FROM fin)"""


@register("fit_logit_inference", f"""WITH RECURSIVE {_LOGIT_SQL}
SELECT term, coef, std_err, {S.erfc("(abs(coef / std_err) / sqrt(2))")} AS p_value, 1 - ll / (n * (share * ln(share) + (1 - share) * ln(1 - share))) AS pseudo_r2, FALSE AS separated FROM terms, fin""")
def q_k5(T):
    """K5: contender ~ offence + defence rating: coefficients, std errors, p-values, McFadden R^2."""
    return logit_inference(materialize(_ranks(T).select("rel_ortg", "rel_drtg", "is_contender")), ["rel_ortg", "rel_drtg"], "is_contender")


@register("fit_random_forest")
def q_k6(T):
    """K6: balanced random forest (100 trees, depth 5) on the rank study; in-sample probabilities."""
    r = _ranks(T)
    model = M.fit_random_forest(r, ["off_rank", "def_rank", "contender_score"], "is_contender", balanced=True)
    return M.score_batch(model, r, ["finish_year", "team", "is_contender"])


@register("fit_random_forest_plain")
def q_k6_plain(T):
    """K6: unweighted random forest classifier on the rank study; fitted on the seasons of even years, scored on the others."""
    r = materialize(_ranks(T))
    even = c("finish_year") % 2 == 0
    model = M.fit_random_forest(r.where(even), ["off_rank", "def_rank", "contender_score"], "is_contender")
    return M.score_batch(model, r.where(~even), ["finish_year", "team", "is_contender"])


@register("fit_random_forest_price")
def q_k6_price(T):
    """K6: random forest regressor of 500 trees for the log price; fitted on four folds, scored on the fifth."""
    h = _house_frame(T).where(c("origin") == "train")
    model = M.fit_random_forest(h.where(c("fold") < 4), HOUSE_FEATURES, "y", classifier=False, trees=500)
    return M.score_batch(model, h.where(c("fold") == 4), ["id", "y"])


_OOF_SQL = f"""{_HOUSE_SQL}, f_cand AS (SELECT 0 AS cand, 1.0 AS alpha),
f_src AS (SELECT f AS model, x, y FROM hs, range(5) v(f) WHERE origin = 'train' AND fold <> f),
{S.ridge("f", _P)},
f_oof AS (SELECT id, origin, avg({S.value("x")}) AS oof FROM hs, f_fit WHERE origin = 'test' OR fold = model GROUP BY id, origin)"""


@register("oof_predict", f"WITH RECURSIVE {_OOF_SQL} SELECT id, origin, oof FROM f_oof")
def q_k7(T):
    """K7: out-of-fold ridge predictions (train) and fold-model means (test) from one aggregate of fold sums."""
    return gram.oof_linear(_house_frame(T), "id", HOUSE_FEATURES, "y", gram.ridge(1.0))


_SIZE_FEATURES = ["lot_frontage", "total_bsmt_sf", "gr_liv_area"]


@register("stack_ridge", f"""WITH RECURSIVE {_OOF_SQL}, s_cand AS (SELECT 0 AS cand, 100.0 AS alpha),
s_src AS (SELECT model, x[1:3] AS x, y FROM f_src), {S.ridge("s", 3)},
s_oof AS (SELECT id, avg({S.value("x[1:3]")}) AS oof FROM hs, s_fit WHERE origin = 'test' OR fold = model GROUP BY id),
two AS (SELECT hs.id, hs.origin, hs.y, [f_oof.oof, s_oof.oof] AS x FROM hs JOIN f_oof USING (id) JOIN s_oof USING (id)),
t_cand AS (SELECT 0 AS cand, 1.0 AS alpha), t_src AS (SELECT 0 AS model, x, y FROM two WHERE origin = 'train'), {S.ridge("t", 2)}
SELECT id, origin, {S.value("x")} AS stacked FROM two, t_fit""")
def q_k8(T):
    """K8: ridge stacked on the out-of-fold predictions of a ridge on all features and one on the areas."""
    h = _house_frame(T)
    oofs = {"every": gram.oof_linear(h, "id", HOUSE_FEATURES, "y", gram.ridge(1.0)), "areas": gram.oof_linear(h, "id", _SIZE_FEATURES, "y", gram.ridge(100.0))}
    return gram.stack_linear(oofs, h, "id", "y", gram.ridge(1.0))


def _drawn(n: int) -> list[float]:
    """Penalties from 0.01 to 10,000, drawn by the hash of their number."""
    return [10 ** (6 * int(md5(str(i).encode()).hexdigest()[:8], 16) / 2**32 - 2) for i in range(n)]


_ROUNDS = ((1, 16), (2, 5), (4, 0))
_N_DRAWN = 48


@register("tune", f"""WITH RECURSIVE {_HOUSE_SQL}, k_cand AS (SELECT i AS cand, pow(10, 6 * CAST(('0x' || substr(md5(CAST(i AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 - 2) AS alpha FROM range({_N_DRAWN}) v(i)),
rd AS (SELECT * FROM (VALUES {", ".join(f"({r}, {n})" for r, (n, _) in enumerate(_ROUNDS))}) v(rnd, slices)),
hp AS (SELECT *, CAST(('0x' || substr(md5('s' || id), 1, 8)) AS BIGINT) % 4 AS slice FROM hs WHERE origin = 'train'),
k_src AS (SELECT rnd * 5 + f AS model, x, y FROM hp, range(5) v(f), rd WHERE fold <> f AND slice < slices),
{S.ridge("k", _P)},
err AS (SELECT rnd, cand, avg(e) AS rmse FROM (SELECT rnd, cand, fold, sqrt(avg(pow(y - {S.value("x")}, 2))) AS e FROM hp JOIN rd ON slice < slices JOIN k_fit ON model = rnd * 5 + fold GROUP BY rnd, cand, fold) GROUP BY rnd, cand),
r1 AS (SELECT cand FROM err WHERE rnd = 0 ORDER BY rmse, cand LIMIT {_ROUNDS[0][1]}),
r2 AS (SELECT cand FROM err JOIN r1 USING (cand) WHERE rnd = 1 ORDER BY rmse, cand LIMIT {_ROUNDS[1][1]})
SELECT rnd AS round, cand AS candidate, alpha, rmse FROM err JOIN k_cand USING (cand) WHERE rnd = 0 OR (rnd = 1 AND cand IN (FROM r1)) OR (rnd = 2 AND cand IN (FROM r2))""")
def q_k10(T):
    """Successive halving of 48 ridge penalties on the frozen folds, a quarter, half and all of the rows, in one pass."""
    h = _house_frame(T).where(c("origin") == "train").withColumn("slice", fold_of(F.concat(F.lit("s"), c("id").cast("string")), 4))
    alphas = _drawn(_N_DRAWN)
    out = gram.halving(h, HOUSE_FEATURES, "y", [gram.ridge(a) for a in alphas], rounds=_ROUNDS)
    return out.select("round", "candidate", F.element_at(F.array(*[F.lit(a) for a in alphas]), c("candidate") + 1).alias("alpha"), "rmse")


_DAY_FEATURES = ["rolling_pd_5_diff", "rolling_pd_10_diff", "rest_days_diff", "home_back_to_back", "home_advantage"]


_DAY_X = "[" + ", ".join(_DAY_FEATURES) + "]::DOUBLE[]"


@register("score_batch", f"""WITH RECURSIVE jb AS ({BASELINE_SQL}), jd AS ({DAY_SQL}),
w_src AS (SELECT 0 AS model, {_DAY_X} AS x, home_win::DOUBLE AS y FROM jb WHERE game_date_et < {AS_OF_SQL}),
{S.penalised_logit("w", len(_DAY_FEATURES))}
SELECT game_id, game_date_et, state, 1 / (1 + exp(-{S.value(_DAY_X)})) AS p, CAST({S.value(_DAY_X)} > 0 AS INTEGER) AS prediction FROM jd, w_fit""")
def q_k11(T):
    """Win probabilities for every match of the latest day with a scheduled
    match, whatever its state; the model is fitted on matches before that day."""
    day = scoring_day(T)
    train = materialize(q_j2(T).join(F.broadcast(day), c("game_date_et") < c("as_of")).drop("as_of"))
    fit = newton_logit(train, _DAY_FEATURES, "home_win", balanced=True, C=1.0)
    return day_matrix(T, day).select("game_id", "game_date_et", "state", fit.probability().alias("p"), (fit.linear() > 0).cast("int").alias("prediction"))


_PLAYER_FEATS = ["pts_l5", "reb_l5", "ast_l5", "min_l5", "pts_l10", "reb_l10", "ast_l10", "pts_l20"]


@register("player_projection")
def q_l8(T):
    """The daily props job: one projection of points, rebounds and assists per
    player whose team plays on the latest scheduled day that has such players, from L5/L10/L20
    features known before it, to one decimal, with the gap to the player's
    average and the rank of the gap (the published document takes ranks 1 to 5)."""
    from pitlane.functions.scalars import parse_duration
    logs = T.fx_player_logs.withColumn("minutes", parse_duration(c("min_raw")))
    order = ["game_date", "game_id", "line_no"]
    frames = {"pts_l5": ("pts", 5), "reb_l5": ("reb", 5), "ast_l5": ("ast", 5), "min_l5": ("minutes", 5),
              "pts_l10": ("pts", 10), "reb_l10": ("reb", 10), "ast_l10": ("ast", 10), "pts_l20": ("pts", 20)}
    sides = T.fx_games.where(norm_status(c("status")) == "scheduled").select(
        "game_date_et", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    day = sides.join(T.fx_players, "team_id", "left_semi").agg(F.max("game_date_et").alias("as_of"))
    logs = logs.join(F.broadcast(day), c("game_date") < c("as_of")).drop("as_of")
    hist = materialize(pit.trailing(logs, "player_id", order, {o: ("avg", col, -k, -1) for o, (col, k) in frames.items()})
                       .where(c("pts_l20").isNotNull()))
    now = pit.current_last_n(logs, "player_id", order, frames)
    games = T.fx_games.where(norm_status(c("status")) == "scheduled").join(F.broadcast(day))
    active = or_key_join(T.fx_players, games, "team_id", ["home_team_id", "away_team_id"],
                         ["player_id", "team_id", "game_id", "game_date_et"], where=c("game_date_et") == c("as_of"))
    one = active.groupBy("player_id").agg(F.min(F.struct("game_id", "game_date_et")).alias("g")).select("player_id", "g.*")
    feats = one.join(now, "player_id")
    out = feats
    targets = ["pts", "reb", "ast"]
    models = gram.fit_linear(hist, _PLAYER_FEATS, targets, [gram.ridge(1.0)])
    out = gram.score_linear(out, _PLAYER_FEATS, models, [f"proj_{t}" for t in targets], by="label")
    gap = F.round(c("proj_pts"), 1) - F.round(c("pts_l20"), 1)
    out = materialize(out.select("player_id", "game_id", "game_date_et", *[F.round(f"proj_{t}", 1).alias(f"proj_{t}") for t in ("pts", "reb", "ast")],
                                 F.round("pts_l20", 1).alias("avg_pts"), F.round(gap, 1).alias("gap")))
    top = top_k(out.select("player_id", F.abs("gap").alias("_size")), 5, [c("_size").desc(), c("player_id")])
    top = top.agg(F.array_sort(F.collect_list(F.struct((-c("_size")).alias("s"), "player_id"))).alias("_top"))  # five ids
    top = top.select(F.transform("_top", lambda t: t["player_id"]).alias("_top"))
    place = F.array_position(F.col("_top"), c("player_id"))
    return out.crossJoin(F.broadcast(top)).withColumn("top_rank", F.when(place > 0, place)).drop("_top")


@register("backtest", f"""WITH RECURSIVE mm AS ({_J1_SQL}), gm AS (SELECT mm.*, game_date_et, {_WIN_X} AS x FROM mm JOIN fx_games USING (game_id)),
dates AS (SELECT DISTINCT game_date_et AS on_day FROM gm ORDER BY 1 DESC LIMIT 7), b_cand AS (SELECT 0 AS cand, 1.0 AS alpha),
b_src AS (SELECT CAST(on_day AS VARCHAR) || side AS model, x, CAST(CASE WHEN side = 'm' THEN margin ELSE total END AS DOUBLE) AS y FROM gm JOIN dates ON game_date_et < on_day, (VALUES ('m'), ('t')) v(side)),
{S.ridge("b", len(WIN_FEATURES))},
pr AS (SELECT gm.*, {S.value("x", "m.")} AS pm, {S.value("x", "t.")} AS pt FROM gm JOIN dates ON game_date_et = on_day
  LEFT JOIN b_fit m ON m.model = CAST(on_day AS VARCHAR) || 'm' LEFT JOIN b_fit t ON t.model = CAST(on_day AS VARCHAR) || 't')
SELECT game_date_et, count(*) AS n_games, avg(CAST(((pt + pm) / 2 > (pt - pm) / 2) = (home_win = 1) AS INTEGER)) AS accuracy, avg(abs(pm - margin)) AS mae_margin, avg(abs(pt - total)) AS mae_total FROM pr GROUP BY game_date_et""")
def q_m3(T):
    """M3: replay the last 7 match dates, each with margin and total models of all earlier
    games (running Gram sums over the dates); scores split (L1), one aggregate per replayed date."""
    m = materialize(match_matrix(T).join(T.fx_games.select("game_id", "game_date_et"), "game_id"))
    dates = m.select("game_date_et").distinct().orderBy(c("game_date_et").desc()).limit(7)
    j = gram.walk_forward(m, WIN_FEATURES, ["margin", "total"], "game_date_et", dates, gram.ridge(1.0))
    h, a = split_scores(c("pred_total"), c("pred_margin"))
    j = j.withColumn("pred_home", h).withColumn("pred_away", a)
    return j.groupBy("game_date_et").agg(
        F.count(F.lit(1)).alias("n_games"),
        F.avg(((c("pred_home") > c("pred_away")).cast("int") == c("home_win")).cast("double")).alias("accuracy"),
        F.avg(F.abs(c("pred_margin") - c("margin"))).alias("mae_margin"),
        F.avg(F.abs(c("pred_total") - c("total"))).alias("mae_total"))
