"""Feature-matrix and preprocessing queries."""

from pyspark.sql import functions as F

from pitlane.functions.scalars import dow_sun0, fold_of, norm_status
from pitlane.operators import features as X
from pitlane.operators import pit
from pitlane.operators.joins import dual_side_join
from pitlane.operators.reshape import stack_frames
from pitlane.plans.q_pit import _F6_SQL, _PLAYED, _form_cte, _rest_cte, side
from pitlane.plans.registry import register

c = F.col

# ---------------------------------------------------------------------------
# Houses: shared frame (train + test stacked, log1p target, frozen folds)
# ---------------------------------------------------------------------------

_HOUSES_SQL = """d AS (SELECT *, CASE WHEN sale_price IS NULL THEN 'test' ELSE 'train' END AS origin, ln(1 + sale_price) AS y,
  CAST(CAST(('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold FROM fx_houses),
tr AS (SELECT * FROM d WHERE origin = 'train')"""


def _houses(T):
    h = T.fx_houses
    s = stack_frames(h.where(c("sale_price").isNotNull()), h.where(c("sale_price").isNull()), origin="origin")
    return s.withColumn("y", F.log1p("sale_price")).withColumn("fold", fold_of(c("id")))


def _train(df):
    return df.where(c("origin") == "train")


@register("fill_constant", """SELECT id, COALESCE(bsmt_qual, 'None') AS bsmt_qual, COALESCE(total_bsmt_sf, 0.0) AS total_bsmt_sf FROM fx_houses""")
def q_j7(T):
    return X.fill_constant(T.fx_houses, {"bsmt_qual": "None", "total_bsmt_sf": 0.0}).select("id", "bsmt_qual", "total_bsmt_sf")


def _mode_all(col):
    return f"(SELECT {col} FROM fx_houses WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)"


@register("fill_mode", f"""SELECT id, COALESCE(sale_type, {_mode_all('sale_type')}) AS sale_type,
  COALESCE(bsmt_qual, {_mode_all('bsmt_qual')}) AS bsmt_qual FROM fx_houses""")
def q_j8(T):
    return X.fill_mode(T.fx_houses, ["sale_type", "bsmt_qual"]).select("id", "sale_type", "bsmt_qual")


@register("fill_group_median", """WITH f AS (SELECT h.id, COALESCE(h.lot_frontage, (SELECT median(x.lot_frontage) FROM fx_houses x WHERE x.neighborhood = h.neighborhood)) AS lot_frontage FROM fx_houses h)
SELECT id, COALESCE(lot_frontage, (SELECT median(lot_frontage) FROM f)) AS lot_frontage FROM f""")
def q_j9(T):
    return X.fill_group_median(T.fx_houses, "neighborhood", "lot_frontage").select("id", "lot_frontage")


@register("fill_mean", f"""WITH {_HOUSES_SQL}
SELECT id, origin, COALESCE(lot_frontage, (SELECT AVG(lot_frontage) FROM tr)) AS lot_frontage FROM d""")
def q_j10(T):
    h = _houses(T)
    return X.fill_mean(h, ["lot_frontage"], _train(h)).select("id", "origin", "lot_frontage")


@register("ordinal_encode", """SELECT id,
  CASE COALESCE(bsmt_qual, 'None') WHEN 'None' THEN 0 WHEN 'Po' THEN 1 WHEN 'Fa' THEN 2 WHEN 'TA' THEN 3 WHEN 'Gd' THEN 4 WHEN 'Ex' THEN 5 END AS bsmt_qual,
  COALESCE(bsmt_qual, 'None') NOT IN ('None', 'Po', 'Fa', 'TA', 'Gd', 'Ex') AS bsmt_qual_unmapped FROM fx_houses""")
def q_j11(T):
    h = X.fill_constant(T.fx_houses, {"bsmt_qual": "None"})
    return X.ordinal_encode(h, ["bsmt_qual"]).select("id", "bsmt_qual", "bsmt_qual_unmapped")


_ENG_SQL = """e AS (SELECT id, lot_frontage, total_bsmt_sf, gr_liv_area, overall_qual, year_built, yr_sold,
  COALESCE(total_bsmt_sf, 0) + gr_liv_area AS total_sf, yr_sold - year_built AS age,
  gr_liv_area + 0.5 * COALESCE(total_bsmt_sf, 0) AS weighted_area FROM fx_houses)"""


def _engineered(T):
    h = T.fx_houses
    return h.select("id", "lot_frontage", "total_bsmt_sf", "gr_liv_area", "overall_qual", "year_built", "yr_sold",
                    (F.coalesce(c("total_bsmt_sf"), F.lit(0.0)) + c("gr_liv_area")).alias("total_sf"),
                    (c("yr_sold") - c("year_built")).alias("age"),
                    (c("gr_liv_area") + 0.5 * F.coalesce(c("total_bsmt_sf"), F.lit(0.0))).alias("weighted_area"))


@register("derived_sums", f"WITH {_ENG_SQL} SELECT id, total_sf, age, weighted_area FROM e")
def q_j12(T):
    return _engineered(T).select("id", "total_sf", "age", "weighted_area")


@register("interactions", f"""WITH {_ENG_SQL} SELECT id, overall_qual * gr_liv_area AS qual_x_area, overall_qual * total_sf AS qual_x_total,
  gr_liv_area * total_bsmt_sf AS area_x_bsmt FROM e""")
def q_j13(T):
    e = _engineered(T)
    return e.select("id", (c("overall_qual") * c("gr_liv_area")).alias("qual_x_area"),
                    (c("overall_qual") * c("total_sf")).alias("qual_x_total"),
                    (c("gr_liv_area") * c("total_bsmt_sf")).alias("area_x_bsmt"))


@register("boolean_flags", """SELECT id, CAST(COALESCE(total_bsmt_sf, 0) > 0 AS INTEGER) AS has_bsmt,
  CAST(COALESCE(yr_sold = year_built, FALSE) AS INTEGER) AS sold_new,
  CAST(COALESCE(neighborhood IN ('Brand#13', 'Brand#24', 'Brand#55'), FALSE) AS INTEGER) AS premium FROM fx_houses""")
def q_j14(T):
    h = T.fx_houses
    out = X.rule_flags(h, {"has_bsmt": F.coalesce(c("total_bsmt_sf"), F.lit(0.0)) > 0,
                           "sold_new": c("yr_sold") == c("year_built"),
                           "premium": c("neighborhood").isin("Brand#13", "Brand#24", "Brand#55")})
    return out.select("id", "has_bsmt", "sold_new", "premium")


_SKEW_COLS = ["lot_frontage", "total_bsmt_sf", "gr_liv_area", "total_sf", "area_x_bsmt"]


def _skew_sql_col(col):
    sk = f"(SELECT AVG(POWER(s.{col} - m.mu, 3)) / POWER(AVG(POWER(s.{col} - m.mu, 2)), 1.5) FROM s, (SELECT AVG({col}) AS mu FROM s) m)"
    return f"CASE WHEN {sk} > 0.75 THEN (POWER(1 + {col}, 0.15) - 1) / 0.15 ELSE {col} END AS {col}"


@register("skew_correct", f"""WITH {_ENG_SQL}, s AS (SELECT id, lot_frontage, total_bsmt_sf, gr_liv_area, total_sf,
  gr_liv_area * total_bsmt_sf AS area_x_bsmt FROM e)
SELECT id, """ + ", ".join(_skew_sql_col(x) for x in _SKEW_COLS) + " FROM s")
def q_j15(T):
    e = _engineered(T).withColumn("area_x_bsmt", c("gr_liv_area") * c("total_bsmt_sf"))
    return X.skew_correct(e.select("id", *_SKEW_COLS), _SKEW_COLS, limit=0.75)


@register("one_hot", """SELECT id, COALESCE(bsmt_qual, 'None') AS bsmt_qual, """ + ", ".join(
    f"CAST(COALESCE(bsmt_qual, 'None') = '{v}' AS INTEGER) AS bsmt_qual_{v}" for v in ["Ex", "Fa", "Gd", "None", "Po", "TA"])
    + " FROM fx_houses")
def q_j16(T):
    h = X.fill_constant(T.fx_houses, {"bsmt_qual": "None"}).select("id", "bsmt_qual")
    return X.one_hot(h, "bsmt_qual")


_TE_SQL = f"""{_HOUSES_SQL},
g AS (SELECT median(y) AS gm FROM tr),
te AS (SELECT d.id, d.origin, d.neighborhood, d.fold, d.total_bsmt_sf, d.gr_liv_area,
  COALESCE(CASE WHEN d.origin = 'train'
                THEN (SELECT median(t.y) FROM tr t WHERE t.neighborhood = d.neighborhood AND t.fold <> d.fold)
                ELSE (SELECT median(t.y) FROM tr t WHERE t.neighborhood = d.neighborhood) END, (SELECT gm FROM g)) AS te
FROM d)"""


def _te(T):
    return X.target_encode_oof(_houses(T), "neighborhood", "y")


@register("target_encode_oof", f"WITH {_TE_SQL} SELECT id, origin, neighborhood, fold, te FROM te")
def q_j17(T):
    return _te(T).select("id", "origin", "neighborhood", "fold", "te")


_Z_SQL = f"""{_TE_SQL},
st AS (SELECT AVG(te) AS mu, CASE WHEN stddev_pop(te) > 0 THEN stddev_pop(te) ELSE 1.0 END AS sd FROM te WHERE origin = 'train'),
z AS (SELECT te.*, (te - st.mu) / st.sd AS te_z FROM te CROSS JOIN st)"""


def _z(T):
    t = _te(T)
    return X.standardise(t, ["te"], _train(t))


@register("standardise", f"WITH {_Z_SQL} SELECT id, origin, te, te_z FROM z")
def q_j18(T):
    return _z(T).select("id", "origin", "te", "te_z")


@register("robust_scale", f"""WITH {_HOUSES_SQL},
q AS (SELECT quantile_cont(gr_liv_area, 0.25) AS q1, quantile_cont(gr_liv_area, 0.5) AS q2, quantile_cont(gr_liv_area, 0.75) AS q3 FROM tr)
SELECT id, origin, (gr_liv_area - q2) / CASE WHEN q3 - q1 <> 0 THEN q3 - q1 ELSE 1.0 END AS gr_liv_area_rs FROM d CROSS JOIN q""")
def q_j19(T):
    h = _houses(T)
    return X.robust_scale(h, ["gr_liv_area"], _train(h)).select("id", "origin", "gr_liv_area_rs")


@register("encode_interaction", f"""WITH {_Z_SQL}
SELECT id, origin, (COALESCE(total_bsmt_sf, 0) + gr_liv_area) * te_z AS total_sf_x_te_z FROM z""")
def q_j20(T):
    z = _z(T)
    return z.select("id", "origin", ((F.coalesce(c("total_bsmt_sf"), F.lit(0.0)) + c("gr_liv_area")) * c("te_z")).alias("total_sf_x_te_z"))


@register("fold_assign", f"WITH {_HOUSES_SQL} SELECT id, fold FROM d")
def q_j21(T):
    return X.fold_assign(T.fx_houses.select("id"), "id")


_FINAL_LABEL_SQL = """fl AS (SELECT game_id, CASE WHEN home_pts > away_pts THEN 1 ELSE 0 END AS home_win FROM fx_games
  WHERE lower(trim(status)) = 'final' AND home_pts IS NOT NULL AND away_pts IS NOT NULL)"""


def _final_labels(T):
    g = T.fx_games.where((norm_status(c("status")) == "final") & c("home_pts").isNotNull() & c("away_pts").isNotNull())
    return g.select("game_id", F.when(c("home_pts") > c("away_pts"), 1).otherwise(0).alias("home_win"))


@register("stratified_split", f"""WITH {_FINAL_LABEL_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY home_win ORDER BY CAST(('0x' || substr(md5(game_id), 1, 8)) AS BIGINT), game_id) AS rn,
             count(*) OVER (PARTITION BY home_win) AS n FROM fl)
SELECT game_id, home_win, CASE WHEN rn <= n - ceil(n * 0.2) THEN 'train' ELSE 'test' END AS split FROM r""")
def q_j22(T):
    return X.stratified_split(_final_labels(T), "home_win", "game_id", test_share=0.2)


@register("class_weights", f"""WITH {_FINAL_LABEL_SQL}, c AS (SELECT home_win, count(*) AS n_class FROM fl GROUP BY home_win)
SELECT home_win, n_class, (SELECT sum(n_class) FROM c) / ((SELECT count(*) FROM c) * n_class) AS class_weight FROM c""")
def q_j23(T):
    return X.class_weights(_final_labels(T), "home_win")


@register("cast_categorical", "SELECT id, CAST(overall_qual AS VARCHAR) AS overall_qual, CAST(yr_sold AS VARCHAR) AS yr_sold FROM fx_houses")
def q_j24(T):
    return X.cast_categorical(T.fx_houses.select("id", "overall_qual", "yr_sold"), ["overall_qual", "yr_sold"])


@register("rule_flags", """SELECT id,
  CAST(COALESCE(lot_frontage > 80, FALSE) AS INTEGER) AS wide_lot,
  CAST(COALESCE(total_bsmt_sf IS NULL OR total_bsmt_sf = 0, FALSE) AS INTEGER) AS no_basement,
  CAST(COALESCE(gr_liv_area BETWEEN 1 AND 900, FALSE) AS INTEGER) AS compact,
  CAST(COALESCE(yr_sold - year_built <= 3, FALSE) AS INTEGER) AS sold_young,
  CAST(COALESCE(overall_qual >= 9 AND NOT neighborhood LIKE '%1', FALSE) AS INTEGER) AS fine_elsewhere
FROM fx_houses""")
def q_j25(T):
    out = X.rule_flags(T.fx_houses, {
        "wide_lot": c("lot_frontage") > 80,
        "no_basement": c("total_bsmt_sf").isNull() | (c("total_bsmt_sf") == 0),
        "compact": c("gr_liv_area").between(1, 900),
        "sold_young": c("yr_sold") - c("year_built") <= 3,
        "fine_elsewhere": (c("overall_qual") >= 9) & ~c("neighborhood").like("%1")})
    return out.select("id", "wide_lot", "no_basement", "compact", "sold_young", "fine_elsewhere")


# ---------------------------------------------------------------------------
# Match matrices J1-J3
# ---------------------------------------------------------------------------

# One row per (match, team) with all its features, folded to one row per match.
_J1_SQL = _F6_SQL + f""",
facing AS (SELECT game_id, opp_team_id AS team_id, rolling_pd_10 AS opp_form FROM f6),
tight AS (SELECT t.game_id, t.team_id, avg(opp_form) OVER (PARTITION BY t.team_id ORDER BY t.game_date_et, t.game_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS sos
  FROM f6 t LEFT JOIN facing USING (game_id, team_id)),
style AS (SELECT game_id, team_id, avg(pace_est) OVER back AS pace, avg(oreb_pct) OVER back AS oreb, avg(dreb_pct) OVER back AS dreb
  FROM fx_team_game_stats JOIN (SELECT game_id, game_date_et FROM fx_games) USING (game_id)
  WINDOW back AS (PARTITION BY team_id ORDER BY game_date_et, game_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)),
folded AS (SELECT game_id, any_value(game_date_et) AS day, {side("margin", True)} AS margin,
    {side("rolling_pd_5", True)} - {side("rolling_pd_5", False)} AS rolling_pd_5_diff, {side("rolling_pd_10", True)} - {side("rolling_pd_10", False)} AS rolling_pd_10_diff,
    {side("rest_days", True)} AS home_rest, {side("rest_days", False)} AS away_rest,
    {side("sos", True, "0")} - {side("sos", False, "0")} AS sos_diff, ({side("pace", True, "98.0")} + {side("pace", False, "98.0")}) / 2 AS pace_metric,
    {side("oreb", True, "0")} - {side("dreb", False, "0")} AS home_glass_advantage
  FROM f6 LEFT JOIN tight USING (game_id, team_id) LEFT JOIN style USING (game_id, team_id) GROUP BY game_id HAVING count(*) = 2)
SELECT game_id, CAST(dayofweek(day) AS INTEGER) AS day_of_week, rolling_pd_5_diff, rolling_pd_10_diff, home_rest - away_rest AS rest_days_diff,
  CAST(coalesce(home_rest = 0, FALSE) AS INTEGER) AS home_back_to_back, 1 AS home_advantage, sos_diff, pace_metric, home_glass_advantage,
  CAST(margin > 0 AS INTEGER) AS home_win, margin, home_pts + away_pts AS total
FROM folded JOIN fx_games USING (game_id)"""


def match_matrix(T, pace_default=98.0, glass_defaults=(0.0, 0.0)):
    """Home - away differentials, flags, weekday, pace, glass advantage and
    targets.  All per-team features are joined into one per-(match, team)
    table first, so the match table is attached to it with one dual join."""
    games = T.fx_games
    f6 = pit.team_features_with_rest(games)
    sos = pit.strength_of_schedule(games, f6=f6).select("game_id", "team_id", "rolling_sos_10")
    adv_rows = T.fx_team_game_stats.join(games.select("game_id", "game_date_et"), "game_id")
    adv = pit.rolling_rows(adv_rows.select("game_id", "team_id", "game_date_et", "pace_est", "oreb_pct", "dreb_pct"),
                           "team_id", ["game_date_et", "game_id"],
                           {"rolling_pace_10": "pace_est", "rolling_oreb_10": "oreb_pct", "rolling_dreb_10": "dreb_pct"},
                           10, include_current=False)
    per_team = (f6.select("game_id", "team_id", "rolling_pd_5", "rolling_pd_10", "rest_days")
                .join(sos, ["game_id", "team_id"], "left")
                .join(adv.select("game_id", "team_id", "rolling_pace_10", "rolling_oreb_10", "rolling_dreb_10"),
                      ["game_id", "team_id"], "left"))
    fin = games.where(norm_status(c("status")) == "final").select(
        "game_id", "game_date_et", "home_team_id", "away_team_id", "home_pts", "away_pts")
    m = dual_side_join(fin, per_team, ["rolling_pd_5", "rolling_pd_10", "rest_days", "rolling_sos_10",
                                       "rolling_pace_10", "rolling_oreb_10", "rolling_dreb_10"])
    z = F.lit(0.0)
    return m.select(
        "game_id", dow_sun0(c("game_date_et")).alias("day_of_week"),
        (c("home_rolling_pd_5") - c("away_rolling_pd_5")).alias("rolling_pd_5_diff"),
        (c("home_rolling_pd_10") - c("away_rolling_pd_10")).alias("rolling_pd_10_diff"),
        (c("home_rest_days") - c("away_rest_days")).alias("rest_days_diff"),
        F.when(c("home_rest_days") == 0, 1).otherwise(0).alias("home_back_to_back"),
        F.lit(1).alias("home_advantage"),
        (F.coalesce(c("home_rolling_sos_10"), z) - F.coalesce(c("away_rolling_sos_10"), z)).alias("sos_diff"),
        ((F.coalesce(c("home_rolling_pace_10"), F.lit(pace_default))
          + F.coalesce(c("away_rolling_pace_10"), F.lit(pace_default))) / 2.0).alias("pace_metric"),
        (F.coalesce(c("home_rolling_oreb_10"), F.lit(glass_defaults[0]))
         - F.coalesce(c("away_rolling_dreb_10"), F.lit(glass_defaults[1]))).alias("home_glass_advantage"),
        F.when(c("home_pts") > c("away_pts"), 1).otherwise(0).alias("home_win"),
        (c("home_pts") - c("away_pts")).alias("margin"), (c("home_pts") + c("away_pts")).alias("total"))


@register("match_matrix", _J1_SQL)
def q_j1(T):
    return match_matrix(T)


_DOCS_SQL = f"""{_PLAYED}, {_form_cte("TRUE")},
docs AS (SELECT game_id, team_id, is_home, scheduled_date_et AS as_of_date, map_from_entries(list_value(
    {", ".join(f"struct_pack(k := 'rolling_pd_{n}', v := rolling_pd_{n}::DOUBLE), struct_pack(k := 'rolling_pd_{n}_n', v := rolling_pd_{n}_n::DOUBLE), struct_pack(k := 'rolling_pd_{n}_missing', v := (rolling_pd_{n}_n < {n})::INTEGER::DOUBLE)" for n in (5, 10))})) AS feature_json
  FROM form)"""


def feature_store_rows(T):
    """(match, team, as_of, document{value, count, missing flag}) for every
    match -- the pre-match last-5/10 form as a MAP document."""
    f = pit.last_n_form(T.fx_games, ns=(5, 10), requests="all")
    kv = []
    for n in (5, 10):
        kv += [F.lit(f"rolling_pd_{n}"), c(f"rolling_pd_{n}").cast("double"),
               F.lit(f"rolling_pd_{n}_n"), c(f"rolling_pd_{n}_n").cast("double"),
               F.lit(f"rolling_pd_{n}_missing"), (c(f"rolling_pd_{n}_n") < n).cast("double")]
    return f.select("game_id", "team_id", c("scheduled_date_et").alias("as_of_date"), F.create_map(*kv).alias("feature_json"))


@register("feature_store_row", f"""WITH {_DOCS_SQL}
SELECT game_id, team_id, as_of_date, unnest(map_keys(feature_json)) AS feature_key, unnest(map_values(feature_json)) AS feature_value FROM docs""")
def q_j3(T):
    d = feature_store_rows(T)
    return d.select("game_id", "team_id", "as_of_date", F.explode("feature_json").alias("feature_key", "feature_value"))


@register("baseline_matrix", f"""WITH {_DOCS_SQL}, {_rest_cte("TRUE")},
rows AS (SELECT d.game_id, d.is_home, as_of_date, feature_json['rolling_pd_5'] AS pd5, feature_json['rolling_pd_10'] AS pd10, rest_days
  FROM docs d LEFT JOIN rest r USING (game_id, team_id)),
folded AS (SELECT game_id, any_value(as_of_date) AS game_date_et, {side("pd5", True)} - {side("pd5", False)} AS rolling_pd_5_diff,
    {side("pd10", True)} - {side("pd10", False)} AS rolling_pd_10_diff, {side("rest_days", True)} - {side("rest_days", False)} AS rest_days_diff,
    CAST(coalesce({side("rest_days", True)} = 0, FALSE) AS INTEGER) AS home_back_to_back
  FROM rows GROUP BY game_id)
SELECT f.game_id, game_date_et, CAST(diff > 0 AS INTEGER) AS home_win, rolling_pd_5_diff, rolling_pd_10_diff, rest_days_diff, home_back_to_back, 1 AS home_advantage
FROM folded f JOIN played p ON p.game_id = f.game_id AND p.is_home""")
def q_j2(T):
    """Training rows from stored feature documents (typed map lookups) + rest days."""
    docs = feature_store_rows(T)
    rest = pit.rest_days(T.fx_games, season_type="regular", requests="all").select("game_id", "team_id", "rest_days")
    ftg = docs.join(rest, ["game_id", "team_id"], "left").select(
        "game_id", "team_id", c("feature_json")["rolling_pd_5"].alias("pd5"),
        c("feature_json")["rolling_pd_10"].alias("pd10"), "rest_days")
    fin = _final_labels(T).join(T.fx_games.select("game_id", "game_date_et", "home_team_id", "away_team_id"), "game_id")
    m = dual_side_join(fin, ftg, ["pd5", "pd10", "rest_days"])
    return m.select("game_id", "game_date_et", "home_win",
                    (c("home_pd5") - c("away_pd5")).alias("rolling_pd_5_diff"),
                    (c("home_pd10") - c("away_pd10")).alias("rolling_pd_10_diff"),
                    (c("home_rest_days") - c("away_rest_days")).alias("rest_days_diff"),
                    F.when(c("home_rest_days") == 0, 1).otherwise(0).alias("home_back_to_back"),
                    F.lit(1).alias("home_advantage"))


# The day that is scored: the latest one with a scheduled match.
_AS_OF_SQL = "(SELECT max(game_date_et) FROM fx_games WHERE lower(trim(status)) = 'scheduled')"


def scoring_day(T):
    """One-row frame `as_of`: the latest day with a scheduled match."""
    return T.fx_games.where(norm_status(c("status")) == "scheduled").agg(F.max("game_date_et").alias("as_of"))


def day_matrix(T, as_of):
    """Features of every match of a day, whatever its state, from what was known
    before the day; matches whose teams have no history stay, with NULLs.

    `as_of` is a one-row frame with the column `as_of`; only that day's matches
    are asked for, so the output grows with the day, not with the history."""
    games = T.fx_games.join(F.broadcast(as_of), c("game_date_et") == c("as_of"), "left_semi")
    asked = games.select("game_id")
    form = pit.last_n_form(T.fx_games, ns=(5, 10), requests="all").join(asked, "game_id", "left_semi")
    rest = pit.rest_days(T.fx_games, season_type="regular", requests="all").select("game_id", "team_id", "rest_days")
    rows = form.join(rest, ["game_id", "team_id"], "left").select(
        "game_id", "team_id", c("rolling_pd_5").cast("double").alias("pd5"), c("rolling_pd_10").cast("double").alias("pd10"), "rest_days")
    m = dual_side_join(games.select("game_id", "game_date_et", "home_team_id", "away_team_id", "status"), rows,
                       ["pd5", "pd10", "rest_days"], how="left")
    return m.select("game_id", "game_date_et", norm_status(c("status")).alias("state"),
                    (c("home_pd5") - c("away_pd5")).alias("rolling_pd_5_diff"),
                    (c("home_pd10") - c("away_pd10")).alias("rolling_pd_10_diff"),
                    (c("home_rest_days") - c("away_rest_days")).alias("rest_days_diff"),
                    F.when(c("home_rest_days") == 0, 1).otherwise(0).alias("home_back_to_back"),
                    F.lit(1).alias("home_advantage"))


@register("day_matrix", f"""WITH {_PLAYED}, {_form_cte(f"day = {_AS_OF_SQL}")}, {_rest_cte(f"day = {_AS_OF_SQL}")},
folded AS (SELECT game_id, {side("rolling_pd_5::DOUBLE", True)} - {side("rolling_pd_5::DOUBLE", False)} AS rolling_pd_5_diff,
    {side("rolling_pd_10::DOUBLE", True)} - {side("rolling_pd_10::DOUBLE", False)} AS rolling_pd_10_diff,
    {side("rest_days", True)} - {side("rest_days", False)} AS rest_days_diff, CAST(coalesce({side("rest_days", True)} = 0, FALSE) AS INTEGER) AS home_back_to_back
  FROM (SELECT form.game_id, form.team_id, form.is_home, rolling_pd_5, rolling_pd_10, rest_days FROM form LEFT JOIN rest USING (game_id, team_id)) GROUP BY game_id)
SELECT game_id, game_date_et, lower(trim(status)) AS state, rolling_pd_5_diff, rolling_pd_10_diff, rest_days_diff, home_back_to_back, 1 AS home_advantage
FROM folded JOIN fx_games USING (game_id)""")
def q_day_matrix(T):
    """J1 for scoring: all matches of the latest day with a scheduled match."""
    return day_matrix(T, scoring_day(T))
