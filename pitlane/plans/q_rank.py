"""Season-rank study and ordering queries."""

from pyspark.sql import functions as F

from pitlane.functions.scalars import norm_status
from pitlane.operators import pit
from pitlane.operators import ranking as K
from pitlane.plans.q_agg import _RANKS_SQL, _ranks
from pitlane.plans.registry import register


@register("rank_in_group", f"WITH {_RANKS_SQL} SELECT finish_year, team, rel_ortg, rel_drtg, off_rank, def_rank FROM sr")
def q_f11(T):
    return _ranks(T).select("finish_year", "team", "rel_ortg", "rel_drtg", "off_rank", "def_rank")


@register("composite_rank_score", f"WITH {_RANKS_SQL} SELECT finish_year, team, off_rank, def_rank, contender_score FROM sr")
def q_j4(T):
    return _ranks(T).select("finish_year", "team", "off_rank", "def_rank", "contender_score")


@register("elite_flag", f"WITH {_RANKS_SQL} SELECT finish_year, team, elite FROM sr")
def q_j5(T):
    return _ranks(T).select("finish_year", "team", "elite")


@register("outcome_label", """SELECT season, team, playoffs,
  CASE WHEN contains(playoffs, 'Won Finals') THEN 'Finals Winner' WHEN contains(playoffs, 'Lost Finals') THEN 'Finals Loser'
       WHEN contains(playoffs, 'Conf. Finals') THEN 'Conference Finals' WHEN contains(playoffs, 'Conf. Semis') THEN 'Playoffs Round 2'
       WHEN contains(playoffs, '1st Rnd.') THEN 'Playoffs Round 1' ELSE 'Missed Playoffs' END AS outcome,
  CASE WHEN contains(playoffs, 'Won Finals') OR contains(playoffs, 'Lost Finals') OR contains(playoffs, 'Conf. Finals') THEN 1 ELSE 0 END AS is_contender
FROM fx_team_records""")
def q_j6(T):
    r = T.fx_team_records
    return r.select("season", "team", "playoffs", K.outcome_label(F.col("playoffs")).alias("outcome"),
                    K.contains_any(F.col("playoffs")).alias("is_contender"))


@register("top1_per_group", f"""WITH {_RANKS_SQL}
SELECT * FROM sr QUALIFY row_number() OVER (PARTITION BY finish_year, outcome ORDER BY contender_score DESC, team ASC) = 1""")
def q_f12(T):
    return K.top1_per_group(_ranks(T), ["finish_year", "outcome"], [F.col("contender_score").desc(), F.col("team").asc()])


_ORD_SQL = """CASE outcome WHEN 'Finals Winner' THEN 0 WHEN 'Finals Loser' THEN 1 WHEN 'Conference Finals' THEN 2
  WHEN 'Playoffs Round 2' THEN 3 WHEN 'Playoffs Round 1' THEN 4 WHEN 'Missed Playoffs' THEN 5 END"""


@register("ordinal_sort", f"""WITH {_RANKS_SQL}
SELECT finish_year, team, outcome, {_ORD_SQL} AS outcome_ord, contender_score FROM sr
ORDER BY outcome_ord, finish_year, contender_score DESC, team""")
def q_g4(T):
    r = _ranks(T).withColumn("outcome_ord", K.ordinal(F.col("outcome")))
    return r.select("finish_year", "team", "outcome", "outcome_ord", "contender_score").orderBy(
        "outcome_ord", "finish_year", F.col("contender_score").desc(), "team")


@register("group_report", f"""WITH {_RANKS_SQL}
SELECT finish_year, team, outcome, {_ORD_SQL} AS outcome_ord, contender_score, off_rank, def_rank,
  MAX(CASE WHEN outcome = 'Finals Winner' THEN team END) OVER (PARTITION BY finish_year) AS champion
FROM sr ORDER BY finish_year, outcome_ord, contender_score DESC, team""")
def q_g6(T):
    r = _ranks(T).withColumn("outcome_ord", K.ordinal(F.col("outcome")))
    r = K.group_report(r, "finish_year", "outcome", "Finals Winner", "team")
    return r.select("finish_year", "team", "outcome", "outcome_ord", "contender_score", "off_rank", "def_rank",
                    "champion").orderBy("finish_year", "outcome_ord", F.col("contender_score").desc(), "team")


@register("topk_abs_gap", """WITH pl AS (
  SELECT player_id, game_date, game_id, line_no, pts,
    row_number() OVER (PARTITION BY player_id ORDER BY game_date DESC, game_id DESC, line_no DESC) AS rn FROM fx_player_logs),
a AS (SELECT player_id, AVG(pts) FILTER (WHERE rn <= 5) AS projection, AVG(pts) FILTER (WHERE rn <= 20) AS average FROM pl GROUP BY player_id)
SELECT player_id, projection, average, projection - average AS gap FROM a ORDER BY abs(projection - average) DESC, player_id LIMIT 5""")
def q_g1(T):
    """G1: the 5 players whose short-window projection is furthest from their average."""
    cur = pit.current_last_n(T.fx_player_logs, "player_id", ["game_date", "game_id", "line_no"],
                             {"projection": ("pts", 5), "average": ("pts", 20)})
    cur = cur.select("player_id", "projection", "average", (F.col("projection") - F.col("average")).alias("gap"))
    return K.top_k(cur, 5, [F.abs(F.col("gap")).desc(), F.col("player_id")])


_RESID_SQL = """r AS (SELECT game_id, (pred_home_score - pred_away_score) - (actual_home_score - actual_away_score) AS residual
  FROM fx_prediction_history WHERE actual_home_score IS NOT NULL)"""


@register("worst_k", f"""WITH {_RESID_SQL}
(SELECT 'largest' AS side, game_id, residual FROM r ORDER BY residual DESC, game_id LIMIT 5)
UNION ALL
(SELECT 'smallest' AS side, game_id, residual FROM r ORDER BY residual ASC, game_id LIMIT 5)""")
def q_g2(T):
    """K largest and k smallest signed margin residuals (ties broken by id)."""
    p = T.fx_prediction_history.where(F.col("actual_home_score").isNotNull())
    r = p.select("game_id", ((F.col("pred_home_score") - F.col("pred_away_score"))
                             - (F.col("actual_home_score") - F.col("actual_away_score"))).alias("residual"))
    big = K.top_k(r, 5, [F.col("residual").desc(), F.col("game_id")]).select(F.lit("largest").alias("side"), "*")
    small = K.top_k(r, 5, [F.col("residual").asc(), F.col("game_id")]).select(F.lit("smallest").alias("side"), "*")
    return big.unionByName(small)


@register("latest_distinct", "SELECT DISTINCT game_date_et FROM fx_games ORDER BY game_date_et DESC LIMIT 5")
def q_g3(T):
    return K.latest_distinct(T.fx_games, "game_date_et", 5)


@register("union_all", """SELECT game_date_et, home_team_id AS team_id FROM fx_games WHERE lower(trim(status)) = 'final'
UNION ALL SELECT game_date_et, away_team_id FROM fx_games WHERE lower(trim(status)) = 'final'""")
def q_g5(T):
    """Union of the home and away projections (B4 is the one-scan form)."""
    g = T.fx_games.where(norm_status(F.col("status")) == "final")
    return g.select("game_date_et", F.col("home_team_id").alias("team_id")).unionByName(
        g.select("game_date_et", F.col("away_team_id").alias("team_id")))
