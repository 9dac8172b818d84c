"""Point-in-time queries."""

from pyspark.sql import functions as F

from pitlane.operators import pit
from pitlane.plans.registry import register

# Oracle building blocks.  A match gives two sides; a team's played sides are
# numbered in order, so "the last n before a day" is a range of numbers that
# ends at the number an as-of join finds.
_PLAYED = """
sides AS (
  SELECT game_id, game_date_et AS day, lower(trim(status)) AS state, season_type, home AS is_home,
    CASE WHEN home THEN home_team_id ELSE away_team_id END AS team,
    CASE WHEN home THEN home_pts - away_pts ELSE away_pts - home_pts END AS diff
  FROM fx_games CROSS JOIN (VALUES (TRUE), (FALSE)) v(home)),
played AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY day, game_id) AS nth FROM sides WHERE state = 'final' AND diff IS NOT NULL),
reached AS (SELECT team, day, max(nth) AS nth FROM played GROUP BY ALL),
regular_days AS (SELECT DISTINCT team, day FROM played WHERE season_type = 'regular')"""


def _form_cte(wanted: str) -> str:
    """CTE `form`: last-5/10 form of the sides that `wanted` picks."""
    return f"""asked AS (SELECT s.*, coalesce(r.nth, 0) AS upto FROM (SELECT * FROM sides WHERE {wanted}) s ASOF LEFT JOIN reached r ON s.team = r.team AND s.day > r.day),
form AS (SELECT a.game_id, a.day AS scheduled_date_et, a.team AS team_id, a.is_home,
    CAST(avg(p.diff) FILTER (WHERE p.nth > a.upto - 5) AS DECIMAL(10,3)) AS rolling_pd_5, count(p.diff) FILTER (WHERE p.nth > a.upto - 5) AS rolling_pd_5_n,
    CAST(avg(p.diff) AS DECIMAL(10,3)) AS rolling_pd_10, count(p.diff) AS rolling_pd_10_n
  FROM asked a LEFT JOIN played p ON p.team = a.team AND p.nth BETWEEN a.upto - 9 AND a.upto
  GROUP BY a.game_id, a.day, a.team, a.is_home)"""


def _rest_cte(wanted: str) -> str:
    """CTE `rest`: days of rest of the regular-season sides that `wanted` picks."""
    return f"""rest AS (SELECT s.game_id, s.day AS scheduled_date_et, s.team AS team_id, s.is_home, d.day AS last_final_date_et,
    CAST(date_diff('day', d.day, s.day) - 1 AS INTEGER) AS rest_days, d.day IS NULL AS rest_days_missing
  FROM (SELECT * FROM sides WHERE season_type = 'regular' AND {wanted}) s ASOF LEFT JOIN regular_days d ON s.team = d.team AND s.day > d.day)"""


LAST_N_FORM_SQL = f"""WITH {_PLAYED}, {_form_cte("state = 'scheduled'")} SELECT * FROM form"""
REST_DAYS_SQL = f"""WITH {_PLAYED}, {_rest_cte("state = 'scheduled'")} SELECT * FROM rest"""
FLAGSHIP_SQL = f"""WITH {_PLAYED}, {_form_cte("state = 'scheduled'")}, {_rest_cte("state = 'scheduled'")}
SELECT form.*, rest_days, rest_days_missing FROM form LEFT JOIN rest USING (game_id, team_id)"""


@register("last_n_form", LAST_N_FORM_SQL)
def q_last_n_form(T):
    """F2 on fx_games: last 5/10 finished margins before each scheduled team row."""
    return pit.last_n_form(T.fx_games, ns=(5, 10))


@register("rest_days", REST_DAYS_SQL)
def q_rest_days(T):
    """F1 on fx_games, regular season only."""
    return pit.rest_days(T.fx_games, season_type="regular")


@register("scheduled_form_rest", FLAGSHIP_SQL)
def q_flagship(T):
    """Flagship: F2 + F1 for every scheduled team row."""
    return pit.scheduled_form_and_rest(T.fx_games)


# ---------------------------------------------------------------------------
# Rolling windows F3-F10, F13-F15
# ---------------------------------------------------------------------------

_TEAM_ROWS_SQL = """team_rows AS (
  SELECT game_id, game_date_et, home_team_id AS team_id, away_team_id AS opp_team_id, TRUE AS is_home,
         home_pts AS pts_for, away_pts AS pts_against, home_pts - away_pts AS margin
  FROM fx_games WHERE lower(trim(status)) = 'final' AND home_pts IS NOT NULL AND away_pts IS NOT NULL
  UNION ALL
  SELECT game_id, game_date_et, away_team_id, home_team_id, FALSE, away_pts, home_pts, away_pts - home_pts
  FROM fx_games WHERE lower(trim(status)) = 'final' AND home_pts IS NOT NULL AND away_pts IS NOT NULL)"""

_ADV_METRICS = {"rolling_pace_10": "pace_est", "rolling_ortg_10": "ortg", "rolling_drtg_10": "drtg",
                "rolling_oreb_10": "oreb_pct", "rolling_dreb_10": "dreb_pct"}


def _adv_rows(T):
    s = T.fx_team_game_stats
    g = T.fx_games.select("game_id", "game_date_et")
    return s.join(g, "game_id").select("game_id", "team_id", "game_date_et", *_ADV_METRICS.values())


@register("rolling_avg_incl", "SELECT s.game_id, s.team_id, g.game_date_et, s.pace_est, s.ortg, s.drtg, s.oreb_pct, s.dreb_pct, "
          + ", ".join(f"AVG(s.{c}) OVER (PARTITION BY s.team_id ORDER BY g.game_date_et, s.game_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS {o}"
                      for o, c in _ADV_METRICS.items())
          + " FROM fx_team_game_stats s JOIN fx_games g ON s.game_id = g.game_id")
def q_f3(T):
    """v_team_advanced_stats -- 10-row means including the current row."""
    return pit.rolling_rows(_adv_rows(T), "team_id", ["game_date_et", "game_id"], _ADV_METRICS, 10, include_current=True)


@register("rolling_avg_excl", f"""WITH {_TEAM_ROWS_SQL}
SELECT game_id, team_id, game_date_et, pts_for,
  AVG(pts_for) OVER (PARTITION BY team_id ORDER BY game_date_et, game_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS rolling_avg_pts
FROM team_rows""")
def q_f4(T):
    """mean of the previous 5 rows, current excluded (no leak)."""
    rows = pit.team_rows_final(T.fx_games).select("game_id", "team_id", "game_date_et", "pts_for")
    return pit.rolling_rows(rows, "team_id", ["game_date_et", "game_id"], {"rolling_avg_pts": "pts_for"}, 5,
                            include_current=False)


@register("rolling_avg_full", f"""WITH {_TEAM_ROWS_SQL}
SELECT game_id, team_id, game_date_et, pts_for,
  CASE WHEN COUNT(pts_for) OVER w = 5 THEN AVG(pts_for) OVER w END AS avg_points_5g
FROM team_rows WINDOW w AS (PARTITION BY team_id ORDER BY game_date_et, game_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def q_f5(T):
    """pandas rolling(5).mean(): NULL until 5 values exist."""
    rows = pit.team_rows_final(T.fx_games).select("game_id", "team_id", "game_date_et", "pts_for")
    return pit.rolling_rows(rows, "team_id", ["game_date_et", "game_id"], {"avg_points_5g": "pts_for"}, 5,
                            include_current=True, full_only=True)


_F6_SQL = f"""WITH {_TEAM_ROWS_SQL},
f6 AS (SELECT game_id, team_id, opp_team_id, is_home, game_date_et, margin,
  AVG(margin) OVER (PARTITION BY team_id ORDER BY game_date_et, game_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS rolling_pd_5,
  AVG(margin) OVER (PARTITION BY team_id ORDER BY game_date_et, game_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS rolling_pd_10,
  CAST(game_date_et - LAG(game_date_et) OVER (PARTITION BY team_id ORDER BY game_date_et, game_id) - 1 AS INTEGER) AS rest_days
  FROM team_rows)"""


def side(col: str, home: bool, default: str | None = None) -> str:
    """SQL of one side's value of `col` when team rows are grouped by match."""
    v = f"max({col}) FILTER (WHERE {'' if home else 'NOT '}is_home)"
    return f"coalesce({v}, {default})" if default is not None else v


@register("team_features_with_rest", _F6_SQL + """
SELECT *, CASE WHEN rest_days = 0 THEN 1 ELSE 0 END AS back_to_back FROM f6""")
def q_f6(T):
    return pit.team_features_with_rest(T.fx_games)


@register("strength_of_schedule", _F6_SQL + """,
o AS (SELECT a.game_id, a.team_id, a.game_date_et, b.rolling_pd_10 AS opp_form
      FROM f6 a LEFT JOIN f6 b ON a.game_id = b.game_id AND a.opp_team_id = b.team_id)
SELECT game_id, team_id, game_date_et,
  AVG(opp_form) OVER (PARTITION BY team_id ORDER BY game_date_et, game_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS rolling_sos_10
FROM o""")
def q_f7(T):
    return pit.strength_of_schedule(T.fx_games)


@register("volatility", f"""WITH {_TEAM_ROWS_SQL}
SELECT game_id, team_id, game_date_et, pts_for,
  COALESCE(stddev_samp(pts_for) OVER (PARTITION BY team_id ORDER BY game_date_et, game_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 11.0) AS volatility
FROM team_rows""")
def q_f8(T):
    rows = pit.team_rows_final(T.fx_games).select("game_id", "team_id", "game_date_et", "pts_for")
    return pit.cumulative_prior(rows, "team_id", ["game_date_et", "game_id"], "pts_for", "volatility")


_PLAYER_ROWS_SQL = """pl AS (
  SELECT game_id, player_id, game_date, line_no, pts, reb, ast,
    COALESCE(CASE WHEN len(string_split(trim(min_raw), ':')) = 2
                  THEN TRY_CAST(string_split(trim(min_raw), ':')[1] AS DOUBLE) + TRY_CAST(string_split(trim(min_raw), ':')[2] AS DOUBLE) / 60
                  WHEN len(string_split(trim(min_raw), ':')) = 1 THEN TRY_CAST(trim(min_raw) AS DOUBLE) END, 0.0) AS minutes
  FROM fx_player_logs)"""
_PLAYER_FRAMES = {"pts_l5": ("pts", 5), "reb_l5": ("reb", 5), "ast_l5": ("ast", 5), "min_l5": ("minutes", 5),
                  "pts_l10": ("pts", 10), "reb_l10": ("reb", 10), "ast_l10": ("ast", 10), "pts_l20": ("pts", 20)}
_PLAYER_ORDER = ["game_date", "game_id", "line_no"]
_F9_SQL = f"""WITH {_PLAYER_ROWS_SQL}
SELECT game_id, player_id, game_date, line_no, pts, reb, ast, minutes, """ + ", ".join(
    f"AVG({c}) OVER (PARTITION BY player_id ORDER BY game_date, game_id, line_no ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS {o}"
    for o, (c, k) in _PLAYER_FRAMES.items()) + " FROM pl"


def _player_rows(T):
    from pitlane.functions.scalars import parse_duration
    p = T.fx_player_logs
    return p.select("game_id", "player_id", "game_date", "line_no", "pts", "reb", "ast",
                    parse_duration(F.col("min_raw")).alias("minutes"))


def _f9(T):
    aggs = {o: ("avg", c, -k, -1) for o, (c, k) in _PLAYER_FRAMES.items()}
    return pit.trailing(_player_rows(T), "player_id", _PLAYER_ORDER, aggs)


@register("player_rolling", _F9_SQL)
def q_f9(T):
    """F9 [definition ours]: v_player_rolling_stats -- prior L5/L10/L20 plus actuals."""
    return _f9(T)


_F10_SQL = f"""WITH {_PLAYER_ROWS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY game_date DESC, game_id DESC, line_no DESC) AS rn FROM pl)
SELECT player_id, count(*) FILTER (WHERE rn <= 20) AS n_rows, """ + ", ".join(
    f"AVG({c}) FILTER (WHERE rn <= {k}) AS {o}" for o, (c, k) in _PLAYER_FRAMES.items()) + " FROM r GROUP BY player_id"


@register("current_last_n", _F10_SQL)
def q_f10(T):
    """per player now, mean of the latest 5/10/20 lines (short history uses what exists)."""
    return pit.current_last_n(_player_rows(T), "player_id", _PLAYER_ORDER,
                              {o: (c, k) for o, (c, k) in _PLAYER_FRAMES.items()})


@register("recent_form_margin", f"""WITH {_TEAM_ROWS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY game_date_et DESC, game_id DESC) AS rn FROM team_rows),
a AS (SELECT team_id, AVG(margin) FILTER (WHERE rn <= 3) AS form_3, AVG(margin) FILTER (WHERE rn <= 10) AS form_10
      FROM r GROUP BY team_id)
SELECT team_id, form_3, form_10, form_3 - form_10 AS form_delta,
  CASE WHEN form_3 > form_10 THEN 'heating' WHEN form_3 < form_10 THEN 'slumping' ELSE 'steady' END AS trend FROM a""")
def q_f13(T):
    """F13 [doc]: mean margin of the last 3 against the last 10; heating / slumping flag."""
    rows = pit.team_rows_final(T.fx_games)
    cur = pit.current_last_n(rows, "team_id", ["game_date_et", "game_id"], {"form_3": ("margin", 3), "form_10": ("margin", 10)})
    d = F.col("form_3") - F.col("form_10")
    return cur.select("team_id", "form_3", "form_10", d.alias("form_delta"),
                      F.when(d > 0, "heating").when(d < 0, "slumping").otherwise("steady").alias("trend"))


@register("blended_form", f"""WITH f9 AS ({_F9_SQL})
SELECT game_id, player_id, line_no, pts_l5, pts_l20, 0.7 * pts_l5 + 0.3 * pts_l20 AS pts_blend FROM f9""")
def q_f14(T):
    """F14 [doc]: 0.7 x short window + 0.3 x long window (L5 and L20 of points)."""
    f9 = _f9(T)
    return f9.select("game_id", "player_id", "line_no", "pts_l5", "pts_l20",
                     (0.7 * F.col("pts_l5") + 0.3 * F.col("pts_l20")).alias("pts_blend"))


@register("time_decay_weight", f"""WITH {_TEAM_ROWS_SQL},
a AS (SELECT max(game_date_et) AS as_of FROM fx_games),
s AS (SELECT t.game_id, t.team_id, t.game_date_et, t.margin, a.as_of,
        CASE WHEN month(t.game_date_et) >= 10 THEN year(t.game_date_et) ELSE year(t.game_date_et) - 1 END AS season,
        CASE WHEN month(a.as_of) >= 10 THEN year(a.as_of) ELSE year(a.as_of) - 1 END AS as_of_season
      FROM team_rows t CROSS JOIN a)
SELECT game_id, team_id, game_date_et, margin, CAST(as_of - game_date_et AS INTEGER) AS age_days,
  exp(-ln(2.0) * (as_of - game_date_et) / 365.0) AS weight
FROM s WHERE season >= as_of_season - 2""")
def q_f15(T):
    """F15 [doc]: exponential time-decay weight (half-life 365 days), last 3 seasons."""
    from pitlane.functions.scalars import season_start_year
    rows = pit.team_rows_final(T.fx_games).select("game_id", "team_id", "game_date_et", "margin")
    as_of = T.fx_games.select(F.max("game_date_et")).scalar()  # scalar subquery, no join
    j = rows.where(season_start_year(F.col("game_date_et")) >= season_start_year(as_of) - 2)
    return pit.time_decay_weight(j, "game_date_et", as_of)
