"""Reshape, filter and scalar-cleaning queries."""

from pyspark.sql import functions as F

from pitlane.functions import scalars as S
from pitlane.operators import reshape as R
from pitlane.plans.registry import register


@register("pair_rows_to_match", """
WITH h AS (SELECT game_id, game_date, team_id, pts FROM fx_team_log WHERE matchup LIKE '%vs.%'),
     a AS (SELECT game_id, team_id, pts FROM fx_team_log WHERE matchup LIKE '%@%')
SELECT h.game_id, h.game_date, h.team_id AS home_team_id, a.team_id AS away_team_id, h.pts AS home_pts, a.pts AS away_pts
FROM h JOIN a ON h.game_id = a.game_id""")
def q_b1(T):
    return R.pair_rows_to_match(T.fx_team_log)


@register("pair_rows_exactly_two", """
WITH r AS (SELECT *, count(*) OVER (PARTITION BY game_id) AS n,
                  row_number() OVER (PARTITION BY game_id ORDER BY team_id) AS rn FROM fx_team_log),
     r0 AS (SELECT * FROM r WHERE n = 2 AND rn = 1), r1 AS (SELECT * FROM r WHERE n = 2 AND rn = 2)
SELECT r0.game_id,
  CASE WHEN r0.matchup LIKE '%vs.%' THEN r0.game_date ELSE r1.game_date END AS game_date,
  CASE WHEN r0.matchup LIKE '%vs.%' THEN r0.team_id ELSE r1.team_id END AS home_team_id,
  CASE WHEN r0.matchup LIKE '%vs.%' THEN r1.team_id ELSE r0.team_id END AS away_team_id,
  CASE WHEN r0.matchup LIKE '%vs.%' THEN r0.pts ELSE r1.pts END AS home_pts,
  CASE WHEN r0.matchup LIKE '%vs.%' THEN r1.pts ELSE r0.pts END AS away_pts
FROM r0 JOIN r1 ON r0.game_id = r1.game_id""")
def q_b2(T):
    return R.pair_rows_exactly_two(T.fx_team_log)


@register("pair_rows_nullable", """
WITH h AS (SELECT game_id, game_date, team_id, pts FROM fx_team_log WHERE matchup LIKE '%vs.%'),
     a AS (SELECT game_id, game_date, team_id, pts FROM fx_team_log WHERE matchup LIKE '%@%' AND matchup NOT LIKE '%vs.%')
SELECT h.game_id, greatest(h.game_date, a.game_date) AS game_date, h.team_id AS home_team_id, a.team_id AS away_team_id,
  h.pts AS home_pts, a.pts AS away_pts,
  CASE WHEN h.pts IS NOT NULL AND a.pts IS NOT NULL THEN 'final' ELSE 'scheduled' END AS status
FROM h JOIN a ON h.game_id = a.game_id""")
def q_b3(T):
    return R.pair_rows_nullable(T.fx_team_log)


@register("completed_only", """
SELECT game_id, CAST(game_date AS DATE) AS game_date, team_id, matchup, wl, pts FROM fx_team_log
WHERE wl IS NOT NULL AND pts IS NOT NULL AND TRY_CAST(CAST(game_date AS VARCHAR) AS TIMESTAMP) IS NOT NULL""")
def q_b5(T):
    return R.completed_only(T.fx_team_log)


@register("normalise_status", "SELECT game_id, lower(trim(status)) AS status FROM fx_games")
def q_b6(T):
    return R.normalise_status(T.fx_games.select("game_id", "status"))


@register("parse_duration", """
SELECT game_id, player_id, line_no, min_raw,
  COALESCE(CASE WHEN len(string_split(trim(min_raw), ':')) = 2
                THEN TRY_CAST(string_split(trim(min_raw), ':')[1] AS DOUBLE) + TRY_CAST(string_split(trim(min_raw), ':')[2] AS DOUBLE) / 60
                WHEN len(string_split(trim(min_raw), ':')) = 1 THEN TRY_CAST(trim(min_raw) AS DOUBLE) END, 0.0) AS minutes
FROM fx_player_logs""")
def q_b7(T):
    p = T.fx_player_logs
    return p.select("game_id", "player_id", "line_no", "min_raw", S.parse_duration(F.col("min_raw")).alias("minutes"))


@register("safe_int", """
SELECT game_id, player_id, line_no, min_raw, CAST(trunc(TRY_CAST(min_raw AS DOUBLE)) AS BIGINT) AS min_int FROM fx_player_logs""")
def q_b8(T):
    p = T.fx_player_logs
    return p.select("game_id", "player_id", "line_no", "min_raw", S.safe_int(F.col("min_raw")).alias("min_int"))


@register("season_key", """
WITH s AS (SELECT game_id, game_date_et,
  CASE WHEN month(game_date_et) >= 10 THEN year(game_date_et) ELSE year(game_date_et) - 1 END AS season FROM fx_games),
l AS (SELECT *, CAST(season AS VARCHAR) || '-' || lpad(CAST((season + 1) % 100 AS VARCHAR), 2, '0') AS season_label FROM s)
SELECT game_id, game_date_et, CAST(season AS INTEGER) AS season, season_label,
  CAST(substr(season_label, 1, 4) AS INTEGER) AS label_start,
  CAST(CASE WHEN (CAST(substr(season_label, 1, 4) AS INTEGER) // 100) * 100 + CAST(substr(season_label, 6, 2) AS INTEGER) < CAST(substr(season_label, 1, 4) AS INTEGER)
       THEN (CAST(substr(season_label, 1, 4) AS INTEGER) // 100) * 100 + CAST(substr(season_label, 6, 2) AS INTEGER) + 100
       ELSE (CAST(substr(season_label, 1, 4) AS INTEGER) // 100) * 100 + CAST(substr(season_label, 6, 2) AS INTEGER) END AS INTEGER) AS label_finish
FROM l""")
def q_b9(T):
    g = T.fx_games.select("game_id", "game_date_et")
    g = g.withColumn("season", S.season_start_year(F.col("game_date_et")))
    g = g.withColumn("season_label", S.season_label(F.col("season")))
    return g.select("*", S.season_label_start(F.col("season_label")).alias("label_start"),
                    S.season_label_finish(F.col("season_label")).alias("label_finish"))


@register("business_date", """
SELECT event_id, event_utc,
  CAST(timezone('America/New_York', event_utc AT TIME ZONE 'UTC') - INTERVAL 4 HOUR AS DATE) AS business_date,
  CAST(timezone('America/New_York', event_utc AT TIME ZONE 'UTC') AS DATE) AS local_date
FROM fx_api_times""")
def q_b10(T):
    e = T.fx_api_times
    return e.select("event_id", "event_utc", S.business_date(F.col("event_utc")).alias("business_date"),
                    S.business_date(F.col("event_utc"), cutoff_hour=0).alias("local_date"))


@register("fill_and_flag", """
SELECT s.game_id, s.team_id, s.team_id = g.home_team_id AS is_home,
  COALESCE(s.pace_est, 0.0) AS pace_est, COALESCE(s.ortg, 0.0) AS ortg, COALESCE(s.drtg, 0.0) AS drtg,
  COALESCE(s.oreb_pct, 0.0) AS oreb_pct, COALESCE(s.dreb_pct, 0.0) AS dreb_pct
FROM fx_team_game_stats s LEFT JOIN fx_games g ON s.game_id = g.game_id""")
def q_b11(T):
    return R.fill_and_flag(T.fx_team_game_stats, T.fx_games, ["pace_est", "ortg", "drtg", "oreb_pct", "dreb_pct"])


@register("map_with_fallback", """
SELECT p.player_id, p.name, p.team_id, COALESCE(t.team_abbr, upper(substr(p.name, 1, 3))) AS abbr
FROM fx_players p LEFT JOIN fx_teams t ON p.team_id = t.team_id""")
def q_b12(T):
    return R.map_with_fallback(T.fx_players, T.fx_teams, "team_id", "team_abbr", "name")


@register("predicates", """
SELECT game_id, status, home_team_id, home_pts FROM fx_games
WHERE status ILIKE '%inal%' AND home_pts BETWEEN 90 AND 120 AND season_type IS NOT NULL
  AND starts_with(game_id, '1') AND home_team_id IN (1, 2, 3, 5, 8, 13) AND away_pts <> home_pts""")
def q_b13(T):
    g = T.fx_games
    return g.where(F.col("status").ilike("%inal%") & F.col("home_pts").between(90, 120)
                   & F.col("season_type").isNotNull() & F.col("game_id").startswith("1")
                   & F.col("home_team_id").isin(1, 2, 3, 5, 8, 13) & (F.col("away_pts") != F.col("home_pts"))
                   ).select("game_id", "status", "home_team_id", "home_pts")


@register("outlier_filter", """
SELECT * FROM fx_houses WHERE NOT COALESCE(gr_liv_area > 4000 AND sale_price < 300000, FALSE)""")
def q_b14(T):
    h = T.fx_houses
    return R.outlier_filter(h, (F.col("gr_liv_area") > 4000) & (F.col("sale_price") < 300000))


_STACK_SQL = """
SELECT *, 'train' AS origin FROM fx_houses WHERE sale_price IS NOT NULL
UNION ALL
SELECT id, neighborhood, lot_frontage, bsmt_qual, sale_type, total_bsmt_sf, gr_liv_area, overall_qual, year_built, yr_sold,
  NULL AS sale_price, 'test' AS origin FROM fx_houses WHERE sale_price IS NULL"""


def _stacked(T):
    h = T.fx_houses
    return R.stack_frames(h.where(F.col("sale_price").isNotNull()),
                          h.where(F.col("sale_price").isNull()).drop("sale_price"), origin="origin")


@register("stack_frames", _STACK_SQL)
def q_b15(T):
    return _stacked(T)


@register("split_back", f"SELECT * EXCLUDE (origin) FROM ({_STACK_SQL}) WHERE origin = 'test'")
def q_b16(T):
    return R.split_back(_stacked(T), "test", origin="origin")


@register("date_spine", """
WITH b AS (SELECT min(game_date_et) AS lo, max(game_date_et) AS hi FROM fx_games),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
n AS (SELECT game_date_et, count(*) AS n_games FROM fx_games GROUP BY game_date_et)
SELECT d.day, COALESCE(n.n_games, 0) AS n_games FROM d LEFT JOIN n ON d.day = n.game_date_et""")
def q_b17(T):
    g = T.fx_games
    spine = R.date_spine(g, "game_date_et")
    n = g.groupBy(F.col("game_date_et").alias("day")).agg(F.count(F.lit(1)).alias("n_games"))
    return spine.join(n, "day", "left").select("day", F.coalesce("n_games", F.lit(0)).alias("n_games"))


@register("drop_columns", "SELECT * EXCLUDE (id) FROM fx_houses")
def q_b18(T):
    return R.drop_columns(T.fx_houses, ["id", "garage_yr_blt"])


@register("scalars", """
SELECT game_id,
  COALESCE(home_pts, 0) AS pts0,
  CASE WHEN home_pts > away_pts THEN 'H' WHEN home_pts < away_pts THEN 'A' ELSE 'T' END AS side,
  home_pts > away_pts AS home_win,
  abs(home_pts - away_pts) AS abs_margin,
  (home_pts + away_pts) * 2 - away_pts / 4 AS arith,
  CAST((home_pts + away_pts) / 3.0 AS DECIMAL(10,3)) AS third_total,
  CAST(dayofweek(game_date_et) AS INTEGER) AS dow,
  CAST(game_date_et - DATE '1995-01-01' AS INTEGER) AS days_since,
  CAST(game_date_et - INTERVAL 3 DAY AS DATE) AS minus3,
  strftime(game_date_et, '%Y/%m/%d') AS date_text,
  CAST(strptime(strftime(game_date_et, '%Y/%m/%d'), '%Y/%m/%d') AS DATE) AS date_parsed,
  json_extract_string(json_object('game_id', game_id, 'home_pts', home_pts), '$.home_pts') AS json_pts,
  ln(1 + home_pts) AS log1p_pts, exp(home_pts / 100.0) - 1 AS expm1_pts,
  (pow(1 + home_pts, 0.15) - 1) / 0.15 AS boxcox_pts,
  status ILIKE 'fin%' AS is_fin, contains(season_type, 'reg') AS is_reg, starts_with(status, 'F') AS cap_f,
  replace(status, 'al', 'AL') AS status_rep, substr(status, 1, 3) AS status3, upper(status) AS status_up,
  CAST(trunc(home_pts / 7.0) AS INTEGER) AS trunc7, round(home_pts / 2.0, 0) AS round_half_up,
  round_even(home_pts / 2.0, 0) AS round_half_even,
  printf('%.1f%%', 100.0 * home_pts / (home_pts + away_pts)) AS home_share_text
FROM fx_games""")
def q_scalars(T):
    g = T.fx_games
    c = F.col
    return g.select(
        "game_id",
        F.coalesce(c("home_pts"), F.lit(0)).alias("pts0"),
        F.when(c("home_pts") > c("away_pts"), "H").when(c("home_pts") < c("away_pts"), "A").otherwise("T").alias("side"),
        (c("home_pts") > c("away_pts")).alias("home_win"),
        F.abs(c("home_pts") - c("away_pts")).alias("abs_margin"),
        ((c("home_pts") + c("away_pts")) * 2 - c("away_pts") / 4).alias("arith"),
        ((c("home_pts") + c("away_pts")) / 3.0).cast("decimal(10,3)").alias("third_total"),
        S.dow_sun0(c("game_date_et")).alias("dow"),
        F.datediff(c("game_date_et"), F.lit("1995-01-01").cast("date")).alias("days_since"),
        F.date_sub(c("game_date_et"), 3).alias("minus3"),
        F.date_format(c("game_date_et"), "yyyy/MM/dd").alias("date_text"),
        F.to_date(F.date_format(c("game_date_et"), "yyyy/MM/dd"), "yyyy/MM/dd").alias("date_parsed"),
        F.get_json_object(F.to_json(F.struct("game_id", "home_pts")), "$.home_pts").alias("json_pts"),
        F.log1p(c("home_pts")).alias("log1p_pts"), F.expm1(c("home_pts") / 100.0).alias("expm1_pts"),
        ((F.pow(1 + c("home_pts"), 0.15) - 1) / 0.15).alias("boxcox_pts"),
        c("status").ilike("fin%").alias("is_fin"), c("season_type").contains("reg").alias("is_reg"),
        c("status").startswith("F").alias("cap_f"),
        F.replace(c("status"), F.lit("al"), F.lit("AL")).alias("status_rep"),
        F.substring(c("status"), 1, 3).alias("status3"), F.upper(c("status")).alias("status_up"),
        (c("home_pts") / 7.0).cast("int").alias("trunc7"), F.round(c("home_pts") / 2.0, 0).alias("round_half_up"),
        F.bround(c("home_pts") / 2.0, 0).alias("round_half_even"),
        S.percent_text(100.0 * c("home_pts") / (c("home_pts") + c("away_pts"))).alias("home_share_text"),
    )


@register("match_to_team_rows", """
SELECT game_id, game_date_et, home_team_id AS team_id, away_team_id AS opp_team_id, TRUE AS is_home, home_pts AS pts_for, away_pts AS pts_against FROM fx_games
UNION ALL
SELECT game_id, game_date_et, away_team_id, home_team_id, FALSE, away_pts, home_pts FROM fx_games""")
def q_b4(T):
    """One match row -> two team rows with for/against swapped (one scan)."""
    return R.match_to_team_rows(T.fx_games)
