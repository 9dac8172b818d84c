"""Fixture projections of the driver tables (FIXTURES.md §2).

Fixed values: the projection texts below are the documented fixture definitions.
They run unchanged in Spark SQL and DuckDB; `{name}` marks a table reference,
resolved to a DataFrame parameter in Spark and to a CTE / view name in DuckDB.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixture projections (FIXTURES.md §2), in registration order.
FIXTURE_SQL: dict[str, str] = {
    "fx_teams": """SELECT CAST(n_nationkey + 1 AS INT) AS team_id, concat('T', lpad(CAST(n_nationkey + 1 AS VARCHAR(4)), 2, '0')) AS team_abbr, n_name AS team_name FROM {nation}""",
    "fx_games": """SELECT CAST(o_orderkey AS VARCHAR(20)) AS game_id, CAST(o_orderdate AS DATE) AS game_date_et,
 CAST(1 + o_custkey % 25 AS INT) AS home_team_id,
 CAST(1 + (o_custkey + 1 + o_orderkey % 24) % 25 AS INT) AS away_team_id,
 CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'P' THEN 'Final' WHEN 'O' THEN 'scheduled' END AS status,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'playoffs' ELSE 'regular' END AS season_type,
 CASE WHEN o_orderstatus <> 'O' THEN CAST(80 + CAST(floor(o_totalprice) AS BIGINT) % 60 AS INT) END AS home_pts,
 CASE WHEN o_orderstatus <> 'O' THEN CAST(80 + CAST(floor(o_totalprice / 7) AS BIGINT) % 61 AS INT) END AS away_pts
FROM {orders}""",
    "fx_team_log": """SELECT game_id, game_date_et AS game_date, home_team_id AS team_id, concat('T', home_team_id, ' vs. T', away_team_id) AS matchup,
 CASE WHEN home_pts IS NULL THEN NULL WHEN home_pts > away_pts THEN 'W' ELSE 'L' END AS wl, home_pts AS pts
FROM {fx_games} WHERE CAST(game_id AS BIGINT) % 17 <> 0
UNION ALL
SELECT game_id, game_date_et, away_team_id, concat('T', away_team_id, ' @ T', home_team_id),
 CASE WHEN home_pts IS NULL THEN NULL WHEN away_pts > home_pts THEN 'W' ELSE 'L' END, away_pts
FROM {fx_games}""",
    "fx_team_game_stats": """SELECT game_id, home_team_id AS team_id, TRUE AS is_home, CAST(90 + home_pts % 20 AS DOUBLE) AS pace_est, CAST(home_pts AS DOUBLE) AS ortg, CAST(away_pts AS DOUBLE) AS drtg,
 CASE WHEN home_pts % 9 = 0 THEN 0.0 ELSE CAST(home_pts % 40 AS DOUBLE) / 100 END AS oreb_pct, CAST(60 + away_pts % 30 AS DOUBLE) / 100 AS dreb_pct
FROM {fx_games} WHERE home_pts IS NOT NULL AND CAST(game_id AS BIGINT) % 10 <> 0
UNION ALL
SELECT game_id, away_team_id, FALSE, CAST(90 + away_pts % 20 AS DOUBLE), CAST(away_pts AS DOUBLE), CAST(home_pts AS DOUBLE),
 CASE WHEN away_pts % 9 = 0 THEN 0.0 ELSE CAST(away_pts % 40 AS DOUBLE) / 100 END, CAST(60 + home_pts % 30 AS DOUBLE) / 100
FROM {fx_games} WHERE home_pts IS NOT NULL AND CAST(game_id AS BIGINT) % 10 <> 0""",
    "fx_players": """SELECT s_suppkey AS player_id, s_name AS name, CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE CAST(s_nationkey + 1 AS INT) END AS team_id FROM {supplier}""",
    "fx_player_logs": """SELECT CAST(l_orderkey AS VARCHAR(20)) AS game_id, l_suppkey AS player_id, CAST(l_shipdate AS DATE) AS game_date, l_linenumber AS line_no,
 CASE WHEN l_partkey % 5 = 0 THEN concat(CAST(l_partkey % 48 AS VARCHAR(4)), ':', lpad(CAST(l_partkey % 60 AS VARCHAR(4)), 2, '0')) WHEN l_partkey % 23 = 0 THEN 'DNP' ELSE CAST(l_partkey % 48 AS VARCHAR(4)) END AS min_raw,
 CAST(l_quantity AS INT) AS pts, CAST(l_partkey % 15 AS INT) AS reb, CAST(l_partkey % 12 AS INT) AS ast FROM {lineitem}""",
    "fx_prediction_history": """SELECT game_id, game_date_et AS prediction_date_et, 'v1' AS model_version,
 CAST(CAST(game_id AS BIGINT) % 101 AS DOUBLE) / 100 AS pred_home_prob,
 CAST(95 + CAST(game_id AS BIGINT) % 37 AS DOUBLE) AS pred_home_score, CAST(95 + CAST(game_id AS BIGINT) % 31 AS DOUBLE) AS pred_away_score,
 CASE WHEN CAST(game_id AS BIGINT) % 3 = 0 THEN home_pts END AS actual_home_score, CASE WHEN CAST(game_id AS BIGINT) % 3 = 0 THEN away_pts END AS actual_away_score FROM {fx_games}""",
    "fx_game_officials": """SELECT DISTINCT CAST(l_orderkey AS VARCHAR(20)) AS game_id, l_suppkey AS official_id FROM {lineitem} WHERE l_linenumber <= 3""",
    "fx_ref_profiles": """SELECT s_suppkey AS official_id, s_acctbal / 1000 AS pf_bias, s_acctbal / 100000 AS home_bias_delta, CAST(s_suppkey % 10 AS DOUBLE) / 10 AS timing_factor FROM {supplier}""",
    "fx_team_records": """SELECT concat(CAST(year(o_orderdate) AS VARCHAR(4)), '-', lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR(4)), 2, '0')) AS season,
 n_name AS team, CASE WHEN max(o_orderkey) % 19 = 0 THEN NULL ELSE CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) % 23 AS DOUBLE) / 2 - 5.5 END AS rel_ortg,
 CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) % 29 AS DOUBLE) / 2 - 7 AS rel_drtg,
 CASE CAST(max(o_orderkey) % 7 AS INT) WHEN 0 THEN 'Won Finals' WHEN 1 THEN 'Lost Finals' WHEN 2 THEN 'Lost E. Conf. Finals' WHEN 3 THEN 'Lost W. Conf. Semis' WHEN 4 THEN 'Lost E. Conf. 1st Rnd.' END AS playoffs
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey GROUP BY year(o_orderdate), n_name""",
    "fx_houses": """SELECT p_partkey AS id, p_brand AS neighborhood, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS lot_frontage,
 CASE CAST(p_partkey % 6 AS INT) WHEN 0 THEN NULL WHEN 1 THEN 'Po' WHEN 2 THEN 'Fa' WHEN 3 THEN 'TA' WHEN 4 THEN 'Gd' ELSE 'Ex' END AS bsmt_qual,
 CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_type END AS sale_type,
 CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size * p_size AS DOUBLE) END AS total_bsmt_sf,
 CAST(p_size * 100 AS DOUBLE) AS gr_liv_area, CAST(1 + p_partkey % 10 AS INT) AS overall_qual, CAST(1900 + p_partkey % 110 AS INT) AS year_built, CAST(2006 + p_partkey % 5 AS INT) AS yr_sold,
 CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_retailprice END AS sale_price FROM {part}""",
    "fx_api_times": """SELECT event_id, user_id, ts AS event_utc, event_type, value FROM {events}""",
}

_REF = re.compile(r"\{(\w+)\}")


def deps(name: str) -> list[str]:
    return _REF.findall(FIXTURE_SQL[name])


def _closure(names) -> list[str]:
    """Fixtures needed by `names`, dependencies first, in registration order."""
    need: set[str] = set()

    def visit(n):
        if n in FIXTURE_SQL and n not in need:
            need.add(n)
            for d in deps(n):
                visit(d)

    for n in names:
        visit(n)
    return [n for n in FIXTURE_SQL if n in need]


def duckdb_with(body: str) -> str:
    """Prefix a DuckDB query with the fixture CTEs it references.

    The base tables are views registered by the caller; fixtures are inlined
    as CTEs so the oracle reads only the given parquet tables.
    """
    used = [n for n in FIXTURE_SQL if re.search(rf"\b{n}\b", body)]
    order = _closure(used)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS (\n{_REF.sub(lambda m: m.group(1), FIXTURE_SQL[n])}\n)" for n in order)
    body = body.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


class Tables:
    """Lazily built base tables and fixture projections for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in FIXTURE_SQL:
                args = {d: self(d) for d in deps(name)}
                self._cache[name] = self.spark.sql(FIXTURE_SQL[name], **args)
            elif name in BASE_TABLES:
                self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                raise KeyError(name)
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self(name)
