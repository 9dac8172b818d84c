"""Source and sink queries.  Sinks write under the session's
checkpoint folder and the query returns what was written, read back."""

from pyspark.sql import functions as F

from pitlane.operators.evaluate import back_transform
from pitlane.plans.q_features import _TE_SQL, _te
from pitlane.plans.registry import register
from pitlane.sources import readers as RD
from pitlane.sources import sinks as SK

c = F.col

_LANDED_SCHEMA = ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                  "l_shipdate TIMESTAMP_NTZ")


@register("src_landed_logs", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def q_a1(T):
    """A1: landed player-log extract read with a declared schema (only the declared columns are scanned)."""
    return RD.read_landed(T.spark, f"{T.sf_dir}/lineitem.parquet", _LANDED_SCHEMA)


_RECORDS_SCHEMA = "season STRING, team STRING, rel_ortg DOUBLE, rel_drtg DOUBLE, playoffs STRING"


@register("src_csv", "SELECT * FROM fx_team_records")
def q_a2(T):
    """A2: header CSV with pinned types (season records written as CSV, read back)."""
    path = SK.write_csv(T.fx_team_records, SK.scratch_dir(T.spark, "records-csv"))
    return RD.read_csv(T.spark, path, _RECORDS_SCHEMA)


@register("src_table", """SELECT game_id, game_date_et, home_team_id, away_team_id, home_pts, away_pts FROM fx_games
WHERE lower(trim(status)) = 'final' AND game_date_et >= DATE '1998-01-01'""")
def q_a3(T):
    """A3: a query result over a bound table (no global view)."""
    return RD.read_table(T.spark, """SELECT game_id, game_date_et, home_team_id, away_team_id, home_pts, away_pts FROM {g}
        WHERE lower(trim(status)) = 'final' AND game_date_et >= DATE '1998-01-01'""", g=T.fx_games)


@register("sink_csv", f"WITH {_TE_SQL} SELECT id, exp(te) - 1 AS prediction FROM te WHERE origin = 'test'")
def q_a4(T):
    """A4: (id, prediction) CSV for the test slice, read back with its schema."""
    sub = _te(T).where(c("origin") == "test").select("id", back_transform(c("te")).alias("prediction"))
    path = SK.write_csv(sub, SK.scratch_dir(T.spark, "submission"))
    return RD.read_csv(T.spark, path, "id BIGINT, prediction DOUBLE")


_GAMES_DOC_SQL = """gd AS (SELECT game_date_et AS day, list_sort(list(struct_pack(game_id := game_id, home_team_id := home_team_id,
    away_team_id := away_team_id, home_pts := home_pts, away_pts := away_pts))) AS games FROM fx_games GROUP BY game_date_et)"""
_PROPS_DOC_SQL = """pd AS (SELECT game_date AS day, list_sort(list(struct_pack(pos := CAST(rn AS INTEGER), player_id := player_id, pts := pts))) AS top_props
  FROM (SELECT *, row_number() OVER (PARTITION BY game_date ORDER BY pts DESC, player_id, game_id, line_no) AS rn FROM fx_player_logs)
  WHERE rn <= 5 GROUP BY game_date)"""


def _games_docs(T):
    g = T.fx_games.withColumnRenamed("game_date_et", "day")
    return SK.day_documents(g, "day", ["game_id", "home_team_id", "away_team_id", "home_pts", "away_pts"])


def _props_docs(T):
    from pyspark.sql import Window
    p = T.fx_player_logs.withColumnRenamed("game_date", "day")
    w = Window.partitionBy("day").orderBy(c("pts").desc(), "player_id", "game_id", "line_no")
    top = p.withColumn("pos", F.row_number().over(w)).where(c("pos") <= 5)
    return top.groupBy("day").agg(F.array_sort(F.collect_list(F.struct("pos", "player_id", "pts"))).alias("top_props"))


# The fixture's days hold far fewer games than one document part (5,000), so
# every day is the single part 0 in the oracle.
@register("sink_day_document", f"WITH {_GAMES_DOC_SQL} SELECT day, 0 AS part, CAST(to_json(games) AS VARCHAR) AS games_json FROM gd")
def q_a5(T):
    """A5: one JSON document per day with its games[], written and read back; the
    published JSON text of the games array is returned."""
    docs = _games_docs(T)
    path = SK.write_json_documents(docs, SK.scratch_dir(T.spark, "day-docs"))
    back = T.spark.read.schema(docs.schema).json(path)
    return back.select("day", "part", F.to_json("games", {"ignoreNullFields": "false"}).alias("games_json"))


@register("merge_documents", f"""WITH {_GAMES_DOC_SQL}, {_PROPS_DOC_SQL}
SELECT gd.day, 0 AS part, CAST(to_json(gd.games) AS VARCHAR) AS games_json,
  CAST(to_json(COALESCE(pd.top_props, [])) AS VARCHAR) AS top_props_json FROM gd LEFT JOIN pd ON gd.day = pd.day""")
def q_a6(T):
    """Attach the props document's array as top_props (empty when the day has
    none); returned as the published JSON text of both arrays."""
    m = SK.merge_documents(_games_docs(T), _props_docs(T).withColumn("part", F.lit(0)), ["day", "part"], "top_props")
    opts = {"ignoreNullFields": "false"}
    return m.select("day", "part", F.to_json("games", opts).alias("games_json"),
                    F.to_json("top_props", opts).alias("top_props_json"))


@register("sink_payload_append", """SELECT prediction_date_et AS prediction_date, 'prediction' AS category,
  CAST(json_object('game_id', game_id, 'pred_home_prob', pred_home_prob, 'actual_home_score', actual_home_score) AS VARCHAR) AS payload
FROM fx_prediction_history""")
def q_a7(T):
    """(date, category, JSON payload) appended under a category partition, read back."""
    rows = SK.payload_rows(T.fx_prediction_history, "prediction", "prediction_date_et",
                           ["game_id", "pred_home_prob", "actual_home_score"])
    path = SK.append_payloads(rows, SK.scratch_dir(T.spark, "payloads"))
    return T.spark.read.parquet(path).select("prediction_date", "category", "payload")


@register("refresh_snapshot", """SELECT s.game_id, s.team_id, g.game_date_et, s.pace_est, s.ortg,
  AVG(s.pace_est) OVER (PARTITION BY s.team_id ORDER BY g.game_date_et, s.game_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS rolling_pace_10
FROM fx_team_game_stats s JOIN fx_games g ON s.game_id = g.game_id""")
def q_a8(T):
    """Recompute the rolling-pace view and publish it as a new snapshot."""
    from pitlane.operators import pit
    rows = T.fx_team_game_stats.join(T.fx_games.select("game_id", "game_date_et"), "game_id").select(
        "game_id", "team_id", "game_date_et", "pace_est", "ortg")
    view = pit.rolling_rows(rows, "team_id", ["game_date_et", "game_id"], {"rolling_pace_10": "pace_est"}, 10)
    return SK.refresh_snapshot(view, SK.scratch_dir(T.spark, "adv-view"))

