"""Incremental-load query: the delta load (D8) as an availableNow stream."""

from pyspark.sql import functions as F

from pitlane.plans.registry import register
from pitlane.sources.sinks import scratch_dir
from pitlane.streaming.incremental import delta_load_stream

c = F.col


@register("stream_delta_load", """SELECT * FROM fx_player_logs
QUALIFY row_number() OVER (PARTITION BY game_id, player_id, line_no
  ORDER BY game_date >= DATE '1997-01-01', game_date, min_raw, pts, reb, ast) = 1""")
def q_stream(T):
    """Player logs land in two drops (before / from 1997); each availableNow run
    merges the new files into the keyed snapshot table (first write wins; inside
    one drop the first row by its remaining columns wins)."""
    logs = T.fx_player_logs
    base = scratch_dir(T.spark, "stream")
    src, target, ckpt = f"{base}/landing", f"{base}/table", f"{base}/_checkpoint"
    cut = F.lit("1997-01-01").cast("date")
    logs.where(c("game_date") < cut).write.mode("append").parquet(src)
    delta_load_stream(T.spark, src, logs.schema, target, ["game_id", "player_id", "line_no"], ckpt)
    logs.where(c("game_date") >= cut).write.mode("append").parquet(src)
    return delta_load_stream(T.spark, src, logs.schema, target, ["game_id", "player_id", "line_no"], ckpt)


from pitlane.plans.q_eval import _M1_SQL  # noqa: E402
from pitlane.sources.sinks import write_snapshot  # noqa: E402
from pitlane.streaming.incremental import grade_stream  # noqa: E402


@register("stream_grade_next_day", f"WITH {_M1_SQL} SELECT * FROM graded")
def q_stream_grade(T):
    """M1 as a stream: results land in two drops (before / from 1997); each
    availableNow run grades the prediction-history snapshot with them."""
    base = scratch_dir(T.spark, "grade-stream")
    hist, src, ckpt = f"{base}/history", f"{base}/results", f"{base}/_checkpoint"
    h = T.fx_prediction_history.withColumn("correct_winner", F.lit(None).cast("boolean")).withColumn(
        "error_margin", F.lit(None).cast("double"))
    write_snapshot(h, hist)
    games = T.fx_games.select("game_id", "status", "home_pts", "away_pts", "game_date_et")
    cut = F.lit("1997-01-01").cast("date")
    games.where(c("game_date_et") < cut).write.mode("append").parquet(src)
    grade_stream(T.spark, src, games.schema, hist, ckpt)
    games.where(c("game_date_et") >= cut).write.mode("append").parquet(src)
    return grade_stream(T.spark, src, games.schema, hist, ckpt)


from pitlane.streaming.manifest import manifest_stream  # noqa: E402


@register("stream_manifest_merge", """SELECT * FROM fx_player_logs
QUALIFY row_number() OVER (PARTITION BY game_date, game_id, player_id, line_no
  ORDER BY min_raw, pts, reb, ast) = 1""")
def q_stream_manifest(T):
    """Player logs land in two drops by date; each availableNow run rewrites only
    the files whose dates the drop can touch and commits one manifest."""
    logs = T.fx_player_logs
    base = scratch_dir(T.spark, "manifest-stream")
    src, table, ckpt = f"{base}/landing", f"{base}/table", f"{base}/_checkpoint"
    cut = F.lit("1997-01-01").cast("date")
    keys = ["game_date", "game_id", "player_id", "line_no"]
    logs.where(c("game_date") < cut).write.mode("append").parquet(src)
    manifest_stream(T.spark, src, logs.schema, table, keys, ckpt)
    logs.where(c("game_date") >= cut).write.mode("append").parquet(src)
    return manifest_stream(T.spark, src, logs.schema, table, keys, ckpt)
