"""Hand-made edge tables (FIXTURES.md §3), checked against brute force."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pitlane.functions import scalars as S
from pitlane.operators import evaluate as V
from pitlane.operators import features as X
from pitlane.operators import joins as J
from pitlane.operators import pit
from pitlane.operators import ranking as K
from pitlane.operators import reshape as R
from pitlane.operators import upsert as U

D = dt.date
GAMES_SCHEMA = ("game_id string, game_date_et date, home_team_id int, away_team_id int, status string, "
                "season_type string, home_pts int, away_pts int")


def games_df(spark, data):
    return spark.createDataFrame(data, GAMES_SCHEMA)


# team 1: four finals (two on 01-03), a scheduled game on 01-03 (same-date final excluded)
# team 3: no prior final; team 4: only a NULL-points 'Final'
EDGE_GAMES = [
    ("g1", D(2024, 1, 1), 1, 2, "final", "regular", 100, 90),
    ("g2", D(2024, 1, 2), 2, 1, "Final", "regular", 95, 99),
    ("g3", D(2024, 1, 3), 1, 2, " FINAL", "regular", 80, 85),
    ("g4", D(2024, 1, 3), 2, 1, "final", "regular", 70, 77),
    ("g5", D(2024, 1, 3), 1, 3, "Scheduled", "regular", None, None),
    ("g6", D(2024, 1, 5), 1, 4, "scheduled", "regular", None, None),
    ("g7", D(2024, 1, 4), 4, 2, "Final", "regular", None, None),
    ("g8", D(2024, 1, 6), 3, 1, "scheduled", None, None, None),
]


def brute_form(games, n):
    fin = []
    for g in games:
        if g[4].strip().lower() == "final" and g[6] is not None and g[7] is not None:
            fin.append((g[2], g[1], g[0], g[6] - g[7]))
            fin.append((g[3], g[1], g[0], g[7] - g[6]))
    out = {}
    for g in games:
        if g[4].strip().lower() != "scheduled":
            continue
        for team in (g[2], g[3]):
            prior = sorted([f for f in fin if f[0] == team and f[1] < g[1]], key=lambda f: (f[1], f[2]), reverse=True)[:n]
            avg = round(sum(f[3] for f in prior) / len(prior), 3) if prior else None
            out[(g[0], team)] = (avg, len(prior))
    return out


def test_last_n_form_edges(spark):
    df = pit.last_n_form(games_df(spark, EDGE_GAMES), ns=(2, 5))
    got = {(r.game_id, r.team_id): r for r in df.collect()}
    for n in (2, 5):
        exp = brute_form(EDGE_GAMES, n)
        assert set(exp) == set(got)
        for k, (avg, cnt) in exp.items():
            r = got[k]
            assert r[f"rolling_pd_{n}_n"] == cnt
            assert (None if r[f"rolling_pd_{n}"] is None else float(r[f"rolling_pd_{n}"])) == avg


def test_rest_days_edges(spark):
    df = pit.rest_days(games_df(spark, EDGE_GAMES), season_type=None)
    got = {(r.game_id, r.team_id): (r.last_final_date_et, r.rest_days, r.rest_days_missing) for r in df.collect()}
    # g5 on 01-03: team 1's finals on 01-03 are excluded (strict <); last is 01-02 -> 0 rest days
    assert got[("g5", 1)] == (D(2024, 1, 2), 0, False)
    assert got[("g5", 3)] == (None, None, True)
    # g6 on 01-05: team 4's NULL-points final on 01-04 still counts as a final for rest days
    assert got[("g6", 4)] == (D(2024, 1, 4), 0, False)
    assert got[("g6", 1)] == (D(2024, 1, 3), 1, False)


def test_rest_days_season_type_null_never_matches(spark):
    df = pit.rest_days(games_df(spark, EDGE_GAMES), season_type="regular")
    assert "g8" not in {r.game_id for r in df.collect()}


def test_no_future_leak(spark):
    base = games_df(spark, EDGE_GAMES)
    changed = games_df(spark, [g if g[1] < D(2024, 1, 4) else (g[0], g[1], g[2], g[3], "final", g[5], 150, 60)
                               for g in EDGE_GAMES])
    a = {(r.game_id, r.team_id): r for r in pit.last_n_form(base, ns=(5,)).collect()}
    b = {(r.game_id, r.team_id): r for r in pit.last_n_form(changed, ns=(5,)).collect()}
    assert a[("g5", 1)] == b[("g5", 1)]


@pytest.mark.parametrize("include_current,full_only,chunk", [(True, False, 1), (False, False, 7), (True, True, 5),
                                                             (True, False, 100_000), (False, False, 100_000)])
def test_rolling_rows_matches_plain_window(spark, monkeypatch, include_current, full_only, chunk):
    monkeypatch.setattr(pit, "CHUNK_ROWS", chunk)
    data = [(e, D(2020 + (i // 7), 1 + i % 12, 1 + (i * 3) % 27), f"m{i:03d}", None if i % 9 == 4 else float(i % 13))
            for e in (1, None) for i in range(40)]
    df = spark.createDataFrame(data, "e int, d date, mid string, v double")
    out = pit.rolling_rows(df, "e", ["d", "mid"], {"r": "v"}, 5, include_current=include_current, full_only=full_only)
    got = {(r.e, r.mid): r.r for r in out.collect()}
    for e in (1, None):
        seq = sorted([x for x in data if x[0] == e], key=lambda x: (x[1], x[2]))
        for i, x in enumerate(seq):
            frame = seq[max(0, i - 4):i + 1] if include_current else seq[max(0, i - 5):i]
            vals = [f[3] for f in frame if f[3] is not None]
            exp = (sum(vals) / len(vals)) if vals else None
            if full_only and len(vals) < 5:
                exp = None
            assert got[(e, x[2])] == pytest.approx(exp) if exp is not None else got[(e, x[2])] is None


@pytest.mark.parametrize("shift", [0.0, 1e9])
def test_cumulative_prior_matches_brute_force(spark, shift):
    data = [(1, D(2019 + i // 5, 1 + i % 12, 1 + i % 2), f"m{i:02d}", shift + float((i * 7) % 11)) for i in range(25)]
    df = spark.createDataFrame(data, "e int, d date, mid string, v double")
    out = {r.mid: r.vol for r in pit.cumulative_prior(df, "e", ["d", "mid"], "v", "vol").collect()}
    import statistics
    seq = sorted(data, key=lambda x: (x[1], x[2]))
    for i, x in enumerate(seq):
        prev = [p[3] for p in seq[:i]]
        exp = statistics.stdev(prev) if len(prev) > 1 else 11.0
        assert out[x[2]] == pytest.approx(exp)


def test_pairing_edges(spark):
    log = spark.createDataFrame([
        ("a", D(2024, 1, 1), 1, "T1 vs. T2", 100), ("a", D(2024, 1, 1), 2, "T2 @ T1", 90),
        ("b", D(2024, 1, 1), 3, "T3 vs. T4", 80),
        ("c", D(2024, 1, 1), 5, "T5 vs. T6", 70), ("c", D(2024, 1, 1), 6, "T6 vs. T5", 71),
        ("d", D(2024, 1, 1), 7, "T7 @ T8", 60), ("d", D(2024, 1, 1), 8, "T8 vs. T7", None),
        ("e", D(2024, 1, 1), 9, "T9 vs. T1", 1), ("e", D(2024, 1, 1), 10, "T10 @ T9", 2), ("e", D(2024, 1, 1), 11, "x", 3),
    ], "game_id string, game_date date, team_id int, matchup string, pts int")
    b1 = {r.game_id for r in R.pair_rows_to_match(log).collect()}
    assert b1 == {"a", "d", "e"}  # b: one row; c: both home
    b2 = {r.game_id: (r.home_team_id, r.away_team_id) for r in R.pair_rows_exactly_two(log).collect()}
    assert b2 == {"a": (1, 2), "c": (5, 6), "d": (8, 7)}
    b3 = {r.game_id: r.status for r in R.pair_rows_nullable(log).collect()}
    assert b3 == {"a": "final", "d": "scheduled", "e": "final"}


def test_parse_duration_and_safe_int(spark):
    vals = ["24:15", "24.25", "", None, "DNP", "1:2:3", " 12:30 ", "7"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [tuple(r) for r in df.select(S.parse_duration(F.col("x")), S.safe_int(F.col("x"))).collect()]
    assert got == [(24.25, None), (24.25, 24), (0.0, None), (0.0, None), (0.0, None), (0.0, None), (12.5, None), (7.0, 7)]


def test_season_and_business_date(spark):
    df = spark.createDataFrame([(D(2023, 9, 30),), (D(2023, 10, 1),)], "d date")
    assert [r[0] for r in df.select(S.season_start_year(F.col("d"))).collect()] == [2022, 2023]
    lab = spark.createDataFrame([("1999-00",), ("2024-25",)], "s string")
    assert [r[0] for r in lab.select(S.season_label_finish(F.col("s"))).collect()] == [2000, 2025]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 10, 8, 59),), (dt.datetime(2024, 1, 10, 9, 0),),
                                (dt.datetime(2024, 3, 10, 7, 59),), (dt.datetime(2024, 3, 10, 8, 0),),
                                (dt.datetime(2024, 11, 3, 7, 59),), (dt.datetime(2024, 11, 3, 9, 0),)],
                               "t timestamp_ntz")
    got = [r[0] for r in ts.select(S.business_date(F.col("t"))).collect()]
    # 03:59 EST -> previous day; 04:00 EST -> same day; 2024-03-10 is the spring DST day (EDT from 03:00)
    assert got == [D(2024, 1, 9), D(2024, 1, 10), D(2024, 3, 9), D(2024, 3, 10), D(2024, 11, 2), D(2024, 11, 3)]


def test_or_key_join_edges(spark):
    players = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 40)], "player_id int, team_id int")
    games = spark.createDataFrame([("g", 10, 10), ("h", 20, 30)], "game_id string, home_team_id int, away_team_id int")
    got = rows(J.or_key_join(players, games, "team_id", ["home_team_id", "away_team_id"], ["player_id", "game_id"]))
    assert got == [(1, "g"), (2, "h")]


def _tgt(spark):
    return spark.createDataFrame([(1, "final", 100, "x"), (2, "scheduled", None, "y")], "k int, status string, pts int, note string")


def test_upsert_edges(spark):
    src = spark.createDataFrame([(2, "final", None), (3, "scheduled", 5)], "k int, status string, pts int")
    u1 = rows(U.upsert_replace(_tgt(spark), src, "k"))
    assert u1 == [(1, "final", 100, "x"), (2, "final", None, "y"), (3, "scheduled", 5, None)]
    u2 = rows(U.upsert_columns(_tgt(spark), src, "k", ["status"]))
    assert u2 == [(1, "final", 100, "x"), (2, "final", None, "y"), (3, "scheduled", 5, None)]
    u3 = rows(U.insert_if_absent(_tgt(spark), src.withColumn("note", F.lit("z")), "k"))
    assert u3 == [(1, "final", 100, "x"), (2, "scheduled", None, "y"), (3, "scheduled", 5, "z")]
    regress = spark.createDataFrame([(1, "scheduled")], "k int, status string")
    u6 = rows(U.upsert_priority(_tgt(spark), regress, "k", ["status"]))
    assert u6[0] == (1, "final", 100, "x")
    u6b = rows(U.upsert_priority(_tgt(spark), regress, "k", ["status"], allow_regress=True))
    assert u6b[0] == (1, "scheduled", 100, "x")
    # idempotent
    once = U.upsert_replace(_tgt(spark), src, "k")
    assert rows(U.upsert_replace(once, src, "k")) == rows(once)


def test_upsert_duplicate_source_key_fails(spark):
    dup = spark.createDataFrame([(2, "final", 1), (2, "final", 2)], "k int, status string, pts int")
    with pytest.raises(Exception, match="duplicate key"):
        U.upsert_replace(_tgt(spark), dup, "k").collect()


def test_merge_map_edges(spark):
    t = spark.createDataFrame([(1, {"a": 1.0, "b": 2.0}), (2, None)], "k int, doc map<string,double>")
    s = spark.createDataFrame([(1, {"b": 20.0, "c": 3.0}), (2, {"a": 5.0}), (3, {"z": 0.0})], "k int, doc map<string,double>")
    got = {r.k: r.doc for r in U.upsert_merge_map(t, s, "k", doc="doc").collect()}
    assert got == {1: {"a": 1.0, "b": 20.0, "c": 3.0}, 2: {"a": 5.0}, 3: {"z": 0.0}}
    keep = {r.k: r.doc for r in U.upsert_merge_map(t, s, "k", doc="doc", keep_old=True).collect()}
    assert keep == {1: {"a": 1.0, "b": 2.0}, 2: {}, 3: {"z": 0.0}}


def test_rank_ties_and_labels(spark):
    df = spark.createDataFrame([("2001-02", "A", 1.0, 1.0, "Won Finals"), ("2001-02", "B", 1.0, 2.0, None),
                                ("2001-02", "C", 0.5, 2.0, "Lost E. Conf. Finals Won Finals"),
                                ("2001-02", "D", None, 0.0, "Lost Finals")],
                               "season string, team string, rel_ortg double, rel_drtg double, playoffs string")
    r = {x.team: x for x in K.season_ranks(df).collect()}
    assert set(r) == {"A", "B", "C"}
    assert (r["A"].off_rank, r["B"].off_rank, r["C"].off_rank) == (1, 1, 3)
    assert (r["A"].def_rank, r["B"].def_rank, r["C"].def_rank) == (1, 2, 2)
    assert r["B"].outcome == "Missed Playoffs" and r["C"].outcome == "Finals Winner"
    assert r["A"].contender_score == pytest.approx(10 * (30 + 30) / 60)


def test_imputation_edges(spark):
    df = spark.createDataFrame([(1, "n1", "a", None), (2, "n1", "b", 4.0), (3, "n2", "b", None), (4, "n2", "a", None),
                                (5, "n3", None, 8.0)], "id int, g string, cat string, v double")
    assert rows(X.fill_mode(df, ["cat"]).select("id", "cat"))[4] == (5, "a")  # tie a/b -> smallest
    med = dict(rows(X.fill_group_median(df, "g", "v").select("id", "v")))
    assert med == {1: 4.0, 2: 4.0, 3: 4.0, 4: 4.0, 5: 8.0}  # all-NULL group n2 -> median of the filled column (4, 4, 8)


def test_target_encode_edges(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 0, "train"), (2, "a", 3.0, 1, "train"), (3, "b", 5.0, 0, "train"),
                                (4, "c", 7.0, 2, "train"), (5, "zz", None, 0, "test"), (6, "a", None, 3, "test")],
                               "id int, cat string, y double, fold int, origin string")
    te = dict(rows(X.target_encode_oof(df, "cat", "y").select("id", "te")))
    glob = 4.0  # median of 1, 3, 5, 7
    assert te == {1: 3.0, 2: 1.0, 3: glob, 4: glob, 5: glob, 6: 2.0}


def test_standardise_constant_column(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, x double")
    assert [r.x_z for r in X.standardise(df, ["x"], df).collect()] == [0.0, 0.0]


def test_grading_edges(spark):
    hist = spark.createDataFrame([("a", 0.5, 100.0, 90.0, None, None), ("b", 0.7, 100.0, 90.0, None, None),
                                  ("c", 0.2, 90.0, 95.0, 1, 2)],
                                 "game_id string, pred_home_prob double, pred_home_score double, pred_away_score double, "
                                 "actual_home_score int, actual_away_score int")
    games = spark.createDataFrame([("a", "Final", 100, 90), ("b", "final", 99, 99), ("c", "final", 80, 70)],
                                  "game_id string, status string, home_pts int, away_pts int")
    g = {r.game_id: r for r in V.grade_predictions(hist, games).collect()}
    assert g["a"].correct_winner is False and g["a"].error_margin == 0.0   # p = 0.5 counts wrong
    assert g["b"].correct_winner is False                                 # tie: neither side won
    assert g["c"].actual_home_score == 1 and g["c"].correct_winner is None  # already graded: untouched


def test_metric_edges(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 1.0), (1, 0.5), (0, 0.5)], "y int, p double")
    m = V.class_metrics(df, "y", "p", 0.99).first()
    assert (m.tp, m.fp) == (0, 1) and m.precision == 0.0
    none = V.class_metrics(df, "y", "p", 1.0).first()
    assert none.precision is None  # no predicted positive
    pm = V.prob_metrics(df, "y", "p").first()
    assert pm.auc == pytest.approx(0.125)  # 4 pos/neg pairs: only the tied one scores (a half)
    assert pm.log_loss > 10                # p = 0 / 1 clipped, not infinite
    one = V.prob_metrics(df.where("y = 1"), "y", "p").first()
    assert one.auc is None


def test_stratified_split_exact(spark):
    df = spark.createDataFrame([(f"k{i}", i % 3 == 0) for i in range(101)], "k string, lab boolean")
    out = X.stratified_split(df, "lab", "k", test_share=0.2)
    counts = {(r.lab, r.split): r.n for r in out.groupBy("lab", "split").agg(F.count("*").alias("n")).collect()}
    import math
    for lab, n in ((True, 34), (False, 67)):
        assert counts[(lab, "test")] == math.ceil(0.2 * n)


def test_chunked_frames_equal_plain_windows_on_player_logs(spark, monkeypatch):
    from conftest import SF_SMALL
    from pyspark.sql import Window
    from pitlane.plans import q_pit
    from pitlane.sources.fixtures import Tables
    monkeypatch.setattr(pit, "CHUNK_ROWS", 25)
    rows_ = q_pit._player_rows(Tables(spark, SF_SMALL))
    rows_ = rows_.withColumn("player_id", F.when(F.col("player_id") % 3 > 0, F.col("player_id")))  # a third in the NULL entity
    aggs = {o: ("avg", c, -k, -1) for o, (c, k) in q_pit._PLAYER_FRAMES.items()}
    aggs |= {"max_pts_3": ("max", "pts", -3, 0), "sd_pts_4": ("stddev_samp", "pts", -4, -1), "n_4": ("count", "pts", -4, -1), "sum_4": ("sum", "pts", -4, 0)}
    order = [*q_pit._PLAYER_ORDER, "pts", "reb", "ast"]
    a = pit.trailing(rows_, "player_id", order, aggs)
    fns = {"avg": F.avg, "max": F.max, "stddev_samp": F.stddev_samp, "count": F.count, "sum": F.sum}
    w = Window.partitionBy("player_id").orderBy(*order)
    b = rows_.select("*", *[fns[fn](c).over(w.rowsBetween(x, y)).alias(name) for name, (fn, c, x, y) in aggs.items()])
    assert a.schema == b.schema
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("float_buckets", [1, 1 << 18])
def test_exact_quantiles(spark, monkeypatch, float_buckets):
    from pitlane.operators import positions
    from pitlane.operators.aggregate import exact_quantiles, group_mode
    import numpy as np
    monkeypatch.setattr(positions, "FLOAT_BUCKETS", float_buckets)
    rng = np.random.default_rng(7)
    inf = float("inf")
    data = [("hot", float(v)) for v in rng.lognormal(size=3000)] + [("hot", 1.5)] * 200 + \
           [("small", v) for v in (3.0, 1.0, 2.0, None)] + [("one", 4.0), ("nulls", None)] + \
           [(None, v) for v in (1.0, 2.0, 3.0)] + [("wide", v) for v in (-inf, -1e300, -1e-300, 0.0, 1e-300, 1e300, inf)] + \
           [("far", 1e9 + i) for i in range(101)]
    df = spark.createDataFrame(data, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r for r in exact_quantiles(df, ["g"], "x", probs).collect()}
    for g in ("hot", "small", "one", None, "far"):
        xs = np.array([v for k, v in data if k == g and v is not None])
        for i, p in enumerate(probs):
            assert got[g][f"q{i}"] == pytest.approx(float(np.quantile(xs, p)), rel=1e-12)
    assert got["nulls"]["q0"] is None and (got["wide"]["q0"], got["wide"]["q2"], got["wide"]["q4"]) == (-inf, 0.0, inf)
    glob = exact_quantiles(df, [], "x", [0.5]).first()[0]
    assert glob == pytest.approx(float(np.median([v for _, v in data if v is not None])))
    assert exact_quantiles(df.limit(0), [], "x", [0.5]).collect()[0][0] is None
    modes = {r.g: r.mode_x for r in group_mode(df, ["g"], "x").collect()}
    assert modes["hot"] == 1.5 and modes["small"] == 1.0
    assert [r[0] for r in group_mode(df.where("x is null"), [], "x").collect()] == [None]


@pytest.mark.parametrize("bucket", ["day", "hour", None])
def test_asof_timestamps_bucketed(spark, bucket):
    import random
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    ev = [(rnd.choice([1, 2]), base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 5)), float(i)) for i in range(300)]
    rq = [(rnd.choice([1, 2, 3]), base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 6))) for _ in range(200)]
    evdf = spark.createDataFrame(ev, "e int, t timestamp_ntz, v double")
    rqdf = spark.createDataFrame(rq, "e int, t timestamp_ntz")
    out = pit.asof_last_before(rqdf, evdf, "e", "t", "t", values=["v"], out_time="lt", bucket=bucket)
    got = sorted((r.e, r.t, r.lt, r.v) for r in out.collect())
    exp = []
    for e, t in rq:
        prior = [x for x in ev if x[0] == e and x[1] < t]
        if prior:
            lt = max(x[1] for x in prior)
            v = max(x[2] for x in prior if x[1] == lt)
            exp.append((e, t, lt, v))
        else:
            exp.append((e, t, None, None))
    assert got == sorted(exp)


def test_day_documents_split_hot_day(spark):
    from pitlane.sources.sinks import day_documents
    games = spark.createDataFrame([(D(2024, 1, 1), f"g{i:03d}", i) for i in range(250)] + [(D(2024, 1, 2), "x", 1)],
                                  "day date, game_id string, pts int")
    props = spark.createDataFrame([(D(2024, 1, d), i) for d in (1, 2) for i in range(9)], "day date, gap int")
    docs = day_documents(games, "day", ["game_id", "pts"], props, ["gap"], ["gap"], max_items=100).collect()
    hot = sorted((r for r in docs if r.day == D(2024, 1, 1)), key=lambda r: r.part)
    assert [r.part for r in hot] == [0, 1, 2] and [g.game_id for r in hot for g in r.games] == [f"g{i:03d}" for i in range(250)]
    assert [len(r.games) for r in docs if r.day == D(2024, 1, 2)] == [1]
    assert {(r.day.day, r.part): len(r.top_props) for r in docs} == {(1, 0): 5, (1, 1): 0, (1, 2): 0, (2, 0): 5}
    tiny = day_documents(games, "day", ["game_id", "pts"], props, ["gap"], ["gap"], max_items=1).collect()
    assert sum(len(r.top_props) for r in tiny) == 10


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("kind", ["double", "bigint", "string", "date"])
def test_rank_in_group_equals_window(spark, ascending, kind):
    from pyspark.sql import Window
    data = [("s1", float(v % 17) if v % 11 else None) for v in range(300)] + [("s2", 1.0), ("s2", 1.0), ("s2", 0.5)] + [(None, 3.0), (None, 2.0), (None, None)]
    df = spark.createDataFrame(data, "g string, x double").withColumn("id", F.monotonically_increasing_id())
    x = {"double": F.when(F.col("x") == 3, float("inf")).when(F.col("x") == 4, float("nan")).otherwise(F.col("x")), "bigint": (F.col("x") + F.lit(2**53)).cast("bigint"),
         "string": F.concat(F.lit("name "), F.col("x").cast("string")), "date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("x").cast("int"))}[kind]
    if kind == "bigint":
        x = F.when(F.col("x") == 1, F.lit(2**53 + 1)).when(F.col("x") == 2, F.lit(2**53)).otherwise(F.col("x").cast("bigint"))
    df = df.withColumn("x", x)
    a = {r.id: r.rk for r in K.rank_in_group(df, "g", "x", "rk", ascending).collect()}
    o = F.col("x").asc() if ascending else F.col("x").desc()
    b = {r.id: r.rk for r in df.withColumn("rk", F.rank().over(Window.partitionBy("g").orderBy(o))).collect()}
    assert a == b


def test_stratified_split_keeps_null_labels_and_keys(spark):
    df = spark.createDataFrame([(f"k{i}" if i % 5 else None, None if i % 4 == 0 else i % 2) for i in range(40)], "k string, lab int")
    out = X.stratified_split(df, "lab", "k")
    assert out.count() == 40 and out.where("lab is null and split = 'test'").count() == 2


def test_fill_mode_of_an_empty_column(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "id int, x string, y string")
    assert rows(X.fill_mode(df, ["x", "y"])) == [(1, None, "a"), (2, None, "a")]


def test_one_hot_many_and_declared(spark):
    df = spark.createDataFrame([(i, f"c{i:03d}") for i in range(150)] + [(150, None)], "id int, c string")
    assert len(X.one_hot(df, "c").columns) == 152
    few = X.one_hot(df, "c", categories=["c001", "zzz"])
    assert few.columns == ["id", "c", "c_c001", "c_zzz"] and few.agg(F.sum("c_c001")).first()[0] == 1
    assert X.one_hot_vector(df, "c", "v").where("id = 3").first().v.size == 150


def test_merge_map_keeps_null_of_unlisted_columns(spark):
    t = spark.createDataFrame([(1, {"a": 1.0}, None), (2, {"b": 1.0}, 5)], "k int, feature_json map<string,double>, other int")
    s = spark.createDataFrame([(1, {"a": 2.0}, 7), (3, {"c": 1.0}, 8)], "k int, feature_json map<string,double>, other int")
    got = {r.k: (r.feature_json, r.other) for r in U.upsert_merge_map(t, s, ["k"]).collect()}
    assert got == {1: ({"a": 2.0}, None), 2: ({"b": 1.0}, 5), 3: ({"c": 1.0}, 8)}


def test_upsert_replace_rejects_unknown_columns(spark):
    t = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="extra"):
        U.upsert_replace(t, t.withColumn("extra", F.lit(1)), ["k"])


def test_or_key_join_without_right_keys_is_distinct(spark):
    left = spark.createDataFrame([(1, "x")], "team int, name string")
    games = spark.createDataFrame([("d", 1, 2), ("d", 3, 1), ("d", 1, 1)], "day string, home int, away int")
    assert J.or_key_join(left, games, "team", ["home", "away"], ["team", "day"]).count() == 1


def test_grading_with_a_match_finished_twice(spark):
    hist = spark.createDataFrame([("g", 0.7, 100.0, 90.0, None, None)], "game_id string, pred_home_prob double, pred_home_score double, pred_away_score double, actual_home_score int, actual_away_score int")
    games = spark.createDataFrame([("g", "final", 101, 99), ("g", "Final ", 101, 99)], "game_id string, status string, home_pts int, away_pts int")
    assert V.grade_predictions(hist, games).count() == 1
    with pytest.raises(Exception, match="duplicate key"):
        V.grade_predictions(hist, games.union(spark.createDataFrame([("g", "final", 1, 2)], games.schema))).collect()


def test_dual_side_join_contract(spark):
    m = spark.createDataFrame([("g", 1, 2, {"a": 1})], "game_id string, home_team_id int, away_team_id int, extra map<string,int>")
    e = spark.createDataFrame([("g", 1, 5), ("g", 2, 6)], "game_id string, team_id int, form int")
    r = J.dual_side_join(m, e, ["form"]).collect()[0]
    assert (r.home_form, r.away_form, r.extra) == (5, 6, {"a": 1})
    for a, b in ((m.union(m), e), (m, e.union(e))):
        with pytest.raises(Exception, match="more than one row"):
            J.dual_side_join(a, b, ["form"]).collect()


def test_stream_merge_does_not_lose_the_table(spark, tmp_path, monkeypatch):
    from pitlane.sources import sinks
    from pitlane.streaming import incremental
    base = str(tmp_path / "t")
    assert not sinks.has_snapshot(spark, base)
    sinks.write_snapshot(spark.range(1000).selectExpr("id as k", "id as v"), base)
    batch = spark.range(998, 1001).selectExpr("id as k", "-id as v")
    merge = incremental._merge_batch(base, ["k"], "insert")

    def broken(*a, **b):
        raise OSError("read error")

    with monkeypatch.context() as m:
        m.setattr(incremental, "read_snapshot", broken)
        with pytest.raises(OSError):
            merge(batch, 0)
    assert sinks.read_snapshot(spark, base).count() == 1000
    merge(batch, 0)
    merge(batch, 0)  # a replay changes nothing
    assert sinks.read_snapshot(spark, base).agg(F.count("*"), F.sum("v")).first() == (1001, sum(range(1000)) - 1000)
    assert sinks.expire_snapshots(spark, base, keep=1) == 2 and sinks.read_snapshot(spark, base).count() == 1001


def test_session_keeps_submitted_settings():
    import subprocess
    import sys
    code = ("from pitlane.session import get_session; s = get_session('local[1]');"
            "print('PARTS', s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'))")
    env = {**__import__("os").environ, "PYSPARK_SUBMIT_ARGS": "--conf spark.sql.shuffle.partitions=400 --conf spark.ui.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=env, timeout=120, cwd=__import__("conftest").ROOT)
    assert "PARTS 400 UTC" in out.stdout, out.stderr[-500:]


def test_evolve_schema_edges(spark):
    df = spark.createDataFrame([(1, "a")], "ID int, Name string")
    out = U.evolve_schema(df, renames={"player_id": ["id", "person_id"], "name": []},
                          add={"team_id": (None, "int"), "NAME": ("x", "string")})
    assert out.columns == ["player_id", "name", "team_id"]   # alias renamed, case fixed, existing column not re-added
    assert rows(out) == [(1, "a", None)]


def test_quality_checks_flags_problems(spark):
    from pitlane.operators.quality import quality_checks
    df = spark.createDataFrame([(1, D(2024, 1, 1)), (1, D(2024, 1, 2)), (None, D(2024, 1, 3))], "k int, d date")
    got = {r.check: (r.value, r.ok) for r in quality_checks(df, "t", ["k"], date="d", as_of="2024-01-05",
                                                            expected_columns=["k", "d", "extra"]).collect()}
    assert got["row_count"] == (3, True) and got["null_keys"] == (1, False)
    assert got["duplicate_keys"] == (1, False) and got["recent_rows"] == (3, True)
    assert got["column_parity"] == (1, False)


def test_update_from_rejects_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, 10)], "k int, v int")
    s = spark.createDataFrame([(1, 20), (1, 30)], "k int, v int")
    with pytest.raises(Exception, match="duplicate key"):
        U.update_from(t, s, "k", {"v": "v"}).collect()
    ok = spark.createDataFrame([(1, 20), (2, 30)], "k int, v int")
    assert rows(U.update_from(t, ok, "k", {"v": "v"})) == [(1, 20)]   # no row added


def test_null_groups_keep_median_mode_and_winner(spark):
    from pitlane.operators.aggregate import group_median_mode
    from pitlane.operators.ranking import group_report
    df = spark.createDataFrame([(None, 1.0, "a"), (None, 3.0, "a"), ("g", None, None), ("g", 5.0, "b"), ("h", None, None)], "k string, x double, m string")
    got = {r.k: (r.median_x, r.mode_m) for r in group_median_mode(df, "k", ["x"], ["m"]).collect()}
    assert got == {None: (2.0, "a"), "g": (5.0, "b"), "h": (None, None)}
    rep = group_report(spark.createDataFrame([(None, "won", "A"), (None, "lost", "B"), (1, "lost", "C")], "y int, l string, n string"), "y", "l", "won", "n")
    assert sorted((str(r.y), r.n, r.champion) for r in rep.collect()) == [("1", "C", None), ("None", "A", "A"), ("None", "B", "A")]


def test_target_encoding_by_subtraction(spark):
    import random
    from statistics import median
    from pitlane.operators.features import target_encode_oof
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", None, "rare"]) if i % 40 else f"only{i}", rng.choice([None, 1e9, -3.5, *range(6)]), rng.choice([0, 1, 2, None]), rng.choice(["train", "train", "test"])) for i in range(300)]
    rows = [(i, c, None if y is None else float(y), f, o) for i, c, y, f, o in rows]
    df = spark.createDataFrame(rows, "id int, cat string, y double, fold int, origin string")
    got = {r.id: r.te for r in target_encode_oof(df, "cat", "y", k=3).collect()}
    train = [r for r in rows if r[4] == "train" and r[2] is not None]
    whole = median(r[2] for r in train)
    for i, c, _, f, o in rows:
        own = [r[2] for r in train if r[1] == c and (o == "test" or r[3] != f)]
        want = whole if (o == "train" and f is None) or not own else median(own)
        assert got[i] == want, (i, c, f, o)
    assert target_encode_oof(df.limit(0), "cat", "y", k=3).count() == 0


def test_or_key_join_of_one_date(spark):
    from pitlane.operators.joins import or_key_join
    left = spark.createDataFrame([(1, "p"), (2, "q"), (1, "p")], "t int, n string")
    right = spark.createDataFrame([(9, 1, 2, "d1"), (8, 2, 1, "d2"), (7, 1, 1, "d1")], "g int, h int, a int, d string")
    got = or_key_join(left, right, "t", ["h", "a"], ["n", "g"], where=F.col("d") == "d1")
    assert sorted(tuple(r) for r in got.collect()) == [("p", 7), ("p", 9), ("q", 9)]


@pytest.mark.parametrize("inclusive", [False, True])
def test_asof_has_one_row_for_each_time(spark, inclusive):
    """Both sides go through one aggregate, so an entity's window holds a time once; null entities, null times and repeated rows as ever."""
    ev = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 3, None), (None, 2, "n"), (1, None, "z"), (2, 5, "q")], "e int, t int, v string")
    rq = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, 3), (1, 4), (None, 2), (None, 3), (1, None), (2, 1), (3, 1)], "e int, t int")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("t"))
    ev, rq = ev.withColumn("t", day), rq.withColumn("t", day)
    out = pit.asof_last_before(rq, ev, "e", "t", "t", values=["v"], out_time="lt", inclusive=inclusive)
    assert out._jdf.queryExecution().executedPlan().toString().count("HashAggregate") + out._jdf.queryExecution().executedPlan().toString().count("SortAggregate") == 2
    got = sorted((r.e or 0, r.t.day - 1 if r.t else 0, r.lt.day - 1 if r.lt else None, r.v) for r in out.collect())
    first = (1, 1, 1, "b") if inclusive else (1, 1, None, "z")
    third = (1, 3, 3, None) if inclusive else (1, 3, 1, "b")
    null2 = (0, 2, 2, "n") if inclusive else (0, 2, None, None)
    assert got == sorted([first, (1, 2, 1, "b"), (1, 2, 1, "b"), third, (1, 4, 3, None), null2, (0, 3, 2, "n"), (1, 0, None, None), (2, 1, None, None), (3, 1, None, None)], key=lambda r: r[:2])


def test_or_key_join_result_is_small(spark, tmp_path):
    """Every player meets every game of its team: the rows are many, their bytes in a columnar file few."""
    players = spark.range(400).select((F.col("id") % 2).cast("int").alias("team"), F.col("id").alias("player"), F.concat(F.lit("p#"), F.xxhash64("id")).alias("name"))
    players = players.union(spark.createDataFrame([(None, -1, "n")], players.schema))
    games = spark.range(4_000).select(F.when(F.col("id") % 50 != 0, F.lit(0)).alias("home"), F.when(F.col("id") % 3 != 0, F.lit(1)).otherwise(0).alias("away"), F.concat(F.lit("g"), F.xxhash64("id")).alias("game"))
    out = J.or_key_join(players, games.union(games), "team", ["home", "away"])
    out.coalesce(1).write.parquet(path := str(tmp_path / "out"))
    both = spark.read.parquet(path)
    want = games.selectExpr("sum(int(coalesce(home = 0, false) OR away = 0) + int(away = 1))").first()[0] * 200
    assert both.count() == both.distinct().count() == want
    assert both.where("team NOT IN (home, away)").count() == 0 and both.where("home IS NULL").count() > 0
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < want


def test_or_key_join_unfolds_lists_in_many_tasks(spark, tmp_path):
    """A few KB of lists give hundreds of thousands of rows: no task unfolds most of them."""
    spark.range(400).select((F.col("id") % 4).cast("int").alias("team"), F.col("id").alias("player")).write.parquet(a := str(tmp_path / "players"))
    spark.range(20_000).select((F.col("id") % 4).cast("int").alias("home"), ((F.col("id") + 1) % 4).cast("int").alias("away"), F.col("id").alias("game")).write.parquet(b := str(tmp_path / "games"))
    out = J.or_key_join(spark.read.parquet(a), spark.read.parquet(b), "team", ["home", "away"])
    by_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(by_task) == 100 * 40_000 and max(by_task) < sum(by_task) / 8
