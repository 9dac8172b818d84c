"""Gram models and Newton logistic regression against numpy on the plain rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitlane.operators import gram
from pitlane.operators import ml as M
from pitlane.operators.logit import logit_inference, newton_logit

FEATS = ["a", "b", "c"]


def table(spark, n=400, seed=1, parts=5):
    """Rows (id, fold, slice, day, origin, a, b, c, y, t) with missing and constant features and missing labels."""
    rng = np.random.default_rng(seed)
    x = rng.normal([5, -3, 100], [1, 2, 10], (n, 3))
    y = 2 * x[:, 0] - x[:, 1] + 0.1 * x[:, 2] + rng.normal(0, 1, n)
    rows = []
    for i in range(n):
        v = [None if rng.random() < 0.1 else float(q) for q in x[i]]
        rows.append((i, int(i * 7 % 5), int(i * 3 % 4), int(i // 40), "test" if i % 9 == 0 else "train", *v, None if i % 50 == 3 else float(y[i]), float(y[i] > np.median(y))))
    return spark.createDataFrame(rows, "id int, fold int, slice int, day int, origin string, a double, b double, c double, y double, t double").repartition(parts), rows


def design(rows):
    x = np.array([[np.nan if v is None else v for v in r[5:8]] for r in rows], float)
    return x, np.array([np.nan if r[8] is None else r[8] for r in rows], float)


def plain_ridge(x, y, alpha):
    """(prediction function) of scikit-learn's mean imputer, scaler and ridge."""
    ok = ~np.isnan(y)
    x, y = x[ok], y[ok]
    mean = np.nanmean(x, 0)
    z = np.where(np.isnan(x), mean, x)
    sd = z.std(0)
    sd[sd == 0] = 1
    z = (z - mean) / sd
    b = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    return lambda q: y.mean() + (np.where(np.isnan(q), mean, q) - mean) / sd @ b


def test_out_of_fold_against_separate_fits(spark):
    df, rows = table(spark)
    got = {r.id: r.oof for r in gram.oof_linear(df, "id", FEATS, "y", gram.ridge(3.0)).collect()}
    x, y = design(rows)
    fold, train = np.array([r[1] for r in rows]), np.array([r[4] == "train" for r in rows])
    fits = [plain_ridge(x[train & (fold != f)], y[train & (fold != f)], 3.0) for f in range(5)]
    for i, r in enumerate(rows):
        want = fits[r[1]](x[i]) if r[4] == "train" else np.mean([f(x[i]) for f in fits])
        assert got[i] == pytest.approx(want, rel=1e-8)


def test_no_row_sees_its_own_fold(spark):
    df, _ = table(spark)
    changed = df.withColumn("y", F.when(F.col("fold") == 2, F.col("y") * 100 + 7).otherwise(F.col("y")))
    before, after = ({r.id: r for r in gram.oof_linear(d, "id", FEATS, "y", gram.ridge(1.0)).collect()} for d in (df, changed))
    fold = {r.id: r.fold for r in df.collect()}
    same = {i for i in before if before[i].oof == pytest.approx(after[i].oof, rel=1e-9)}
    assert same == {i for i in before if before[i].origin == "train" and fold[i] == 2}


def test_one_exchange_for_all_folds(spark):
    df, _ = table(spark)
    plan = gram.gram_sums(df, FEATS, ["y"], ["fold"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("reg,ratio", [(0.01, 1.0), (0.3, 0.9), (2.5, 0.5), (50.0, 1.0), (0.0, 1.0)])
def test_elastic_net_is_optimal(spark, reg, ratio):
    df, rows = table(spark)
    m = gram.fit_linear(df, FEATS, ["y"], [gram.elastic_net(reg, ratio)]).first()
    x, y = design(rows)
    ok = ~np.isnan(y)
    z, mean = x[ok], np.nanmean(x[ok], 0)
    z = np.where(np.isnan(z), mean, z)
    sd = z.std(0)
    b, z, y = np.array(m.coef) * sd, (z - mean) / sd, y[ok] - y[ok].mean()
    pull = z.T @ (y - z @ b) / len(y) - reg * (1 - ratio) * b  # gradient against the penalty
    for g, c in zip(pull, b):
        assert (abs(g) <= reg * ratio + 1e-7) if c == 0 else g == pytest.approx(reg * ratio * np.sign(c), abs=1e-7)
    assert m.gap <= 1e-12 and (reg < 50 or not b.any())


def test_walk_forward_uses_earlier_dates_only(spark):
    df, rows = table(spark)
    replay = df.select("day").distinct().where("day in (0, 4, 9)")
    got = {r.id: r for r in gram.walk_forward(df, FEATS, ["y", "t"], "day", replay, gram.ridge(1.0)).collect()}
    x, y = design(rows)
    day, t = np.array([r[3] for r in rows]), np.array([r[9] for r in rows])
    assert set(got) == {r[0] for r in rows if r[3] in (0, 4, 9)}
    for i, r in got.items():
        if day[i] == 0:
            assert r.pred_y is None
            continue
        ok = (day < day[i]) & ~np.isnan(y)
        assert r.pred_y == pytest.approx(plain_ridge(x[ok], y[ok], 1.0)(x[i]), rel=1e-8)
        assert r.pred_t == pytest.approx(plain_ridge(x[ok], t[ok], 1.0)(x[i]), rel=1e-8)


def test_halving_scores_equal_full_fits(spark):
    df, rows = table(spark)
    alphas = [0.1, 1.0, 10.0, 100.0, 1000.0, 5.0]
    got = [tuple(r) for r in gram.halving(df, FEATS, "y", [gram.ridge(a) for a in alphas], rounds=((1, 3), (2, 2), (4, 0))).collect()]
    x, y = design(rows)
    fold, part, ok = np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), ~np.isnan(y)
    left, want = list(range(6)), []
    for r, (slices, keep) in enumerate(((1, 3), (2, 2), (4, 0))):
        scores = []
        for c in left:
            e = []
            for f in range(5):
                out = ok & (part < slices)
                fit = plain_ridge(x[out & (fold != f)], y[out & (fold != f)], alphas[c])
                e.append(np.sqrt(np.mean((y[out & (fold == f)] - fit(x[out & (fold == f)])) ** 2)))
            scores.append((np.mean(e), c))
        want += [(r, c, s) for s, c in sorted(scores)]
        left = [c for _, c in sorted(scores)[:keep]]
    assert sorted(x[:2] for x in got) == sorted(x[:2] for x in want)
    assert [s for *_, s in sorted(got)] == pytest.approx([s for *_, s in sorted(want)], rel=1e-8)


def test_empty_missing_and_constant(spark):
    df, _ = table(spark)
    assert gram.fit_linear(df.limit(0), FEATS, ["y"], [gram.ridge(1.0)]).collect() == []
    assert gram.oof_linear(df.limit(0), "id", FEATS, "y", gram.ridge(1.0)).collect() == []
    odd = df.withColumn("a", F.lit(None).cast("double")).withColumn("b", F.lit(7.0)).withColumn("c", F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("c")))
    m = gram.fit_linear(odd, FEATS, ["y"], [gram.ridge(1.0), gram.elastic_net(0.1, 1.0)]).collect()
    assert all(r.coef[0] == r.coef[1] == 0 and math.isfinite(r.coef[2]) for r in m)
    assert all(math.isfinite(r.p) for r in gram.score_linear(odd, FEATS, spark.createDataFrame(m[:1]), ["p"]).collect())


def test_penalised_logit_solves_its_equations(spark):
    df, rows = table(spark)
    fit = newton_logit(df, FEATS, "t", balanced=True, C=0.7)
    x, t = design(rows)[0], np.array([r[9] for r in rows])
    mean = np.nanmean(x, 0)
    z = np.where(np.isnan(x), mean, x)
    z = np.append((z - mean) / z.std(0), np.ones((len(z), 1)), 1)
    w = np.where(t == 1, len(t) / (2 * t.sum()), len(t) / (2 * (len(t) - t.sum())))
    p = 1 / (1 + np.exp(-z @ fit.coef))
    assert 0.7 * z.T @ (w * (t - p)) == pytest.approx(fit.coef, abs=1e-6) and fit.converged
    got = {r.id: r.p for r in df.select("id", fit.probability().alias("p")).collect()}
    assert [got[i] for i in range(len(rows))] == pytest.approx(p, rel=1e-8)


def test_inference_against_information(spark):
    df, rows = table(spark)
    got = {r.term: r for r in logit_inference(df, FEATS, "t").collect()}
    x, t = design(rows)[0], np.array([r[9] for r in rows])
    ok = ~np.isnan(x).any(1)
    z, t = np.append(x[ok], np.ones((ok.sum(), 1)), 1), t[ok]
    b = np.array([got[k].coef for k in [*FEATS, "intercept"]])
    p = 1 / (1 + np.exp(-z @ b))
    assert np.abs(z.T @ (t - p) / np.abs(z).sum(0)).max() < 1e-7
    err = np.sqrt(np.diag(np.linalg.inv((z * (p * (1 - p))[:, None]).T @ z)))
    assert [got[k].std_err for k in [*FEATS, "intercept"]] == pytest.approx(err, rel=1e-5)
    assert all(r.p_value == pytest.approx(math.erfc(abs(r.coef / r.std_err) / math.sqrt(2))) and not r.separated for r in got.values())


def test_separated_classes_are_recognised(spark):
    df = spark.createDataFrame([(float(i), float(i > 9)) for i in range(20)], "a double, t double")
    out = logit_inference(df, ["a"], "t").collect()
    assert all(r.separated and r.coef is None for r in out) and out[0].pseudo_r2 == pytest.approx(1, abs=1e-4)
    assert all(r.separated for r in logit_inference(df.where("t = 1"), ["a"], "t").collect())
    assert [r.coef for r in logit_inference(df.limit(0), ["a"], "t").collect()] == [None, None]
    bounded = newton_logit(df, ["a"], "t", C=1.0)
    assert bounded.converged and not bounded.separated


@pytest.mark.parametrize("kind", ["gbt", "forest regressor", "forest classifier"])
def test_trees_beat_a_constant_and_repeat(spark, kind):
    df, _ = table(spark, 600)
    df = df.where("y is not null").fillna(0.0)
    label = "t" if "classifier" in kind else "y"
    fit = {"gbt": lambda d: M.fit_gbt(d, FEATS, label, max_iter=15), "forest regressor": lambda d: M.fit_random_forest(d, FEATS, label, classifier=False, trees=30),
           "forest classifier": lambda d: M.fit_random_forest(d, FEATS, label, trees=30)}[kind]
    train, test = df.where("fold < 4").repartition(1).sortWithinPartitions("id"), df.where("fold = 4")
    got = [[(r.y, r.t, r.prediction) for r in M.score_batch(fit(train), test, ["id", "y", "t"]).orderBy("id").collect()] for _ in range(2)]
    assert got[0] == got[1]
    y = np.array([r[0 if label == "y" else 1] for r in got[0]])
    e = np.array([r[2] for r in got[0]]) - y
    assert (e**2).mean() < 0.6 * (y - y.mean()).var() if label == "y" else (e != 0).mean() < 0.3
