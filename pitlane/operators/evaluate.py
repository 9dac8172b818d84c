"""Scoring projections, grading and evaluation metrics.

Metrics are aggregates (map-side partial, one final row).  AUC needs ranks;
instead of a global rank window (one task, trap T8) positives and negatives
are counted per probability value, prefix counts over 2^20 value buckets come
from one window over at most that many (small) bucket rows, and only values
inside a bucket use a window partitioned by bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Published residual sigmas of the score models and the 95% normal quantile.
SIGMA_MARGIN = 15.877148430658387
SIGMA_TOTAL = 20.795709473221258
Z95 = 1.959964


def split_scores(total: Column, margin: Column) -> tuple[Column, Column]:
    """L1: home = (total + margin) / 2, away = (total - margin) / 2."""
    return (total + margin) / 2.0, (total - margin) / 2.0


def adjust_by_bridge(total: Column, margin: Column, pf_bias: Column, home_bias: Column,
                     k_total: float = 0.85, k_margin: float = 10.0) -> tuple[Column, Column]:
    """L2: total += 0.85 * pf_bias, margin += 10 * home_bias."""
    return total + pf_bias * k_total, margin + home_bias * k_margin


def composite_sigma(base: Column, home_pace: Column, away_pace: Column, opp_drtg: Column) -> Column:
    """L3: base sigma x (mean pace / 100) x (opponent defence / 115)."""
    return base * ((home_pace + away_pace) / 2.0 / 100.0) * (opp_drtg / 115.0)


def risk_flags(p_home: Column, margin: Column | None = None, lo: float = 0.45, hi: float = 0.55,
               close: float = 3.0) -> Column:
    """L4: list of risk labels: 'COIN FLIP' when lo < p < hi; 'CLOSE MARGIN'
    when |predicted margin| < close."""
    items = [F.when((p_home > lo) & (p_home < hi), F.lit("COIN FLIP"))]
    if margin is not None:
        items.append(F.when(F.abs(margin) < close, F.lit("CLOSE MARGIN")))
    return F.array_compact(F.array(*items))


def interval_normal(total: Column, margin: Column, sigma_total: float = SIGMA_TOTAL,
                    sigma_margin: float = SIGMA_MARGIN, z: float = Z95) -> dict[str, Column]:
    """Closed-form 95% interval of home/away scores when margin ~ N(m, sm)
    and total ~ N(t, st) independently: each score has sd sqrt(st^2 + sm^2) / 2
    (replaces the Monte-Carlo draws)."""
    home, away = split_scores(total, margin)
    sd = (sigma_total ** 2 + sigma_margin ** 2) ** 0.5 / 2.0
    return {"home_lo": home - z * sd, "home_hi": home + z * sd, "away_lo": away - z * sd, "away_hi": away + z * sd}


def interval_empirical(graded: DataFrame, pred: str, actual: str, q_lo: float = 0.025, q_hi: float = 0.975) -> DataFrame:
    """Residual quantiles (exact) added to the predictions; coverage and
    mean width of the resulting interval, one row."""
    from pitlane.operators.aggregate import exact_quantiles
    r = graded.withColumn("_res", F.col(actual) - F.col(pred))
    q = exact_quantiles(r, [], "_res", [q_lo, q_hi], ["_qlo", "_qhi"])
    j = r.crossJoin(F.broadcast(q))
    lo = F.col(pred) + F.col("_qlo")
    hi = F.col(pred) + F.col("_qhi")
    return j.agg(F.first("_qlo").alias("resid_lo"), F.first("_qhi").alias("resid_hi"),
                 F.avg(((F.col(actual) >= lo) & (F.col(actual) <= hi)).cast("double")).alias("coverage"),
                 F.avg(hi - lo).alias("avg_width"), F.count(F.lit(1)).alias("n"))


def back_transform(log_pred: Column) -> Column:
    """expm1 of a log1p prediction; a non-positive result fails the job."""
    v = F.expm1(log_pred)
    return F.when(v > 0, v).otherwise(F.raise_error(F.concat(F.lit("non-positive prediction: "), v.cast("string"))))


def grade_predictions(history: DataFrame, games: DataFrame, match_id: str = "game_id") -> DataFrame:
    """M1: fill actual scores of ungraded predictions from finished matches;
    correct_winner (p = 0.5 counts wrong) and signed margin error.  Graded
    rows and rows without a finished match are unchanged (U5 semantics).  A
    match that is finished several times with one score counts once; with
    different scores the job fails."""
    from pitlane.functions.scalars import norm_status
    from pitlane.operators.upsert import assert_unique
    h = history
    for col, typ in (("correct_winner", "boolean"), ("error_margin", "double")):
        if col not in h.columns:
            h = h.withColumn(col, F.lit(None).cast(typ))
    fin = games.where(norm_status(F.col("status")) == "final").select(
        match_id, F.col("home_pts").alias("_hp"), F.col("away_pts").alias("_ap")).distinct()
    fin = assert_unique(fin, match_id, "finished matches")
    j = h.join(fin, match_id, "left")
    todo = F.col("_hp").isNotNull() & F.col("actual_home_score").isNull()
    p = F.col("pred_home_prob")
    correct = (((p > 0.5) & (F.col("_hp") > F.col("_ap"))) | ((p < 0.5) & (F.col("_hp") < F.col("_ap"))))
    err = (F.col("pred_home_score") - F.col("pred_away_score")) - (F.col("_hp") - F.col("_ap"))
    upd = {"actual_home_score": F.col("_hp"), "actual_away_score": F.col("_ap"),
           "correct_winner": F.coalesce(correct, F.lit(False)), "error_margin": err.cast("double")}
    return j.select(*[F.when(todo, upd[c]).otherwise(F.col(c)).alias(c) if c in upd else F.col(c) for c in h.columns])


def evaluation_report(graded: DataFrame, as_of, days: int, date: str = "prediction_date_et") -> DataFrame:
    """M2: over graded rows dated within `days` before `as_of` (a parameter, not
    the clock): accuracy % (ties count as not-home-win), MAE of the home score
    and of the total."""
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    g = graded.where(F.col("actual_home_score").isNotNull() & (F.col(date) >= F.date_sub(a, days)))
    pw = F.col("pred_home_score") > F.col("pred_away_score")
    aw = F.col("actual_home_score") > F.col("actual_away_score")
    return g.agg(F.count(F.lit(1)).alias("n_games"), (F.avg((pw == aw).cast("double")) * 100).alias("accuracy_pct"),
                 F.avg(F.abs(F.col("pred_home_score") - F.col("actual_home_score"))).alias("mae_home"),
                 F.avg(F.abs((F.col("pred_home_score") + F.col("pred_away_score"))
                             - (F.col("actual_home_score") + F.col("actual_away_score")))).alias("mae_total"))


def class_metrics(df: DataFrame, label: str, prob: str, threshold: float | Column = 0.5,
                  group: Sequence[str] = ()) -> DataFrame:
    """M5: confusion counts, accuracy, precision, recall at `prob > threshold`;
    zero denominators give NULL."""
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    pred = F.col(prob) > thr
    y = F.col(label) == 1
    agg = [F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
           F.count_if(~pred & ~y).alias("tn"), F.count_if(~pred & y).alias("fn")]
    out = df.groupBy(*group).agg(*agg) if group else df.agg(*agg)
    n = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")

    def ratio(a, b):
        return F.when(b > 0, a / b)
    return out.select("*", ratio(F.col("tp") + F.col("tn"), n).alias("accuracy"),
                      ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                      ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def threshold_sweep(df: DataFrame, label: str, prob: str, thresholds: Sequence[float]) -> DataFrame:
    """M9: M5 at several thresholds -- each row is tagged with the k thresholds
    (a fixed small list) and aggregated once per threshold."""
    t = df.select(label, prob, F.explode(F.array(*[F.lit(float(x)) for x in thresholds])).alias("threshold"))
    return class_metrics(t, label, prob, F.col("threshold"), group=["threshold"])


def prob_metrics(df: DataFrame, label: str, prob: str, eps: float = 1e-15, buckets: int = 1 << 20) -> DataFrame:
    """M6: log-loss (probabilities clipped to [eps, 1-eps]), Brier score and
    ROC AUC = P(score_pos > score_neg) + 0.5 P(tie) (mid-ranks)."""
    # rows missing a label or a probability are not scored (greatest/least
    # would otherwise turn a NULL probability into eps)
    df = df.where(F.col(label).isNotNull() & F.col(prob).isNotNull())
    y = F.col(label).cast("double")
    p = F.col(prob).cast("double")
    pc = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    base = df.agg(F.avg(-(y * F.log(pc) + (1 - y) * F.log(1 - pc))).alias("log_loss"),
                  F.avg(F.pow(p - y, 2)).alias("brier"), F.count(F.lit(1)).alias("n"),
                  F.sum(y).alias("_pos"))
    per_v = df.groupBy(p.alias("_p")).agg(F.sum(y).alias("_np"), F.sum(1 - y).alias("_nn"))
    per_v = per_v.withColumn("_b", F.least(F.greatest(F.floor(F.col("_p") * buckets), F.lit(0)), F.lit(buckets - 1)).cast("int"))
    per_b = per_v.groupBy("_b").agg(F.sum("_nn").alias("_bn"))
    per_b = per_b.select("_b", F.coalesce(F.sum("_bn").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
                                          F.lit(0.0)).alias("_off"))
    w = Window.partitionBy("_b").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    v = per_v.join(per_b, "_b").withColumn("_below", F.col("_off") + F.coalesce(F.sum("_nn").over(w), F.lit(0.0)))
    auc_num = v.agg(F.sum(F.col("_np") * (F.col("_below") + 0.5 * F.col("_nn"))).alias("_num"),
                    F.sum("_np").alias("_P"), F.sum("_nn").alias("_N"))
    return base.crossJoin(auc_num).select(
        "n", "log_loss", "brier",
        F.when((F.col("_P") > 0) & (F.col("_N") > 0), F.col("_num") / (F.col("_P") * F.col("_N"))).alias("auc"))


def regression_metrics(df: DataFrame, pred: str, actual: str) -> DataFrame:
    """M7: MAE, RMSE, R^2 and RMSLE (log1p scale), one row."""
    e = F.col(pred) - F.col(actual)
    one = df.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                 F.sum(e * e).alias("_sse"), F.var_pop(actual).alias("_var"), F.count(F.lit(1)).alias("n"),
                 F.sqrt(F.avg(F.pow(F.log1p(pred) - F.log1p(actual), 2))).alias("rmsle"))
    return one.select("n", "mae", "rmse", (1 - F.col("_sse") / (F.col("_var") * F.col("n"))).alias("r2"), "rmsle")


def residual_frame(preds: DataFrame, raw: DataFrame, key: str, pred: str, actual: str) -> DataFrame:
    """M8: residual and |residual| joined back to the raw columns by key
    (the reference aligned by row position)."""
    j = preds.join(raw, key, "inner")
    return j.withColumn("residual", F.col(actual) - F.col(pred)).withColumn("abs_residual", F.abs(F.col("residual")))


def blend_search(df: DataFrame, a: str, b: str, actual: str, weights: Sequence[float] = (0.4, 0.5, 0.6)) -> DataFrame:
    """K9: RMSE of w*a + (1-w)*b for each weight (rows x a fixed small weight
    list, one aggregate); the best weight is flagged."""
    t = df.select(a, b, actual, F.explode(F.array(*[F.lit(float(w)) for w in weights])).alias("weight"))
    e = F.col("weight") * F.col(a) + (1 - F.col("weight")) * F.col(b) - F.col(actual)
    g = t.groupBy("weight").agg(F.sqrt(F.avg(e * e)).alias("rmse"))
    best = g.agg(F.min_by("weight", F.struct("rmse", "weight")).alias("_best"))
    return g.crossJoin(best).select("weight", "rmse", (F.col("weight") == F.col("_best")).alias("is_best"))
