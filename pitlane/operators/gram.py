"""Linear models from Gram statistics.

One aggregate sums all products of a row's values, in groups (folds, dates,
slices) if asked. Sums add up and subtract, so the models of all folds, all
dates before a date or all candidates of a search come from one pass over the
data; what is solved is a matrix of a few features, in a task of its own row.

A missing feature counts as its mean over the model's own rows. As the products
with the features' presence are summed too, that holds for any sum of groups
without reading the rows again. Features are standardised by the population
standard deviation (0: 1), labels are not; rows without a label take no part."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MODEL = "label int, candidate int, intercept double, coef array<double>, mean array<double>, rows double, gap double"


def gram_sums(df: DataFrame, features: Sequence[str], labels: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """(groups, g): the sums of products of (features or 0, features' presence, labels, 1), the upper triangle row by row."""
    there = [F.col(f).cast("double") for f in features]
    has = [(x.isNotNull() & ~F.isnan(x)) for x in there]
    v = [F.when(h, x).otherwise(0.0) for x, h in zip(there, has)] + [h.cast("double") for h in has]
    v += [F.col(y).cast("double") for y in labels] + [F.lit(1.0)]
    names = [f"_v{i}" for i in range(len(v))]
    rows = df.select(*groups, *[x.alias(n) for x, n in zip(v, names)])
    rows = rows.dropna(subset=names[2 * len(features): -1]) if labels else rows
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = rows.groupBy(*groups).agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0.0)).alias(f"{a}{b}") for a, b in pairs])
    return sums.select(*groups, F.array(*[f"{a}{b}" for a, b in pairs]).alias("g"))


def _added(stats: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, g) summed over what else tells rows apart; one row of g without groups."""
    at = stats.select(*groups, F.posexplode("g").alias("_i", "_x")).groupBy(*groups, "_i").agg(F.sum("_x").alias("_x"))
    return at.groupBy(*groups).agg(F.array_sort(F.collect_list(F.struct("_i", "_x"))).alias("_g")).select(*groups, F.transform("_g", lambda t: t["_x"]).alias("g"))


def of_others(stats: DataFrame) -> DataFrame:
    """`stats` with `own`, each group's own sums, and `g`, those of all other groups: the total less the own part."""
    total = _added(stats).select(F.col("g").alias("_total"))
    return stats.withColumnRenamed("g", "own").crossJoin(F.broadcast(total)).withColumn("g", F.zip_with("_total", "own", lambda a, b: a - b)).drop("_total")


def before(stats: DataFrame, order: str) -> DataFrame:
    """(order, g): for each value of `order` the sums over all smaller ones, running totals of one entry being one window."""
    so_far = Window.partitionBy("_i").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    run = stats.select(order, F.posexplode("g").alias("_i", "_x")).select(order, "_i", F.coalesce(F.sum("_x").over(so_far), F.lit(0.0)).alias("_x"))
    return run.groupBy(order).agg(F.array_sort(F.collect_list(F.struct("_i", "_x"))).alias("_g")).select(order, F.transform("_g", lambda t: t["_x"]).alias("g"))


@dataclass
class Moments:
    """What a model needs of some rows: centred and scaled products, as if missing values were the mean."""

    n: float
    mean: np.ndarray
    scale: np.ndarray
    xx: np.ndarray  # of standardised features
    xy: np.ndarray  # (features, labels)
    yy: np.ndarray  # centred squares of the labels
    y_mean: np.ndarray


def unpack(g: np.ndarray) -> np.ndarray:
    """The full symmetric matrix of an upper triangle."""
    k = int((np.sqrt(8 * len(g) + 1) - 1) / 2)
    out = np.zeros((k, k))
    out[np.triu_indices(k)] = g
    return out + np.triu(out, 1).T


def moments(g: np.ndarray, p: int) -> Moments:
    """Moments of the rows whose sums are g, with p features."""
    a = unpack(np.asarray(g, float))
    z, m, y = slice(0, p), slice(p, 2 * p), slice(2 * p, -1)
    n, present = a[-1, -1], np.diag(a[m, m])
    mean = np.divide(np.diag(a[z, m]), present, out=np.zeros(p), where=present > 0)
    half = a[z, m] * mean  # [i, j]: mean of j times the sum of i where j is there
    xx = a[z, z] - half - half.T + np.outer(mean, mean) * a[m, m]
    xy = a[z, y] - mean[:, None] * a[m, y]
    var = np.maximum(np.diag(xx), 0) / max(n, 1)
    scale = np.where(var > 1e-12 * (1 + mean**2), np.sqrt(var), 1.0)
    y_mean = a[-1, y] / max(n, 1)
    return Moments(n, mean, scale, xx / np.outer(scale, scale), xy / scale[:, None], np.diag(a[y, y]) - n * y_mean**2, y_mean)


def solve_ridge(mo: Moments, alpha: float) -> tuple[np.ndarray, float]:
    """Standardised coefficients of each label for scikit-learn's penalty, and 0 for the gap: the solution is exact."""
    a = mo.xx + alpha * np.eye(len(mo.xx))
    try:
        return np.linalg.solve(a, mo.xy), 0.0
    except np.linalg.LinAlgError:  # without a penalty, features may depend on one another
        return np.linalg.lstsq(a, mo.xy, rcond=None)[0], 0.0


def solve_elastic_net(mo: Moments, reg: float, l1_ratio: float, tol: float = 1e-13, sweeps: int = 20_000) -> tuple[np.ndarray, float]:
    """Coordinate descent on the Gram matrix: (standardised coefficients, largest duality gap over the labels' squares).

    Minimises |y - Xb|^2 / 2n + reg (l1_ratio |b|_1 + (1 - l1_ratio) |b|^2 / 2). Sweeps run over the
    active set, the features with a coefficient; when it is at rest all features are swept
    once, and the end is there when the duality gap is below `tol` times the label's squares."""
    n = max(mo.n, 1.0)
    l1, l2 = reg * l1_ratio * n, reg * (1 - l1_ratio) * n
    if l1 <= 0:  # no corner at zero: a plain linear system
        return solve_ridge(mo, l2)
    out, worst = np.zeros_like(mo.xy), 0.0
    for y in range(mo.xy.shape[1]):
        r, b, yy = mo.xy[:, y], out[:, y], mo.yy[y]
        down = np.diag(mo.xx) + l2

        def sweep(some):
            most = 0.0
            for j in some:
                if down[j] <= 0:
                    continue
                pull = r[j] - mo.xx[j] @ b + mo.xx[j, j] * b[j]
                new = np.sign(pull) * max(abs(pull) - l1, 0) / down[j]
                most, b[j] = max(most, abs(new - b[j])), new
            return most

        left = sweeps
        while left > 0:
            sweep(range(len(b)))
            left -= 1
            while left > 0 and sweep(np.flatnonzero(b)) > 1e-15 * (1 + np.abs(b).max()):
                left -= 1
            gap = duality_gap(mo.xx, r, yy, b, l1, l2)
            if gap <= tol * max(yy, 1e-300):
                break
        worst = max(worst, gap / max(yy, 1e-300))
    return out, worst


def duality_gap(xx: np.ndarray, xy: np.ndarray, yy: float, b: np.ndarray, l1: float, l2: float) -> float:
    """How far the penalised sum of squares at b can be above its least value."""
    rest = yy - 2 * b @ xy + b @ xx @ b
    dual = np.abs(xy - xx @ b - l2 * b).max(initial=0.0)
    by = min(1.0, l1 / dual) if dual > 0 else 1.0
    primal = rest / 2 + l1 * np.abs(b).sum() + l2 / 2 * (b @ b)
    return max(0.0, primal - (by * (yy - b @ xy) - by**2 * (rest + l2 * (b @ b)) / 2))


def fitted(stats: DataFrame, p: int, candidates: Sequence[Callable[[Moments], tuple[np.ndarray, float]]]) -> DataFrame:
    """The models of every row of sums: (the row's other columns, MODEL), for each label and candidate; no model without rows.

    A row is solved where it lies, so folds and dates are solved side by side and nothing reaches the driver."""
    keep = [c for c in stats.columns if c not in ("g", "own")]
    kinds = ", ".join(f"`{c}` {stats.schema[c].dataType.simpleString()}" for c in keep)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.to_dict("records"):
                mo = moments(r["g"], p)
                for c, solve in enumerate(candidates if mo.n > 0 else ()):
                    b, gap = solve(mo)
                    rows += [[*[r[k] for k in keep], y, c, float(mo.y_mean[y]), (b[:, y] / mo.scale).tolist(), mo.mean.tolist(), mo.n, gap] for y in range(b.shape[1])]
            yield pd.DataFrame(rows, columns=[*keep, "label", "candidate", "intercept", "coef", "mean", "rows", "gap"])

    return stats.select(*keep, "g").mapInPandas(run, ", ".join(x for x in (kinds, MODEL) if x))


def model_struct() -> Column:
    """The model columns as one value."""
    return F.struct("intercept", "coef", "mean")


def predicted(features: Sequence[str], model: Column) -> Column:
    """The model's value for a row: intercept plus the features' distances from the mean times their coefficients; a missing one is at the mean."""
    out = model["intercept"]
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        x = F.when(~F.isnan(x), x)
        out = out + model["coef"][i] * (F.coalesce(x, model["mean"][i]) - model["mean"][i])
    return out


def squared_error(own: Column | np.ndarray, p: int, label: int, model: tuple[float, np.ndarray, np.ndarray]) -> tuple[float, float]:
    """(sum of squared errors, rows) of a model (intercept, coef, mean) over the rows whose sums are `own`, without reading them."""
    a = unpack(np.asarray(own, float))
    intercept, coef, mean = model
    w = np.zeros(len(a))
    w[:p], w[p: 2 * p], w[2 * p + label], w[-1] = -coef, coef * mean, 1.0, -intercept
    return max(0.0, float(w @ a @ w)), float(a[-1, -1])


def fit_linear(train: DataFrame, features: Sequence[str], labels: Sequence[str], solvers: Sequence[Callable]) -> DataFrame:
    """One model for each label and solver from one aggregate."""
    return fitted(gram_sums(train, features, labels), len(features), solvers)


def ridge(alpha: float) -> Callable[[Moments], tuple[np.ndarray, float]]:
    return lambda mo: solve_ridge(mo, alpha)


def elastic_net(reg: float, l1_ratio: float) -> Callable[[Moments], tuple[np.ndarray, float]]:
    return lambda mo: solve_elastic_net(mo, reg, l1_ratio)


def score_linear(df: DataFrame, features: Sequence[str], models: DataFrame, names: Sequence[str], by: str = "candidate") -> DataFrame:
    """`df` plus a column for each value 0, 1, ... of `by`, the model's value. The models, a few rows, come as one broadcast row."""
    one = models.groupBy().agg(F.map_from_entries(F.collect_list(F.struct(by, model_struct()))).alias("_models"))
    j = df.crossJoin(F.broadcast(one))
    return j.select(*df.columns, *[predicted(features, F.col("_models")[i]).alias(n) for i, n in enumerate(names)])


def oof_linear(df: DataFrame, key: str, features: Sequence[str], label: str, solver: Callable, fold: str = "fold", origin: str = "origin", out: str = "oof") -> DataFrame:
    """K7: (key, origin, out): for train rows the model of the other folds, for test rows the mean of the folds' models.

    One aggregate gives each fold's sums, and a fold's model comes from the total less its own part: no row sees its own fold."""
    train = df.where(F.col(origin) == "train")
    models = fitted(of_others(gram_sums(train, features, [label], [fold])), len(features), [solver])
    one = models.groupBy().agg(F.map_from_entries(F.collect_list(F.struct(fold, model_struct()))).alias("_by"))  # a row for each fold
    j = df.crossJoin(F.broadcast(one))
    mine = predicted(features, F.col("_by")[F.col(fold)])
    total = F.aggregate(F.map_values("_by"), F.lit(0.0), lambda s, m: s + predicted(features, m))
    mean = total / F.size("_by")
    return j.select(key, origin, F.when(F.col(origin) == "train", mine).otherwise(mean).alias(out))


def stack_linear(oofs: dict[str, DataFrame], base: DataFrame, key: str, label: str, solver: Callable, origin: str = "origin") -> DataFrame:
    """K8: (key, origin, stacked): a linear model over the out-of-fold columns of several models."""
    j = base.select(key, label, origin)
    for name, o in oofs.items():
        j = j.join(o.select(key, F.col("oof").alias(name)), key)
    models = fit_linear(j.where(F.col(origin) == "train"), list(oofs), [label], [solver])
    return score_linear(j, list(oofs), models, ["stacked"]).select(key, origin, "stacked")


def walk_forward(df: DataFrame, features: Sequence[str], labels: Sequence[str], date: str, replay: DataFrame, solver: Callable) -> DataFrame:
    """M3: rows of the dates in `replay` (one column, `date`) plus `pred_<label>`, each date by a model of all dates before it.

    One aggregate sums up each date; running totals over the dates give every date's model. A date without any before it has no prediction."""
    sums = before(gram_sums(df, features, labels, [date]), date).join(replay, date, "left_semi")
    models = fitted(sums, len(features), [solver])
    wide = models.groupBy(date).agg(F.map_from_entries(F.collect_list(F.struct("label", model_struct()))).alias("_by"))
    j = df.join(replay, date, "left_semi").join(wide, date, "left")
    return j.select(*df.columns, *[predicted(features, F.col("_by")[i]).alias(f"pred_{y}") for i, y in enumerate(labels)])


def halving(train: DataFrame, features: Sequence[str], label: str, solvers: Sequence[Callable], fold: str = "fold", slice_col: str = "slice", rounds: Sequence[tuple[int, int]] = ((1, 16), (2, 5), (4, 0))) -> DataFrame:
    """Successive halving: (round, candidate, rmse), rmse being the mean over the folds.

    Round r reads the rows with `slice_col` below its first number and keeps as many of
    the best candidates as its second says. Sums by (fold, slice) are one pass for all
    rounds and candidates; a fold's error comes from its own sums."""
    p = len(features)
    stats = gram_sums(train, features, [label], [fold, slice_col])
    whole = stats.groupBy().agg(F.collect_list(F.struct(F.col(fold).cast("int").alias("f"), F.col(slice_col).cast("int").alias("s"), "g")).alias("all"))  # folds x slices

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for parts in frame["all"]:
                left = list(range(len(solvers)))
                for r, (slices, keep) in enumerate(rounds):
                    own: dict[int, np.ndarray] = {}
                    for x in parts:
                        if x["s"] < slices:
                            own[x["f"]] = own.get(x["f"], 0) + np.asarray(x["g"], float)
                    total, errors = sum(own.values()), {c: [] for c in left}
                    for g in own.values():
                        mo = moments(total - g, p)
                        for c in left if mo.n > 0 else ():
                            b, _ = solvers[c](mo)
                            sse, n = squared_error(g, p, 0, (mo.y_mean[0], b[:, 0] / mo.scale, mo.mean))
                            errors[c].append(np.sqrt(sse / n))
                    scores = sorted((float(np.mean(e)), c) for c, e in errors.items() if e)
                    rows += [(r, c, s) for s, c in scores]
                    left = [c for _, c in scores[:keep]]
            yield pd.DataFrame(rows, columns=["round", "candidate", "rmse"])

    return whole.mapInPandas(run, "round int, candidate int, rmse double")
