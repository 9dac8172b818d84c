"""Logistic regression by Newton steps over sums that the executors make.

Each step is one aggregate: the gradient and the information matrix at the
present coefficients. The driver holds those sums of a few features only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A linear predictor beyond which a probability counts as certain.
CERTAIN = 30.0


@dataclass
class LogitFit:
    features: list[str]
    coef: np.ndarray  # of standardised features, the intercept last
    mean: np.ndarray
    scale: np.ndarray
    information: np.ndarray  # at the solution, with the penalty
    log_likelihood: float
    rows: int
    positives: float
    steps: int
    converged: bool
    separated: bool

    def linear(self) -> Column:
        """The linear predictor of a row; a missing feature counts as its mean."""
        out = F.lit(float(self.coef[-1]))
        for f, b, m, s in zip(self.features, self.coef, self.mean, self.scale):
            out = out + F.lit(float(b / s)) * (F.coalesce(F.col(f).cast("double"), F.lit(float(m))) - F.lit(float(m)))
        return out

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.linear()))

    def raw(self) -> tuple[np.ndarray, np.ndarray]:
        """(coefficients, covariance) of the features as they are, the intercept last."""
        to = np.diag(np.append(1 / self.scale, 1.0))
        to[-1, :-1] = -self.mean / self.scale
        return to @ self.coef, to @ np.linalg.pinv(self.information) @ to.T


def _sums(rows: DataFrame, x: list[Column], b: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """(gradient, information, log-likelihood, largest linear predictor) of rows with `_y` and `_w` at b."""
    z = sum((F.lit(float(c)) * v for c, v in zip(b, x)), F.lit(0.0))
    at = rows.select(*[v.alias(f"_x{i}") for i, v in enumerate(x)], "_y", "_w", z.alias("_z"))
    p = 1 / (1 + F.exp(-F.col("_z")))
    at = at.withColumn("_r", F.col("_w") * (F.col("_y") - p)).withColumn("_h", F.col("_w") * p * (1 - p))
    k = len(x)
    softplus = F.greatest(F.col("_z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_z")))
    aggs = [F.sum(F.col("_r") * F.col(f"_x{i}")) for i in range(k)]
    aggs += [F.sum(F.col("_h") * F.col(f"_x{i}") * F.col(f"_x{j}")) for i in range(k) for j in range(i, k)]
    aggs += [F.sum(F.col("_w") * (F.col("_y") * F.col("_z") - softplus)), F.max(F.abs("_z"))]
    got = [float(v or 0.0) for v in at.agg(*[a.alias(f"_a{i}") for i, a in enumerate(aggs)]).first()]
    h = np.zeros((k, k))
    h[np.triu_indices(k)] = got[k: -2]
    return np.array(got[:k]), h + np.triu(h, 1).T, got[-2], got[-1]


def newton_logit(df: DataFrame, features: Sequence[str], label: str, balanced: bool = False, C: float | None = None, steps: int = 50) -> LogitFit:
    """Minimises C * sum(w_i loss_i) + |b|^2 / 2, the intercept's square included as liblinear does, or sum(loss_i) where C is None.

    Features are standardised (population deviation, 0: 1) with the mean for missing
    values; rows without a label take no part. A step is halved until the objective
    falls. Without a penalty, classes that a plane separates have no finite solution:
    the fit ends there with `separated` set, when the likelihood is all but certain."""
    feats, y = list(features), F.col(label).cast("double")
    rows = df.where(y.isNotNull())
    x = [F.col(f).cast("double") for f in feats]
    one = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(y), F.lit(0.0)).alias("pos"), *[F.avg(v).alias(f"_m{i}") for i, v in enumerate(x)]).first()
    n, pos = one["n"], float(one["pos"])
    mean = np.array([one[f"_m{i}"] or 0.0 for i in range(len(x))])
    centred = [F.coalesce(v, F.lit(float(m))) - F.lit(float(m)) for v, m in zip(x, mean)]
    spread = rows.agg(*[F.avg(v * v).alias(f"_s{i}") for i, v in enumerate(centred)]).first()
    scale = np.array([math.sqrt(s) if s and s > 1e-12 * (1 + m * m) else 1.0 for s, m in zip(spread, mean)])
    weight = F.lit(1.0)
    if balanced and 0 < pos < n:
        weight = F.when(y == 1, F.lit(n / (2 * pos))).otherwise(F.lit(n / (2 * (n - pos))))
    cols = [v / F.lit(float(s)) for v, s in zip(centred, scale)] + [F.lit(1.0)]
    held = rows.select(*[v.alias(f"_f{i}") for i, v in enumerate(cols)], y.alias("_y"), weight.alias("_w"))
    at = [F.col(f"_f{i}") for i in range(len(cols))]
    keep, factor = (1.0, C) if C is not None else (0.0, 1.0)
    b = np.zeros(len(cols))
    grad, info, ll, far = _sums(held, at, b)
    goal, converged, taken = factor * ll - keep * (b @ b) / 2, False, 0
    while n and taken < steps:
        g, h = factor * grad - keep * b, factor * info + keep * np.eye(len(b))
        if np.abs(g).max() <= 1e-9 * max(1.0, n):
            converged = True
            break
        if C is None and far > CERTAIN and -ll < 1e-6 * n:
            break
        move, cut = np.linalg.lstsq(h, g, rcond=None)[0], 1.0
        while True:
            new = _sums(held, at, b + cut * move)
            now = factor * new[2] - keep * ((b + cut * move) @ (b + cut * move)) / 2
            if now >= goal - 1e-12 * abs(goal) or cut < 1e-6:
                break
            cut /= 2
        b, (grad, info, ll, far), goal, taken = b + cut * move, new, now, taken + 1
    separated = C is None and n > 0 and (far > CERTAIN and -ll < 1e-6 * n or pos in (0, n))
    return LogitFit(feats, b, mean, scale, factor * info + keep * np.eye(len(b)), ll, n, pos, taken, converged and not separated, separated)


def logit_inference(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """K5: (term, coef, std_err, p_value, pseudo_r2, separated), one row for each feature and the intercept.

    Standard errors come from the inverse information, p-values from the normal
    distribution, pseudo_r2 is 1 - LL / LL of the intercept alone. Rows with a missing
    value take no part. Where the classes are separated, coefficients have no
    finite value: they, errors and p-values are null."""
    rows = df.dropna(subset=[*features, label])
    fit = newton_logit(rows, features, label)
    coef, cov = fit.raw()
    err = np.sqrt(np.maximum(np.diag(cov), 0))
    share = fit.positives / fit.rows if fit.rows else 0.0
    alone = sum(fit.rows * s * math.log(s) for s in (share, 1 - share) if s > 0)
    r2 = 1 - fit.log_likelihood / alone if alone else None
    out = [(t, None, None, None, r2, True) if fit.separated or not fit.rows else
           (t, float(c), float(e), math.erfc(abs(c / e) / math.sqrt(2)) if e > 0 else None, r2, False) for t, c, e in zip([*features, "intercept"], coef, err)]
    return df.sparkSession.createDataFrame(out, "term string, coef double, std_err double, p_value double, pseudo_r2 double, separated boolean")
