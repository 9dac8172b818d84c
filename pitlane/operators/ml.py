"""Model jobs on pyspark.ml: trees, the
pipeline form of ridge, out-of-fold predictions of any model and batch scoring.

Fitting runs on the executors (treeAggregate of gradients / histograms); the
driver only holds the fitted coefficients or trees. Linear models of folds,
dates and searches come from Gram sums (operators.gram), logistic ones from
Newton steps (operators.logit)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _prep(features: Sequence[str], scale: bool = True, impute: bool = True):
    feats = list(features)
    stages = []
    cols = feats
    if impute:
        cols = [f"_imp_{f}" for f in feats]
        stages.append(Imputer(inputCols=feats, outputCols=cols, strategy="mean"))
    stages.append(VectorAssembler(inputCols=cols, outputCol="_raw", handleInvalid="keep"))
    if scale:
        stages.append(StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True))
    else:
        stages[-1].setOutputCol("features")
    return stages


def balanced_weights(df: DataFrame, label: str, out: str = "_w") -> DataFrame:
    """n / (k * n_class) per row (class-weight 'balanced'); the per-class
    counts are a tiny aggregate joined back (AQE broadcasts it)."""
    from pitlane.operators.features import class_weights
    w = class_weights(df, label, out).select(label, out)
    return df.join(w, label, "left")


#: Rows of a task that trees are counted in; a training table of fewer rows stays as it lies.
TREE_ROWS = 1 << 15


def _evenly(df: DataFrame) -> DataFrame:
    """Training rows dealt evenly over tasks of about TREE_ROWS rows, one for each core at least.

    Counting trees costs a task as many steps as it has rows and trees, and rows that come from a join lie by
    its key: a few keys make a few tasks, of which the largest is waited for at every level. A forest draws its
    bags by partition, so above TREE_ROWS rows its draws are those of this layout."""
    n = df.count()
    return df if n <= TREE_ROWS else df.repartition(max(-(-n // TREE_ROWS), df.sparkSession.sparkContext.defaultParallelism))


def _cast_double(df, cols):
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def fit_ridge(train: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0) -> PipelineModel:
    """K2: mean impute, standardise, ridge with scikit-learn's alpha.

    Spark minimises (1/2n)||y - Xb||^2 with the label standardised when a
    penalty is set (glmnet convention), so the penalty acting on the original
    scale is regParam / std_pop(y).  regParam = alpha * std_pop(y) / n
    therefore solves (Xc'Xc + alpha I) b = Xc'yc, scikit-learn's Ridge
    (checked against a Spark Gram aggregate in tests/test_ml.py)."""
    d = _cast_double(train, list(features) + [label])
    st = d.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("sd")).first()
    n, sd = max(st["n"], 1), (st["sd"] or 0.0)
    reg = alpha * sd / n if sd > 0 else alpha / n
    lr = LinearRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=0.0,
                          standardization=False, solver="normal")
    return Pipeline(stages=_prep(features) + [lr]).fit(d)


def fit_gbt(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 50, step: float = 0.1,
            depth: int = 3, seed: int = 42) -> PipelineModel:
    """K3: gradient-boosted trees (no scaling needed)."""
    d = _cast_double(train, list(features) + [label])
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, stepSize=step, maxDepth=depth, seed=seed)
    return Pipeline(stages=_prep(features, scale=False) + [gbt]).fit(d)


def fit_random_forest(train: DataFrame, features: Sequence[str], label: str, classifier: bool = True,
                      trees: int = 100, depth: int = 5, balanced: bool = False, seed: int = 42) -> PipelineModel:
    """K6: random forest classifier (optionally class-weighted) or regressor."""
    d = _cast_double(train, list(features) + [label])
    if balanced:
        d = balanced_weights(d, label)
    kw = dict(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    if balanced:
        kw["weightCol"] = "_w"
    est = RandomForestClassifier(**kw) if classifier else RandomForestRegressor(**kw)
    return Pipeline(stages=_prep(features, scale=False) + [est]).fit(_evenly(d))


def p_positive(pred: DataFrame, out: str = "p") -> DataFrame:
    """Probability of class 1 as a plain column."""
    return pred.withColumn(out, vector_to_array("probability")[1])


def oof_predict(df: DataFrame, key: str, features: Sequence[str], label: str, fit, fold: str = "fold",
                origin: str = "origin", k: int = 5) -> DataFrame:
    """K7: out-of-fold predictions for train rows (model of the other folds) and,
    for test rows, the mean of the k fold models.  k distributed fits; the
    predictions are unioned and averaged by key."""
    train = df.where(F.col(origin) == "train")
    test = df.where(F.col(origin) == "test")
    parts, test_parts = [], []
    for f in range(k):
        m = fit(train.where(F.col(fold) != f), features, label)
        parts.append(m.transform(train.where(F.col(fold) == f)).select(key, F.col("prediction").alias("oof")))
        test_parts.append(m.transform(test).select(key, F.col("prediction").alias("oof")))
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    tp = test_parts[0]
    for p in test_parts[1:]:
        tp = tp.unionByName(p)
    return oof.withColumn(origin, F.lit("train")).unionByName(
        tp.groupBy(key).agg(F.avg("oof").alias("oof")).withColumn(origin, F.lit("test")))


def score_batch(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Score every row of a batch (e.g. all games of a date) in one job."""
    out = model.transform(df)
    if "probability" in out.columns:
        out = p_positive(out)
    return out.select(*keep, "prediction", *(["p"] if "p" in out.columns else []))
