"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.llm.shared import stored, text_chunks
from pitlane.llm.words import LOWER, span_hashes, word_spans

#: Bounds of the training sample: confirmed toxic and unlabelled documents of the smallest hash.
POSITIVES, UNLABELLED = 4_000, 8_000
#: Features that the classifier may hold, and the least z-score by which one must be commoner among toxic texts.
MOST_FEATURES, LEAST_Z = 2_000, 4.0
#: Adam steps over the whole sample, their size, and the weight of the squared norm.
STEPS, RATE, SHRINK = 400, 0.05, 1e-4
#: A document is toxic from this score on.
TOXIC_FROM = 0.3
#: Feature kinds: whole words, and their first so many bytes.
PREFIXES = (4, 5, 6, 7)

#: Levels at which a word or beginning counts: any, twice, three times, twice and 1 % or 2 % of the words.
LEVELS = 5

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, words in the row) of every word and word beginning of the rows, repeats included.

    The three lowest bits of a hash are 0: a feature is a hash plus its level."""
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets, _IN_WORD)
    words = np.bincount(rows, minlength=len(offsets) - 1)
    if not len(starts):
        return rows, np.zeros(0, np.int64), words
    all_rows, hashes = [rows], [span_hashes(data, starts, ends)]
    for n in PREFIXES:
        long = ends - starts >= n
        all_rows.append(rows[long])
        hashes.append(span_hashes(data, starts[long], starts[long] + n) ^ np.uint64(n))
    return np.concatenate(all_rows), np.concatenate(hashes).view(np.int64) & ~7, words


def reached(count: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
    """For each level, which of the counts reach it in rows of so many words."""
    return [count >= 1, count >= 2, count >= 3, (count >= 2) & (count * 100 >= words), (count >= 2) & (count * 50 >= words)]


@dataclass
class ToxicityModel:
    features: np.ndarray  # sorted; a hash plus a level each
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability that each row is toxic, from which features it holds."""
        z = np.full(len(offsets) - 1, self.bias)
        rows, hashes, words = word_features(data, offsets)
        bases = np.unique(self.features & ~7)
        if len(bases) and len(hashes):
            at = np.minimum(np.searchsorted(bases, hashes), len(bases) - 1)
            hit = bases[at] == hashes
            pairs, count = np.unique(rows[hit] * len(bases) + at[hit], return_counts=True)
            row, base = pairs // len(bases), bases[pairs % len(bases)]
            for level, ok in enumerate(reached(count, words[row])):
                at = np.minimum(np.searchsorted(self.features, base + level), len(self.features) - 1)
                ok &= self.features[at] == base + level
                z += np.bincount(row[ok], weights=self.weights[at[ok]], minlength=len(z))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def nnpu_fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier of least non-negative PU risk.

    The risk of positives is prior * E_P[loss(+)]; that of negatives is estimated
    as E_U[loss(-)] - prior * E_P[loss(-)]. Where the estimate falls below zero,
    which no true risk can, the step goes up it instead of down."""
    both = np.concatenate([positive, unlabelled]).astype(np.float32)
    n_p, n_u = len(positive), len(unlabelled)
    is_p = np.arange(len(both)) < n_p
    weight_p, weight_u = prior / max(n_p, 1), 1 / max(n_u, 1)
    w, b = np.zeros(both.shape[1], np.float32), np.float32(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        z = both @ w + b
        p = 1 / (1 + np.exp(-z))
        negative = np.logaddexp(0, z)  # loss(-)
        risk = weight_u * negative[~is_p].sum() - weight_p * negative[is_p].sum()
        up = np.where(is_p, -weight_p * p, weight_u * p)  # its gradient
        g = up + np.where(is_p, weight_p * (p - 1), 0) if risk >= 0 else -up
        grad = np.append(both.T @ g.astype(np.float32) + SHRINK * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1].astype(np.float32), np.float32(b - move[-1])
    return w.astype(np.float64), tied_bias(float(b), prior)


def tied_bias(bias: float, prior: float) -> float:
    """The bias, but no more than what gives a text without any feature half of the prior.

    The clipped risk alone leaves it open: raising all scores lowers the positives' loss and costs nothing once the
    negatives' risk is cut off. As all features are commoner in toxic texts, a text without them is below the average."""
    return min(bias, float(np.log(prior / 2 / (1 - prior / 2))))


def _features_of(batches):
    """(positive, doc, distinct features) of sampled rows (positive, text)."""
    for batch in batches:
        docs = []
        for first, last, data, offsets in text_chunks(batch.column(2)):
            rows, hashes, words = word_features(data, offsets)
            order = np.lexsort((hashes, rows))
            rows, hashes = rows[order], hashes[order]
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
            count = np.diff(np.append(np.flatnonzero(new), len(rows)))
            rows, hashes = rows[new], hashes[new]
            levels = reached(count, words[rows])
            row = np.concatenate([rows[ok] for ok in levels])
            feature = np.concatenate([hashes[ok] + level for level, ok in enumerate(levels)])
            order = np.argsort(row, kind="stable")
            docs += np.split(feature[order], np.searchsorted(row[order], np.arange(1, last - first)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(docs, pa.list_(pa.int64()))], ["doc", "positive", "features"])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, usable: Callable[[Column], Column] | None = None, prior: float | None = None) -> ToxicityModel:
    """Fit on confirmed toxic documents (label 1) and unlabelled text (any document, its label unread).

    `usable` tells from an id column which documents may be learnt from. `prior`, the share of toxic
    documents, is by default their share among usable labelled rows. The sample
    is bounded (POSITIVES, UNLABELLED), picked by the hash of the id and so the
    same on every run; only its ids reach the driver. Document frequencies of
    all words and word beginnings in it are counted by Spark. Kept features are
    those commoner in toxic texts than in others by LEAST_Z, where the share in
    others is the unlabelled one less the prior's part of the toxic one, not
    below 0. The fit itself is one task over the bounded sample. Without
    positives or without unlabelled documents all scores are the prior."""
    spark = docs.sparkSession
    usable = (lambda doc: F.lit(True)) if usable is None else usable
    rank = F.xxhash64(F.col("doc"))
    said = labels.select(F.col(id_col).alias("doc"), F.col(label_col).alias("y")).dropna()
    said = said.where(usable(F.col("doc"))).groupBy("doc").agg(F.max("y").alias("y"))
    n, toxic = said.agg(F.count("*"), F.coalesce(F.sum((F.col("y") == 1).cast("int")), F.lit(0))).first()
    prior = min(0.9, max(1e-4, toxic / n if n else 0.05)) if prior is None else prior
    marked = said.where("y = 1").select("doc").orderBy(rank, "doc").limit(POSITIVES)
    others = docs.select(F.col(id_col).alias("doc")).dropna().where(usable(F.col("doc"))).distinct().orderBy(rank, "doc").limit(UNLABELLED)
    sample = marked.withColumn("positive", F.lit(1)).union(others.withColumn("positive", F.lit(0)))
    sample = spark.createDataFrame(sample.collect(), sample.schema)  # at most POSITIVES + UNLABELLED ids
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc").select("doc", "positive", "text")
    rows = stored(rows.mapInArrow(_features_of, f"doc {sample.schema['doc'].dataType.simpleString()}, positive int, features array<long>"), "toxic-sample")
    size = {r.positive: r.n for r in rows.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = size.get(1, 0), size.get(0, 0)
    none = ToxicityModel(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))), prior)
    if not n_p or not n_u:
        return none
    counts = rows.select("positive", F.explode("features").alias("feature")).groupBy("feature").agg(
        (F.sum("positive") / n_p).alias("p"), (F.sum(1 - F.col("positive")) / n_u).alias("u"))
    q = F.greatest(F.lit(0.0), (F.col("u") - prior * F.col("p")) / (1 - prior))
    p, u = F.col("p"), F.col("u")
    z = (p - q) / F.sqrt((p * (1 - p) + 1 / n_p) / n_p + (u * (1 - u) + 1 / n_u) / n_u)
    kept = counts.withColumn("z", z).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(MOST_FEATURES).select("feature").collect()
    features = np.array(sorted(r.feature for r in kept), np.int64)
    if not len(features):
        return none

    def cut(batches):
        for batch in batches:
            have = batch.column(2)
            values, ends = have.flatten().to_numpy(), np.cumsum([0, *pc.fill_null(pc.list_value_length(have), 0).to_pylist()])
            at = np.minimum(np.searchsorted(features, values), len(features) - 1)
            hit = features[at] == values
            left = np.concatenate([[0], np.cumsum(hit)])[ends]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(at[hit], pa.int32()))], ["positive", "at"])

    def fit(table: pa.Table) -> pa.Table:
        x = np.zeros((table.num_rows, len(features)), np.float32)
        for k, at in enumerate(table.column("at").to_pylist()):
            x[k, at] = 1
        positive = table.column("positive").to_numpy() == 1
        w, b = nnpu_fit(x[positive], x[~positive], prior)
        return pa.table({"at": pa.array(np.arange(len(w) + 1), pa.int32()), "w": pa.array(np.append(w, b))})

    got = rows.mapInArrow(cut, "positive int, at array<int>").groupBy().applyInArrow(fit, "at int, w double").orderBy("at").collect()
    w = np.array([r.w for r in got])
    return ToxicityModel(features, w[:-1], float(w[-1]), prior)


def with_score(docs: DataFrame, text_col: str, model: ToxicityModel, score_col: str = "score") -> DataFrame:
    """`docs` with the score of each row: every whole text is read where it lies, without a shuffle.

    A null or empty text has the score of a text without any feature; null,
    repeated and tied ids stay rows of their own; a column named like the new
    one is replaced."""
    docs = docs.drop(score_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, names = docs.columns.index(text_col), [*docs.columns, score_col]

    def run(batches):
        for batch in batches:
            scores = [shared.value.score(data, offsets) for _, _, data, offsets in text_chunks(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores) if scores else np.zeros(0))], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def score_toxicity(docs: DataFrame, id_col: str, text_col: str, model: ToxicityModel) -> DataFrame:
    """(id, score) for each row, as `with_score` gives it."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return with_score(rows, "text", model).select("id", "score")
