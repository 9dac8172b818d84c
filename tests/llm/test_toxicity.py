import math
import random
import zlib

import numpy as np
import pytest
from edge import docs_frame, odd_texts
from pyspark.sql import functions as F

from pitlane.llm import queries, toxicity
from pitlane.llm.toxicity import fit_toxicity, nnpu_fit, score_toxicity


def auc(pairs):
    ranks = {s: 0.0 for s, _ in pairs}
    order = sorted(pairs)
    i = 0
    while i < len(order):
        j = i
        while j < len(order) and order[j][0] == order[i][0]:
            j += 1
        ranks[order[i][0]] = (i + j + 1) / 2
        i = j
    pos = [ranks[s] for s, y in pairs if y]
    return (sum(pos) - len(pos) * (len(pos) + 1) / 2) / (len(pos) * (len(pairs) - len(pos)))


def test_risk_corrects_for_positives_among_the_unlabelled():
    rng = np.random.default_rng(0)
    n, prior = 3000, 0.3
    toxic = rng.random(n) < prior
    x = np.column_stack([rng.random(n) < np.where(toxic, .9, .05), rng.random(n) < .5]).astype(np.float32)
    positive = np.column_stack([rng.random(500) < .9, rng.random(500) < .5]).astype(np.float32)
    w, b = nnpu_fit(positive, x, prior)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.mean((p > .5) == toxic) > .9 and abs(w[1]) < abs(w[0]) / 4


def test_held_out_accuracy_of_the_query(spark):
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    assert len(got) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(got[r.doc_id], r.toxic) for r in labels if got[r.doc_id].held_out]
    assert auc([(g.score, y) for g, y in held]) > 0.95
    assert np.mean([g.predicted for g, y in held if y]) > 0.85 and np.mean([g.predicted for g, y in held if not y]) < 0.05


@pytest.fixture(scope="module")
def toy(spark):
    rng = random.Random(1)
    clean = lambda: " ".join(f"word{rng.randrange(300)}" for _ in range(60))
    rows = [(i, clean() + (" You Blarghead, vile!" if i % 4 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0), "x") for i in range(0, 600, 2)] + [(0, 1, "x"), (None, 1, "x"), (4, None, "x")], "doc_id long, toxic int, score string")
    return docs_frame(spark, rows), labels


def test_edges(spark, toy):
    docs, labels = toy
    model = fit_toxicity(docs, labels, "doc_id", "text", "toxic", prior=0.25)
    texts = odd_texts() + ["blarghead!", "calm words"]
    some = docs_frame(spark, enumerate(texts)).union(docs_frame(spark, [(None, "blarghead"), (3, "blarghead")]))
    rows = score_toxicity(some, "doc_id", "text", model).collect()
    assert len(rows) == len(texts) + 2
    by = {}
    for r in rows:
        by.setdefault(r.id, []).append(r.score)
    assert by[len(texts) - 2][0] > 0.5 > by[len(texts) - 1][0] and by[None][0] > 0.5 and max(by[3]) > 0.5
    assert by[0] == by[1] and by[0][0] < 0.3
    again = fit_toxicity(docs, labels, "doc_id", "text", "toxic", prior=0.25)
    assert np.array_equal(model.features, again.features)


def test_without_labels_or_documents(spark, toy):
    docs, labels = toy
    for d, y in ((docs, labels.limit(0)), (docs.limit(0), labels), (docs, labels.withColumn("toxic", F.lit(0)))):
        model = fit_toxicity(d, y, "doc_id", "text", "toxic")
        scores = [r.score for r in score_toxicity(docs, "doc_id", "text", model).limit(5).collect()]
        assert len(set(scores)) == 1 and abs(scores[0] - model.prior) < 1e-9


def test_labels_of_other_folds_are_not_read(spark, toy):
    docs, labels = toy
    usable = lambda doc: doc % 3 != 0
    a = fit_toxicity(docs, labels, "doc_id", "text", "toxic", usable)
    b = fit_toxicity(docs, labels.withColumn("toxic", F.when(F.col("doc_id") % 3 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))), "doc_id", "text", "toxic", usable)
    assert np.array_equal(a.features, b.features) and np.allclose(a.weights, b.weights) and a.prior == b.prior


def test_scores_are_tied_to_the_prior(spark):
    """With all labels and with three quarters of them, a text without features is below the prior and few documents are flagged."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    for usable in (None, lambda doc: F.crc32(doc.cast("string")) % 4 != 2):
        model = toxicity.fit_toxicity(docs, labels, "doc_id", "text", "toxic", usable)
        empty = model.score(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0]
        assert len(model.features) and empty < model.prior < toxicity.TOXIC_FROM
        scored = toxicity.score_toxicity(docs, "doc_id", "text", model).withColumnRenamed("id", "doc_id").join(labels, "doc_id", "left")
        flagged = {r.toxic: r.s for r in scored.groupBy("toxic").agg(F.avg((F.col("score") >= toxicity.TOXIC_FROM).cast("double")).alias("s")).collect()}
        assert flagged[1] >= 0.6 and flagged[0] <= 0.05 and flagged[None] <= 0.2


def test_tied_bias():
    assert toxicity.tied_bias(-5.0, 0.1) == -5.0
    assert 1 / (1 + math.exp(-toxicity.tied_bias(3.0, 0.1))) == pytest.approx(0.05)
