import math

import duckdb
import numpy as np
import pytest

from pitlane.llm import queries, topk_search
from pitlane.llm.topk_search import integer_vectors, top_k


def brute(rows, k=5, every=50):
    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, q in sorted({i: v for i, v in good if i is not None and i % every == 0}.items()):
        best = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in good if i != qi)[:k]
        out += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


def result(spark, rows):
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, label int, cells string, v int")
    v = integer_vectors(df, "vec_id", "embedding")
    got = top_k(v, v.where("id % 50 = 0"))
    return sorted(tuple(r) for r in got.select("query_id", "rank", "id", "score").collect())


def test_nulls_ties_and_few_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.round(rng.normal(0, .2, 6), 1)]) for i in range(140)]
    rows += [(200, None), (250, [None] * 6), (300, [float("nan")] * 6), (350, [float("inf")] * 6), (400, [1.0] * 5 + [None]), (450, [])]
    rows += [(500 + i, rows[0][1]) for i in range(20)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows[:3]) == brute(rows[:3])
    assert result(spark, rows[:1]) == [] and result(spark, []) == []


@pytest.mark.parametrize("spread", [0.001, 1.0, 1e4])
def test_many_query_blocks(spark, monkeypatch, spread):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in (rng.normal(0, spread, 8)).astype(np.float32)]) for i in range(400)]
    assert result(spark, rows) == brute(rows)


def test_query_on_whole_table(spark):
    got = sorted(tuple(r) for r in queries.op7_topk_search(spark, "/root/testdata/sf0.01").select("query_id", "rank", "vec_id", "score").collect())
    rows = duckdb.sql("select vec_id, embedding from '/root/testdata/sf0.01/embeddings.parquet'").fetchall()
    assert got == brute(rows)


def test_null_ids_and_unequal_lengths(spark):
    """Rows without an id take no part; each length is a search of its own, so a stray longer vector changes nothing."""
    rng = np.random.default_rng(3)
    draw = lambda n: [float(x) for x in np.round(rng.normal(0, .3, n), 2)]
    threes, fives = [(i, draw(3)) for i in range(0, 300, 2)], [(i, draw(5)) for i in range(1, 500, 14)] + [(1000, draw(5))]
    alone = [(50 * 41, draw(9))]
    want = sorted(brute(threes) + brute(fives))
    assert result(spark, threes + fives + alone + [(None, draw(3)), (None, draw(5)), (None, None)]) == want


@pytest.mark.parametrize("reads", [(1, 1), (2,), ()])
def test_rounds_of_exact_reads(spark, monkeypatch, reads):
    """Many equal scores and wide cells: nothing may be left out, however few rows a round reads."""
    monkeypatch.setattr(topk_search, "READS", reads)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(300)] + [(900, [1e5, 0.0, 0.0, -1e5])]
    assert result(spark, rows) == brute(rows)


def test_reading_stops_when_certain(spark, monkeypatch):
    """The bounds fall below the second score after four rows: the fifth and later ones are not read."""
    monkeypatch.setattr(topk_search, "READS", (2, 2, 2))
    near = spark.createDataFrame([(0, i, 20.0 - 4 * i) for i in range(1, 9)], "query_id long, id long, most double")
    exact = spark.createDataFrame([(0, [1])] + [(i, [7 + i % 2]) for i in range(1, 9)], "id long, v array<long>")
    got = topk_search._refined(near, exact, exact.where("id = 0"), 2).collect()
    assert sorted(r.id for r in got) == [1, 2, 3]
