import math
import random
import re

import pytest
from edge import docs_frame, odd_texts, words
from pyspark.sql import functions as F

from pitlane.llm import mixing, queries
from pitlane.llm.mixing import entropy, mixture, powers, realise, schedule


def test_bisection_meets_its_targets():
    tokens = {"a": 1000, "b": 300, "c": 100, "d": 7}
    free = mixture(tokens, most_passes=1e9)
    want = (entropy(powers(tokens, 1.0)) + math.log(4)) / 2
    assert abs(entropy(free.weights) - want) < 1e-9 and abs(sum(free.weights.values()) - 1) < 1e-12
    held = mixture(tokens, most_passes=2.0)
    assert abs(max(held.passes.values()) - 2.0) < 1e-6 and held.exponent > free.exponent and min(held.passes.values()) >= 1 - 1e-12
    for m in (free, held):
        for s, n in tokens.items():
            assert abs(m.weights[s] - m.passes[s] * n / m.budget) < 1e-9
    assert mixture(tokens, target_entropy=0).exponent == 1.0 and mixture(tokens, target_entropy=9, most_passes=1e9).exponent < 1e-6
    assert mixture({"a": 5}).passes == {"a": 1.0} and mixture({}).weights == {} and mixture({"a": 0, "b": 3}).weights == {"b": 1.0}
    assert mixture({"a": 5, "b": 5}).passes == {"a": 1.0, "b": 1.0}


def brute(rows, mix, block_docs):
    """Copies of each (doc_id, source, tokens), with the hashes that Spark gives."""
    out = {}
    for src in {r["s"] for r in rows}:
        own = [r for r in rows if r["s"] == src]
        often = mix.passes.get(src, 1.0)
        whole = max(1, math.floor(often + 1e-9))
        left = max(0, math.floor((often - whole) * sum(r["t"] for r in own) + 1e-6))
        n = max(1, len(own) // block_docs)
        blocks = {}
        for r in own:
            out[r["i"]] = whole
            blocks.setdefault(r["h1"] % n, []).append(r)
        for b in sorted(blocks, key=lambda b: (blocks[b][0]["place"], b)):
            for r in sorted(blocks[b], key=lambda r: (r["h2"], r["i"])):
                if r["t"] and r["t"] > left:
                    left = -1
                    break
                if r["t"]:
                    out[r["i"]] += 1
                    left -= r["t"]
            if left < 0:
                break
    return out


@pytest.mark.parametrize("block_docs,most", [(1_000, 4.0), (10, 2.5), (1, 3.3)])
def test_against_brute_force(spark, monkeypatch, block_docs, most):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", block_docs)
    rng = random.Random(block_docs)
    docs = spark.createDataFrame([(i, words(rng, rng.randrange(0, 40)), rng.choice(["hot"] * 8 + ["x", "x", "y", None])) for i in range(500)], "doc_id long, text string, source string")
    got, mix = realise(docs, "doc_id", "source", "text", most_passes=most)
    rows = [r.asDict() for r in got.select(F.col("doc_id").alias("i"), F.col("source").alias("s"), F.col("mix_tokens").alias("t"), F.xxhash64("doc_id").alias("h1"),
                                           F.xxhash64("doc_id", F.lit(2)).alias("h2"), F.col("mix_order").alias("place"), "copies").collect()]
    assert {r["i"]: r["copies"] for r in rows} == brute(rows, mix, block_docs)
    for s, often in mix.passes.items():
        own = [r for r in rows if r["s"] == s]
        read, total = sum(r["t"] * r["copies"] for r in own), sum(r["t"] for r in own)
        assert 0 <= often * total - read + 1e-3 < 1 + max(r["t"] for r in own) + 1e-3


def test_edges(spark):
    rows = list(enumerate(odd_texts())) + [(None, "a b c"), (5, "two words"), (5, "two words")]
    df = docs_frame(spark, rows).withColumn("copies", F.lit("extra")).withColumn("source", F.when(F.col("doc_id") == 9, None).otherwise(F.col("source")))
    got, _ = realise(df, "doc_id", "source", "text")
    out = got.collect()
    assert len(out) == len(rows) and all(r.copies >= 1 for r in out)
    assert [r.mix_tokens for r in sorted((r for r in out if r.doc_id is not None and r.doc_id < 5), key=lambda r: r.doc_id)] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in odd_texts()[:5]]
    assert schedule(got, "doc_id", "source").count() == sum(r.copies for r in out)
    assert realise(df.limit(0), "doc_id", "source", "text")[0].count() == 0


def test_query_on_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    rows = queries.op10_mixing(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs}
    tokens = {}
    for r in docs:
        tokens[r.source] = tokens.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    mix = mixture(tokens)
    read = {}
    for r in rows:
        read[r.source] = read.get(r.source, 0) + r.n_tokens
    total = sum(read.values())
    assert max(abs(read[s] / total - w) for s, w in mix.weights.items()) < 0.01


def test_each_pass_has_its_own_order(spark, monkeypatch):
    """Whole passes are permutations of all blocks, all different; the last pass reads the first blocks of its own."""
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 5)
    docs = spark.createDataFrame([(i, "a b c d", "big" if i % 10 else ("x" if i % 20 else None)) for i in range(2_000)], "doc_id long, text string, source string")
    realised, mix = realise(docs, "doc_id", "source", "text", target_entropy=9, most_passes=3.5)
    orders, copies = {}, {}
    for r in realised.collect():
        copies.setdefault((r.source, r.mix_block), set()).add(r.copies)
    for r in schedule(realised, "doc_id", "source").collect():
        orders.setdefault((r.source, r["pass"]), {}).setdefault(r.block, r.place)
    ranks = {k: sorted(v, key=v.get) for k, v in orders.items()}
    assert {s for s, _ in ranks} == {"big", "x", None} and abs(mix.passes["x"] - 3.5) < 1e-6
    for s in ("x", None):
        full = [ranks[s, p] for p in (1, 2, 3)]
        assert all(sorted(f) == sorted(full[0]) for f in full) and len({tuple(f) for f in full}) == 3
        last = {b for b in full[0] if max(copies[s, b]) == 4}
        assert set(ranks[s, 4]) == last and 0 < len(last) < len(full[0])
    assert ranks["x", 1] != [b for b in ranks[None, 1] if b in ranks["x", 1]]
