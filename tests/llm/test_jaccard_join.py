import random
import re

import pytest
from edge import docs_frame, odd_texts

from pitlane.llm import jaccard_join, queries
from pitlane.llm.components import components
from pitlane.llm.jaccard_join import jaccard_groups


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute(docs):
    """{doc: (size, component)} by an inverted index over all shingles."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = {}
    for i in sorted(sets):
        common = {}
        for s in sets[i]:
            for j in index.get(s, ()):
                common[j] = common.get(j, 0) + 1
            index.setdefault(s, []).append(i)
        for j, c in common.items():
            if 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def families(seed, n=110):
    """Documents copied with ever more changes, with shared passages, and short ones."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(12)]
    seeds = [[word() for _ in range(rng.choice([3, 5, 6, 9, 20, 60, 200]))] for _ in range(12)]
    docs = []
    for i in range(n):
        w = list(rng.choice(seeds))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 12])):
            at = rng.randrange(len(w))
            if rng.random() < .5:
                w[at] = word()
            else:
                w.insert(at, word())
        if rng.random() < .3:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        if rng.random() < .3:
            seeds.append(w)
        docs.append((i, " ".join(w)))
    return docs


@pytest.mark.parametrize("seed,whole,pivots,local", [(1, 32, 4, 2), (2, 2, 2, 8), (4, 3, 4, 3)])
def test_against_brute_force(spark, monkeypatch, seed, whole, pivots, local):
    monkeypatch.setattr(jaccard_join, "WHOLE", whole)
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard_join, "LOCAL", local)
    docs = families(seed)
    assert result(jaccard_groups(docs_frame(spark, docs), "doc_id", "text")) == brute(docs)


def test_borders_of_the_similarity(spark):
    """Sets at 74, 75 and 76 percent, and chains of links."""
    line = lambda a, b: " ".join(f"v{k}" for k in range(a, b))
    docs = [(10, line(0, 79)), (11, line(0, 104)), (12, line(200, 278)), (13, line(200, 304)), (14, line(400, 500)), (15, line(412, 512)), (16, line(424, 524)), (17, line(600, 606)), (18, line(600, 607))]
    got = result(jaccard_groups(docs_frame(spark, docs), "doc_id", "text"))
    assert got == brute(docs)
    assert got[11] == (100, 10) and got[13] == (100, 13) and got[16][1] == 14 and got[18][1] == 18


def test_edges(spark):
    docs = list(enumerate(odd_texts())) + [(100, "a b c"), (101, "A  b\tc"), (102, "a b c d e")]
    extra = [(None, "a b c"), (None, None), (100, "a b c")]
    rows = jaccard_groups(docs_frame(spark, docs + extra), "doc_id", "text").collect()
    assert len(rows) == len(docs) + 3
    want = brute(docs)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    assert jaccard_groups(docs_frame(spark, docs).limit(0), "doc_id", "text").count() == 0


def test_query_on_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert result(queries.op1_jaccard_join(spark, "/root/testdata/sf0.01")) == brute(docs)


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5000 + k) for k in range(50)] + [(7, 7), (None, 3), (3, None)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.component for r in components(df, "a", "b").collect()} == {x: root(x) for x in list(parent)}
    assert components(df.limit(0), "a", "b").count() == 0


def test_a_set_passes_the_filter_once(spark):
    """Copies of a set stand beside it by a rare chance only; else the joins with it grow by their number."""
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(0)
    wanted, others = (rng.integers(-1 << 63, (1 << 63) - 1, n) for n in (20_000, 200_000))
    shared = jaccard_join._filter_of(spark.createDataFrame(pa.table({"s": wanted})))
    assert jaccard_join._passes(shared, wanted).all() and jaccard_join._passes(shared, others).mean() < 1e-4
    ids = pa.array(range(40))
    shared = jaccard_join._filter_of(spark.createDataFrame(pa.table({"s": jaccard_join._mixed(ids)})))
    batch = pa.RecordBatch.from_arrays([ids, pa.array([f"one two three four five {k % 2}" for k in range(40)])], ["doc", "text"])
    assert sum(len(b) for b in jaccard_join._sets(shared)(iter([batch, batch]))) == 2


def changed(places, n=120):
    """A text of 200 words among copies of it with that many words replaced, no two of them alike."""
    rng = random.Random(places)
    base = [f"b{k}" for k in range(200)]
    docs = []
    for i in range(n):
        w = list(base)
        for at in rng.sample(range(5, 195, 6), places):
            w[at] = f"new{i}x{at}"
        docs.append((i, " ".join(w)))
    docs[n // 2] = (n // 2, " ".join(base))
    return docs


def rows_stored(monkeypatch, name):
    seen, store = [], jaccard_join.stored

    def counted(df, what):
        out = store(df, what)
        if what == name:
            seen.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "stored", counted)
    return seen


def test_what_was_copied_is_a_pivot(spark, monkeypatch):
    """Copies that are linked with their origin only are settled in one round, however many they are."""
    docs = changed(4)
    rounds = rows_stored(monkeypatch, "jaccard-met")
    got = result(jaccard_groups(docs_frame(spark, docs), "doc_id", "text"))
    assert got == brute(docs) and {c for _, c in got.values()} == {0}
    assert len(rounds) == 1


def test_sets_that_leave_no_room_are_not_paired(spark, monkeypatch):
    """Copies with too many shingles of their own meet nobody in the regions of the shared ones."""
    docs = changed(6)
    regions = rows_stored(monkeypatch, "jaccard-regions")
    got = result(jaccard_groups(docs_frame(spark, docs), "doc_id", "text"))
    assert got == brute(docs) and len({c for _, c in got.values()}) == len(docs)
    assert regions == [0]


def linked(docs):
    """{doc: how many others it is linked with}, by all pairs."""
    sets = {i: shingles(t) for i, t in docs}
    fits = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    return {i: sum(1 for j in sets if j != i and fits(sets[i], sets[j])) for i in sets}


def links(df):
    return {r.doc_id: r.n_links for r in df.collect()}


@pytest.mark.parametrize("seed,whole,part", [(1, 32, 1 << 10), (3, 2, 2), (5, 3, 4)])
def test_all_links_are_counted(spark, monkeypatch, seed, whole, part):
    """Also those inside a group that other links hold together, whether a region is split, compared whole or cut into parts."""
    monkeypatch.setattr(jaccard_join, "WHOLE", whole)
    monkeypatch.setattr(jaccard_join, "PART", part)
    docs = families(seed) + [(1000 + i, t) for i, t in changed(2, 40)]
    got = jaccard_groups(docs_frame(spark, docs), "doc_id", "text")
    assert links(got) == linked(docs) and result(got) == brute(docs)


def test_values_in_common(monkeypatch):
    """Counted by matrices and by pairs of rows alike."""
    import numpy as np
    rng = np.random.default_rng(4)
    for n, kinds, cells in [(3, 5, 1 << 22), (120, 30, 256), (150, 2000, 1 << 22), (40, 1, 64), (2, 0, 64)]:
        monkeypatch.setattr(jaccard_join, "MATRIX", cells)
        sets = [set(rng.integers(0, kinds, rng.integers(0, 40)).tolist()) if kinds else set() for _ in range(n)]
        rows = np.array([i for i, s in enumerate(sets) for _ in s], np.int64)
        values = np.array([v for s in sets for v in s], np.int64)
        got = jaccard_join._common(rows, values, n)
        assert all(got[i, j] == len(sets[i] & sets[j]) for i in range(n) for j in range(n) if i != j)
