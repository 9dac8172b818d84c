import math
import random
import re
from collections import Counter

import pytest
from edge import docs_frame, odd_texts

from pitlane.llm import lexical_search
from pitlane.llm.lexical_search import ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, k):
    """Sorted (item, rank, doc, score) rows; equal documents may stand for one another."""
    held = [(i, Counter(t)) for i, text in docs if (t := terms(text))]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(terms(text))
    out = []
    for item, want in wanted.items():
        scores = []
        for i, c in held:
            m = 10 + 90 * c.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in want if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def got(docs, items, k):
    out = ranked_search(docs, "doc_id", "text", items, "item_id", "text", k)
    assert out.columns == ["item_id", "rank", "id", "score"]
    return sorted([tuple(r) for r in out.collect()], key=str)


@pytest.mark.parametrize("postings,cells", [(200_000, 1 << 21), (15, 7)])
def test_against_brute_force(spark, monkeypatch, postings, cells):
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    rng = random.Random(3)
    some = [*"abcdefgh", "ab", "AB", "é", "Éa", "x1", "1x", "ſ", "日本"]
    text = lambda n: "".join(rng.choice(some) + rng.choice([" ", ", ", "-", "\n", "  ", "\x00", "{"]) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 40))) for i in range(120)] + [(500 + i, "a b, c") for i in range(30)]
    items = [(i, text(rng.randrange(1, 9))) for i in range(12)]
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    assert got(frame(docs, "doc_id long, text string").repartition(5), frame(items, "item_id long, text string"), 4) == brute(docs, items, 4)


def test_edges(spark):
    rows = list(enumerate(odd_texts())) + [(None, "one two"), (4, "one"), (4, "one"), (-1, "a" * 50_000 + " one"), (77, "wörds WÖRDS wÖrds")]
    items = [(1, "one Two"), (1, "w1 w2"), (None, "words w3 wörds"), (2, None), (3, ""), (4, "absent"), (5, "k ſ \U0001F600")]
    docs, bench = docs_frame(spark, rows), docs_frame(spark, items).withColumnRenamed("doc_id", "item_id")
    assert got(docs, bench, 3) == brute(rows, items, 3)
    assert got(docs.limit(0), bench, 3) == [] and got(docs, bench.limit(0), 3) == []
