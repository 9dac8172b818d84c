import hashlib
import zlib

import pytest
from edge import docs_frame, odd_texts
from pyspark.sql import functions as F

from pitlane.llm import merkle
from pitlane.llm.merkle import manifest, manifest_digest, place_in_group

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    out = []
    for f in FIELDS:
        v = r[f] if r[f] is None or f != "n_chars" else r[f] + more
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return sha(*out)


def climb(hashes):
    """The root and, for each leaf, (left, right) of every level."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for i, a in enumerate(at):
            run = level[a - a % 2: a - a % 2 + 2]
            paths[i].append((run[0] if a % 2 else "", run[1] if a % 2 == 0 and len(run) == 2 else ""))
        level = [sha(*level[k: k + 2]) for k in range(0, len(level), 2)]
        at = [a // 2 for a in at]
    return level[0], paths


def brute(rows):
    """The digest rows of a list of row dicts."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        subs[g] = climb([x[2] for x in groups[g]])
    root, tops = climb([subs[g][0] for g in names]) if names else ("", [])
    out = []
    for g, top in zip(names, tops):
        for (_, _, h, r), path in zip(groups[g], subs[g][1]):
            steps, x = path + top, h
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0:
                x = leaf(r, 1)
            for a, b in steps:
                x = sha(a, x, b)
            out.append((r["doc_id"], h, subs[g][0], root, sha(*[a + b for a, b in steps]), x, x == root))
    return sorted(out, key=str)


def digest(docs):
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    out = manifest_digest(manifest(docs, "doc_id", "lang", FIELDS, {"n_chars": F.col("n_chars") + 1}, changed))
    return sorted([tuple(r) for r in out.collect()], key=str)


@pytest.mark.parametrize("band", [1, 2, 10])
def test_against_brute_force(spark, monkeypatch, band):
    monkeypatch.setattr(merkle, "BAND", band)
    rows = [dict(doc_id=i * 3 % 101, source=f"s{i % 3}", lang=[None, "en", "é", "z", "", "en"][i % 6], n_chars=None if i % 11 == 0 else i, text=f"text ü {i}") for i in range(67)]
    rows += [dict(doc_id=5, source="s", lang="lone", n_chars=1, text="t")]
    got = digest(spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], "doc_id long, source string, lang string, n_chars long, text string"))
    assert got == brute(rows)
    assert any(not r[6] for r in got) and any(r[6] for r in got)


def test_edges(spark):
    docs = docs_frame(spark, [(i, t) for i, t in enumerate(odd_texts())] + [(None, "x"), (None, None), (3, "\n\n"), (3, "\n\n"), (-7, "y")])
    assert digest(docs) == brute([r.asDict() for r in docs.collect()])
    assert digest(docs.limit(0)) == []
    one = docs.limit(1)
    ((_, h, sub, root, proof, folded, ok),) = digest(one)
    assert h == sub == root and proof == sha() and ok == (folded == root)


def test_places_are_whole_over_many_partitions(spark):
    nodes = spark.range(0, 5000, 1, 7).select(F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("g"), (F.col("id") * 7919 % 4999).alias("id"))
    got = {}
    for r in place_in_group(nodes.repartition(13), ["id"]).collect():
        got.setdefault(r.g, []).append((r.pos, r.id, r.n))
    for have in got.values():
        have.sort()
        assert [p for p, _, _ in have] == list(range(len(have))) and [i for _, i, _ in have] == sorted(i for _, i, _ in have)
        assert {n for _, _, n in have} == {len(have)}

