import math
import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from pitlane.llm import queries, url_filter
from pitlane.llm.url_filter import RULES, UrlModel, filter_urls, lexical

URLS = ["http://a.org/x", "http://org/", "http://org", "http://morg/x", "HTTP://X.Example.ORG/es/1?q=/de/", "https://example.org/en/12#a", "https://b.example.org/en/2", "x.com/fr/1", "ftp://www.com/fr/", "a://com/de/://x.org/",
        "://org/", "http://", "", None, "http://É.ORG/x", "http://a.com?x=/fr/", "http://a.com/fr", "http://user@h.com:80/fr/a/b.html", "http://a.org./", "a://b\nc.org/é/\n?"]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def same(rows, urls):
    for r in rows:
        host, path, rule, verdict = brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), urls[r.page_id]
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)


def test_rules_on_edges(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("extra")).withColumn("score", F.lit(1)).withColumn("f_depth", F.lit("x"))
    rows = filter_urls(df, "page_id", "url").collect()
    assert len(rows) == len(URLS)
    same(rows, dict(enumerate(URLS)))
    assert filter_urls(df.limit(0), "page_id", "url").count() == 0
    alone = df.where("url is null or url = ''")
    assert [r.verdict for r in filter_urls(alone.union(alone), "page_id", "url").collect()] == ["allow"] * 4


def test_query_on_whole_table(spark):
    urls = dict(duckdb.sql("select page_id, url from '/root/testdata/sf0.01/pages.parquet'").fetchall())
    rows = queries.op6_url_filter(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(urls)
    same(rows, urls)


def test_held_out_accuracy(spark):
    rng = random.Random(3)
    name = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    good = [f"https://{name(6)}.net/{name(5)}/{name(7)}" for _ in range(400)]
    bad = [f"http://{name(4)}-{name(4)}.{name(3)}{rng.randrange(10**6)}.biz/{name(3)}?a={rng.randrange(10**6)}&b=1&c=2" for _ in range(400)]
    rows = [(u, 0.0) for u in good] + [(u, 1.0) for u in bad]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows[:500], "url string, blocked double")
    held = spark.createDataFrame(rows[500:], "url string, truth double")
    got = UrlModel(df, "url", "blocked").score(lexical(held, "url")).select("truth", "score").collect()
    assert sum((r.score >= 0.5) == (r.truth == 1) for r in got) / len(got) > 0.95


def test_statistics_are_of_all_labelled_urls(spark, monkeypatch):
    """With a fit on 40 URLs, the counts are still those of all 600, a URL of both labels being blocked once."""
    monkeypatch.setattr(url_filter, "TRAIN_ROWS", 40)
    rows = [(f"http://h{i}.n{i % 50}.t{i % 3}/{i}{'.html' if i % 2 else ''}", float(i % 3 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows + [(rows[1][0], 1.0), (rows[2][0], 0.0), (None, 1.0), ("http://x.y/", None)], "url string, blocked double")
    model = UrlModel(df, "url", "blocked")
    assert model.n == 600 and abs(model.base - 201 / 600) < 1e-12
    got = {k: {r[k]: (r[f"{k}_n"], r[f"{k}_blocked"]) for r in model.stats[k].collect()} for k in url_filter.KEYS}
    assert got["suffix"] == {"t0": (200, 200.0), "t1": (200, 1.0), "t2": (200, 0.0)}
    assert len(got["name"]) == 50 and {n for n, _ in got["name"].values()} == {12}
    assert {k: n for k, (n, _) in got["ending"].items()} == {".html": 300, "": 300}


def test_entropy_and_very_long_urls(spark):
    rng = random.Random(4)
    long = "http://a.biz/" + "".join(chr(0x4E00 + rng.randrange(20_000)) for _ in range(100_000))
    texts = ["", "a", "aab", "http://x.org/?a=1", long]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(url_filter._entropy(F.col("t"))).collect()]
    for t, e in zip(texts, got):
        shares = [n / len(t) for n in Counter(t).values()]
        assert abs(e + sum(p * math.log(p) for p in shares)) < 1e-9
    df = spark.createDataFrame([(1, long), (2, "http://a.org/" + "x" * 300_000)], "page_id long, url string")
    assert {r.page_id: r.rule for r in filter_urls(df, "page_id", "url").collect()} == {1: None, 2: "org/"}
