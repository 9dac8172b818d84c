import re

import duckdb
import pytest
from edge import docs_frame, odd_texts

from pitlane.llm import queries
from pitlane.llm.license_scan import license_digest, license_spans

PHRASES = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
TEXTS = ["All rights reserved. ALL RIGHTS, RESERVED! cc-by cc by 4", "all rights all rights reserved reserved", "General  Public\nLicense", "ccé by; c c by",
         "Released under the MIT License.", "Permission is hereby granted, free of charge, to any one person who is obtaining a copy of this software and associated documentation files, the Software, to deal in the Software",
         "cc", "cc by", "cc cc by by", "Kcc by"]


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = sorted((i, k) for k, p in PHRASES.items() for i in range(len(w)) if w[i: i + len(p)] == p)
    return len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({k for _, k in at}))


def rows(df):
    return {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in df.collect()}


def test_edges(spark):
    texts = odd_texts() + TEXTS
    df = license_digest(license_spans(docs_frame(spark, enumerate(texts)), "doc_id", "text"))
    assert rows(df) == {i: brute(t) for i, t in enumerate(texts)}
    labels = {r.doc_id - len(odd_texts()): (r.labels, r.score) for r in df.collect()}
    assert labels[4] == ("mit", 1.0) and labels[5][0] == "mit" and 0.6 <= labels[5][1] < 1
    assert labels[0][0] == "cc-by,reserved"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_on_whole_table(spark, sf):
    docs = duckdb.sql(f"select doc_id, text from '/root/testdata/{sf}/documents.parquet'").fetchall()
    assert rows(queries.op5_license_scan(spark, f"/root/testdata/{sf}")) == {i: brute(t) for i, t in docs}


def test_repeated_null_and_empty(spark):
    df = docs_frame(spark, [(1, "cc by"), (1, "cc by"), (None, "cc by"), (None, None)])
    assert sorted(r.n_base for r in license_digest(license_spans(df, "doc_id", "text")).collect()) == [0, 1, 1, 1]
    assert license_digest(license_spans(df.limit(0), "doc_id", "text")).count() == 0


def test_no_python_in_the_plan(spark):
    plan = queries.op5_license_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
