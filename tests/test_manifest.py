"""Merges through a manifest of files: what is read and written, replays, lost batches, edges."""

import pytest
from pyspark.sql import functions as F

from pitlane.streaming import manifest as M


@pytest.fixture
def table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "FILE_ROWS", 100)
    base = str(tmp_path / "t")
    done = M.merge_batch(base, rows(spark, 0, 1000), ["k"])
    assert done["written"] == 1000 and M.read_manifest(spark, base).count() >= 8
    return base


def rows(spark, start, end, v=0):
    return spark.range(start, end).select(F.col("id").alias("k"), (F.col("id") * 10 + v).alias("v"))


def content(spark, base):
    return {r.k: r.v for r in M.read_table(spark, base).collect()}


def test_a_batch_rewrites_only_what_it_can_touch(spark, table):
    before = {r.file for r in M.read_manifest(spark, table).collect()}
    done = M.merge_batch(table, rows(spark, 480, 520, 7), ["k"])
    after = {r.file for r in M.read_manifest(spark, table).collect()}
    assert done["read"] <= 2 and done["written"] <= 300 and len(before & after) == done["kept"] >= len(before) - 2
    want = {k: k * 10 + (7 if 480 <= k < 520 else 0) for k in range(1000)}
    assert content(spark, table) == want
    far = M.merge_batch(table, rows(spark, 2000, 2050), ["k"])
    assert far["read"] == 0 and far["written"] == 50 and content(spark, table) == want | {k: k * 10 for k in range(2000, 2050)}
    assert M.expire_files(spark, table) == 0  # every folder still has a named file
    assert M.merge_batch(table, rows(spark, 2000, 2050, 1), ["k"])["written"] == 50 and M.expire_files(spark, table) == 1
    assert content(spark, table)[2049] == 20491


def test_replay_and_lost_batch(spark, table, monkeypatch):
    batch = rows(spark, 100, 130, 3)
    with monkeypatch.context() as m:
        def broken(*_):
            raise OSError("lost before the commit")

        m.setattr(M, "write_snapshot", broken)
        with pytest.raises(OSError):
            M.merge_batch(table, batch, ["k"])
    assert content(spark, table) == {k: k * 10 for k in range(1000)}
    for _ in range(2):
        M.merge_batch(table, batch, ["k"])
        assert content(spark, table) == {k: k * 10 + (3 if 100 <= k < 130 else 0) for k in range(1000)}
    assert M.merge_batch(table, rows(spark, 50, 60, 9), ["k"], how="insert") and content(spark, table)[55] == 550


def test_edges(spark, tmp_path):
    base = str(tmp_path / "e")
    empty = rows(spark, 0, 0)
    assert M.merge_batch(base, empty, ["k"])["written"] == 0
    one = spark.createDataFrame([(None, 1), (5, 2)], "k long, v long")
    M.merge_batch(base, one, ["k"])
    M.merge_batch(base, empty, ["k"])
    M.merge_batch(base, spark.createDataFrame([(None, 9)], "k long, v long"), ["k"], how="insert")
    assert set(content(spark, base)) == {None, 5} and len(M.read_table(spark, base).collect()) >= 2
    M.merge_batch(base, spark.createDataFrame([(7, 8, "x")], "v long, k long, other string").drop("other"), ["k"])
    assert content(spark, base)[8] == 7
