"""Positions of values and rows held against sorted Python lists: NULL groups, no group, long common beginnings, wide ranges."""

import random

import pytest
from pyspark.sql import functions as F

from pitlane.operators.positions import bucket_totals, row_positions, value_positions

INF, NAN = float("inf"), float("nan")


def draws(kind, n):
    rng = random.Random(n)
    if kind == "string":
        return [f"https://www.example.org/a/common/long/path/of/every/item/{rng.randrange(400):06d}"[: rng.choice([0, 3, 9, 30, 58, 99])] for _ in range(n)]
    if kind == "long":
        return [rng.choice([rng.randrange(-2**63, 2**63), rng.randrange(-9, 9), 10**12 + rng.randrange(5000), -2**63, 2**63 - 1]) for _ in range(n)]
    return [rng.choice([rng.gauss(0, 1), 1e300 * rng.random(), -1e-300, 0.0, INF, -INF, float(rng.randrange(9))]) for _ in range(n)]


@pytest.mark.parametrize("group", [["g"], []])
@pytest.mark.parametrize("kind", ["string", "long", "double"])
def test_positions_equal_a_sort(spark, kind, group):
    rows = [(random.Random(i).choice(["a", "a", "b", None]), v, i) for i, v in enumerate(draws(kind, 600))]
    rows += [("a", None, 1000), (None, None, 1001)]
    df = spark.createDataFrame(rows, f"g string, x {kind}, i long")
    order = lambda v: (v is not None, (v.encode() if kind == "string" else v) if v is not None else 0)
    key = lambda r: r[0] if group else 0
    want_rows, want_values = {}, {}
    for g in {key(r) for r in rows}:
        own = sorted((r for r in rows if key(r) == g), key=lambda r: (order(r[1]), r[2]))
        want_rows |= {r[2]: at for at, r in enumerate(own)}
        values = [r[1] for r in own if r[1] is not None]
        for v in set(values):
            want_values[g, v] = (values.count(v), sum(order(w) < order(v) for w in values), len(values))
    assert {r.i: r._p for r in row_positions(df, group, ["x", "i"], "_p").collect()} == want_rows
    got = {(r.g if group else 0, r.x): (r._n, r._before, r._total) for r in value_positions(df, group, "x").collect()}
    assert got == want_values


def test_a_million_long_keys(spark):
    """Distinct 20-character ids with a common beginning: every position once, and each level's windows are small."""
    n = 1_000_000
    df = spark.range(n).select(F.format_string("game-2024-x-%08d", F.pmod(F.col("id") * 7919, F.lit(n))).alias("x"), (F.col("id") * 2**43).alias("y"))
    got = value_positions(df, [], "x").select(F.sum((F.col("_before") == F.substring("x", 13, 8).cast("long")).cast("int")), F.max("_total")).first()
    assert tuple(got) == (n, n)
    got = row_positions(df, [], ["y"], "_p").select(F.sum((F.col("_p") == F.col("y") / 2**43).cast("int"))).first()
    assert got[0] == n


def test_totals_run_over_children_only(spark):
    """No window of the string and long plans goes over the finest buckets without the level above as its partition."""
    for dtype, value in (("string", "'a'"), ("long", "1L"), ("double", "1.0D"), ("timestamp", "timestamp_micros(1)")):
        df = spark.range(9).selectExpr(f"cast({value} as {dtype}) as v", "id as _kn")
        from pitlane.operators.positions import coarse_key
        t = bucket_totals(df.withColumn("_k", coarse_key(F.col("v"), df.schema["v"].dataType)).select("_k", "_kn"), [], df.schema["v"].dataType)
        plan = t._jdf.queryExecution().analyzed().toString()
        assert "windowspecdefinition(_k" in plan and "windowspecdefinition(0, _k#" not in plan
