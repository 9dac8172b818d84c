"""Exact top-k search by inner product with a vector-approximation file."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitlane.llm.shared import stored

#: Cells of a component's range; a cell number takes one byte.
CELLS = 256
#: Queries that one pass over the approximations takes; more queries take more passes.
QUERY_BLOCK = 4_096
#: Rows of approximations that a task compares at once.
SCAN_ROWS = 1_024
#: Exact vectors that one round reads for a query, in the order of their upper bounds; what is still open after the last round is read at once.
READS = (32, 256, 2_048)


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(id, v): floor(scale * x) of every component as a long, for vectors whose components are all finite.

    Null and empty vectors, ones with a null, NaN or infinite component, and rows with a null id take no part."""
    x = F.col(vector_col).cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    # a null component makes forall null or false: neither passes the filter
    return (df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & F.forall(x, finite))
            .select(F.col(id_col).alias("id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v")))


def _approximate(low: np.ndarray, width: np.ndarray):
    """(id, length, cells): the cells of a vector's components, one byte each."""
    def run(batches):
        for batch in batches:
            length = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(length)
            place = np.arange(len(v)) - np.repeat(ends - length, length)
            cells = ((v - low[place]) // width[place]).astype(np.uint8)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(offsets), pa.py_buffer(cells)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(length.astype(np.int32)), packed], ["id", "length", "cells"])
    return run


def _bounds(low: np.ndarray, width: np.ndarray, shared, k: int):
    """For each query, the rows of its length whose best possible score reaches the k-th largest worst score in the task so far."""
    def run(batches):
        by_length = {}
        for n, (query_ids, q) in shared.value.items():
            middle = low[:n] + (width[:n] - 1) / 2.0
            # a score lies within +- spread of that of the cells' middles; the second part is for rounding
            most = np.maximum(np.abs(low[:n]), np.abs(low[:n] + width[:n] * CELLS)).astype(np.float64)
            spread = np.abs(q) @ ((width[:n] - 1) / 2.0) + 1e-9 * (np.abs(q) @ most)
            by_length[n] = [query_ids, q, middle, spread, np.full((len(q), k), -np.inf)]
        for batch in batches:
            lengths = batch.column(1).to_numpy()
            for n in np.unique(lengths):
                if n not in by_length:
                    continue
                query_ids, q, middle, spread, worst = by_length[n]
                rows = batch.filter(pa.array(lengths == n))
                for at in range(0, len(rows), SCAN_ROWS):
                    part = rows.slice(at, SCAN_ROWS)
                    ids = part.column(0).to_numpy()
                    cells = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(len(part), n)
                    score = q @ (cells * width[:n].astype(np.float64) + middle).T
                    score[query_ids[:, None] == ids] = -np.inf
                    least = score - spread[:, None]
                    worst = -np.partition(np.concatenate([-worst, -least], axis=1), k - 1, axis=1)[:, :k]
                    kth = worst.min(axis=1)
                    row, col = np.nonzero((score + spread[:, None] >= kth[:, None]) & np.isfinite(score))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query_ids[row]), pa.array(ids[col]), pa.array(least[row, col]), pa.array(score[row, col] + spread[row])], ["query_id", "id", "least", "most"])
                by_length[n][4] = worst
    return run


def _refined(near: DataFrame, exact: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score) of the rows that had to be read: `near` (query_id, id, most) in falling order of `most`.

    A round reads the next READS rows of each query whose upper bound reaches the k-th
    exact score so far; a query without such rows is certain. What is open after the
    last round is read by one join, so no order of all of a query's rows is made."""
    inner = F.aggregate(F.zip_with("v", "qv", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    queries = asked.select(F.col("id").alias("query_id"), F.col("v").alias("qv"))
    read, rows = None, near.withColumn("turn", F.struct(-F.col("most"), F.col("id")))
    for reads in (*READS, None):
        open_rows = rows
        if read is not None:
            nth = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
            cut = (read.where("score is not null").withColumn("nth", nth).where(F.col("nth") <= k)
                   .groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("cut")))
            state = read.groupBy("query_id").agg(F.max("turn").alias("last")).join(cut, "query_id", "left")
            open_rows = rows.join(state, "query_id").where((F.col("turn") > F.col("last")) & (F.col("cut").isNull() | (F.col("most") >= F.col("cut")))).select(*rows.columns)
        if reads is not None:
            open_rows = open_rows.withColumn("nth", F.row_number().over(W.partitionBy("query_id").orderBy("turn"))).where(F.col("nth") <= reads).drop("nth")
        part = open_rows.join(exact, "id").join(queries, "query_id").where(F.size("v") == F.size("qv")).select("query_id", "id", "turn", inner.alias("score"))
        part = stored(part, "scores")
        if not part.limit(1).count():
            break
        read = part if read is None else read.union(part)
    return (part if read is None else read).select("query_id", "id", "score")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, id, score): the k largest integer inner products of each query with rows other than itself.

    `vectors` and `queries` are (id long, v array<long>) as `integer_vectors`
    gives them; a query is compared with vectors of its own length only. Ties go to the smaller id; with fewer than k
    other rows, all are returned; repeated rows are candidates of their own, and
    a row with the query's id is never its candidate; of queries with
    one id the one of the smallest vector counts. Empty tables give an empty result.

    The approximation file holds each component's cell (one byte) in the shared
    folder. Queries are taken in blocks of QUERY_BLOCK rows, each sent to a scan
    of the cells that bounds every score from both sides. What can't reach the
    k-th largest lower bound of its task is dropped there, the rest is cut by the
    k-th lower bound of all tasks. Exact vectors are then read in falling order of
    the upper bounds, in rounds, until the k-th exact score is above the bounds of
    all that is left (`_refined`), so the result is exact whatever the cells are."""
    spark = vectors.sparkSession
    out = "query_id long, rank int, id long, score long"
    exact = stored(vectors, "vectors")
    asked = stored(queries.groupBy("id").agg(F.min("v").alias("v")), "queries")
    span = exact.select(F.posexplode("v").alias("p", "x")).groupBy("p").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("p").collect()
    low = np.array([r.lo for r in span], np.int64)
    width = np.array([max(1, -(-(r.hi - r.lo + 1) // CELLS)) for r in span], np.int64)
    cells = stored(exact.mapInArrow(_approximate(low, width), "id long, length int, cells binary"), "cells")
    found, done = None, None
    while True:  # query blocks by id: each pass takes the next QUERY_BLOCK queries
        block = (asked if done is None else asked.where(F.col("id") > done)).orderBy("id").limit(QUERY_BLOCK).collect()
        if not block:
            break
        done = block[-1].id
        by_length = {n: [r for r in block if len(r.v) == n] for n in {len(r.v) for r in block}}
        shared = spark.sparkContext.broadcast({n: (np.array([r.id for r in rs], np.int64), np.array([r.v for r in rs], np.float64)) for n, rs in by_length.items()})
        part = cells.mapInArrow(_bounds(low, width, shared, k), "query_id long, id long, least double, most double")
        part = stored(part, "bounds")
        found = part if found is None else found.union(part)
        if len(block) < QUERY_BLOCK:
            break
    if found is None:
        return spark.createDataFrame([], out)
    best = W.partitionBy("query_id")
    bar = (found.withColumn("nth", F.row_number().over(best.orderBy(F.desc("least")))).where(F.col("nth") <= k)
           .groupBy("query_id").agg(F.when(F.count("*") == k, F.min("least")).alias("bar")))
    near = found.join(bar, "query_id").where(F.col("bar").isNull() | (F.col("most") >= F.col("bar")))
    near = stored(near.groupBy("query_id", "id").agg(F.max("most").alias("most")), "near")
    rank = F.row_number().over(best.orderBy(F.desc("score"), "id"))
    return _refined(near, exact, asked, k).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
