"""Helpers of the training-data operators: shared scratch tables and Arrow text batches."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from pitlane.session import ensure_checkpoint_dir

#: Bytes of text that the vectorised helpers take at once (a longer text is taken alone and whole).
CHUNK_BYTES = 1 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder that `spark.checkpoint.dir` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor rereads files that all executors share.
    What was shuffled for it isn't needed any more; Spark deletes such files once
    the driver has collected the plans' garbage, which is asked for here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    spark._jvm.System.gc()
    return out


def forget(*frames: DataFrame) -> None:
    """Delete the folders of `stored` tables that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def code_for_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a cluster installs it)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    held = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in held.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, held) if x)


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow string array into runs of rows of about `limit` bytes.

    Yields (first row, last row + 1, UTF-8 bytes, offsets of the rows in them). Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset: texts.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last, data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first]
        first = last
