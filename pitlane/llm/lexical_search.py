"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items make one automaton, each between guards, which every task
gets by broadcast. It reads the folded text of each document once and counts the
items' terms straight from it; no index of the documents is made. Its outputs
map to the items that hold the term.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.llm.shared import forget, stored, text_chunks
from pitlane.llm.words import LOWER, word_spans

#: A term in the texts' own characters (ASCII letters and digits, and all beyond ASCII).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Item terms that one automaton holds, about: more items are searched in blocks, one after another.
BLOCK_POSTINGS = 200_000
#: Cells (document, item) that a task scores at once, and groups in which the tasks' best are first compared.
CELLS, ROUNDS = 1 << 21, 64

_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.where(_IN_TERM, LOWER, 32).astype(np.uint8)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term): the distinct terms of each item, A-Z lower-cased. Rows of one id, null too, are one item."""
    folded = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return items.select(F.col(id_col).alias("item"), F.explode(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def guarded_automaton(terms: list[str]) -> ahocorasick.Automaton:
    """An automaton over bytes (one character each) that finds term k between two spaces as k."""
    out = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, term in enumerate(terms):
        out.add_word(" " + term.encode().decode("latin-1") + " ", k)
    if terms:
        out.make_automaton()
    return out


def count_terms(data: np.ndarray, offsets: np.ndarray, automaton: ahocorasick.Automaton, size: int) -> tuple[np.ndarray, ...]:
    """(terms of each row with repeats; row, term and tf of the automaton's terms by row and term) of UTF-8 rows."""
    n = np.bincount(word_spans(data, offsets, _IN_TERM)[2], minlength=len(offsets) - 1)
    none = np.zeros(0, np.int64)
    if not size:
        return n, none, none, none
    ends = offsets[1:] + np.arange(1, len(offsets))  # a guard stands behind each row
    text = np.insert(_FOLD[data], offsets[1:], 32)
    found = np.fromiter((x for hit in automaton.iter(" " + text.tobytes().decode("latin-1")) for x in hit), np.int64).reshape(-1, 2)
    row = np.searchsorted(ends, found[:, 0] - 1, "left")  # a hit ends on its closing guard, one place on for the guard in front
    key, tf = np.unique(row * size + found[:, 1], return_counts=True)
    return n, key // size, key % size, tf


def term_counts(docs: DataFrame, id_col: str, text_col: str, terms: list[str]) -> DataFrame:
    """(id, n, terms, tfs) of each document with a term: how many it has, and which of `terms` how often."""
    shared = docs.sparkSession.sparkContext.broadcast(guarded_automaton(terms))
    size = len(terms)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    lists = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column(1)):
                n, row, term, tf = count_terms(data, offsets, shared.value, size)
                at = pa.array(np.searchsorted(row, np.arange(last - first + 1)), pa.int32())
                held = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (term, tf)]
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(n, pa.int64()), *[x.cast(lists) for x in held]], ["id", "n", "terms", "tfs"])
                yield out.filter(pc.greater(out.column(1), 0))

    kinds = [T.StructField("n", T.LongType()), *[T.StructField(x, T.ArrayType(T.IntegerType())) for x in ("terms", "tfs")]]
    return rows.mapInArrow(run, T.StructType([rows.schema["id"], *kinds]))


def _best(held: pa.Table, k: int) -> pa.Table:
    """The k rows of highest score of each item, equal scores by id, null ids last."""
    order = pc.sort_indices(held, sort_keys=[("item", "ascending"), ("score", "descending"), ("id", "ascending")], null_placement="at_end")
    held = held.take(order)
    item = held.column("item").to_numpy()
    first = np.searchsorted(item, item, "left")
    return held.filter(pa.array(np.arange(len(item)) - first < k))


def score_documents(counted: DataFrame, weights: np.ndarray, holders: list[list[int]], n_items: int, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, id, score): each task's k best documents of each item, by the item's number."""
    ends = np.cumsum([0, *map(len, holders)])
    shared = counted.sparkSession.sparkContext.broadcast((weights, ends, np.array([i for x in holders for i in x], np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, end, items = shared.value
        held, least = None, np.ones(n_items, np.int64)  # the score that a document must reach, by item
        step = max(1, CELLS // max(n_items, 1))
        for whole in batches:
            for batch in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
                term, tf = (batch.column(x).flatten().to_numpy().astype(np.int64) for x in (2, 3))
                row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(2)).to_numpy())
                m = 100 - 90 + (90 * batch.column(1).to_numpy() * n_docs) // n_terms
                part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
                often = end[term + 1] - end[term]
                inside = np.arange(often.sum()) - np.repeat(np.cumsum(often) - often, often)
                scores = np.zeros((batch.num_rows, n_items), np.int64)
                np.add.at(scores, (np.repeat(row, often), items[np.repeat(end[term], often) + inside]), np.repeat(part, often))
                at, item = np.nonzero(scores >= least)
                new = pa.table({"item": pa.array(item), "id": batch.column(0).take(pa.array(at)), "score": pa.array(scores[at, item])})
                if not len(at):
                    continue
                held = _best(pa.concat_tables([held, new]) if held else new, k)
                got = held.column("item").to_numpy()
                full = np.flatnonzero(np.arange(len(got)) - np.searchsorted(got, got, "left") == k - 1)
                least[got[full]] = held.column("score").to_numpy()[full]
        if held:
            yield from held.combine_chunks().to_batches()

    kinds = [T.StructField("item", T.LongType()), counted.schema["id"], T.StructField("score", T.LongType())]
    return counted.mapInArrow(run, T.StructType(kinds))


def ranked_search(docs: DataFrame, id_col: str, text_col: str, items: DataFrame, item_col: str, item_text: str, k: int = 10) -> DataFrame:
    """(item_id, rank, id, score): the k documents of highest score for each item, all with a score above 0.

    With N documents that hold a term, L terms in them, n in one and df documents
    of a term, a term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))); with m =
    10 + 90 n N div L a document's score is the sum of w (10^9 tf div (1000 tf +
    8 m)) over the item's distinct terms. Texts are read whole, a null one as
    without terms. Every row is a document of its own, so repeated ones take
    ranks of their own; equal scores stand by id, null ids last. Items of one
    id are one; items without terms and empty tables give no rows. Columns
    beside the named ones are not read. Items are taken in blocks of about
    BLOCK_POSTINGS terms, each a pass over the documents; N, L and df are of all."""
    postings = stored(item_terms(items, item_col, item_text), "search-terms")
    blocks = max(1, math.ceil(postings.count() / BLOCK_POSTINGS))
    found = [_search_block(docs, id_col, text_col, postings.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), k) for b in range(blocks)]
    forget(postings)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _search_block(docs: DataFrame, id_col: str, text_col: str, postings: DataFrame, k: int) -> DataFrame:
    held = sorted(((r.term, r.item) for r in postings.collect()), key=lambda x: (x[0], x[1] is not None, x[1]))  # one block
    names = sorted({i for _, i in held}, key=lambda i: (i is not None, i))
    number = {i: at for at, i in enumerate(names)}
    terms = sorted({t for t, _ in held})
    place = {t: at for at, t in enumerate(terms)}
    holders: list[list[int]] = [[] for _ in terms]
    for term, item in held:
        holders[place[term]].append(number[item])
    counted = stored(term_counts(docs, id_col, text_col, terms), "search-counts")
    n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(terms), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a number for each term of the block
        df[r.term] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    best = score_documents(counted, weights, holders, len(names), n_docs, n_terms, k).withColumn("_round", F.spark_partition_id() % ROUNDS)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    for keys in (["item", "_round"], ["item"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    named = docs.sparkSession.createDataFrame([(at, i) for at, i in enumerate(names)], T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", postings.schema["item"].dataType)]))
    out = stored(best.join(F.broadcast(named), "item").select("item_id", "rank", "id", "score"), "search-best")  # items of one block
    forget(counted)
    return out
