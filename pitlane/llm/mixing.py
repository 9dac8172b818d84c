"""Temperature mixing of sources: weights by bisection, realised as budgeted block permutations."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitlane.llm.shared import stored

#: The entropy of the weights is raised from that of the token shares by this part of the way to the largest possible.
ENTROPY_PART = 0.5
#: No source is read more often than this.
MOST_PASSES = 4.0
#: Blocks of a source are about this many documents, by hash.
BLOCK_DOCS = 1_000
#: Weights are bisected until the exponent is known to 2^-HALVINGS.
HALVINGS = 60
#: Sources that the weights are found for on the driver, at most.
MOST_SOURCES = 100_000


def block_place(source: Column, turn: Column, block: Column) -> Column:
    """A block's place in the order of one pass over a source; each pass of each source has an order of its own."""
    return F.xxhash64(source, turn.cast("long"), block.cast("long"))


@dataclass
class Mixture:
    exponent: float
    weights: dict  # source -> weight, summing to 1
    passes: dict  # source -> times that its tokens are read, at least 1
    budget: float  # tokens in all


def powers(tokens: dict, exponent: float) -> dict:
    """Normalised token shares to the power of `exponent`."""
    total = sum(tokens.values())
    logs = {s: exponent * math.log(n / total) for s, n in tokens.items()}
    top = max(logs.values())
    raw = {s: math.exp(v - top) for s, v in logs.items()}
    whole = sum(raw.values())
    return {s: v / whole for s, v in raw.items()}


def entropy(weights: dict) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def mixture(tokens: dict, target_entropy: float | None = None, most_passes: float = MOST_PASSES) -> Mixture:
    """Weights proportional to share ** exponent, for sources that have tokens.

    The exponent lies from 0 (all alike) to 1 (the shares themselves). It is the
    largest one at which the entropy reaches the target (by default ENTROPY_PART
    of the way from the shares' entropy to that of equal weights), or, if there
    a source would be read more than `most_passes` times, the smallest one that
    keeps to this limit. The budget is the smallest at which every source is
    read once at least: the source of the largest share once, the others more."""
    tokens = {s: n for s, n in tokens.items() if n > 0}
    if not tokens:
        return Mixture(1.0, {}, {}, 0.0)
    least, most = entropy(powers(tokens, 1.0)), math.log(len(tokens))
    target = least + ENTROPY_PART * (most - least) if target_entropy is None else min(max(target_entropy, least), most)

    def passes(exponent: float) -> dict:
        weights = powers(tokens, exponent)
        budget = max(n / weights[s] for s, n in tokens.items())
        return {s: budget * weights[s] / n for s, n in tokens.items()}

    def bisect(holds_low) -> float:
        """The border between exponents where `holds_low` is true (low ones) and those where it isn't."""
        low, high = 0.0, 1.0
        for _ in range(HALVINGS):
            middle = (low + high) / 2
            low, high = (middle, high) if holds_low(middle) else (low, middle)
        return low

    exponent = 1.0 if entropy(powers(tokens, 1.0)) >= target - 1e-12 else bisect(lambda t: entropy(powers(tokens, t)) >= target)
    if max(passes(exponent).values()) > most_passes + 1e-9:
        exponent = min(1.0, bisect(lambda t: max(passes(t).values()) > most_passes) + 2.0**-HALVINGS)
    weights = powers(tokens, exponent)
    often = passes(exponent)
    return Mixture(exponent, weights, often, sum(often[s] * n for s, n in tokens.items()))


def with_tokens(docs: DataFrame, text_col: str, name: str = "_tokens") -> DataFrame:
    """Adds the number of words, parted by ASCII white space, of each whole text (null: 0)."""
    return docs.withColumn(name, F.coalesce(F.regexp_count(text_col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long"))


def realise(docs: DataFrame, id_col: str, source_col: str, text_col: str, target_entropy: float | None = None, most_passes: float = MOST_PASSES) -> tuple[DataFrame, Mixture]:
    """`docs` plus `mix_tokens`, `mix_block`, `mix_order` and `copies`, and the mixture.

    Each source is cut into blocks by the hash of the id, and for each pass its
    blocks are put in an order by hash of source, pass and block. Its passes are
    whole ones, of all its blocks, and a last one over the first blocks of its
    order (`mix_order`) that fit what is left of its token budget; of the block on the border the first documents (by
    hash) that fit are taken. `copies` is how often a document is read. So every
    document is read once at least, and a source's tokens fall short of its
    budget by less than one document.

    A null source is a source of its own. Documents without words (null texts,
    too) are read in whole passes only. Rows of one id, repeated or null, are
    taken alike; an empty table gives an empty result; other columns are kept,
    except those named like the new ones.

    A hot source has more blocks, not larger ones. Windows run over one source's
    block sums and over the documents of one border block a source. What
    decides is a border for each source, so the documents themselves are never
    shuffled; sources and borders are broadcast (MOST_SOURCES rows at most)."""
    spark = docs.sparkSession
    docs = docs.drop("mix_tokens", "mix_block", "mix_order", "copies")
    rows = with_tokens(docs, text_col, "mix_tokens")
    narrow = stored(rows.select(F.col(id_col).alias("id"), F.col(source_col).alias("src"), F.col("mix_tokens").alias("t")), "mix-docs")
    sums = narrow.groupBy("src").agg(F.sum("t").alias("t"), F.count("*").alias("docs")).limit(MOST_SOURCES + 1).collect()
    if len(sums) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    mix = mixture({r.src: r.t for r in sums}, target_entropy, most_passes)
    src, ident = docs.schema[source_col].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
    plan = {}
    for r in sums:
        often = mix.passes.get(r.src, 1.0)
        whole = max(1, math.floor(often + 1e-9))
        plan[r.src] = [max(1, r.docs // BLOCK_DOCS), whole, max(0, math.floor((often - whole) * r.t + 1e-6))]

    # the border block of each source: the last that the budget reaches into
    at = F.broadcast(spark.createDataFrame([(s, b, whole, rest) for s, (b, whole, rest) in plan.items()], f"p_src {src}, blocks long, whole int, rest long"))
    dealt = narrow.join(at, F.col("src").eqNullSafe(F.col("p_src"))).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    blocks = dealt.groupBy("src", "block", "whole", "rest").agg(F.sum("t").alias("t")).withColumn("order", block_place(F.col("src"), F.col("whole") + 1, F.col("block")))
    along = W.partitionBy("src").orderBy("order", "block")
    blocks = blocks.withColumn("before", F.sum("t").over(along) - F.col("t")).where((F.col("t") > 0) & (F.col("before") < F.col("rest")))
    border = blocks.groupBy("src").agg(F.max(F.struct("before", "order", "block", "rest")).alias("b")).select("src", "b.*").collect()

    # and the last document in it that fits
    edge = F.broadcast(spark.createDataFrame([(r.src, r.block, r.rest - r.before) for r in border], f"e_src {src}, e_block long, room long"))
    inside = W.partitionBy("src").orderBy(F.xxhash64("id", F.lit(2)), "id")
    last = dealt.join(edge, F.col("src").eqNullSafe(F.col("e_src")) & (F.col("block") == F.col("e_block")))
    last = last.withColumn("sum", F.sum("t").over(inside)).where(F.col("sum") <= F.col("room"))
    last = {r.src: (r.l.h, r.l.id) for r in last.groupBy("src").agg(F.max(F.struct(F.xxhash64("id", F.lit(2)).alias("h"), "id")).alias("l")).collect()}
    edges = {r.src: (r.order, r.block, *last.get(r.src, (None, None))) for r in border}

    none = (None, None, None, None)
    decide = [(s, b, whole, *edges.get(s, none), s in last) for s, (b, whole, _) in plan.items()]
    decide = spark.createDataFrame(decide, f"p_src {src}, p_blocks long, p_whole int, p_order long, p_block long, p_hash long, p_id {ident}, p_some boolean")
    out = rows.join(F.broadcast(decide), F.col(source_col).eqNullSafe(F.col("p_src")))
    out = out.withColumn("mix_block", F.pmod(F.xxhash64(id_col), F.col("p_blocks"))).withColumn("mix_order", block_place(F.col(source_col), F.col("p_whole") + 1, F.col("mix_block")))
    place, border = F.struct("mix_order", "mix_block"), F.struct("p_order", "p_block")
    first = F.struct(F.xxhash64(id_col, F.lit(2)).alias("p_hash"), F.col(id_col).alias("p_id")) <= F.struct("p_hash", "p_id")
    more = F.col("p_order").isNotNull() & (F.col("mix_tokens") > 0) & ((place < border) | ((place == border) & F.col("p_some") & first))
    out = out.withColumn("copies", F.col("p_whole") + more.cast("int"))
    return out.select(*docs.columns, "mix_tokens", "mix_block", "mix_order", "copies"), mix


def schedule(realised: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """One row for each reading: (doc_id, source, pass, block, place, n_tokens); `place` orders a source's blocks within a pass, anew for each."""
    every = realised.withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return every.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col("pass"), F.col("mix_block").alias("block"), block_place(F.col(source_col), F.col("pass"), F.col("mix_block")).alias("place"), F.col("mix_tokens").alias("n_tokens"))
