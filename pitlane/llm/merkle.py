"""Merkle manifest of a dataset by lag and lead windows.

Every row is a leaf. Leaves of one group stand in the order of their ids and are
hashed in pairs, level by level, to the group's subroot; subroots are hashed the
same way to the root. The levels of one band run over one window layout: chunks
of 2 ** BAND neighbouring nodes, in which a node lives on the row of its first
leaf, so that at every level its sibling stands a fixed number of rows away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.llm.shared import stored

#: Levels that share one window layout: a chunk holds 2 ** BAND neighbouring nodes.
BAND = 10

_STEPS = "array<struct<l:string,r:string>>"


def field_text(column: Column) -> Column:
    """A field as its leaf holds it: `-` for null, else its UTF-8 byte count, a colon and its value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields one after another."""
    return F.sha2(F.concat(*[field_text(x) for x in fields]), 256)


def place_in_group(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """`nodes` (with group column `g`) plus `pos`, the row's place in its group from 0, and `n`, the group's size.

    Rows are dealt out by ranges of (g, *order), nulls first, and numbered where
    they lie; only the counts of each (partition, group) are added up. Rows that
    tie in everything are interchangeable and may be split between partitions."""
    nodes = nodes.withColumn("_tie", F.monotonically_increasing_id())
    keys = ["g", *order, "_tie"]
    lain = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    lain = stored(lain, "merkle-order").withColumn("_part", F.shiftright("_at", 33))
    runs = lain.groupBy("g", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy("g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(runs.select("g", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                              F.sum("_rows").over(Window.partitionBy("g")).alias("n")), "merkle-runs")
    placed = lain.join(runs, ["g", "_part"]).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before"))
    return placed.drop("_at", "_part", "_first", "_before")


def hash_band(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """BAND levels over nodes (g, pos, h, n, ...): (`nodes` with `steps`, the nodes above them as (g, pos, h, n)).

    `n` is the number of nodes of the group. A level is there while the group
    has several nodes. At level k the node of a run of 2 ** k rows stands on the
    run's first row, its sibling 2 ** k rows later (even slot; null where the
    last run has one node) or before (odd slot), and even slots hash the parent.
    `steps` holds for each level what stands left and right of the node."""
    chunk = Window.partitionBy("g", "chunk").orderBy("pos")
    so_far = chunk.rowsBetween(Window.unboundedPreceding, 0)
    rows = nodes.withColumn("chunk", F.shiftright("pos", BAND)).withColumn("_h0", F.col("h"))
    for k in range(BAND):
        far, node = 1 << k, f"_h{k}"
        rows = rows.withColumn("_next", F.lead(node, far).over(chunk)).withColumn("_last", F.lag(node, far).over(chunk))
        there, odd = F.col("n") > far, F.col("pos").bitwiseAND(far) != 0
        here = F.col("pos").bitwiseAND(far - 1) == 0
        step = F.struct(F.when(odd, F.col("_last")).otherwise("").alias("l"),
                        F.when(~odd, F.col("_next")).otherwise("").alias("r"))
        parent = F.when(there, F.sha2(F.concat(node, F.coalesce("_next", F.lit(""))), 256)).otherwise(F.col(node))
        rows = rows.withColumns({f"_s{k}": F.when(here & there, step), f"_h{k + 1}": F.when(here & ~odd, parent)}).drop("_next", "_last")
    steps = F.array_compact(F.array(*[F.last(f"_s{k}", ignorenulls=True).over(so_far) for k in range(BAND)]))
    keep = [*nodes.columns, "chunk"]
    done = stored(rows.select(*keep, steps.cast(_STEPS).alias("steps"), F.col(f"_h{BAND}").alias("_top")), "merkle-band")
    above = done.where(F.col("pos") == F.shiftleft("chunk", BAND)).select(
        "g", F.col("chunk").alias("pos"), F.col("_top").alias("h"), F.shiftright(F.col("n") + ((1 << BAND) - 1), BAND).alias("n"))
    return done.drop("_top"), above


def hash_tree(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(`nodes` with all `steps` up to their group's root, the roots as (g, h)) for nodes (g, pos, h, n, ...)."""
    bands, most = [], nodes.agg(F.max("n")).first()[0] or 0
    while True:
        done, nodes = hash_band(nodes)
        bands.append(done)
        most = -(-most >> BAND)
        if most <= 1:
            break
    whole = bands.pop()
    while bands:  # upper bands are 2 ** BAND times smaller each: add their steps from the top down
        up = whole.select("g", F.col("pos").alias("chunk"), F.col("steps").alias("_up"))
        whole = bands.pop().join(up, ["g", "chunk"]).withColumn("steps", F.concat("steps", "_up")).drop("_up")
    return whole.drop("chunk"), nodes.select("g", "h")


def fold_steps(start: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, start, lambda x, s: F.sha2(F.concat(s["l"], x, F.coalesce(s["r"], F.lit(""))), 256))


def steps_hash(steps: Column) -> Column:
    """SHA-256 of the siblings, level by level."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["l"], F.coalesce(s["r"], F.lit("")))), ""), 256)


def manifest(docs: DataFrame, id_col: str, group_col: str, fields: Sequence[str], found: dict[str, Column] | None = None,
             changed: Column | None = None) -> DataFrame:
    """(id, leaf, steps, subroot, root, folded_root, verified) for each row.

    `fields` are hashed in their order. `found` gives columns as they are found
    now, on rows where `changed` is true; those rows' leaves are taken anew and
    folded with the stored siblings, so `verified` tells whether the row still
    is what the manifest says. Null groups are a group of their own, which comes
    first; null ids come first in their group; rows of one id stand by their
    leaf, and equal rows get neighbouring places of their own. A group of one
    leaf has it as its subroot. An empty table gives no rows. Columns beside the
    named ones are not read; a long text is hashed whole."""
    now = [found[x] if found and x in found else F.col(x) for x in fields]
    again = F.when(changed, leaf_hash(now)) if changed is not None else F.lit(None).cast("string")
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = docs.select(group.alias("g"), F.col(id_col).alias("id"), leaf_hash([F.col(x) for x in fields]).alias("h"), again.alias("again"))
    placed = place_in_group(leaves, ["id", "h"])
    rows, subroots = hash_tree(placed)
    subroots = subroots.select(F.lit(0).alias("g"), F.col("g").alias("_group"), "h")
    tops, root = hash_tree(place_in_group(subroots, ["_group"]))
    tops = stored(tops.select(F.col("_group").alias("g"), F.col("h").alias("subroot"), F.col("steps").alias("_up"))
                  .crossJoin(F.broadcast(root.select(F.col("h").alias("root")))), "merkle-subroots")  # one root
    out = rows.join(tops, "g").withColumn("steps", F.concat("steps", "_up"))
    out = out.select("id", F.col("h").alias("leaf"), "steps", "subroot", "root", fold_steps(F.coalesce("again", "h"), F.col("steps")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_digest(rows: DataFrame) -> DataFrame:
    """One line of each leaf of `manifest`, the siblings as one hash."""
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", steps_hash(F.col("steps")).alias("proof_sha256"), "folded_root", "verified")
