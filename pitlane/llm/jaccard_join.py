"""Exact n-gram Jaccard join: pivots, Voronoi regions, triangle-inequality windows, recursion.

Documents are sets of word shingles under the Jaccard distance 1 - |A n B| / |A u B|,
a metric. Two sets without a common shingle are at distance 1, so the space falls
into regions by shared shingles first: the pivots of this first level are single
shingles, and a document lies in the regions of the shingles that come first in
one global order. Its window holds so many of them that two documents within
the radius meet in one region at least. Regions of more than a few documents
are then split around document pivots: every member goes to the region of its
nearest pivot and, where the triangle inequality lets a partner lie across a
border, to the regions beyond it too; these are joined in the same way, until
they are small or pivots don't part them. Then all pairs of a region are compared in
one task, each pair in one region only, and every link between different texts is counted.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitlane.llm.components import components
from pitlane.llm.shared import forget, stored, text_chunks
from pitlane.llm.words import mix, shingle_sets

#: Words in a shingle, and the least Jaccard similarity in percent.
SHINGLE, PERCENT = 5, 75
#: Shingles that the global order puts last because they are common: at most so many (16 MB with their ranks), each in LOCAL documents or more of one task.
COMMON, LOCAL = 1 << 20, 2
#: Shingles that a task holds while it counts common ones.
COUNT_ROWS = 2_000_000
#: A region of WHOLE + 1 members is compared whole. Larger ones get
#: PIVOTS pivots, and twice as many in each further round.
WHOLE, PIVOTS = 32, 4
#: A region is split only if its parts hold at most so many times its members, and none a larger share of them than MOST; else it is compared whole.
COPIES, MOST = 1.5, 0.75
#: Sets and shingles in a part of a region that is compared whole: a task holds two parts. Cells of a 0/1 matrix that it makes at once.
PART, PART_SHINGLES, MATRIX = 1 << 10, 1 << 20, 1 << 22
#: Shingles below it, a quarter of all hashes, tell most unlike sets apart before whole sets are fetched.
BELOW = -(1 << 62)
#: Members farther than NEAR from every pivot form a region of their own. RADIUS is the distance of the least similarity.
NEAR, RADIUS = 0.5, 1 - PERCENT / 100
#: 64-bit words (a power of two) in a filter of wanted sets: 1 MB whatever the corpus. A wanted set has so many bits of one word:
#: with one, a hundredth of the copies of a set passed beside it, and all joins with it grew by their number.
FILTER_WORDS, FILTER_BITS = 1 << 17, 3
#: Rounding slack of distances in windows; links themselves are decided on integers.
SLACK = 1e-9


def _per_row(rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    count = np.bincount(rows, minlength=n)
    return count, np.cumsum(count) - count


def _set_ids(rows: np.ndarray, hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A 64-bit name for each row's set, from its shingles and size."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes.view(np.uint64)))])
    end = np.cumsum(count)
    return mix(sums[end] - sums[end - count] + count.astype(np.uint64)).view(np.int64)


def _profiles(batches):
    """Rows (0, doc, set, size, mixed doc) of documents and (1, shingle, count) of shingles common in the task."""
    held, size, seen = [], 0, set()

    def counted():
        shingles, count = np.unique(np.concatenate(held), return_counts=True)
        common = count >= LOCAL
        return _profile_rows(1, pa.array(shingles[common]), count[common], None, None)

    for batch in batches:
        ids = batch.column(0)
        for first, last, data, offsets in text_chunks(batch.column(1)):
            rows, hashes = shingle_sets(data, offsets, SHINGLE)
            count, _ = _per_row(rows, last - first)
            sets = _set_ids(rows, hashes, count)
            some = ids.slice(first, last - first)
            yield _profile_rows(0, some, sets, count, _mixed(some))
            new = np.array([s not in seen and not seen.add(s) for s in sets.tolist()], bool)  # copies count once
            held.append(hashes[np.repeat(new, count)])
            size += len(held[-1])
            if size > COUNT_ROWS:
                yield counted()
                held, size, seen = [], 0, set()
    if held:
        yield counted()


def _mixed(ids: pa.Array) -> np.ndarray:
    return mix(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)).view(np.int64)


def _profile_rows(kind: int, a: pa.Array, b: np.ndarray, *more) -> pa.RecordBatch:
    n = len(a)
    more = [pa.nulls(n, pa.int64()) if x is None else pa.array(x.astype(np.int64)) for x in more]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), a, pa.array(b.astype(np.int64)), *more], ["kind", "a", "b", "c", "m"])


def _ranks(hashes: np.ndarray, common: np.ndarray, rank: np.ndarray, maybe: np.ndarray) -> np.ndarray:
    """Rank of each shingle among the common ones, -1 for others; `maybe` tells by the low bits what to look up."""
    out = np.full(len(hashes), -1, np.int64)
    look = np.flatnonzero(maybe[hashes & (1 << 23) - 1])
    if len(look):
        at = np.minimum(np.searchsorted(common, hashes[look]), len(common) - 1)
        hit = common[at] == hashes[look]
        out[look[hit]] = rank[at[hit]]
    return out


def _prefixes(shared):
    """Rows (shingle, set, size, shingles before) of each set's window: its first shingles in the global order, rare ones before common ones."""
    def run(batches):
        common, rank = shared.value
        maybe = np.zeros(1 << 23, bool)
        maybe[common & (1 << 23) - 1] = True
        seen: set[int] = set()
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column(0)):
                rows, hashes = shingle_sets(data, offsets, SHINGLE)
                count, start = _per_row(rows, last - first)
                sets = _set_ids(rows, hashes, count)
                if len(seen) > 1_000_000:
                    seen.clear()
                new = np.array([s not in seen and not seen.add(s) for s in sets.tolist()], bool)
                window = np.where(new & (count > 0), count - (-(-PERCENT * count // 100)) + 1, 0)
                rank_of = _ranks(hashes, common, rank, maybe)
                rare = rank_of < 0
                before = np.cumsum(rare) - rare  # rare ones before each place
                rares = np.bincount(rows[rare], minlength=last - first)
                place = before - (np.cumsum(rares) - rares)[rows]
                take = np.flatnonzero(rare & (place < window[rows]))
                place = place[take]
                more = np.flatnonzero(~rare & (rares < window)[rows])
                if len(more):  # windows that reach into the common shingles
                    more = more[np.lexsort((rank_of[more], rows[more]))]
                    many = np.bincount(rows[more], minlength=last - first)
                    behind = np.arange(len(more)) - (np.cumsum(many) - many)[rows[more]] + rares[rows[more]]
                    inside = behind < window[rows[more]]
                    take, place = np.concatenate([take, more[inside]]), np.concatenate([place, behind[inside]])
                yield pa.RecordBatch.from_arrays([pa.array(hashes[take]), pa.array(sets[rows[take]]), pa.array(count[rows[take]]), pa.array(place)], ["token", "s", "n", "i"])
    return run


def _passes(shared, sets: np.ndarray) -> np.ndarray:
    u = sets.view(np.uint64)
    words = shared.value[(u % np.uint64(FILTER_WORDS)).astype(np.int64)]
    return np.logical_and.reduce([(words >> (u >> np.uint64(58 - 6 * k) & np.uint64(63))) & np.uint64(1) == 1 for k in range(FILTER_BITS)])


def _sets(shared):
    """(set, size, its shingles in order) of the whole texts of documents that the filter lets pass, once for each task's run of 1,000,000 sets."""
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column(1)):
                rows, hashes = shingle_sets(data, offsets, SHINGLE)
                count, _ = _per_row(rows, last - first)
                sets = _set_ids(rows, hashes, count)
                wanted = _passes(shared, _mixed(batch.column(0).slice(first, last - first))) & (count > 0)
                if len(seen) > 1_000_000:
                    seen.clear()
                wanted[wanted] = [s not in seen and not seen.add(s) for s in sets[wanted].tolist()]
                ends = np.concatenate([[0], np.cumsum(count[wanted])]).astype(np.int32)
                arrays = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[np.repeat(wanted, count)]))
                yield pa.RecordBatch.from_arrays([pa.array(sets[wanted]), pa.array(count[wanted]), arrays], ["s", "n", "shingles"])
    return run


def _only(shared):
    """Rows (set, ...) that the filter lets pass."""
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_passes(shared, batch.column(0).to_numpy())))
    return run


def _filter_of(sets: DataFrame):
    """A broadcast bit filter of the names `s`, of a fixed size; a false hit costs time only."""
    bit = " | ".join(f"shiftleft(1L, CAST(shiftrightunsigned(s, {58 - 6 * k}) & 63 AS INT))" for k in range(FILTER_BITS))
    bits = sets.groupBy(F.pmod("s", F.lit(FILTER_WORDS)).alias("at")).agg(F.bit_or(F.expr(bit)).alias("bits")).toArrow()
    words = np.zeros(FILTER_WORDS, np.uint64)
    words[bits.column("at").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return sets.sparkSession.sparkContext.broadcast(words)


def _regions(rows: DataFrame) -> DataFrame:
    """Members (region, s, n, i, size) of all regions of two sets and more; regions with the same members are taken once.

    Linked sets of sizes a and b have PERCENT / (100 + PERCENT) of a + b shingles
    in common, of which the first in the order stands behind i others in the one
    set, so a - i is no less. In its region the smaller of the two stands early: that
    leaves room for a set of its own size. A later one stays only where the smallest
    early one leaves it room; each pair still meets in the region of its first common shingle.

    Two aggregates, both summed up before they are shuffled: a shingle that a
    third of all sets share sends one row for each task, not one for each set."""
    room = 100 * F.col("n") - (100 + PERCENT) * F.col("i")  # PERCENT times the largest partner's size
    early = PERCENT * F.col("n") <= room
    ends = rows.groupBy("token").agg(F.min("s").alias("lo"), F.max("s").alias("hi"), F.min(F.when(early, F.col("n"))).alias("least")).where("lo != hi and least is not null")
    members = rows.join(ends.select("token", "least"), "token").where(early | (PERCENT * F.col("least") <= room))
    members = stored(members.select("token", "s", "n", "i").distinct(), "jaccard-members")
    same = members.groupBy("token").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("s")).alias("x"), F.sum(F.xxhash64("s", F.lit(1)) % (1 << 40)).alias("y")).where("size > 1")
    one = same.groupBy("size", "x", "y").agg(F.min("token").alias("token")).select("token", "size")
    regions = stored(members.join(one, "token").select(F.col("token").alias("region"), "s", "n", "i", "size"), "jaccard-regions")
    forget(members)
    return regions


def _exact(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(p, x, their sizes pn and xn, `both`: the size of the intersection); only sets that stand in a pair are shuffled."""
    pairs = stored(pairs.select("p", "x"), "jaccard-pairs")
    shared = _filter_of(pairs.select(F.col("p").alias("s")).union(pairs.select(F.col("x").alias("s"))))
    some = sets.mapInArrow(_only(shared), sets.schema)
    return (pairs.join(some.select(F.col("s").alias("p"), F.col("n").alias("pn"), F.col("shingles").alias("ps")), "p")
            .join(some.select(F.col("s").alias("x"), F.col("n").alias("xn"), F.col("shingles").alias("xs")), "x")
            .withColumn("both", F.size(F.array_intersect("ps", "xs"))).drop("ps", "xs"))


def _split(members: DataFrame, sets: DataFrame, pivots: int) -> tuple[DataFrame, DataFrame]:
    """One round over large regions: (regions to be compared whole, members of the regions that the pivots make).

    Half the pivots are members with the fewest shingles before the region's own:
    what is copied with changes has no shingles of its own, its copies have, so it
    comes first and is near most of them. The others are picked by hash. A member x goes to its nearest pivot's
    region if that is within NEAR, else to the far region. It goes also to the
    region of another pivot q if d(x, q) <= NEAR + RADIUS and d(x, q) - d(x, p)
    <= 2 RADIUS, and to the far region if d(x, p) > NEAR - RADIUS: a partner
    within RADIUS of x can lie in no other. Where that would copy members too
    often, or leave most of them together, the region is compared whole."""
    half = -(-pivots // 2)
    first = lambda *by: members.withColumn("k", F.row_number().over(W.partitionBy("region").orderBy(*by, F.xxhash64("s"), "s"))).where(F.col("k") <= half)
    chosen = first(F.col("i") / F.col("n")).select("region", "s", "k").union(first().select("region", "s", F.col("k") + half))
    chosen = stored(chosen.groupBy("region", F.col("s").alias("p")).agg(F.min("k").alias("k")), "jaccard-pivots")
    met = stored(members.join(chosen, "region").select("region", "k", "p", F.col("s").alias("x"), "i", "size"), "jaccard-met")
    measured = stored(_exact(met.select("p", "x").distinct(), sets), "jaccard-measured")
    d = 1 - F.col("both") / (F.col("pn") + F.col("xn") - F.col("both"))
    near = met.join(measured.withColumn("d", d), ["p", "x"]).groupBy("region", "x").agg(
        F.min(F.struct("d", "k")).alias("near"), F.first("xn").alias("n"), F.first("i").alias("i"), F.first("size").alias("size"), F.collect_list(F.struct("d", "k")).alias("all"))
    least = F.col("near.d")
    own = F.when(least <= NEAR + SLACK, F.col("near.k")).otherwise(0)
    others = F.filter("all", lambda o: (o["d"] <= NEAR + RADIUS + SLACK) & (o["d"] - least <= 2 * RADIUS + SLACK))
    cells = F.concat(F.array(own), F.transform(others, lambda o: o["k"]), F.when(least > NEAR - RADIUS - SLACK, F.array(F.lit(0))).otherwise(F.array().cast("array<int>")))
    near = stored(near.select("region", F.col("x").alias("s"), "n", "i", "size", F.explode(F.array_distinct(cells)).alias("cell")), "jaccard-cells")
    count = near.groupBy("region", "cell").agg(F.count("*").alias("c"), F.first("size").alias("size"))
    split = count.groupBy("region").agg(F.sum("c").alias("copies"), F.max("c").alias("most"), F.first("size").alias("size"))
    split = split.where((F.col("copies") <= COPIES * F.col("size")) & (F.col("most") <= MOST * F.col("size"))).select("region")
    whole = members.join(split, "region", "left_anti").select("region", "s", "n")
    following = near.join(split, "region", "left_semi").select(F.xxhash64("region", "cell").alias("region"), "s", "n", "i")
    whole, following = stored(whole, "jaccard-leaves"), stored(_sized(following), "jaccard-next")
    forget(chosen, met, measured, near)
    return whole, following


def _sized(members: DataFrame) -> DataFrame:
    """Members (region, s, n, i, size) of regions of two sets and more; of regions with the same members one is left."""
    regions = members.groupBy("region").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("s")).alias("x"), F.sum(F.xxhash64("s", F.lit(1)) % (1 << 40)).alias("y")).where("size > 1")
    return members.join(regions.groupBy("size", "x", "y").agg(F.min("region").alias("region")).select("region", "size"), "region")


def _fitting(members: DataFrame) -> DataFrame:
    """Members (region, s, n) of small regions with another one of a size that can be linked with theirs."""
    order = W.partitionBy("region").orderBy("n", "s")
    last, following = F.lag("n").over(order), F.lead("n").over(order)
    fits = members.withColumn("last", last).withColumn("next", following).where((PERCENT * F.col("n") <= 100 * F.col("last")) | (PERCENT * F.col("next") <= 100 * F.col("n")))
    return fits.select("region", "s", "n")


def _dealt(leaves: DataFrame) -> DataFrame:
    """Rows (run, part, s, n, size, region, regions): the members of each region to be compared whole, its size, and all such regions of theirs.

    A region of more than PART sets or PART_SHINGLES shingles is cut by size into parts, any two of which are a run
    of their own if sets of the one can be linked with sets of the other, so a task holds two parts at most."""
    order = W.partitionBy("region").orderBy("n", "s")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    part = F.floor((F.row_number().over(order) - 1) / PART) + F.floor(before / PART_SHINGLES)
    rows = leaves.withColumn("part", part.cast("int")).withColumn("last", F.max("part").over(W.partitionBy("region")))
    rows = stored(rows, "jaccard-parts")
    many = rows.where("last > 0")
    parts = many.groupBy("region", "part").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    two = parts.select("region", F.col("part").alias("a"), "hi").join(parts.select("region", F.col("part").alias("b"), "lo"), "region")
    two = two.where((F.col("a") <= F.col("b")) & (PERCENT * F.col("lo") <= 100 * F.col("hi"))).select("region", F.xxhash64("region", "a", "b").alias("run"), F.explode(F.array_distinct(F.array("a", "b"))).alias("part"))
    runs = rows.where("last = 0").select(F.col("region").alias("run"), "part", "s", "n", "region").union(many.join(two, ["region", "part"]).select("run", "part", "s", "n", "region"))
    sizes = leaves.groupBy("region").agg(F.count("*").alias("size"))
    regions = leaves.join(sizes, "region").groupBy("s").agg(F.collect_set(F.struct("size", "region")).alias("regions"))
    return runs.join(sizes, "region").join(regions, "s").select("run", "part", "s", "n", "size", "region", "regions")


def _whole_runs(batches):
    """Tables of the rows of one run each, from a partition sorted by run."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        run = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(run)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and held[0].column(0)[0].as_py() != run[a]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _listed(lists: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """(row, value) of all values of a column of lists."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy()), lists.flatten()


def _common(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """How many values each two of n rows have in common; a row has a value once.

    Values of many rows are counted by products of 0/1 matrices, those of few by the pairs of their rows."""
    out = np.zeros((n, n), np.float32)  # whole numbers are exact up to 2^24
    order = np.argsort(values, kind="stable")
    rows, values = rows[order], values[order]
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(values)))
    often = np.repeat(size >= max(2, n // 16), size)
    which = np.cumsum(np.concatenate([[0], size >= max(2, n // 16)]))[:-1]
    column, held = np.repeat(which, size)[often], rows[often]
    wide = max(1, MATRIX // max(n, 1))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, wide):
        a, b = np.searchsorted(column, [first, first + wide])
        m = np.zeros((n, min(wide, int(column[-1]) + 1 - first)), np.float32)
        m[held[a:b], column[a:b] - first] = 1
        out += m @ m.T
    few = np.repeat((size >= 2) & (size < max(2, n // 16)), size)
    rows, values, step = rows[few], values[few], 1
    while len(rows) > step and (same := np.flatnonzero(values[step:] == values[:-step])).size:
        pairs = rows[same] * n + rows[same + step]
        both = np.bincount(pairs, minlength=n * n).reshape(n, n).astype(np.float32)
        out += both
        out += both.T
        step += 1
    return out


def _mine(table: pa.Table) -> np.ndarray:
    """Which pairs of a run's rows (earlier by size, later) are compared in it: sizes allow them, and no larger region (or one of the same size and a smaller name) holds both."""
    size, part, members, region = (table.column(k).to_numpy() for k in ("n", "part", "size", "region"))
    rows, held = _listed(table.column("regions"))
    regions, others = held.field("region").to_numpy(), held.field("size").to_numpy()
    less = (others > members[0]) | (others == members[0]) & (regions < region[0])
    n = len(size)
    order = np.lexsort((np.arange(n), size))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    mine = (place[:, None] < place[None, :]) & (PERCENT * size[None, :] <= 100 * size[:, None])
    if part.min() != part.max():
        mine &= part[:, None] != part[None, :]
    if mine.any() and less.any():
        mine &= _common(rows[less], regions[less], n) == 0
    return mine


def _needed(batches):
    """The rows of runs that stand in a pair to be compared there."""
    for batch in _whole_runs(batches):
        mine = _mine(batch)
        some = mine.any(0) | mine.any(1)
        if some.any():
            yield from batch.filter(pa.array(some)).to_batches()


def _beginnings(shared):
    """(set, its shingles below BELOW) of sets that the filter lets pass."""
    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(_passes(shared, batch.column(0).to_numpy())))
            rows, shingles = _listed(batch.column("shingles"))
            some = shingles.to_numpy() < BELOW
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows[some], minlength=len(batch)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("s"), pa.ListArray.from_arrays(pa.array(ends), pa.array(shingles.to_numpy()[some]))], ["s", "below"])
    return run


def _likely(batches):
    """The rows of runs that stand in a pair to be compared there whose shingles below BELOW don't differ too much."""
    for table in _whole_runs(batches):
        table = table.take(np.unique(table.column("s").to_numpy(), return_index=True)[1])  # a set may have passed the filter twice
        size = table.column("n").to_numpy()
        rows, below = _listed(table.column("below"))
        count = np.bincount(rows, minlength=len(size))
        unlike = count[:, None] + count[None, :] - 2 * _common(rows, below.to_numpy(), len(size)).astype(np.int64)
        likely = _mine(table) & ((100 + PERCENT) * unlike <= (100 - PERCENT) * (size[:, None] + size[None, :]))
        some = likely.any(0) | likely.any(1)
        if some.any():
            yield from table.drop_columns(["below"]).filter(pa.array(some)).to_batches()


def _compared(batches):
    """(p, x, null) of links that span the groups of each run, and (p, null, links) of the documents that a set is linked with in it, from rows (run, part, s, n, size, region, regions, copies, shingles)."""
    for table in _whole_runs(batches):
        table = table.take(np.unique(table.column("s").to_numpy(), return_index=True)[1])  # a set may have passed the filter twice
        mine = _mine(table)
        s, size, copies = (table.column(k).to_numpy() for k in ("s", "n", "copies"))
        rows, shingles = _listed(table.column("shingles"))
        both = _common(rows, shingles.to_numpy(), len(s)).astype(np.int64)
        link = mine & (100 * both >= PERCENT * (size[:, None] + size[None, :] - both))
        link |= link.T
        linked = np.flatnonzero(link.any(0))
        if not len(linked):
            continue
        often = link[linked] @ copies
        p, x, open_ = [], [], np.zeros(len(s), bool)
        open_[linked] = True
        for first in linked.tolist():
            reached = [first] if open_[first] else []
            open_[first] = False
            while reached:
                k = reached.pop()
                new = np.flatnonzero(link[k] & open_)
                open_[new] = False
                reached += new.tolist()
                p += [k] * len(new)
                x += new.tolist()
        none = pa.nulls(len(linked), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(s[p]), pa.array(s[x]), pa.nulls(len(p), pa.int64())], ["p", "x", "links"])
        yield pa.RecordBatch.from_arrays([pa.array(s[linked]), none, pa.array(often.astype(np.int64))], ["p", "x", "links"])


def _all_links(leaves: DataFrame, sets: DataFrame, copies: DataFrame) -> DataFrame:
    """Rows (p, x, links) as _compared gives them; each pair is compared in the largest region that holds both, so that few sets are fetched for more than one."""
    rows = _dealt(leaves).repartition("run").sortWithinPartitions("run")
    runs = stored(rows.mapInArrow(_needed, rows.schema), "jaccard-runs")
    some = sets.mapInArrow(_beginnings(_filter_of(runs.select("s"))), "s long, below array<long>")
    rows = runs.join(some, "s").select(*runs.columns, "below").repartition("run").sortWithinPartitions("run")
    likely = stored(rows.mapInArrow(_likely, runs.schema), "jaccard-likely")
    forget(runs)
    some = sets.mapInArrow(_only(_filter_of(likely.select("s"))), sets.schema).select("s", "shingles")
    full = likely.join(copies, "s").join(some, "s").select("run", "part", "s", "n", "size", "region", "regions", "copies", "shingles")
    found = stored(full.repartition("run").sortWithinPartitions("run").mapInArrow(_compared, "p long, x long, links long"), "jaccard-found")
    forget(likely)
    return found


def jaccard_links(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents (doc, s, n), links (p, x) between sets, (s, links): documents of other sets that each set is linked with) of similarity PERCENT and more.

    Documents of equal sets share the set's name `s`, which 64 bits and its size
    make up. Every pair of sets that can be linked is compared once, also of sets already known
    to be in one group, and counted; the listed links are those that span a region's
    groups, so their number grows with the sets, not with their pairs."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError(f"{id_col} must be an integer column")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    profile = stored(rows.mapInArrow(_profiles, "kind int, a long, b long, c long, m long"), "jaccard-profile")
    profiles = profile.where("kind = 0").select(F.col("a").alias("doc"), F.col("b").alias("s"), F.col("c").alias("n"))
    top = profile.where("kind = 1").groupBy("a").agg(F.sum("b").alias("n")).orderBy(F.desc("n"), "a").limit(COMMON).toArrow()
    tokens = top.column("a").to_numpy()
    by_count = np.lexsort((tokens, top.column("n").to_numpy()))  # rank: rarer first
    rank = np.empty(len(tokens), np.int64)
    rank[by_count] = np.arange(len(tokens))
    order = np.argsort(tokens)
    shared = spark.sparkContext.broadcast((tokens[order], rank[order]))
    regions = _regions(rows.where("doc is not null").select("text").mapInArrow(_prefixes(shared), "token long, s long, n long, i long"))

    # the sets that some pair or large region needs, by one more pass over the texts
    leaves = [stored(_fitting(regions.where(F.col("size") <= WHOLE + 1)), "jaccard-leaves")]
    waiting = regions.where(F.col("size") > WHOLE + 1)
    inside = leaves[0].select("s").union(waiting.select("s"))
    # each set's text is that of its smallest document; a set that passes twice by chance is harmless, sets being told apart by name
    full = profile.where("kind = 0 and a is not null")
    one = full.join(inside.distinct(), full["b"] == inside["s"], "left_semi").groupBy("b").agg(F.min_by("m", "a").alias("s"), F.count("*").alias("copies"))
    one = stored(one.select("s", F.col("b").alias("name"), "copies"), "jaccard-copies")
    sets = stored(rows.where("doc is not null").mapInArrow(_sets(_filter_of(one)), "s long, n long, shingles array<long>"), "jaccard-sets")

    pivots, last = PIVOTS, regions
    while waiting.limit(1).count():
        whole, following = _split(waiting, sets, pivots)
        small = stored(_fitting(following.where(F.col("size") <= WHOLE + 1)), "jaccard-leaves")
        leaves += [whole, small]
        forget(last)
        waiting, last, pivots = following.where(F.col("size") > WHOLE + 1), following, 2 * pivots
    forget(last)
    together = stored(reduce(DataFrame.union, leaves), "jaccard-whole")
    forget(*leaves)
    found = _all_links(together, sets, one.select(F.col("name").alias("s"), "copies"))
    forget(together, sets, one)
    counts = found.where("x is null").groupBy(F.col("p").alias("s")).agg(F.sum("links").alias("links"))
    return profiles, found.where("x is not null").select("p", "x"), counts


def jaccard_groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_copies, n_links): one row for each row of `docs`.

    `component_id` is the smallest id that a document reaches by links, itself
    included; `n_copies` the documents of the same set; `n_links` the other documents that it is linked with, of the
    same set or another. Words are parted by ASCII
    white space and lower-cased (A-Z). Null and empty texts and ones without
    words have size 0 and are linked with nothing. Rows with a null id take no
    part and have a null component. Repeated rows are documents of the same set; ties go to
    the smaller id; an empty table gives an empty result; other columns are
    ignored."""
    profiles, links, counts = jaccard_links(docs, id_col, text_col)
    alone = F.col("doc").isNull() | (F.col("n") == 0)
    full = profiles.where(~alone)
    sets = full.groupBy("s").agg(F.min("doc").alias("least"), F.count("*").alias("n_copies"))
    groups = components(links, "p", "x").select(F.col("node").alias("s"), F.col("component").alias("g"))
    linked = sets.join(groups, "s")
    least = linked.groupBy("g").agg(F.min("least").alias("first"))
    firsts = linked.join(least, "g").select("s", "first").join(counts, "s")
    named = sets.join(firsts, "s", "left").select("s", F.coalesce("first", "least").alias("component_id"), "n_copies", (F.col("n_copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    named = stored(named, "jaccard-named")
    some = full.join(named, "s").select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", "n_copies", "n_links")
    one, none_linked = (F.lit(k).cast("long") for k in (1, 0))
    none = profiles.where(alone).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("doc").alias("component_id"), one.alias("n_copies"), none_linked.alias("n_links"))
    return some.union(none)
