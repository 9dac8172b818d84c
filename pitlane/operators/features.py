"""Feature matrix and preprocessing.

Fitted statistics (modes, medians, means, std, quantiles, category sets)
are one-row or per-category aggregates computed on the executors and
crossed / joined back; nothing but that bounded result ever reaches a
single task.  The only driver-side values are (a) the list of skewed
columns (one row, one entry per column) and (b) the category list of a
one-hot column, capped by `max_categories`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.functions.scalars import hash_unit
from pitlane.operators.positions import coarse_key, null_safe_join, row_positions


# --- imputation -------------------------------------------------------------

def fill_constant(df: DataFrame, fills: dict) -> DataFrame:
    """Per-column literal fills (only for columns that exist)."""
    have = set(df.columns)
    return df.na.fill({c: v for c, v in fills.items() if c in have})


def fill_mode(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """NULL -> most frequent value (smallest on a tie), fitted on `fit_on`
    (default: the frame itself).  Each mode is a one-row aggregate; a column
    without any value stays NULL."""
    from pitlane.operators.aggregate import group_mode
    fit = fit_on if fit_on is not None else df
    j = df
    for c in cols:  # exactly one row each
        j = j.crossJoin(F.broadcast(group_mode(fit, [], c, f"_mode_{c}")))
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(c), F.col(f"_mode_{c}"))).drop(f"_mode_{c}")
    return j


def fill_group_median(df: DataFrame, group: str, col: str) -> DataFrame:
    """NULL -> median of its group, then remaining NULLs (all-NULL groups)
    -> global median of the group-filled column."""
    from pitlane.operators.aggregate import exact_quantiles
    med = exact_quantiles(df, [group], col, [0.5], ["_gmed"])
    j = df.join(med, group, "left").withColumn(col, F.coalesce(F.col(col), F.col("_gmed"))).drop("_gmed")
    glob = exact_quantiles(j, [], col, [0.5], ["_glob"])
    return j.crossJoin(F.broadcast(glob)).withColumn(col, F.coalesce(F.col(col), F.col("_glob"))).drop("_glob")


def fill_mean(df: DataFrame, cols: Sequence[str], fit_on: DataFrame) -> DataFrame:
    """NULL -> mean fitted on the training slice only."""
    means = fit_on.agg(*[F.avg(c).alias(f"_mean_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(means))
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col(f"_mean_{c}"))).drop(f"_mean_{c}")
    return j


# --- encoding ---------------------------------------------------------------

# Quality scale used by the ordinal encoding (absent feature = 0).
QUALITY_SCALE = {"None": 0, "Po": 1, "Fa": 2, "TA": 3, "Gd": 4, "Ex": 5}


def ordinal_encode(df: DataFrame, cols: Sequence[str], mapping: dict = QUALITY_SCALE) -> DataFrame:
    """Fixed map to integers; a value outside the map (or NULL) gives NULL
    and sets `<col>_unmapped` so the bad rows can be inspected or rejected."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    out = df
    for c in cols:
        out = out.withColumn(f"{c}_unmapped", m[F.col(c)].isNull()).withColumn(c, m[F.col(c)].cast("int"))
    return out


def one_hot(df: DataFrame, col: str, categories: Sequence | None = None, prefix: str | None = None) -> DataFrame:
    """0/1 indicator per category (train and test together); a value
    outside `categories` has 0 in all of them.

    Declare `categories` where they are known.  Otherwise the distinct values
    are fetched, one column each: that suits any number of categories that a
    table can have as columns.  For more, see `one_hot_vector`."""
    if categories is None:
        categories = sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect())
    p = prefix or col
    return df.select("*", *[(F.col(col) == v).cast("int").alias(f"{p}_{v}") for v in categories])


def one_hot_vector(df: DataFrame, col: str, out: str) -> DataFrame:
    """J16 for any number of categories: one sparse vector column (NULL: all zeros)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    index = f"_{col}_index"
    stages = [StringIndexer(inputCol=col, outputCol=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
              OneHotEncoder(inputCol=index, outputCol=out, dropLast=True)]
    return Pipeline(stages=stages).fit(df).transform(df).drop(index)


def cast_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric codes -> text categories."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.col(c).cast("string"))
    return out


def fold_assign(df: DataFrame, key: str, k: int = 5, out: str = "fold") -> DataFrame:
    """Frozen fold from md5 of the key (identical in Spark and DuckDB)."""
    from pitlane.functions.scalars import fold_of
    return df.withColumn(out, fold_of(F.col(key), k))


def target_encode_oof(df: DataFrame, cat: str, target: str, fold: str = "fold", origin: str = "origin",
                      k: int = 5, out: str = "te") -> DataFrame:
    """Out-of-fold median target encoding, no loop over folds, no copies of rows.

    Train row in fold f: median target of its category over train rows in the
    other folds; test rows: median over all train rows; unseen -> global train
    median. Rows are counted once per (category, value) with one count for each
    fold. Over a category's values in order the counts of "all folds but f" are the
    total's less f's own, so running totals of the counts give the place of every
    value in all k + 1 orders at once, and with them the k + 1 medians."""
    y, at = F.col(target).cast("double"), F.col(fold)
    train = df.where((F.col(origin) == "train") & y.isNotNull() & ~F.isnan(y))
    views = [F.count(F.lit(1)) - F.count_if(at.eqNullSafe(F.lit(f))) for f in range(k)] + [F.count(F.lit(1))]
    counts = train.groupBy(F.col(cat).alias("_c"), y.alias("_y")).agg(F.array(*views).alias("_n"))
    by_cat = _view_medians(counts, ["_c"], k + 1)
    glob = _view_medians(counts.groupBy("_y").agg(F.array(*[F.sum(F.col("_n")[i]) for i in range(k + 1)]).alias("_n")), [], k + 1)
    j = df.join(by_cat.withColumnRenamed("_med", "_cat"), F.col(cat).eqNullSafe(F.col("_c")), "left")
    j = j.crossJoin(F.broadcast(glob.select(F.col("_med")[k].alias("_glob"))))  # one row
    inside = at.isNotNull() & (at >= 0) & (at < k)
    enc = F.when((F.col(origin) == "train") & inside, F.get("_cat", at.cast("int"))).when(F.col(origin) != "train", F.get("_cat", F.lit(k)))
    return j.withColumn(out, F.coalesce(enc, F.col("_glob"))).select(*df.columns, out)


def _view_medians(counts: DataFrame, group: list[str], n: int) -> DataFrame:
    """(group, _med): medians of `_y` under each of n counts in `_n`. Values are cut into ordered
    buckets, totals run over a group's buckets and inside a bucket, so no group is one task."""
    rows = counts.withColumn("_k", coarse_key(F.col("_y"), counts.schema["_y"].dataType))
    keyed = rows.groupBy(*group, "_k").agg(*[F.sum(F.col("_n")[i]).alias(f"_n{i}") for i in range(n)])
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    run = whole.orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    before = keyed.select(*group, "_k", F.array(*[F.coalesce(F.sum(f"_n{i}").over(run), F.lit(0)) for i in range(n)]).alias("_b"),
                          F.array(*[F.sum(f"_n{i}").over(whole) for i in range(n)]).alias("_t"))
    j = null_safe_join(rows, before, [*group, "_k"])
    inside = Window.partitionBy(*group, "_k").orderBy("_y").rowsBetween(Window.unboundedPreceding, -1)
    j = j.select(*group, "_y", "_n", "_t", *[(F.col("_b")[i] + F.coalesce(F.sum(F.col("_n")[i]).over(inside), F.lit(0))).alias(f"_p{i}") for i in range(n)])

    def middle(i):
        """The mean of the values at the two middle places."""
        first, last = F.col(f"_p{i}"), F.col(f"_p{i}") + F.col("_n")[i] - 1
        holds = lambda place: (F.col("_n")[i] > 0) & (first <= place) & (place <= last)
        total = F.col("_t")[i]
        low, high = F.floor((total - 1) / 2), F.floor(total / 2)
        return (F.max(F.when(holds(low), F.col("_y"))) + F.max(F.when(holds(high), F.col("_y")))) / 2

    return j.groupBy(*group).agg(F.array(*[middle(i) for i in range(n)]).alias("_med"))


# --- scaling ----------------------------------------------------------------

def standardise(df: DataFrame, cols: Sequence[str], fit_on: DataFrame, suffix: str = "_z") -> DataFrame:
    """Z-score with the population std fitted on `fit_on`; std 0 -> 1."""
    st = fit_on.agg(*[F.avg(c).alias(f"_mu_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_sd_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(st))
    for c in cols:
        sd = F.when(F.col(f"_sd_{c}") > 0, F.col(f"_sd_{c}")).otherwise(F.lit(1.0))
        j = j.withColumn(f"{c}{suffix}", (F.col(c) - F.col(f"_mu_{c}")) / sd).drop(f"_mu_{c}", f"_sd_{c}")
    return j


def robust_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame, suffix: str = "_rs") -> DataFrame:
    """(x - median) / IQR with exact linear-interpolated quartiles (IQR 0 -> 1).

    The columns are stacked as (column, value): one ranking and one row of quartiles for all."""
    from pitlane.operators.aggregate import exact_quantiles
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).cast("double").alias("_x")) for i, c in enumerate(cols)]))
    q = exact_quantiles(fit_on.select(pairs.alias("_p")).select("_p.*"), ["_i"], "_x", [0.25, 0.5, 0.75], ["_q1", "_q2", "_q3"])
    one = q.agg(F.map_from_entries(F.collect_list(F.struct("_i", F.struct("_q1", "_q2", "_q3")))).alias("_q"))  # a row for each column
    j = df.crossJoin(F.broadcast(one))
    out = []
    for i, c in enumerate(cols):
        at = F.col("_q")[i]
        iqr = at["_q3"] - at["_q1"]
        out.append(((F.col(c) - at["_q2"]) / F.when(iqr != 0, iqr).otherwise(F.lit(1.0))).alias(f"{c}{suffix}"))
    return j.select(*df.columns, *out)


def skewed_columns(df: DataFrame, cols: Sequence[str], limit: float = 0.75) -> list[str]:
    """Columns whose population skewness exceeds `limit` (one-row aggregate)."""
    row = df.agg(*[F.skewness(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return [c for c in cols if row[c] is not None and row[c] > limit]


def skew_correct(df: DataFrame, cols: Sequence[str], limit: float = 0.75, lam: float = 0.15,
                 fit_on: DataFrame | None = None) -> DataFrame:
    """Box-Cox of 1 + x with lambda 0.15 for the columns over the skew limit."""
    chosen = skewed_columns(fit_on if fit_on is not None else df, cols, limit)
    out = df
    for c in chosen:
        out = out.withColumn(c, (F.pow(1 + F.col(c), lam) - 1) / lam)
    return out


# --- splits and weights -----------------------------------------------------

def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, out: str = "split") -> DataFrame:
    """Exact, repeatable per-label split: rows ordered by md5 of the key
    within each label; the first n - ceil(test_share * n) are 'train'.  A NULL
    label is a label, NULL keys come first in it.

    A row's place comes from `positions.row_positions` over the hash, so a
    two-valued label doesn't put half the data in one task."""
    j = row_positions(df.withColumn("_h", hash_unit(F.col(key))), [label], ["_h", key], "_pos")
    j = null_safe_join(j, df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")), [label])
    n_train = F.col("_n") - F.ceil(F.col("_n") * test_share)
    return j.withColumn("_split", F.when(F.col("_pos") < n_train, "train").otherwise("test")).select(
        *df.columns, F.col("_split").alias(out))


def class_weights(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """Balanced weights n / (k * n_class) per class (one row per class)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    tot = c.agg(F.sum("n_class").alias("_n"), F.count(F.lit(1)).alias("_k"))
    return c.crossJoin(F.broadcast(tot)).select(label, "n_class", (F.col("_n") / (F.col("_k") * F.col("n_class"))).alias(out))


# --- rule projections -------------------------------------------------------

def rule_flags(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """0/1 columns from boolean rules; NULL counts as 0."""
    return df.select("*", *[F.coalesce(r, F.lit(False)).cast("int").alias(n) for n, r in rules.items()])
