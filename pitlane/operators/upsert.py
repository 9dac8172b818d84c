"""Keyed upserts: the reference's only mutation model.

Built-in parquet tables have no MERGE, so each upsert is a pure DataFrame
plan producing the NEW snapshot: one full outer (or left) join on the key,
i.e. one shuffle of each side by key.  Writing that snapshot to a new folder
and switching readers to it is `sinks.write_snapshot` (A8); a path being read
is never overwritten in place.  Source rows must be unique on the key: the
plans embed a runtime assertion (`raise_error`) instead of a separate action.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def assert_unique(df: DataFrame, keys, what: str = "source") -> DataFrame:
    """Fail the job if `keys` repeat in `df`.  Rows are counted by a partial
    aggregate, so a key that repeats very often is folded before it moves."""
    keys = _keys(keys)
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n_key"), F.first(F.struct(*rest) if rest else F.lit(0)).alias("_row"))
    msg = F.concat(F.lit(f"duplicate key in {what}: "), F.to_json(F.struct(*keys)))
    # the check sits in a filter predicate, which is always evaluated (a
    # dropped helper column would be pruned away before it ran)
    g = g.where(F.when(F.col("_n_key") > 1, F.raise_error(msg).cast("boolean")).otherwise(F.lit(True)))
    return g.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def _merge(target: DataFrame, source: DataFrame, keys, how: str) -> tuple[DataFrame, list[str]]:
    keys = _keys(keys)
    t = target.select(*keys, F.struct(*[F.col(c) for c in target.columns if c not in keys]).alias("_t"),
                      F.lit(True).alias("_in_t"))
    s = assert_unique(source, keys).select(
        *keys, F.struct(*[F.col(c) for c in source.columns if c not in keys]).alias("_s"), F.lit(True).alias("_in_s"))
    j = t.join(s, keys, how)
    return j, keys


def upsert_replace(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """INSERT ... ON CONFLICT DO UPDATE SET every non-key column = EXCLUDED.
    A NULL in the source overwrites.  Columns only in the target stay as they
    were for matched rows and are NULL for new rows; columns only in the source
    are an error."""
    extra = set(source.columns) - set(target.columns)
    if extra:
        raise ValueError(f"columns that the target doesn't have: {sorted(extra)}")
    j, keys = _merge(target, source, keys, "full_outer")
    cols = [c for c in target.columns if c not in keys]
    scols = set(source.columns)
    out = [F.when(F.col("_in_s"), F.col(f"_s.{c}")).otherwise(F.col(f"_t.{c}")).alias(c) if c in scols
           else F.col(f"_t.{c}").alias(c) for c in cols]
    return j.select(*keys, *out)


def upsert_columns(target: DataFrame, source: DataFrame, keys, update_cols: Sequence[str],
                   insert_defaults: dict | None = None) -> DataFrame:
    """On conflict replace only `update_cols`; new keys insert the source
    row (target-only columns NULL or `insert_defaults`)."""
    j, keys = _merge(target, source, keys, "full_outer")
    scols = set(source.columns)
    upd = set(update_cols)
    defaults = insert_defaults or {}
    out = []
    for c in [c for c in target.columns if c not in keys]:
        new_val = F.col(f"_s.{c}") if c in scols else F.lit(defaults.get(c)).cast(target.schema[c].dataType)
        if c in upd:
            e = F.when(F.col("_in_s"), new_val).otherwise(F.col(f"_t.{c}"))
        else:
            e = F.when(F.col("_in_t"), F.col(f"_t.{c}")).otherwise(new_val)
        out.append(e.alias(c))
    return j.select(*keys, *out)


def insert_if_absent(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """ON CONFLICT DO NOTHING -- target plus source rows with new keys.
    Several source rows with the same new key: the first by all columns wins."""
    keys = _keys(keys)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in source.columns if c not in keys])
    src = source.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    new = src.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def upsert_merge_map(target: DataFrame, source: DataFrame, keys, doc: str = "feature_json",
                     set_cols: Sequence[str] = (), keep_old: bool = False) -> DataFrame:
    """U4: upsert of key -> value documents (MAP<string,double>).

    keep_old=False: `doc = COALESCE(old, {}) || new` (right side wins per key).
    keep_old=True : `doc = COALESCE(old, {})` (the row exists; its document is
    only defaulted), as the rest-days upsert does.  `set_cols` are replaced
    from the source on conflict (e.g. as_of_date)."""
    j, keys = _merge(target, source, keys, "full_outer")
    empty = F.create_map().cast("map<string,double>")
    old = F.coalesce(F.col(f"_t.{doc}"), empty)
    new = F.coalesce(F.col(f"_s.{doc}"), empty)
    if keep_old:
        merged = F.when(F.col("_in_t"), old).otherwise(new)
    else:
        merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)
        merged = F.when(F.col("_in_s"), merged).otherwise(F.col(f"_t.{doc}"))
    out = []
    for c in [c for c in target.columns if c not in keys]:
        if c == doc:
            out.append(merged.alias(c))
        elif c in set_cols:
            out.append(F.when(F.col("_in_s"), F.col(f"_s.{c}")).otherwise(F.col(f"_t.{c}")).alias(c))
        else:
            new = F.col(f"_s.{c}") if c in source.columns else F.lit(None)
            out.append(F.when(F.col("_in_t"), F.col(f"_t.{c}")).otherwise(new).alias(c))
    return j.select(*keys, *out)


def update_from(target: DataFrame, source: DataFrame, keys, assignments: dict) -> DataFrame:
    """UPDATE target SET col = expr FROM source WHERE keys match.

    `assignments` maps target column -> source column name or Column (over the
    source's columns).  Unmatched target rows are unchanged; no row is added."""
    keys = _keys(keys)
    src = assert_unique(source, keys)
    exprs = {c: (F.col(v) if isinstance(v, str) else v) for c, v in assignments.items()}
    s = src.select(*keys, F.struct(*[e.alias(c) for c, e in exprs.items()]).alias("_s"), F.lit(True).alias("_hit"))
    j = target.join(s, keys, "left")
    out = [F.when(F.col("_hit"), F.col(f"_s.{c}")).otherwise(F.col(c)).alias(c) if c in exprs else F.col(c)
           for c in target.columns]
    return j.select(*out)


def upsert_priority(target: DataFrame, source: DataFrame, keys, update_cols: Sequence[str], state: str = "status",
                    ranks: dict | None = None, allow_regress: bool = False) -> DataFrame:
    """As U2, but the state column may not move to a lower-ranked state
    (V10: a schedule refresh must not turn a final match back into
    'scheduled'); when it would, the target's state is kept."""
    ranks = ranks or {"scheduled": 1, "final": 2}
    rank_map = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])
    out = upsert_columns(target.withColumn("_old_state", F.col(state)), source, keys, update_cols)
    if allow_regress:
        return out.drop("_old_state")
    regress = F.coalesce(rank_map[F.col("_old_state")], F.lit(0)) > F.coalesce(rank_map[F.col(state)], F.lit(0))
    return out.withColumn(state, F.when(regress, F.col("_old_state")).otherwise(F.col(state))).drop("_old_state")


def dedupe_on_key(df: DataFrame, keys, order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per key under an explicit total `order`
    (dropDuplicates keeps an arbitrary survivor).  `row_number() = 1` is
    planned as a WindowGroupLimit on both sides of the shuffle."""
    keys = _keys(keys)
    w = Window.partitionBy(*keys).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def evolve_schema(df: DataFrame, renames: dict[str, Sequence[str]] | None = None,
                  add: dict[str, tuple[object, str]] | None = None) -> DataFrame:
    """U8: rename the first column matching an alias (case-insensitive) to the
    canonical name unless it already exists; add missing columns with a typed
    default.  Schema-only: no data moves."""
    out = df
    for canon, aliases in (renames or {}).items():
        lower = {c.lower(): c for c in out.columns}
        if canon.lower() in lower:
            if lower[canon.lower()] != canon:
                out = out.withColumnRenamed(lower[canon.lower()], canon)
            continue
        for a in aliases:
            if a.lower() in lower:
                out = out.withColumnRenamed(lower[a.lower()], canon)
                break
    for c, (value, typ) in (add or {}).items():
        if c.lower() not in {x.lower() for x in out.columns}:
            out = out.withColumn(c, F.lit(value).cast(typ))
    return out
