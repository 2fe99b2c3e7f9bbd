"""Table maintenance as pure DataFrame functions: insert-new,
insert-ignore, upsert, keyed update and snapshot refresh. Each returns the
new content of the target, to be written to a new folder, so a target is never
read and overwritten in one plan; ``rows_to_insert`` returns only what to append.

All of them are joins on the key (shuffle on the key; AQE splits skewed
keys), never a row-by-row loop.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ntz_lit


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the first by ``order``, without one the least by its
    other columns. Rows with a NULL in the key are no duplicates (SQL) and stay.

    ``min_by(row, order)`` is aggregated map-side, so a key holding a third
    of the rows is reduced per map task before the shuffle (a window over the
    key would pull all its rows into one task)."""
    others = [c for c in df.columns if c not in keys]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if others:
        row = F.struct(*[F.col(c) for c in others])
        rank = list(order) if order else [F.col(c) for c, t in df.dtypes if c in others and "map<" not in t]
        g = df.where(known).groupBy(*keys).agg((F.min_by(row, F.struct(*rank)) if rank else F.any_value(row)).alias("_r"))
        one = g.select(*keys, *[F.col("_r")[c].alias(c) for c in others]).select(*df.columns)
    else:
        one = df.where(known).distinct()
    return one.unionByName(df.where(~known))


def merge_insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str],
                     dedupe_source: bool = False) -> DataFrame:
    """Insert only source rows whose key is absent from the target
    (MERGE ... WHEN NOT MATCHED THEN INSERT). Duplicate source keys are all
    inserted unless ``dedupe_source``. Idempotent: applying the same source
    twice gives the same table."""
    src = dedupe_by_key(source, keys) if dedupe_source else source
    new = src.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def rows_to_insert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   partition_cols: Sequence[str] = (), order: Sequence[Column] | None = None) -> DataFrame:
    """The source rows that an insert-new adds: one row per key (the first by
    ``order``, without one the least by its other columns), of keys that
    the target lacks. The caller appends them, so a daily update writes what
    is new and not the whole table. With ``partition_cols`` (columns of both
    that the key determines) the target is read only in the source's
    partitions."""
    src = dedupe_by_key(source, keys, order)
    seen = target
    if partition_cols:
        seen = seen.join(src.select(*partition_cols).distinct(), list(partition_cols), "left_semi")
    return src.join(seen.select(*keys), list(keys), "left_anti").select(*target.columns)


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  order: Sequence[Column] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``: source deduplicated by key, then
    only keys new to the target are added."""
    src = dedupe_by_key(source, keys, order)
    new = src.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def upsert_columns(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   set_from_source: Sequence[str] = (), set_const: Mapping[str, object] | None = None,
                   insert_missing: bool = True) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET c = EXCLUDED.c`` /
    ``SET c = const``. A NULL in the source is a value (it is applied).
    Of source rows with one key the least by its other columns counts. One
    full outer join on the key."""
    source = dedupe_by_key(source, keys)
    set_const = dict(set_const or {})
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in target.columns]).withColumn("_t", F.lit(True))
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in source.columns]).withColumn("_s", F.lit(True))
    cond = [t[f"t__{k}"] == s[f"s__{k}"] for k in keys]
    j = t.join(s, cond, "full" if insert_missing else "left")
    matched = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    only_s = F.col("_t").isNull()
    outs = []
    for c in target.columns:
        tc = F.col(f"t__{c}")
        sc = F.col(f"s__{c}") if c in source.columns else F.lit(None)
        if c in keys:
            v = F.coalesce(tc, sc)
        elif c in set_const:
            v = F.when(matched, F.lit(set_const[c])).when(only_s, sc).otherwise(tc)
        elif c in set_from_source:
            v = F.when(matched | only_s, sc).otherwise(tc)
        else:
            v = F.when(only_s, sc).otherwise(tc)
        outs.append(v.cast(target.schema[c].dataType).alias(c))
    return j.select(*outs)


def bulk_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                set_from_source: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Upsert plus the affected-row count (inserted + updated), as a
    one-row frame computed by the same plan's join (no extra pass over the
    target)."""
    flagged = source.select(*keys).distinct().join(
        target.select(*keys).distinct().withColumn("_hit", F.lit(True)), list(keys), "left")
    counts = flagged.agg(F.count(F.lit(1)).alias("affected"),
                         F.count_if(F.col("_hit").isNotNull()).alias("updated"),
                         F.count_if(F.col("_hit").isNull()).alias("inserted"))
    return upsert_columns(target, source, keys, set_from_source), counts


def bulk_update_by_key(target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``UPDATE t SET c = v.c FROM updates v WHERE v.key = t.key``: matched
    rows take the update's value even when it is NULL; unmatched keep theirs;
    no insert. Of updates with one key the least by its other columns counts."""
    u = dedupe_by_key(updates, [key]).select(F.col(key).alias("_k"), *[F.col(c).alias(f"u__{c}") for c in columns]) \
        .withColumn("_m", F.lit(True))
    j = target.join(u, target[key] == u["_k"], "left")
    return j.select(*[F.when(F.col("_m").isNotNull(), F.col(f"u__{c}")).otherwise(F.col(c))
                      .cast(target.schema[c].dataType).alias(c) if c in columns else F.col(c)
                      for c in target.columns])


def snapshot_refresh(current: DataFrame, snapshot: DataFrame, keys: Sequence[str], as_of,
                     value_cols: Sequence[str]) -> DataFrame:
    """Deactivate every row, then re-activate the rows of the new snapshot,
    in ONE full outer join on the key:

    * in both: values from the snapshot, active, ``active_until`` NULL,
      ``updated_at`` = as_of (``created_at``/``active_from`` kept);
    * only current: inactive, ``active_until`` = as_of (kept if already set),
      ``updated_at`` = as_of;
    * only snapshot: inserted active, ``created_at`` = ``active_from`` = as_of.

    ``current`` has keys, value_cols, is_active, active_from, active_until,
    created_at, updated_at; ``snapshot`` has keys and value_cols; of its rows
    with one key the least by its other columns counts.
    """
    snapshot = dedupe_by_key(snapshot, keys)
    ts = ntz_lit(as_of)
    c = current.select(*[F.col(x).alias(f"c__{x}") for x in current.columns]).withColumn("_c", F.lit(True))
    s = snapshot.select(*[F.col(x).alias(f"s__{x}") for x in snapshot.columns]).withColumn("_s", F.lit(True))
    j = c.join(s, [c[f"c__{k}"] == s[f"s__{k}"] for k in keys], "full")
    only_c = F.col("_s").isNull()
    only_s = F.col("_c").isNull()
    out = [F.coalesce(F.col(f"c__{k}"), F.col(f"s__{k}")).alias(k) for k in keys]
    out += [F.when(only_c, F.col(f"c__{v}")).otherwise(F.col(f"s__{v}")).alias(v) for v in value_cols]
    out += [
        (~only_c).alias("is_active"),
        F.when(only_s, ts).otherwise(F.col("c__active_from")).alias("active_from"),
        F.when(only_c, F.coalesce(F.col("c__active_until"), ts)).otherwise(F.lit(None).cast("timestamp_ntz"))
        .alias("active_until"),
        F.when(only_s, ts).otherwise(F.col("c__created_at")).alias("created_at"),
        F.when(only_s, F.lit(None).cast("timestamp_ntz")).otherwise(ts).alias("updated_at"),
    ]
    return j.select(*out)
