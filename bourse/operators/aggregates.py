"""Aggregations and the window helpers of 2.6."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import filter_set_predicate


def count_rows(df: DataFrame, filters=None, fset=None) -> DataFrame:
    pred = filter_set_predicate(filters, fset or {})
    return df.where(pred).agg(F.count(F.lit(1)).alias("count"))


def value_counts(df: DataFrame, col: str, filters=None, fset=None) -> DataFrame:
    """group by one column, count; ordered by count desc, key as tie-break.
    Partial aggregation map-side: a hot value costs one row per map task."""
    pred = filter_set_predicate(filters, fset or {})
    return (df.where(pred).groupBy(F.col(col).alias("key")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("key").asc_nulls_last()))


def null_counts(df: DataFrame, col: str, filters=None, fset=None) -> DataFrame:
    """Counts in two buckets, ``NULL`` and ``NOT_NULL``."""
    pred = filter_set_predicate(filters, fset or {})
    bucket = F.when(F.col(col).isNull(), F.lit("NULL")).otherwise(F.lit("NOT_NULL"))
    return df.where(pred).groupBy(bucket.alias("key")).agg(F.count(F.lit(1)).alias("count"))


def filter_choices(df: DataFrame, field: str, allowed: Mapping[str, str], filters=None, fset=None) -> DataFrame:
    """Choices for one filter field: ``allowed`` maps field -> kind
    (``values`` or ``nulls``); a field not allowed gives an empty result with
    the same schema."""
    kind = allowed.get(field)
    if kind == "nulls":
        return null_counts(df, field, filters, fset)
    if kind == "values":
        return value_counts(df, field, filters, fset).select(F.col("key").cast("string"), "count")
    return df.sparkSession.createDataFrame([], "key string, count bigint")


def distinct_values(df: DataFrame, field: str, filters=None) -> DataFrame:
    """Distinct values of ``field`` under the *other* filters."""
    from .filters import log_filter
    return log_filter(df, filters, field=field).select(field).distinct()


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def max_per_group(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])


def distinct_count(df: DataFrame, col: str, alias: str = "count") -> DataFrame:
    return df.agg(F.count_distinct(F.col(col)).alias(alias))


def collect_aliases(df: DataFrame, key: str, name_col: str = "name", isin_col: str = "isin",
                    type_col: str = "type", extra_keys: Sequence[str] = ()) -> DataFrame:
    """Per key: first (= smallest, deterministic) type and name, the sorted
    distinct names other than the chosen name as aliases, and the first
    non-null ISIN. ``collect_set`` is partially aggregated map-side; the set
    per key is bounded by the number of distinct names of one security."""
    g = df.groupBy(key, *extra_keys).agg(
        F.min(type_col).alias("type"),
        F.min(name_col).alias("name"),
        F.array_sort(F.collect_set(name_col)).alias("_names"),
        F.min(isin_col).alias("isin"),
    )
    return g.select(
        key, *extra_keys, "type", "name",
        F.filter("_names", lambda x: x != F.col("name")).alias("aliases"),
        "isin",
    )


def alias_rows(df: DataFrame, key: str, name_col: str = "name") -> DataFrame:
    """The same aliases as rows ``(key, name, alias)``: for keys that may have
    any number of names, of which no list is gathered."""
    names = df.select(key, F.col(name_col).alias("alias")).where(F.col("alias").isNotNull()).distinct()
    first = df.groupBy(key).agg(F.min(name_col).alias("name"))
    return names.join(first, key).where("alias <> name").select(key, "name", "alias")


def group_to_batches(df: DataFrame, group_cols: Sequence[str], item_cols: Sequence[str],
                     max_items: int) -> DataFrame:
    """Request fan-out lists: per group, its items as sorted lists of at most
    ``max_items`` structs (``batch`` = 0, 1, ... in item order). A group that
    holds a third of all rows becomes many bounded rows instead of one
    unbounded list; groups without items do not appear."""
    item = F.struct(*[F.col(c) for c in item_cols])
    numbered = slice_batches(df, max_items, list(item_cols), partition_by=list(group_cols), batch_col="batch")
    return numbered.groupBy(*group_cols, "batch").agg(F.sort_array(F.collect_list(item)).alias("items"))


def slice_batches(df: DataFrame, n: int, order: Sequence[str], partition_by: Sequence[str] = (),
                  batch_col: str = "batch_id") -> DataFrame:
    """Fixed-size batches of ``n`` rows: ``(row_number - 1) / n``.

    Without ``partition_by`` the numbering is global; it is computed with
    per-partition counts (``zip``-style offsets) instead of a single-partition
    window: rows are range-partitioned by ``order``, each partition's size is
    aggregated (one small row per partition), offsets come from a window over
    those few rows, and each row's global index = offset + index in partition.
    """
    from .keys import global_row_index
    if partition_by:
        # index within the group = global index over (group, order) minus the
        # group's first index: range partitioning splits a hot group across
        # tasks, where a window per group would put it in one task
        idx = global_row_index(df, [*partition_by, *order], "_rn")
        starts = idx.groupBy(*partition_by).agg(F.min("_rn").alias("_start"))
        j = idx.join(starts, [*partition_by], "inner")
        return j.withColumn(batch_col, F.floor((F.col("_rn") - F.col("_start")) / n).cast("bigint")) \
            .drop("_rn", "_start").select(*df.columns, batch_col)
    idx = global_row_index(df, order, "_rn")
    return idx.withColumn(batch_col, F.floor(F.col("_rn") / n).cast("bigint")).drop("_rn")


def row_number_key(df: DataFrame, order: Sequence[str], col: str = "row_id") -> DataFrame:
    """Sequential 0-based row index over an explicit order (distributed)."""
    from .keys import global_row_index
    return global_row_index(df, order, col)


def map_lookup_rate(df: DataFrame, matched: Column) -> DataFrame:
    return df.agg(F.count_if(matched).alias("matched"), F.count_if(~matched).alias("missing"))
