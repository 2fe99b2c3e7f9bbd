"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date_col


def union_all_periods(q: DataFrame, periods: Sequence[tuple[str, object]], as_of,
                      keys: Sequence[str] = ("security_code", "exchange_code"), date_col: str = "date") -> DataFrame:
    """One UNION ALL branch per period, computed in a single scan: the quotes of
    a key that each period's window [start, as_of] holds are counted side by
    side, and the counts above zero become rows. Replaces N scans of the same
    input by one; an aggregation holds one row per key, not one per period."""
    a = as_date_col(as_of)
    d = F.col(date_col)
    starts: dict[str, list] = {}
    for name, s in periods:
        starts.setdefault(name, []).append(as_date_col(s))
    held = [reduce(lambda x, y: x + y, [F.count_if((d >= s) & (d <= a)) for s in of]) for of in starts.values()]
    counts = q.groupBy(*keys).agg(*[n.alias(f"_n{i}") for i, n in enumerate(held)])
    per = F.array(*[F.struct(F.lit(name).alias("period"), F.col(f"_n{i}").alias("n_quotes")) for i, name in enumerate(starts)])
    return counts.select(*keys, F.inline(per)).where(F.col("n_quotes") > 0)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Vertical concat by column name."""
    return reduce(lambda x, y: x.unionByName(y), frames)


def append_virtual_exchange(codes: DataFrame, col: str, code: str) -> DataFrame:
    """Exchange codes plus one literal row (e.g. the virtual index venue)."""
    one = codes.sparkSession.range(1).select(F.lit(code).alias(col))
    return codes.select(col).unionByName(one)


def merge_files(spark, paths, fmt: str = "parquet") -> DataFrame:
    """Flatten a nested list of paths and read them as one frame."""
    flat: list[str] = []

    def walk(p):
        if isinstance(p, (list, tuple)):
            for x in p:
                walk(x)
        else:
            flat.append(str(p))

    walk(paths)
    return spark.read.format(fmt).load(flat)
