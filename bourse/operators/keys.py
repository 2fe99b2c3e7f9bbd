"""Surrogate keys and dense row indexes without a single-partition window.

A global ``row_number()`` over the whole frame forces every row through one
task. Instead the frame is range-partitioned by the order key, sorted within
partitions and checkpointed (so that the partition boundaries are fixed even
if an executor is lost and its input was a shuffle with no row order); the
row count of each partition (one number per partition) gives each
partition's offset, and a row's index is offset + position in partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _n_partitions(df: DataFrame) -> int:
    try:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    except ValueError:
        return 200


def global_row_index(df: DataFrame, order: Sequence[str], col: str = "row_index",
                     num_partitions: int | None = None) -> DataFrame:
    """0-based dense index over ``order`` (which must be a unique key)."""
    ensure_checkpoint_dir(df.sparkSession)
    n = num_partitions or _n_partitions(df)
    fixed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    counts = {r[0]: r[1] for r in fixed.groupBy(F.spark_partition_id()).count().collect()}
    offsets, acc = [], 0
    for pid in range(max(counts, default=-1) + 1):
        offsets.append(acc)
        acc += counts.get(pid, 0)
    pid = F.spark_partition_id()
    local = F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)
    if not offsets:
        return fixed.withColumn(col, F.lit(None).cast("bigint"))
    off = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), pid + 1)
    return fixed.withColumn(col, off + local)


def assign_surrogate_keys(df: DataFrame, keys: DataFrame, uid_col: str, id_col: str = "id",
                          add_missing: bool = True, optional: bool = False,
                          key_uid: str = "uid", key_col: str = "surrogate_key") -> tuple[DataFrame, DataFrame]:
    """Attach an integer key per uid.

    * known uids take their key from ``keys`` (uid, surrogate_key);
    * with ``add_missing``, distinct non-null uids without a key get new
      keys ``max(existing) + 1 + rank by uid`` (deterministic, dense);
    * rows whose uid stays unmapped are dropped unless ``optional``.

    Returns (df with ``id_col``, newly assigned keys). The key registry join
    is a regular shuffle join (the registry grows with the data, so it is not
    broadcast blindly; AQE broadcasts it when its runtime size is small).
    """
    known = keys.select(F.col(key_uid).alias("_uid"), F.col(key_col).alias("_key"))
    spark = df.sparkSession
    if add_missing:
        missing = (df.select(F.col(uid_col).alias("_uid")).where(F.col("_uid").isNotNull()).distinct()
                   .join(known, "_uid", "left_anti"))
        # the largest key is a scalar subquery of the plan, not a job of its own
        top = known.agg(F.coalesce(F.max("_key"), F.lit(0)).alias("_top")).scalar()
        new = global_row_index(missing, ["_uid"], "_rn").select(
            "_uid", (F.col("_rn") + F.lit(1) + top).cast("bigint").alias("_key"))
    else:
        new = spark.createDataFrame([], known.schema)
    all_keys = known.unionByName(new)
    out = df.join(all_keys, df[uid_col] == all_keys["_uid"], "left").drop("_uid").withColumnRenamed("_key", id_col)
    if not optional:
        out = out.where(F.col(id_col).isNotNull())
    return out, new.select(F.col("_uid").alias(key_uid), F.col("_key").alias(key_col))
