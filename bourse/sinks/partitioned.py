"""Keyed changes of a table that lies in partition folders.

A change reads and rewrites the partitions it touches, and no others: those the
source's rows belong to and, where a key does not fix its partition, those that
hold a key of the source. The new content of the touched partitions is staged
first and then replaces them by a dynamic partition overwrite, so a failure
before that leaves the table as it was, and one after it can be repeated from
the staged rows. Partitions that lose their last row are removed.

The driver sees the partition values of a change, never its rows: as many
tuples as the write creates folders. Filters on them are literals, so the scan
of the target lists and reads only these folders (``PartitionFilters``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import scratch_path
from .merge import dedupe_by_key

#: Tuples in one literal filter; beyond, each column's values are listed alone
#: and a semi join picks the tuples.
MAX_TUPLES = 200


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The partition columns of the table at ``path``, outermost first, as its
    first folders name them; none for a flat or an absent table."""
    fs, p = _fs(spark, path)
    cols: list[str] = []
    while fs.exists(p):
        names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
        folder = next((n for n in names if "=" in n and n[0] not in "_."), None)
        if folder is None:
            break
        cols.append(folder.split("=", 1)[0])
        p = spark._jvm.org.apache.hadoop.fs.Path(p, folder)
    return cols


def sorted_values(values: Iterable[tuple]) -> list[tuple]:
    return sorted(values, key=lambda t: tuple((v is not None, v) for v in t))


def partition_values(df: DataFrame, cols: Sequence[str]) -> list[tuple]:
    """The distinct partition tuples of ``df``."""
    return sorted_values(map(tuple, df.select(*cols).distinct().collect()))


def in_partitions(df: DataFrame, cols: Sequence[str], values: Sequence[tuple]) -> DataFrame:
    """The rows of ``df`` in these partitions, by literal filters."""
    def one_of(c: str, vs) -> Column:
        some = F.col(c).isin(sorted(v for v in vs if v is not None))
        return some | F.col(c).isNull() if None in vs else some

    if not values:
        return df.where(F.lit(False))
    out = df.where(reduce(lambda a, b: a & b, [one_of(c, {t[i] for t in values}) for i, c in enumerate(cols)]))
    if len(cols) == 1:
        return out
    if len(values) <= MAX_TUPLES:
        return out.where(reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(cols, t)]) for t in values]))
    names = [f"_p{i}" for i in range(len(cols))]
    tuples = df.sparkSession.createDataFrame(values, ", ".join(f"{n} {df.schema[c].dataType.simpleString()}" for n, c in zip(names, cols)))
    return out.join(tuples, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(cols, names)], "left_semi")


def touched_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str], key_fixes_partition: bool) -> list[tuple]:
    """Partitions that a change by ``source`` reads and writes."""
    here = partition_values(source, cols) if set(cols) <= set(source.columns) else []
    if key_fixes_partition:
        return here
    # only keys and partition columns are read to find where the keys lie
    lie = target.select(*dict.fromkeys([*keys, *cols])).join(source.select(*keys).distinct(), list(keys), "left_semi")
    return sorted_values({*here, *partition_values(lie, cols)})


def read_like(spark: SparkSession, path: str, cols: Sequence[str], source: DataFrame) -> DataFrame:
    """The table at ``path``, its partition columns of the source's types, or
    text as their folders are named where the source lacks them: a code that
    looks like a number must not be written back as one."""
    schema = spark.read.parquet(path).schema
    for f in schema.fields:
        if f.name in cols:
            f.dataType = source.schema[f.name].dataType if f.name in source.columns else StringType()
    return spark.read.schema(schema).parquet(path)


def _drop_folders(rows: DataFrame) -> None:
    """Remove the folders that hold these rows' files."""
    spark, jvm = rows.sparkSession, rows.sparkSession._jvm
    for (folder,) in rows.select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")).distinct().collect():
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def change_partitions(path: str, source: DataFrame, keys: Sequence[str], change: Callable[[DataFrame, DataFrame], DataFrame],
                      partition_by: Sequence[str] | None = None, key_fixes_partition: bool | None = None) -> list[tuple]:
    """Apply ``change(target, source) -> target`` (an upsert, an update, an
    insert-ignore) to the partitions of the table at ``path`` that ``source``
    touches; returns them.

    ``key_fixes_partition``: rows of one key lie in the partition that the
    source's row names. By default that holds where all partition columns are
    keys; otherwise the keys' partitions are looked up, and a row may move."""
    spark = source.sparkSession
    cols = list(partition_by or partition_columns(spark, path))
    if not cols:
        raise ValueError(f"{path} is not partitioned; write the change's result to a new folder")
    if key_fixes_partition is None:
        key_fixes_partition = set(cols) <= set(keys)
    target = read_like(spark, path, cols, source)
    source = source.persist()
    try:
        touched = set(touched_partitions(target, source, keys, cols, key_fixes_partition))
        filled: set[tuple] = set()
        staged = None
        # rows may go to partitions that neither a key nor the source names
        while staged is None or not filled <= touched:
            touched |= filled
            staged = scratch_path(spark, "touched")
            change(in_partitions(target, cols, sorted_values(touched)), source).select(*target.columns).write.parquet(staged)
            new = spark.read.schema(target.schema).parquet(staged)
            filled = set(partition_values(new, cols))
    finally:
        source.unpersist()
    if not touched:
        return []
    (new.hint("rebalance", *cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path))
    if touched - filled:
        _drop_folders(in_partitions(target, cols, sorted_values(touched - filled)))
    fs, p = _fs(spark, staged)
    fs.delete(p, True)
    return sorted_values(touched)


def rows_not_in(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str] = (), key_fixes_partition: bool | None = None) -> DataFrame:
    """One source row per key that the target lacks. Where the key fixes the
    partition, the target is read only in the source's partitions."""
    fresh = dedupe_by_key(source, keys)
    seen = target
    if cols and (set(cols) <= set(keys) if key_fixes_partition is None else key_fixes_partition):
        seen = in_partitions(target, cols, partition_values(source, cols))
    return fresh.join(seen.select(*keys), list(keys), "left_anti").select(*target.columns)


def append_new(path: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str] | None = None, key_fixes_partition: bool | None = None) -> None:
    """Insert the source's rows whose key the table lacks, in the table's own
    layout: an append of the new rows, nothing is rewritten."""
    spark = source.sparkSession
    cols = list(partition_columns(spark, path) if partition_by is None else partition_by)
    source = source.persist()
    try:
        out = rows_not_in(read_like(spark, path, cols, source), source, keys, cols, key_fixes_partition)
        writer = (out.hint("rebalance", *cols) if cols else out).write.mode("append")
        (writer.partitionBy(*cols) if cols else writer).parquet(path)
    finally:
        source.unpersist()


class EpochLog:
    """What a streaming query has done to a table, epoch by epoch, in a hidden
    folder of the table: an epoch is begun before its rows are written and done
    after. A done epoch is skipped when it is replayed; one that was only begun
    may have left some of its rows."""

    def __init__(self, spark: SparkSession, path: str, query: str):
        self.spark, self.base = spark, f"{path.rstrip('/')}/_epochs/{query}"

    def _mark(self, epoch: int, state: str) -> None:
        fs, p = _fs(self.spark, f"{self.base}/{epoch}.{state}")
        fs.create(p, True).close()

    def _has(self, epoch: int, state: str) -> bool:
        fs, p = _fs(self.spark, f"{self.base}/{epoch}.{state}")
        return fs.exists(p)

    def begin(self, epoch: int) -> bool:
        """Whether an earlier attempt at this epoch was begun."""
        again = self._has(epoch, "begun")
        self._mark(epoch, "begun")
        return again

    def done(self, epoch: int) -> bool:
        return self._has(epoch, "done")

    def finish(self, epoch: int) -> None:
        self._mark(epoch, "done")


def append_epoch(path: str, batch: DataFrame, epoch: int, query: str, keys: Sequence[str], partition_by: Sequence[str] | None = None,
                 key_fixes_partition: bool | None = None) -> int:
    """A micro-batch into the table at ``path``: of each key that the table
    lacks one row, appended in the table's layout; returns the rows appended,
    -1 for an epoch that is done already.

    The batch is cached, since its partitions, its keys and its rows are read.
    Rows with a NULL in the key match no key; when an epoch that was begun is
    replayed, those that the earlier attempt left are told by all columns."""
    spark = batch.sparkSession
    log = EpochLog(spark, path, query)
    if log.done(epoch):
        return -1
    cols = list(partition_columns(spark, path) if partition_by is None else partition_by)
    batch = batch.persist()
    try:
        target = read_like(spark, path, cols, batch)
        again = log.begin(epoch)
        fresh = rows_not_in(target, batch, keys, cols, key_fixes_partition)
        if again:
            known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
            there = target.where(~known).select(*[F.col(c).alias(f"_there_{c}") for c in target.columns])
            left = fresh.where(~known).join(there, [F.col(c).eqNullSafe(F.col(f"_there_{c}")) for c in target.columns], "left_anti")
            fresh = fresh.where(known).unionByName(left)
        fresh = fresh.persist()
        n = fresh.count()
        if n:
            writer = (fresh.hint("rebalance", *cols) if cols else fresh).write.mode("append")
            (writer.partitionBy(*cols) if cols else writer).parquet(path)
        fresh.unpersist()
        log.finish(epoch)
        return n
    finally:
        batch.unpersist()
