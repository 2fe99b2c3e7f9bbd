"""A registry of surrogate keys that is stored by hash of the uid.

The registry is a folder of ``(uid, surrogate_key)`` in folders by bucket, with
the largest key given so far (the high mark) beside it. New uids are numbered
from the high mark on, by slot (a hash of the uid) and uid: a window per slot
and a running sum over the slots' counts. No order over all uids, no maximum
over all keys and no job is needed while the plan is built; the same uids get
the same keys whenever the plan runs. ``commit`` appends the new keys and raises
the mark by what the writing pass observed. There may be one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: Slots: three hexadecimal digits of the uid's MD5; a folder holds several.
SLOTS = 16**3
_SCHEMA = "uid string, surrogate_key bigint, bucket int"


def slot(uid: Column) -> Column:
    return F.conv(F.substring(F.md5(uid.cast("binary")), 1, 3), 16, 10).cast("int")


class KeyRegistry:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _fs(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def high(self) -> int:
        """The largest key given; 0 for an empty registry."""
        fs, p = self._fs("_high")
        if not fs.exists(p):
            return 0
        return max((int(s.getPath().getName()) for s in fs.listStatus(p)), default=0)

    def keys(self) -> DataFrame:
        """``uid surrogate_key bucket``."""
        fs, p = self._fs("keys")
        if not fs.exists(p):
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/keys")

    def commit(self, new: DataFrame) -> int:
        """Append ``(uid, surrogate_key)`` and raise the high mark; returns how
        many keys were added."""
        seen = Observation("new keys")
        rows = new.select("uid", "surrogate_key", (slot(F.col("uid")) % self.buckets).alias("bucket"))
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.max("surrogate_key").alias("top"))
        rows.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/keys")
        added, top = seen.get["n"], seen.get["top"]
        if top is not None and top > self.high():
            fs, p = self._fs(f"_high/{top}")
            fs.create(p, True).close()
        return added

    def assign(self, df: DataFrame, uid_col: str, id_col: str = "id", optional: bool = False) -> tuple[DataFrame, DataFrame]:
        """``df`` with an integer key per uid, and the keys that are new. Rows
        without a uid are dropped unless ``optional``."""
        known = self.keys()
        uids = df.select(F.col(uid_col).cast("string").alias("uid")).where("uid is not null").distinct()
        uids = uids.withColumn("bucket", slot(F.col("uid")) % self.buckets)
        missing = uids.join(known, ["uid", "bucket"], "left_anti").select("uid", slot(F.col("uid")).alias("slot"))
        sizes = missing.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
        before = F.coalesce(F.sum("n").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        sizes = sizes.select("slot", (before + F.lit(self.high())).alias("before"))
        place = F.row_number().over(Window.partitionBy("slot").orderBy("uid"))
        new = missing.withColumn("place", place).join(sizes, "slot").select("uid", (F.col("before") + F.col("place")).cast("bigint").alias("surrogate_key"))
        keys = known.select("uid", "surrogate_key").unionByName(new).select(F.col("uid").alias("_uid"), F.col("surrogate_key").alias("_key"))
        out = df.join(keys, df[uid_col].cast("string") == keys["_uid"], "left" if optional else "inner")
        return out.select(*df.columns, F.col("_key").alias(id_col)), new
