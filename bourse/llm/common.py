"""Shared helpers: table access, staged tables in the shared folder, hashes."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: Bytes that a task looks at at a time.
SLICE_BYTES = 2_000_000


def slices(batches, size: int = SLICE_BYTES):
    """Slices of a task's Arrow batches of about ``size`` bytes, one row at
    least. A batch is let go before the next one is read, and at the end free
    memory goes back to the system, so that an idle worker holds little."""
    batches = iter(batches)
    while (batch := next(batches, None)) is not None:
        step = max(1, int(len(batch) * size / max(batch.nbytes, 1)))
        for start in range(0, len(batch), step):
            yield batch.slice(start, step)
        batch = None
    release_memory()


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver can reach: the session's
    checkpoint folder (``spark.checkpoint.dir``). Where it is unset, a private
    folder is made, which only a local master may use."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir()
    if found is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="bourse-")
        sc.setCheckpointDir(configured)
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new Parquet table in the shared folder and read it
    back: lineage ends there, a lost executor costs no recomputation, and the
    planner sees the true size of the table. The folder lives below the
    session's checkpoint folder and goes with it."""
    path = f"{shared_dir(df.sparkSession)}/staged-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(df: DataFrame) -> None:
    """Remove a staged table that nothing will read again."""
    path = getattr(df, "_staged_path", None)
    if path is not None:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)
