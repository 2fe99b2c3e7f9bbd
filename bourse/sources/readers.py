"""Readers. Every reader is a lazy ``DataFrame``: filters and
column selections applied afterwards reach the scan (parquet pushdown,
partition pruning)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv_typed(spark: SparkSession, path, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """Header CSV with a fixed schema; with ``keep_corrupt`` a row that does
    not fit the schema keeps its raw text in ``_corrupt_record`` (PERMISSIVE)."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    return r.schema(schema).csv(path)


def csv_layouts(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """The distinct header lines of the CSV files under ``paths``, with their
    files: the first line of every file, read in one distributed pass (a file's
    first split has it; partial aggregation keeps one line of each). The driver
    gets what it lists anyway, one entry for a file. Empty files have none."""
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
                                                F.monotonically_increasing_id().alias("row"), "value")
    heads = lines.where("at = 0").groupBy("path").agg(F.min_by("value", "row").alias("head")).collect()
    found: dict[str, list[str]] = {}
    for path, head in sorted(map(tuple, heads)):
        found.setdefault(head.lstrip("\ufeff").rstrip("\r"), []).append(path)
    return found


def read_csv_inferred(spark: SparkSession, paths: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """CSV files whose layouts differ (a column may be absent from some): files
    are grouped by their header, each distinct layout is one scan (all columns
    as text, no type guessing), and the scans are unioned BY NAME; a column
    missing from the whole set is added as NULL text."""
    out = None
    for files in csv_layouts(spark, paths).values():
        frame = spark.read.option("header", True).option("inferSchema", False).csv(files)
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    if out is None:
        out = spark.createDataFrame([], T.StructType([]))
    for c in required:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out


def read_csv_encoded(spark: SparkSession, path, charset: str = "ISO-8859-1", schema=None) -> DataFrame:
    r = spark.read.option("header", True).option("encoding", charset)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_json_records(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Files holding one JSON array of flat records each (any folder
    layout below ``path``)."""
    return (spark.read.option("multiLine", True).option("recursiveFileLookup", True).schema(schema).json(path)
            .select(*schema.fieldNames()))


def read_json_documents(spark: SparkSession, path, schema, required: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One nested document per file: (path, doc). Bad documents go to the
    reject frame (path, text) instead of vanishing."""
    from ..operators.nested import parse_documents
    raw = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"),
                                                                 F.col("value").alias("text"))
    return parse_documents(raw, "text", schema, required=required)


def read_parquet_dir(spark: SparkSession, paths) -> DataFrame:
    """One file, a list, or a glob."""
    if isinstance(paths, str):
        paths = [paths]
    return spark.read.parquet(*paths)


def read_hive_partitioned(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Partition columns come from ``k=v`` folder names with DECLARED types
    (a code such as ``007`` stays a string)."""
    return spark.read.schema(schema).format(fmt).option("basePath", path).load(path)


def scan_table(df: DataFrame, predicate: Column | None = None, cols: Sequence[str] | None = None) -> DataFrame:
    """Row filter + column selection; Catalyst pushes both into the scan."""
    out = df.where(predicate) if predicate is not None else df
    return out.select(*cols) if cols else out


def scan_partition(df: DataFrame, col: str, value) -> DataFrame:
    """One partition value (partition pruning on a partitioned table)."""
    return df.where(F.col(col) == F.lit(value))


def read_mapping(m: DataFrame, product=None, source=None, field=None) -> DataFrame:
    from ..operators.lookup import mapping_slice
    return mapping_slice(m, product, source, field)


def read_surrogate_keys(keys: DataFrame, product: str) -> DataFrame:
    return keys.where(F.col("is_active") & (F.col("product") == F.lit(product))).select("uid", "surrogate_key")


def read_table_batches(df: DataFrame, path: str, rows_per_file: int = 250_000) -> DataFrame:
    """Full unload to parquet files of at most ``rows_per_file`` rows, read
    back as one frame."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.parquet(path)


# -------------------------------------------------------------- zip archives
# Spark has no zip codec: archives are read as binary files (one task per
# archive, not splittable) and streamed member by member into CSV rows by an
# Arrow-batched function; the result is repartitioned right after.

def _unzip_rows(batches: Iterable, member_index: int, columns: Sequence[str]):
    import csv
    import io
    import zipfile

    import pandas as pd
    for pdf in batches:
        for content in pdf["content"]:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                name = z.namelist()[member_index]
                with z.open(name) as fh:
                    rd = csv.reader(io.TextIOWrapper(fh, encoding="utf-8", newline=""))
                    header = next(rd, None) or []
                    pos = [header.index(c) if c in header else -1 for c in columns]
                    chunk = []
                    for row in rd:
                        chunk.append([row[i] if 0 <= i < len(row) else None for i in pos])
                        if len(chunk) >= 50_000:
                            yield pd.DataFrame(chunk, columns=list(columns))
                            chunk = []
                    if chunk:
                        yield pd.DataFrame(chunk, columns=list(columns))


def read_zip_csv(spark: SparkSession, path: str, columns: Sequence[str], member_index: int = 0,
                 num_partitions: int | None = None) -> DataFrame:
    """First member of each zip archive under ``path``, read as header CSV
    into the given (text) columns."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("content")
    safe = [f"c{i}" for i in range(len(columns))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in safe])

    def unzip(it):
        for pdf in _unzip_rows(it, member_index, columns):
            yield pdf.set_axis(safe, axis=1)
    rows = raw.mapInPandas(unzip, schema)
    n = num_partitions or spark.sparkContext.defaultParallelism
    return rows.repartition(n).select(*[F.col(s).alias(c) for s, c in zip(safe, columns)])


def _zip_group(pdf, folder: str, columns: Sequence[str], bucket: int):
    import csv
    import io
    import os
    import uuid
    import zipfile

    import pandas as pd
    buf = io.StringIO()
    w = csv.writer(buf)
    w.writerow(columns)
    for row in pdf[list(columns)].itertuples(index=False):
        w.writerow(["" if v is None else v for v in row])
    os.makedirs(folder, exist_ok=True)
    # one name per bucket, so that a task that runs twice leaves one archive
    target, part = os.path.join(folder, f"part-{bucket}.zip"), os.path.join(folder, f".{uuid.uuid4().hex}")
    with zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("data.csv", buf.getvalue())
    os.replace(part, target)
    return pd.DataFrame({"archive": [target], "rows": [len(pdf)]})


def write_zip_csv(df: DataFrame, folder: str, columns: Sequence[str], rows_per_archive: int = 200_000) -> DataFrame:
    """Archives of CSV text, one per hash bucket of about ``rows_per_archive``
    rows (each written by one task). ``folder`` must be a path every executor
    can write (a mounted shared folder). Returns (archive, rows)."""
    from ..session import as_local_path
    n = max(1, -(-df.count() // rows_per_archive))
    local = as_local_path(folder)
    # positional column names inside the task (vendor names may contain dots)
    safe = [f"c{i}" for i in range(len(columns))]
    b = df.select(*[F.col(f"`{c}`").cast("string").alias(s) for c, s in zip(columns, safe)]).withColumn(
        "_b", F.pmod(F.xxhash64(*[F.col(s) for s in safe]), F.lit(n)))

    def one(key, pdf):
        return _zip_group(pdf[safe].set_axis(list(columns), axis=1), local, columns, key[0])
    return b.groupBy("_b").applyInPandas(one, "archive string, rows long")
