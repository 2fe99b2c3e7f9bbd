"""Inverted indexes that are written once and searched many times.

An index is a folder of segments. A segment holds postings, one row for each
(term, row) with the term's positions, in folders by a hash of the term, and
the rows' sizes. Adding rows writes a segment; rows that were there before are
superseded from then on, deleting writes the ids alone. A manifest, replaced as
one file, names the live segments, so a reader sees all of a change or nothing,
and a job that dies leaves files that no manifest names. ``compact`` rewrites
the live rows as one segment, folder by folder, without a shuffle. There may be
one writer at a time.

A query reads the folders of its terms' hashes (``PartitionFilters``), there the
row groups that may hold a term (rows are sorted by term), and drops superseded
rows by an anti join with the later segments' ids. Postings of a frequent term
are many rows of many files, never one list.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .partitioning import spread
from .search import DEFAULT_SIMILARITY_THRESHOLD, WebQuery, fts_match, fts_rank, parse_websearch, query_trigrams, tokens_col, trigrams_col

BUCKETS = 64
# Bytes of a file of a compacted segment, about, and of a task that writes it.
FILE_BYTES = 16 << 20
# So many superseded ids are sent to all tasks rather than that all postings are
# shuffled to meet them (about 60 bytes each, by Spark's map of a bigint).
SENT_IDS = 2_000_000


class StoredIndex:
    """Postings ``(id, term, positions, size)`` under ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = (self._manifest() or {}).get("buckets", buckets)

    # ---- manifest

    def _fs(self, *parts: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _manifest(self) -> dict | None:
        fs, p = self._fs("_manifest")
        if not fs.exists(p):
            return None
        newest = max((s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().isdigit()), key=int, default=None)
        if newest is None:
            return None
        _, p = self._fs("_manifest", newest)
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, segments: list[int], version: int) -> None:
        fs, part = self._fs("_manifest", f"_{version}")
        out = fs.create(part, True)
        out.write(bytearray(json.dumps({"version": version, "segments": segments, "buckets": self.buckets}).encode()))
        out.close()
        _, whole = self._fs("_manifest", str(version))
        if not fs.rename(part, whole):
            raise RuntimeError(f"another writer has published version {version} of {self.path}")

    def segments(self) -> list[int]:
        return (self._manifest() or {"segments": []})["segments"]

    # ---- writing

    def _bucket(self, term: Column) -> Column:
        return (F.crc32(term.cast("binary")) % self.buckets).cast("int")

    def _write(self, number: int, postings: DataFrame | None, rows: DataFrame | None, gone: DataFrame | None, by_bucket: bool = False) -> None:
        """Postings are written twice unless their tasks hold whole folders
        (``by_bucket``): as they come, in files of their task, and from these
        folder by folder. Parquet files of sorted terms are a third of the bytes
        that a shuffle would leave, and go at once."""
        if postings is not None:
            out = postings.select("id", "term", "positions", "size", self._bucket(F.col("term")).alias("bucket"))
            if not by_bucket:
                self._write_folders(out, f"{self.path}/_runs")
                fs, runs = self._fs("_runs")
                out = self._by_bucket(f"{self.path}/_runs", [runs], out.schema)
            if out is not None:
                self._write_folders(out, f"{self.path}/postings/segment={number}")
            if not by_bucket:
                fs.delete(runs, True)
        if rows is not None:
            rows.select("id", "size").write.mode("overwrite").parquet(f"{self.path}/rows/segment={number}")
        if gone is not None:
            gone.select("id").write.mode("overwrite").parquet(f"{self.path}/gone/segment={number}")

    def _write_folders(self, postings: DataFrame, path: str) -> None:
        whole = postings.sortWithinPartitions("bucket", "term").write.mode("overwrite").option("partitionOverwriteMode", "static")
        whole.partitionBy("bucket").parquet(path)

    def _change(self, postings, rows, gone, drop_older: bool = False, by_bucket: bool = False) -> None:
        now = self._manifest() or {"version": -1, "segments": []}
        number = now["version"] + 1
        if gone is not None:
            # only ids that are there: what no earlier segment holds supersedes nothing
            gone = gone.join(self.rows().select(F.col("id").alias("_there")), F.col("id") == F.col("_there"), "left_semi") if now["segments"] else None
        self._write(number, postings, rows, gone, by_bucket)
        self._publish([number] if drop_older else [*now["segments"], number], number)

    def add(self, postings: DataFrame, rows: DataFrame) -> None:
        """Rows ``(id, size)`` with their postings ``(id, term, positions,
        size)``; rows of the same ids are superseded."""
        self._change(postings, rows, rows.select("id").distinct())

    def delete(self, ids: DataFrame) -> None:
        """Rows with these ids go."""
        self._change(None, None, ids.select(F.col(ids.columns[0]).alias("id")).distinct())

    def compact(self) -> None:
        """The live rows as one segment; folders of others go."""
        old, gone = self.segments(), self._superseded()
        found, whole = self._read("postings"), None
        if found is not None and (gone is None or gone[1] <= SENT_IDS):
            whole = self._by_bucket(f"{self.path}/postings", [self._fs("postings", f"segment={n}")[1] for n in old], found.schema)
        postings = self.postings() if whole is None else self._live(whole.select("id", "term", "positions", "size", "segment"))
        self._change(postings, self.rows(), None, drop_older=True, by_bucket=whole is not None)
        for n in old:
            for kind in ("postings", "rows", "gone"):
                fs, p = self._fs(kind, f"segment={n}")
                fs.delete(p, True)

    # ---- reading

    def _read(self, kind: str) -> DataFrame | None:
        fs, _ = self._fs()

        def holds_rows(p) -> bool:
            # of postings none may be left: a folder with a mark of success only
            return fs.exists(p) and any(f.getPath().getName()[0] not in "_." for f in fs.listStatus(p))

        there = [n for n in self.segments() if holds_rows(self._fs(kind, f"segment={n}")[1])]
        if not there:
            return None
        paths = [f"{self.path}/{kind}/segment={n}" for n in there]
        return self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(*paths)

    def _by_bucket(self, base: str, roots: list, schema) -> DataFrame | None:
        """The postings in the folders of these paths, read in tasks of one
        folder's bytes or of some whole folders', so that rows are where they
        are written."""
        fs, _ = self._fs()
        folders: dict[str, list[str]] = {}
        sizes: dict[str, int] = {}
        for root in roots:
            for folder in fs.listStatus(root) if fs.exists(root) else []:
                name = folder.getPath().getName()
                if folder.isDirectory() and name.startswith("bucket="):
                    folders.setdefault(name, []).append(folder.getPath().toString())
                    sizes[name] = sizes.get(name, 0) + sum(f.getLen() for f in fs.listStatus(folder.getPath()))
        parts: list[tuple[list[str], int]] = []
        for name in sorted(folders):
            if parts and parts[-1][1] + sizes[name] <= 2 * FILE_BYTES:
                parts[-1] = (parts[-1][0] + folders[name], parts[-1][1] + sizes[name])
            else:
                parts.append((folders[name], sizes[name]))
        reader = self.spark.read.option("basePath", base).schema(schema)
        # two tasks at least: Spark runs a union of single partitions as one task
        read = [reader.parquet(*paths).coalesce(max(2, math.ceil(size / FILE_BYTES))) for paths, size in parts]
        return reduce(DataFrame.union, read) if read else None

    def _superseded(self) -> tuple[DataFrame, int] | None:
        """The segments' superseded ids, and how many the files hold (read from
        their footers)."""
        gone = self._read("gone")
        return None if gone is None or len(self.segments()) < 2 else (gone, gone.count())

    def _live(self, df: DataFrame) -> DataFrame:
        found = self._superseded()
        if found is None:
            return df.drop("segment")
        gone, n = found
        last = gone.groupBy(F.col("id").alias("_id")).agg(F.max("segment").alias("_last"))
        last = F.broadcast(last) if n <= SENT_IDS else last
        return df.join(last, (F.col("id") == F.col("_id")) & (F.col("segment") < F.col("_last")), "left_anti").drop("segment")

    def rows(self) -> DataFrame:
        """``id size`` of the live rows."""
        rows = self._read("rows")
        if rows is None:
            return self.spark.createDataFrame([], "id bigint, size bigint")
        return self._live(rows.select("id", "size", "segment"))

    def postings(self, terms: Sequence[str] | None = None, smallest: int | None = None, largest: int | None = None) -> DataFrame:
        """``id term positions size`` of the live rows, of these terms only and
        of rows of these sizes."""
        found = self._read("postings")
        if found is None:
            return self.spark.createDataFrame([], "id bigint, term string, positions array<int>, size bigint")
        if terms is not None:
            found = found.where(F.col("bucket").isin(sorted({zlib.crc32(t.encode()) % self.buckets for t in terms})) & F.col("term").isin(sorted(set(terms))))
        if smallest is not None:
            found = found.where(F.col("size") >= smallest)
        if largest is not None:
            found = found.where(F.col("size") <= largest)
        return self._live(found.select("id", "term", "positions", "size", "segment"))


# ------------------------------------------------------------------ words

def word_postings(df: DataFrame, id_col: str, text_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Postings of a text's words, positions from 1 on, and the rows with their
    number of words. Rows without words are rows. The texts are dealt by id, so
    that their words are grouped where they are split and are not shuffled; the
    rows are made where the texts are read."""
    text = F.concat_ws(" ", *[F.col(c) for c in text_cols])
    texts = df.select(F.col(id_col).alias("id"), text.alias("_x"))
    words = texts.repartition("id").select("id", tokens_col(F.col("_x")).alias("_t"))
    each = words.select("id", F.posexplode("_t").alias("_p", "term"), F.size("_t").cast("bigint").alias("size"))
    postings = each.groupBy("id", "term", "size").agg(F.sort_array(F.collect_list((F.col("_p") + 1).cast("int"))).alias("positions"))
    return postings, spread(texts).select("id", F.size(tokens_col(F.col("_x"))).cast("bigint").alias("size"))


class TextIndex(StoredIndex):
    """An index of words; ids are unique."""

    def put(self, df: DataFrame, id_col: str, text_cols: Sequence[str]) -> None:
        self.add(*word_postings(df, id_col, text_cols))

    def tokens(self, words: Sequence[str] | None = None) -> DataFrame:
        """``id token pos n_tokens``, as ``fts_index`` gives them."""
        found = self.postings(words)
        return found.select("id", F.col("term").alias("token"), F.explode("positions").alias("pos"), F.col("size").alias("n_tokens")).withColumn("pos", F.col("pos").cast("bigint"))

    def match(self, query: str | WebQuery) -> DataFrame:
        """``id rank`` of the rows that satisfy the query (``fts_match``), read
        from the folders of its words."""
        wq = parse_websearch(query) if isinstance(query, str) else query
        return fts_match(self.tokens(wq.all_words()), wq, universe=self.rows())

    def rank(self, query: str | WebQuery) -> DataFrame:
        """``id rank`` by the shortest cover (``fts_rank``)."""
        wq = parse_websearch(query) if isinstance(query, str) else query
        return fts_rank(self.tokens(wq.all_words()), wq, universe=self.rows())


# ------------------------------------------------------------------ grams

class GramIndex(StoredIndex):
    """An index of trigram sets for similarity queries; ids are unique. The
    size of a row is that of its set."""

    def put(self, df: DataFrame, id_col: str, text_col: str) -> None:
        sets = spread(df).select(F.col(id_col).alias("id"), trigrams_col(F.coalesce(F.col(text_col), F.lit(""))).alias("_g"))
        rows = sets.select("id", F.size("_g").cast("bigint").alias("size"), "_g")
        self.add(rows.select("id", F.explode("_g").alias("term"), F.lit(None).cast("array<int>").alias("positions"), "size"), rows.select("id", "size"))

    def similar(self, query: str, threshold: float = DEFAULT_SIMILARITY_THRESHOLD) -> DataFrame:
        """``id similarity`` of the rows that reach the threshold, as the
        row-wise form gives them. Of a set of g grams and a query of q, the
        quotient can reach t only where t q <= g <= q / t, and does where t (g +
        q) / (1 + t) grams are shared: rows are read by their size, shared
        grams counted."""
        if threshold <= 0:
            raise ValueError("a threshold of 0 is reached by every row: scan the rows")
        grams = query_trigrams(query)
        q = len(grams)
        shared = self.postings(grams, math.floor(threshold * q), math.ceil(q / threshold)).groupBy("id", "size").agg(F.count("*").alias("_n"))
        similarity = F.col("_n") / (F.col("size") + F.lit(q) - F.col("_n"))
        return shared.select("id", similarity.alias("similarity")).where(F.col("similarity") >= F.lit(threshold))
