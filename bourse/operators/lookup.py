"""Lookup joins, multi-source merges and identifier matching.

No join carries a broadcast hint: Spark broadcasts a side whose size in bytes
is below the session's threshold and shuffles both otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def mapping_slice(m: DataFrame, product: str | None = None, source: str | None = None,
                  field: str | None = None, active_only: bool = True) -> DataFrame:
    """Rows of the value-mapping table for (product, source, field); each
    argument is optional."""
    out = m
    for c, v in (("product", product), ("source", source), ("field", field)):
        if v is not None:
            out = out.where(F.col(c) == F.lit(v))
    if active_only and "is_active" in m.columns:
        out = out.where(F.col("is_active"))
    return out


def lookup_join(df: DataFrame, m: DataFrame, col: str, out_col: str | None = None,
                keep_unmapped: bool = True) -> DataFrame:
    """Left join ``df[col]`` to ``m.source_value``; ``out_col`` =
    ``coalesce(mapping_value, original)``. A value that is mapped to several
    others fans out to all of them, as in the LEFT JOIN it stands for."""
    out_col = out_col or col
    mm = m.select(F.col("source_value").alias("_sv"), F.col("mapping_value").alias("_mv")).distinct()
    j = df.join(mm, df[col] == mm["_sv"], "left")
    val = F.coalesce(F.col("_mv"), F.col(col)) if keep_unmapped else F.col("_mv")
    return j.withColumn(out_col, val).drop("_sv", "_mv")


def reverse_lookup_join(df: DataFrame, m: DataFrame, col: str, out_col: str) -> DataFrame:
    """Join through ``mapping_value`` back to ``source_value``: one composite
    value fans out to every source value mapped to it; unmapped values keep
    themselves."""
    mm = (m.select(F.col("source_value").alias("_sv"), F.col("mapping_value").alias("_mv"))
          .where(F.col("_mv").isNotNull()).distinct())
    j = df.join(mm, df[col] == mm["_mv"], "left")
    return j.withColumn(out_col, F.coalesce(F.col("_sv"), F.col(col))).drop("_sv", "_mv")


def multi_lookup_join(df: DataFrame, lookups: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Chained left lookups: each (mapping slice, column, output column)."""
    out = df
    for m, col, out_col in lookups:
        out = lookup_join(out, m, col, out_col)
    return out


def precedence_merge(base: DataFrame, sources: Mapping[str, DataFrame], key: str,
                     precedence: Mapping[str, Sequence[str]], how: str = "left",
                     bool_cols: Sequence[str] = ()) -> DataFrame:
    """``base LEFT JOIN s2 LEFT JOIN s3 ON key``; each output column is the
    COALESCE of its own source order. ``sources`` must include the base under
    its name. ``how="full"`` keeps keys missing from the base."""
    names = list(sources)
    frames = {n: sources[n].select(*[F.col(c).alias(f"{n}__{c}") for c in sources[n].columns]) for n in names}
    first = names[0]
    j = frames[first]
    keycol = F.col(f"{first}__{key}")
    for n in names[1:]:
        j = j.join(frames[n], keycol == F.col(f"{n}__{key}"), how)
        if how == "full":
            keycol = F.coalesce(keycol, F.col(f"{n}__{key}"))
    outs = [keycol.alias(key)]
    for col, order in precedence.items():
        vals = [F.col(f"{n}__{col}") for n in order if col in sources[n].columns]
        v = F.coalesce(*vals) if len(vals) > 1 else vals[0]
        if col in bool_cols:
            v = (F.coalesce(v.cast("int"), F.lit(0)) != 0)
        outs.append(v.alias(col))
    return j.select(*outs)


def self_join_parent(df: DataFrame, id_col: str, parent_col: str, cols: Sequence[str],
                     prefix: str = "operating_") -> DataFrame:
    """Each row with its parent's columns (self left join, depth 1)."""
    p = df.select(F.col(id_col).alias("_pid"), *[F.col(c).alias(prefix + c) for c in cols])
    return df.join(p, df[parent_col] == p["_pid"], "left").drop("_pid")


def lateral_parent_json(df: DataFrame, id_col: str, parent_col: str, cols: Sequence[str],
                        out_col: str) -> DataFrame:
    """Per row, the parent as a JSON object (NULL when there is none); the
    decorrelated form of a LEFT JOIN LATERAL."""
    p = df.select(F.col(id_col).alias("_pid"),
                  F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}).alias(out_col))
    return df.join(p, df[parent_col] == p["_pid"], "left").drop("_pid")


def scalar_subquery_agg(parent: DataFrame, child: DataFrame, keys: Sequence[str], fields: Sequence[str],
                        order_by: str, out_col: str) -> DataFrame:
    """Per parent row, the JSON array of its child rows ordered by
    ``order_by``; ``'[]'`` when it has none. Children are aggregated first
    (one row per key), then left-joined: the decorrelated scalar subquery."""
    rec = F.struct(F.col(order_by).alias("_o"), *[F.col(c) for c in fields])
    agg = child.groupBy(*keys).agg(F.array_sort(F.collect_list(rec)).alias("_a"))
    agg = agg.select(*keys, F.to_json(F.transform("_a", lambda x: x.dropFields("_o")),
                                      {"ignoreNullFields": "false"}).alias(out_col))
    return parent.join(agg, [*keys], "left").withColumn(out_col, F.coalesce(F.col(out_col), F.lit("[]")))


def child_chunks(child: DataFrame, keys: Sequence[str], fields: Sequence[str], order_by: str, out_col: str, size: int = 1000) -> DataFrame:
    """The child rows of every key as numbered JSON arrays of up to ``size``
    rows, in order of ``order_by`` (ties by the fields): ``keys chunk n``
    and ``out_col``. A parent with a third of all children is many rows, none
    larger than a chunk.

    Children are numbered by a range partitioning of key and order, not by a
    window over the key; a key's first number gives the place in its list. Runs
    the numbering's jobs when it is called (``global_row_index``)."""
    from .keys import global_row_index

    order = list(dict.fromkeys([*keys, order_by, *fields]))
    rows = global_row_index(child.select(*order), order, "_i")
    first = rows.groupBy(*keys).agg(F.min("_i").alias("_first")).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_first")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    rows = rows.join(first, same).withColumn("chunk", F.floor((F.col("_i") - F.col("_first")) / size))
    each = F.array_sort(F.collect_list(F.struct(F.col("_i"), *[F.col(c) for c in fields])))
    chunks = rows.groupBy(*keys, "chunk").agg(each.alias("_a"))
    return chunks.select(*keys, "chunk", F.size("_a").cast("bigint").alias("n"), F.to_json(F.transform("_a", lambda x: x.dropFields("_i")), {"ignoreNullFields": "false"}).alias(out_col))


def chunks_of(chunks: DataFrame, key: Mapping[str, object]) -> DataFrame:
    """The chunks of one parent, in order: what a reader of one listing asks
    for."""
    return chunks.where(reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in key.items()])).orderBy("chunk")


def dual_key_union_join(df: DataFrame, ref: DataFrame, isin_col: str, ticker_col: str,
                        ref_isin: str, ref_ticker: str, ref_cols: Sequence[str], strict: bool = False) -> DataFrame:
    """(left join on ISIN) UNION (left join on ticker), distinct. A row matched
    by one key also appears unmatched from the other branch (as in the
    reference); ``strict=True`` drops those unmatched copies when a matched
    copy exists."""
    r1 = ref.where(F.col(ref_isin).isNotNull()).select(F.col(ref_isin).alias("_k"), *ref_cols)
    r2 = ref.where(F.col(ref_ticker).isNotNull()).select(F.col(ref_ticker).alias("_k"), *ref_cols)
    a = df.join(r1, df[isin_col] == r1["_k"], "left").drop("_k")
    b = df.join(r2, df[ticker_col] == r2["_k"], "left").drop("_k")
    u = a.unionByName(b).distinct()
    if strict:
        probe = ref_cols[0]
        matched = u.where(F.col(probe).isNotNull()).select(*df.columns).distinct()
        um = u.where(F.col(probe).isNull()).join(matched, [*df.columns], "left_anti")
        u = u.where(F.col(probe).isNotNull()).unionByName(um)
    return u


def dual_key_matches(df: DataFrame, ref: DataFrame, isin_col: str, ticker_col: str,
                     ref_isin: str, ref_ticker: str, ref_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(distinct rows that match by ISIN or by ticker, rows that match by
    neither). Both keys go through one join, as (kind, key) pairs."""
    def pairs(d: DataFrame, isin: str, ticker: str, *cols) -> DataFrame:
        key = F.array(F.struct(F.lit("isin").alias("kind"), F.col(isin).alias("key")),
                      F.struct(F.lit("ticker").alias("kind"), F.col(ticker).alias("key")))
        return d.select(*cols, F.inline(key).alias("_kind", "_key")).where(F.col("_key").isNotNull())

    refs = pairs(ref, ref_isin, ref_ticker, F.struct(*[F.col(c) for c in ref_cols]).alias("_ref"))
    mine = pairs(df, isin_col, ticker_col, F.struct(*[F.col(c) for c in df.columns]).alias("_row"))
    matched = mine.join(refs, ["_kind", "_key"]).select("_row.*", "_ref.*").distinct()
    known = refs.select("_kind", "_key").distinct()
    by = {k: known.where(F.col("_kind") == k).select(F.col("_key").alias(f"_{k}")) for k in ("isin", "ticker")}
    missing = df.join(by["isin"], F.col(isin_col) == F.col("_isin"), "left_anti") \
        .join(by["ticker"], F.col(ticker_col) == F.col("_ticker"), "left_anti")
    return matched, missing


def fallback_match(df: DataFrame, ref: DataFrame, isin_col: str, ticker_col: str,
                   ref_isin: str, ref_ticker: str, ref_cols: Sequence[str]) -> DataFrame:
    """Match on ISIN; the unmatched rest on ticker; the rest is missing
    (``matched_by`` NULL). One row per input row when the reference keys are
    unique. Two joins: the second one only takes rows the first left open."""
    found = F.struct(*[F.col(c) for c in ref_cols])
    r1 = ref.where(F.col(ref_isin).isNotNull()).select(F.col(ref_isin).alias("_ik"), found.alias("_i"))
    r2 = ref.where(F.col(ref_ticker).isNotNull()).select(F.col(ref_ticker).alias("_tk"), found.alias("_t"))
    j = df.join(r1, F.col(isin_col) == F.col("_ik"), "left")
    j = j.join(r2, (F.col(ticker_col) == F.col("_tk")) & F.col("_ik").isNull(), "left")
    hit = F.coalesce("_i", "_t")
    by = F.when(F.col("_ik").isNotNull(), "isin").when(F.col("_tk").isNotNull(), "ticker")
    return j.select(*df.columns, *[hit[c].alias(c) for c in ref_cols], by.alias("matched_by"))


def positional_join(requests: DataFrame, responses: DataFrame, keys: Sequence[str] = ("batch_id", "seq")) -> DataFrame:
    """Request i <-> response i by an explicit (batch, position) key; row order
    is never relied on."""
    return requests.join(responses, [*keys], "left")


def explode_response(df: DataFrame, data_col: str = "data", keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """One row per match; requests without a match are split off (second
    frame) so they can be counted."""
    ex = df.select(*keep, F.explode_outer(data_col).alias("_m"))
    matched = ex.where(F.col("_m").isNotNull()).select(*keep, "_m.*")
    unmatched = ex.where(F.col("_m").isNull()).select(*keep)
    return matched, unmatched


def anti_join_missing(df: DataFrame, keys: DataFrame, on: Sequence[str] | Column | str) -> DataFrame:
    return df.join(keys, on, "left_anti")


def interval_self_join(q: DataFrame, keys: Sequence[str], date_col: str, value_col: str,
                       ref_expr: Column, out_prefix: str = "reference_") -> DataFrame:
    """Left self join on a computed reference date (equi join on
    (keys, ref_date) instead of a theta join)."""
    b = q.select(*keys, date_col, value_col, ref_expr.alias("_ref"))
    r = q.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col(date_col).alias("_r_d"),
                 F.col(value_col).alias(out_prefix + value_col))
    cond = [b[k] == r[f"_r_{k}"] for k in keys] + [b["_ref"] == r["_r_d"]]
    j = b.join(r, cond, "left")
    return j.select(*keys, date_col, value_col, F.col("_ref").alias(out_prefix + date_col),
                    out_prefix + value_col)


def cross_join_agg(left: DataFrame, right: DataFrame, by: Sequence[str], aggs: Sequence[Column],
                   keys_per_task: int = 4096) -> DataFrame:
    """The distinct rows of ``left`` times all rows of ``right``, aggregated per
    row of ``left`` and the ``by`` columns of ``right``.

    The product is grouped by a number of the left row instead of its columns:
    hashing those again for every row of the product costs more than the
    product. The numbers are staged, so that both sides of the join that brings
    the columns back see the same ones; a task holds the groups of about
    ``keys_per_task`` left rows, however many there are."""
    spark = left.sparkSession
    path = scratch_path(spark, "keys")
    left.distinct().withColumn("_key", F.monotonically_increasing_id()).write.parquet(path)
    keys = spark.read.parquet(path)
    keys = keys.repartition(keys.count() // keys_per_task + 1, "_key")
    groups = keys.select("_key").crossJoin(right).groupBy("_key", *by).agg(*aggs)
    return groups.join(keys.hint("shuffle_hash"), "_key").select(*left.columns, *[c for c in groups.columns if c != "_key"])
