"""Nested data, JSON and reshape operators.

Vendor documents have data-valued keys (dates, "0", "1", ...). They are parsed
with ``from_json`` into ``map<string, ...>`` types, so no schema inference
runs and numeric text is kept as written. Every reshape is a projection plus
``explode`` / ``inline``: documents are processed independently, in parallel,
and never gathered.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import let
from ..functions.dates import try_parse_date

# Output columns of every fundamental frame.
METRIC_COLUMNS = ["category", "metric", "value", "currency", "period", "period_type", "published_at"]

GRAIN = {"yearly": "year", "quarterly": "quarter"}


def parse_documents(df: DataFrame, text_col: str, schema, out_col: str = "doc", required: str | None = None,
                    only: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse JSON text with a fixed schema, one parse per row. Returns
    (parsed, rejects): malformed text (``from_json`` yields a struct of
    NULLs in PERMISSIVE mode) or a document without the ``required``
    top-level field goes to the reject frame instead of vanishing. With
    ``only`` the other rows are not parsed and in neither frame."""
    # a generator of one row: later projections and filters cannot be merged
    # into it, which would repeat the parse for every field they read
    text = F.col(text_col) if only is None else F.when(only, F.col(text_col))
    parsed = df.select("*", F.explode(F.array(F.from_json(text, schema))).alias(out_col))
    probe = F.col(f"{out_col}.{required or schema.fields[0].name}")
    ok = F.col(out_col).isNotNull() & probe.isNotNull()
    rejects = parsed.where(~ok if only is None else ~ok & only)
    return parsed.where(ok), rejects.drop(out_col)


def deep_get(text_col: Column, path: Sequence[str]) -> Column:
    """Nested lookup by key path on JSON text; missing -> NULL. A text without
    one of the keys is not parsed, unless it may hold the key with escapes."""
    p = "$" + "".join(f"['{k}']" for k in path)
    names = [text_col.contains(k) for k in path if k != "*"]    # ['*'] stands for any key
    value = F.get_json_object(text_col, p)
    return F.when(reduce(and_, names) | text_col.contains("\\"), value) if names else value


def map_get(m: Column, key: str) -> Column:
    """Value of one key of a map, NULL when absent (never raises)."""
    return F.try_element_at(m, F.lit(key))


METRIC_TYPE = ("array<struct<category:string,metric:string,value:string,currency:string,period:date,"
               "period_type:string,published_at:date>>")


def _metric(category, metric, value, currency=None, period=None, period_type=None, published=None) -> Column:
    def lit_or(c, t):
        return c.cast(t) if c is not None else F.lit(None).cast(t)
    return F.struct(F.lit(category).alias("category"), (F.lit(metric) if isinstance(metric, str) else metric)
                    .alias("metric"), lit_or(value, "string").alias("value"),
                    lit_or(currency, "string").alias("currency"), lit_or(period, "date").alias("period"),
                    lit_or(period_type, "string").alias("period_type"),
                    lit_or(published, "date").alias("published_at"))


def _or_empty(arr: Column) -> Column:
    return F.coalesce(arr, F.array().cast(METRIC_TYPE))


def struct_metric_array(m: Column, category: str, fields: Sequence[str] | None = None,
                        nested: dict[str, Sequence[str]] | None = None) -> Column:
    """Metric rows of one object as an array column (empty when the object
    is missing or empty). See ``struct_to_metrics``."""
    nested = nested or {}
    if fields is None:
        arr = F.transform(F.map_entries(m), lambda e: _metric(category, e["key"], e["value"]))
    else:
        # one loop over the names of each run of fields: an expression a field
        # makes methods that the JVM does not compile, and repeats the parse of
        # a sub-object for every field of it
        def rows(obj: Column, names: Sequence[str]) -> Column:
            return F.transform(F.array(*[F.lit(n) for n in names]), lambda n: _metric(category, n, F.try_element_at(obj, n)))

        runs = []
        for is_nested, group in itertools.groupby(fields, lambda f: f in nested):
            if is_nested:
                runs += [let(F.from_json(map_get(m, f), "map<string,string>"), lambda sub, f=f: rows(sub, nested[f])) for f in group]
            else:
                runs.append(rows(m, list(group)))
        arr = F.concat(*runs) if runs else F.array()
    return _or_empty(F.when(m.isNotNull() & (F.size(m) > 0), arr))


def records_metric_array(parts: Sequence[tuple[Column, str]], category: str, date_key: str = "date",
                         published_key: str = "filing_date", id_keys: Sequence[str] = ("currency_symbol",),
                         fields: Sequence[str] | None = None) -> Column:
    """Metric rows of maps of dated records, as one array column."""
    skip = list({date_key, published_key, *id_keys})

    def dated(rec: Column, pt: str) -> Column:
        """The record with its dates, parsed once for all its metrics."""
        return F.struct(rec.alias("rec"), F.trunc(try_parse_date(map_get(rec, date_key), "yyyy-MM-dd"), GRAIN.get(pt, "year")).alias("period"),
                        try_parse_date(map_get(rec, published_key), "yyyy-MM-dd").alias("pub"))

    def rows_of(x: Column, pt: str) -> Column:
        rec, period, pub = x["rec"], x["period"], x["pub"]
        cur = map_get(rec, "currency_symbol")
        if fields is None:
            entries = F.map_entries(F.map_filter(rec, lambda k, v: ~k.isin(skip)))
            return F.transform(entries, lambda e: _metric(category, e["key"], e["value"], cur, period, F.lit(pt), pub))
        return F.array(*[_metric(category, f, map_get(rec, f), cur, period, F.lit(pt), pub)
                         for f in fields if f not in skip])

    def per_record(step, pt: str):
        return lambda r: step(r, pt)      # one-argument lambda (transform counts parameters)

    arrays = [_or_empty(F.flatten(F.transform(F.transform(F.map_values(m), per_record(dated, pt)), per_record(rows_of, pt))))
              for m, pt in parts]
    return F.concat(*arrays) if len(arrays) > 1 else arrays[0]


def json_value_metric_array(m: Column, metric: str, category: str, fields: Sequence[str]) -> Column:
    """One metric whose value is the JSON array of the map's records."""
    return _or_empty(F.when(m.isNotNull() & (F.size(m) > 0), F.array(_metric(category, metric, _json_array(m, fields)))))


def explode_metrics(df: DataFrame, arr: Column, id_cols: Sequence[str] = ()) -> DataFrame:
    """Array of metric rows -> long form (one ``inline``; no shuffle)."""
    return df.select(F.inline(arr), *id_cols)


_MAPS = "array<map<string,string>>"


@dataclass(frozen=True)
class Section:
    """Metric rows of one kind of objects of a document, in two forms. One
    object: ``values`` is an array of the values of ``fields``, NULL where
    there are no rows. Dated records: ``records`` is a map of them, their keys
    (or ``fields``) are metrics."""
    category: str
    fields: tuple[str, ...] | None = None
    values: Column | None = None
    records: Column | None = None
    period_type: str | None = None
    date_key: str = "date"
    published_key: str = "filing_date"


def field_values(m: Column, fields: Sequence[str], given: Column | None = None) -> Column:
    """The values of an object's fields in their order; NULL where ``given``
    (the object itself) is missing or empty."""
    given = m if given is None else given
    return F.when(given.isNotNull() & (F.size(given) > 0), F.array(*[map_get(m, f) for f in fields]))


def _json_array(m: Column, fields: Sequence[str]) -> Column:
    arr = F.transform(F.map_values(m), lambda x: F.struct(*[map_get(x, f).alias(f) for f in fields]))
    return F.to_json(arr, {"ignoreNullFields": "false"})


def json_values(m: Column, fields: Sequence[str]) -> Column:
    """The one value of ``json_value_metric_array``, in an array; NULL where
    the map is missing or empty."""
    return F.when(m.isNotNull() & (F.size(m) > 0), F.array(_json_array(m, fields)))


def explode_sections(df: DataFrame, sections: Sequence[Section], id_cols: Sequence[str], id_keys: Sequence[str] = ("currency_symbol",)) -> DataFrame:
    """The metric rows of all sections in long form, without a shuffle: a
    document becomes rows of its objects and records, whose dates are read once
    each, and these become rows of their metrics. What is done for a row is
    compiled code; an array of whole metric rows for a document would be made
    value by value in interpreted expressions."""
    whole, dated = [s for s in sections if s.records is None], [s for s in sections if s.records is not None]
    kinds = [*whole, *dated]

    def of_kind(values: Sequence, of: str) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]).cast(f"array<{of}>"), F.col("_kind"))

    # A record that is NULL takes its map's rows with it, unless the fields are fixed.
    maps = [s.records if s.fields is not None else F.when(~F.exists(F.map_values(s.records), lambda r: r.isNull()), s.records) for s in dated]
    p = df.select(*id_cols, *[s.values.alias(f"_v{i}") for i, s in enumerate(whole)], *[m.alias(f"_r{i}") for i, m in enumerate(maps)])
    records = [F.coalesce(F.map_values(f"_r{i}"), F.array().cast(_MAPS)) for i in range(len(dated))]
    kind = F.concat(F.array(*[F.lit(i) for i in range(len(whole))]).cast("array<int>"),
                    *[F.array_repeat(F.lit(len(whole) + i), F.size(r)) for i, r in enumerate(records)])
    record = F.concat(F.array_repeat(F.lit(None).cast("map<string,string>"), len(whole)), *records)
    values = F.array(*[F.col(f"_v{i}") for i in range(len(whole))]).cast("array<array<string>>")
    p = p.select(*id_cols, F.inline(F.arrays_zip(kind, record, values)).alias("_kind", "_rec", "_values"))

    rec, fixed = F.col("_rec"), [i for i, s in enumerate(kinds) if s.records is not None and s.fields is not None]
    given = [F.when(F.col("_kind") == i, F.array(*[map_get(rec, f) for f in kinds[i].fields])) for i in fixed]
    p = p.select(*id_cols, "_kind", "_rec", F.coalesce("_values", *given).alias("_values"), map_get(rec, "currency_symbol").alias("currency"),
                 F.try_element_at(rec, of_kind([s.date_key if s.records is not None else None for s in kinds], "string")).alias("_date"),
                 F.try_element_at(rec, of_kind([s.published_key if s.records is not None else None for s in kinds], "string")).alias("_published"))
    day, grain = try_parse_date(F.col("_date"), "yyyy-MM-dd"), of_kind([GRAIN.get(s.period_type, "year") for s in kinds], "string")
    p = p.withColumns({"_day": day, "published_at": try_parse_date(F.col("_published"), "yyyy-MM-dd")})
    p = p.select(*id_cols, "_kind", "_rec", "_values", "currency", "published_at",
                 F.when(grain == "quarter", F.trunc("_day", "quarter")).otherwise(F.trunc("_day", "year")).alias("period"))

    names = F.get(F.array(*[F.array(*[F.lit(f) for f in s.fields]) if s.fields is not None else F.lit(None).cast("array<string>") for s in kinds]), F.col("_kind"))
    entries = F.arrays_zip(F.coalesce(names, F.map_keys("_rec")), F.coalesce("_values", F.map_values("_rec")))
    p = p.select("_kind", "currency", "period", "published_at", *id_cols, F.inline(entries).alias("metric", "value"))
    metric = F.col("metric")
    skip = [metric == of_kind([s.date_key for s in kinds], "string"), metric == of_kind([s.published_key for s in kinds], "string"), metric.isin(list(id_keys))]
    p = p.where(of_kind([s.fields is not None for s in kinds], "boolean") | ~reduce(or_, skip))
    return p.select(of_kind([s.category for s in kinds], "string").alias("category"), "metric", "value", "currency", "period",
                    of_kind([s.period_type for s in kinds], "string").alias("period_type"), "published_at", *id_cols)


def struct_to_metrics(df: DataFrame, map_col: str, category: str, fields: Sequence[str] | None = None,
                      id_cols: Sequence[str] = (), nested: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One row per field of an object: (category, metric, value as text).

    ``fields`` fixes the field list (a missing field yields a NULL value row,
    as a melt over a declared schema does); without it every key present is
    emitted. ``nested`` names sub-objects whose own fields are flattened in
    place (``AddressData`` -> Street, City, ...). Rows are emitted even when
    the value is NULL. Documents lacking the object emit nothing.
    """
    return explode_metrics(df, struct_metric_array(F.col(map_col), category, fields, nested), id_cols)


def records_to_metrics(df: DataFrame, map_col, category: str, period_type: str | None = None,
                       date_key: str = "date", published_key: str = "filing_date",
                       id_keys: Sequence[str] = ("currency_symbol",), fields: Sequence[str] | None = None,
                       id_cols: Sequence[str] = ()) -> DataFrame:
    """Map of dated records -> long form: one row per (record, metric) with
    currency, period (record date truncated to year / quarter), period type
    and publication date. The record's id keys are not metrics.

    ``map_col`` may be one column (with ``period_type``) or a list of
    (column, period_type) pairs; all are reshaped in ONE pass over ``df``."""
    parts = [(map_col, period_type)] if isinstance(map_col, str) else list(map_col)
    arr = records_metric_array([(F.col(c), pt) for c, pt in parts], category, date_key, published_key, id_keys,
                               fields)
    return explode_metrics(df, arr, id_cols)


def nested_to_json_value(df: DataFrame, map_col: str, metric: str, category: str, fields: Sequence[str],
                         id_cols: Sequence[str] = ()) -> DataFrame:
    """A map of records kept as ONE metric whose value is a JSON array of
    the records, each projected to ``fields`` (NULL fields kept)."""
    return explode_metrics(df, json_value_metric_array(F.col(map_col), metric, category, fields), id_cols)


def map_values_explode(df: DataFrame, map_col: str, keep: Sequence[Column | str] = ()) -> DataFrame:
    """Object with data keys -> one row per value (``value.*`` columns)."""
    ex = df.select(*keep, F.explode(F.map_values(map_col)).alias("_v"))
    if not _is_struct_valued(df, map_col):
        return ex
    return ex.select(*[c for c in ex.columns if c != "_v"], "_v.*")


def _is_struct_valued(df: DataFrame, map_col: str) -> bool:
    from pyspark.sql.types import MapType, StructType
    t = df.schema[map_col].dataType
    return isinstance(t, MapType) and isinstance(t.valueType, StructType)


def unpivot_struct_members(df: DataFrame, struct_col: str, ids: Sequence[str], key_name: str = "key",
                           value_name: str = "member") -> DataFrame:
    """Struct with known member fields -> rows (``unpivot``), NULL members
    dropped."""
    flat = df.select(*ids, f"{struct_col}.*")
    members = [c for c in flat.columns if c not in ids]
    long = flat.unpivot(list(ids), members, key_name, value_name)
    return long.where(F.col(value_name).isNotNull())


def unpivot_map_members(df: DataFrame, map_col: str, ids: Sequence[str], key_name: str = "key",
                        value_name: str = "member") -> DataFrame:
    """The same for members whose names are data: an object parsed as a map is
    exploded with its keys, so no set of keys is gathered, however many there
    are."""
    long = df.select(*ids, F.explode(F.col(map_col)).alias(key_name, value_name))
    return long.where(F.col(value_name).isNotNull())


def struct_unnest(df: DataFrame, struct_col: str) -> DataFrame:
    """Replace a struct column by its fields."""
    return df.select(*[c for c in df.columns if c != struct_col], f"{struct_col}.*")


def split_list(c: Column, sep: str = ",") -> Column:
    return F.split(c, sep)


def first_or_null(arr: Column) -> Column:
    """``arr[0]`` that yields NULL on an empty array (``get`` never raises)."""
    return F.get(arr, 0)
