"""Filter, order and page operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import value_lit
from ..functions.predicates import filter_objects_predicate, filter_set_predicate

DEFAULT_PAGE_SIZE = 25  # fixed default page size of the read API


def filter_set(df: DataFrame, filters: Mapping[str, object] | None,
               fset: Mapping[str, tuple[str, str]]) -> DataFrame:
    return df.where(filter_set_predicate(filters, fset))


def filter_objects(df: DataFrame, items) -> DataFrame:
    return df.where(filter_objects_predicate(items))


def filter_in(df: DataFrame, lists: Mapping[str, Sequence]) -> DataFrame:
    """``col IN (...)`` per entry; an empty list gives an empty result."""
    out = df
    for c, vals in lists.items():
        out = out.where(F.col(c).isin(list(vals)) if vals else F.lit(False))
    return out


def exclude_codes(df: DataFrame, col: str, codes: Sequence[str]) -> DataFrame:
    """``col NOT IN (codes)``; NULL codes are dropped, as NOT IN does."""
    return df.where(~F.col(col).isin(list(codes)))


def log_filter(logs: DataFrame, filters: Mapping[str, object] | None, field: str | None = None,
               time_col: str = "created") -> DataFrame:
    """Log-view filters: list -> IN, ``fromTs``/``untilTs`` -> range on the
    time column, anything else -> equality. ``page``, ``pageSize`` and the
    field being listed are not filters."""
    preds: list[Column] = []
    for k, v in (filters or {}).items():
        if k in ("page", "pageSize") or k == field or v is None:
            continue
        if k == "fromTs":
            preds.append(F.col(time_col) >= value_lit(v))
        elif k == "untilTs":
            preds.append(F.col(time_col) <= value_lit(v))
        elif isinstance(v, (list, tuple, set)):
            preds.append(F.col(k).isin(list(v)) if v else F.lit(False))
        else:
            preds.append(F.col(k) == value_lit(v))
    out = logs
    for p in preds:
        out = out.where(p)
    return out


def sort_keys(order: Sequence[tuple[str, str]]) -> list[Column]:
    """(column, ASC|DESC) pairs -> sort keys; NULLs last on ASC (as Postgres)
    and first on DESC."""
    keys = []
    for c, d in order:
        keys.append(F.col(c).desc_nulls_first() if str(d).upper() == "DESC" else F.col(c).asc_nulls_last())
    return keys


def order_rows(df: DataFrame, order: Sequence[tuple[str, str]]) -> DataFrame:
    return df.orderBy(*sort_keys(order))


def paginate(df: DataFrame, page: int | None = 1, page_size: int | None = DEFAULT_PAGE_SIZE,
             order: Sequence[tuple[str, str]] = (), unique_key: Sequence[str] = ()) -> DataFrame:
    """``LIMIT page_size OFFSET (page - 1) * page_size``; page <= 0 -> offset 0.

    The order is made total with ``unique_key`` so that pages do not overlap.
    Spark plans ``orderBy + offset + limit`` as a TakeOrderedAndProject (a
    per-partition top-(offset+limit) heap, then a merge of those): no full
    sort of the data.
    """
    page_size = DEFAULT_PAGE_SIZE if page_size is None else int(page_size)
    page = 1 if page is None else int(page)
    offset = (page - 1) * page_size if page > 0 else 0
    keys = sort_keys(order) + [F.col(k).asc_nulls_last() for k in unique_key]
    out = df.orderBy(*keys) if keys else df
    if offset:
        out = out.offset(offset)
    return out.limit(page_size)


def sort_skip_limit(logs: DataFrame, page: int = 1, page_size: int = DEFAULT_PAGE_SIZE,
                    time_col: str = "created", id_col: str = "id") -> DataFrame:
    """Logs: newest first, then skip and limit."""
    return paginate(logs, page, page_size, order=[(time_col, "DESC")], unique_key=[id_col])


def head_n(df: DataFrame, n: int | None, order: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """First ``n`` rows after a stable sort; ``None`` = no cap (default)."""
    if n is None:
        return df
    return (df.orderBy(*sort_keys(order)) if order else df).limit(int(n))


def check_cardinality(df: DataFrame, min_rows: int = 0, max_rows: int = 1) -> DataFrame:
    """one / oneOrNone contract: at most ``max_rows`` (and at least
    ``min_rows``) rows, or the action fails with ``expected a..b rows, got n``.
    The check is part of the plan: ``max_rows + 1`` rows at most are gathered,
    counted and given back; nothing runs before the action."""
    some = df.limit(max_rows + 1).agg(F.collect_list(F.struct(*[F.col(c) for c in df.columns])).alias("rows"))
    n = F.size("rows")
    wrong = F.concat(F.lit(f"expected {min_rows}..{max_rows} rows, got "), n.cast("string"), F.when(n > max_rows, "+").otherwise(""))
    return some.select(F.inline(F.when(n.between(min_rows, max_rows), F.col("rows")).otherwise(F.raise_error(wrong))))
