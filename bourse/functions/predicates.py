"""Request-filter predicates (Column builders) and their fold.

A filter set declares, per request key, the column and the operator; the
request gives the values. Unknown keys and ``None`` values are ignored and
the remaining predicates are AND-ed, so the result is one ``Column`` that
Catalyst pushes into the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import value_lit

# Fixed operator names of the request filter API.
NULL = "NULL"
NOT_NULL = "NOT_NULL"
INCLUDES = "INCLUDES"
EXCLUDES = "EXCLUDES"
INCLUDES_NULL = "INCLUDES_NULL"
EQUAL = "EQUAL"
NOT_EQUAL = "NOT_EQUAL"
GREATER_EQUAL = "GREATER_EQUAL"
GREATER = "GREATER"
LESS_EQUAL = "LESS_EQUAL"
LESS = "LESS"
LIKE = "LIKE"
FULL_TEXT_SEARCH = "FULL_TEXT_SEARCH"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _list(value) -> list:
    if isinstance(value, (list, tuple, set, frozenset)):
        return list(value)
    return [value]


def pred_null(col, value=None) -> Column:
    return _c(col).isNull()


def pred_not_null(col, value=None) -> Column:
    return _c(col).isNotNull()


def pred_includes(col, value) -> Column:
    vals = _list(value)
    # An empty list selects nothing (IN () is false for every row).
    return _c(col).isin(vals) if vals else F.lit(False)


def pred_excludes(col, value) -> Column:
    vals = _list(value)
    # NOT IN: a NULL column value is not kept (three-valued logic).
    return ~_c(col).isin(vals) if vals else _c(col).isNotNull() | _c(col).isNull()


def pred_includes_null(col, value) -> Column | None:
    """``NULL``, ``NOT_NULL`` or both (OR-ed); other values give no predicate."""
    parts = []
    for v in _list(value):
        if v == NULL:
            parts.append(_c(col).isNull())
        elif v == NOT_NULL:
            parts.append(_c(col).isNotNull())
    if not parts:
        return None
    return reduce(lambda a, b: a | b, parts)


def pred_equal(col, value) -> Column:
    return _c(col) == value_lit(value)


def pred_not_equal(col, value) -> Column:
    return _c(col) != value_lit(value)


def pred_greater_equal(col, value) -> Column:
    return _c(col) >= value_lit(value)


def pred_greater(col, value) -> Column:
    return _c(col) > value_lit(value)


def pred_less_equal(col, value) -> Column:
    return _c(col) <= value_lit(value)


def pred_less(col, value) -> Column:
    return _c(col) < value_lit(value)


def pred_like(col, value) -> Column:
    """``col LIKE lower('%value%')``: only the pattern is lowered; ``%`` and
    ``_`` inside ``value`` stay wildcards, as in the request API."""
    return _c(col).like(f"%{str(value).lower()}%")


def pred_full_text(col, value) -> Column | None:
    """Placeholder: full-text filters are applied by ``fts_search``."""
    return None


OPERATORS = {
    NULL: pred_null,
    NOT_NULL: pred_not_null,
    INCLUDES: pred_includes,
    EXCLUDES: pred_excludes,
    INCLUDES_NULL: pred_includes_null,
    EQUAL: pred_equal,
    NOT_EQUAL: pred_not_equal,
    GREATER_EQUAL: pred_greater_equal,
    GREATER: pred_greater,
    LESS_EQUAL: pred_less_equal,
    LESS: pred_less,
    LIKE: pred_like,
    FULL_TEXT_SEARCH: pred_full_text,
}


def filter_set_predicate(filters: Mapping[str, object] | None,
                         filter_set: Mapping[str, tuple[str, str]]) -> Column:
    """Fold a request's filters through a filter set into one predicate.

    ``filter_set`` maps request key -> (column, operator). Keys absent from it
    and ``None`` values are ignored. Always returns a Column (TRUE if empty).
    """
    preds: list[Column] = []
    for key, value in (filters or {}).items():
        spec = filter_set.get(key)
        if spec is None or value is None:
            continue
        column, op = spec
        p = OPERATORS[op](column, value)
        if p is not None:
            preds.append(p)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


# Python-job filter objects (EQUAL, HIGHER(_EQUAL), LOWER(_EQUAL), IN,
# IS_NULL, IS_NOT_NULL). Only ``None`` skips a value operator, so 0, False
# and empty lists are real filter values.
OBJECT_OPERATORS = {
    "EQUAL": pred_equal,
    "HIGHER": pred_greater,
    "HIGHER_EQUAL": pred_greater_equal,
    "LOWER": pred_less,
    "LOWER_EQUAL": pred_less_equal,
    "IN": pred_includes,
    "IS_NULL": pred_null,
    "IS_NOT_NULL": pred_not_null,
    "NOT_NULL": pred_not_null,
}


def filter_objects_predicate(items: Sequence[Mapping[str, object]]) -> Column:
    preds = []
    for it in items or []:
        op = str(it["operator"]).upper()
        value = it.get("value")
        if op not in ("IS_NULL", "IS_NOT_NULL", "NOT_NULL") and value is None:
            continue
        preds.append(OBJECT_OPERATORS[op](it["column"], value))
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)
