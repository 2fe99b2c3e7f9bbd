"""Column -> Column helpers used across jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed sentinel values that vendor files use for "missing".
DEFAULT_SENTINELS = ("Unknown", "")


def null_if_sentinel(c: Column, sentinels: Sequence[str] = DEFAULT_SENTINELS) -> Column:
    out = c
    for s in sentinels:
        out = F.nullif(out, F.lit(s))
    return out


def sentinel_to_null(df: DataFrame, sentinels: Sequence[str] = DEFAULT_SENTINELS,
                     columns: Iterable[str] | None = None) -> DataFrame:
    """In every string column (or the given ones), sentinel text -> NULL.
    The column list comes from the schema, so it is one projection."""
    cols = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[null_if_sentinel(F.col(f"`{c}`"), sentinels).alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


def slugify(c: Column) -> Column:
    """``replace(lower(x), ' ', '_')``."""
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def underscore_spaces(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit("_"))


def title_case(c: Column) -> Column:
    """Python ``str.title()``: a letter is upper-cased when it follows a
    non-letter, lower-cased otherwise (``O'NEIL`` -> ``O'Neil``,
    ``SMITH-JONES`` -> ``Smith-Jones``). ``initcap`` only splits on spaces.

    Built from JVM functions: split into alternating letter / non-letter
    runs, capitalize each letter run, join back.
    """
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    cased = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30))))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.array_join(cased, ""))


def null_self_reference(ref: Column, own: Column) -> Column:
    """Parent id equal to the row's own id -> NULL."""
    return F.nullif(ref, own)


def us_composite_code(c: Column, venue_codes: Sequence[str], composite: str = "US") -> Column:
    """Venue codes of one country -> their composite code; others unchanged."""
    return F.when(c.isin(list(venue_codes)), F.lit(composite)).otherwise(c)


def request_key(code: Column, exchange: Column) -> Column:
    """``code.exchange`` request key."""
    return F.concat_ws(".", code, exchange)


def hive_path(parts: Sequence[tuple[str, Column]]) -> Column:
    """``k1=v1/k2=v2`` path elements."""
    return F.concat_ws("/", *[F.concat(F.lit(f"{k}="), v) for k, v in parts])


def reference_quote_source(ticker: Column, ticker_ref: Column, mic: Column, mic_ref: Column,
                           operating_mic: Column, source: Column, currency: Column) -> tuple[Column, Column]:
    """``quote_source`` = source when the ticker matches and the venue matches
    either directly or through its operating venue; the currency is kept only
    for such rows. Returns (quote_source, currency)."""
    ok = (ticker == ticker_ref) & ((mic == mic_ref) | (operating_mic == mic_ref))
    qs = F.when(ok, source)
    return qs, F.when(qs.isNotNull(), currency)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))
