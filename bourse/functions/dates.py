"""Date helpers (Column -> Column). Month arithmetic clamps to month end."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


# Ten characters, a year from 0001 on; whether there is such a day is the
# cast's to say.
_ISO_DATE = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def as_date_col(x) -> Column:
    """A Python date / ISO string / Column as a DATE column."""
    if isinstance(x, Column):
        return x.cast("date")
    if isinstance(x, _dt.datetime):
        x = x.date()
    if isinstance(x, _dt.date):
        return F.lit(x)
    return F.to_date(F.lit(str(x)))


def shift_months(d: Column, n: int) -> Column:
    """``d + n months``; 31 Mar - 1 month = last day of Feb."""
    return F.add_months(d, n)


def shift_years(d: Column, n: int) -> Column:
    """``d + n years``; 29 Feb - 1 year = 28 Feb."""
    return F.add_months(d, 12 * n)


def trunc_date(d: Column, grain: str) -> Column:
    """Start of year / quarter / month / week, as DATE (``date_trunc`` would
    give TIMESTAMP)."""
    return F.trunc(d, grain)


def try_parse_date(c: Column, fmt: str) -> Column:
    """``strptime`` that yields NULL on bad text (ANSI would raise). Text of
    the usual form is cast, which gives the same and costs far less."""
    parsed = F.to_date(F.try_to_timestamp(c, F.lit(fmt)))
    if fmt != "yyyy-MM-dd":
        return parsed
    return F.when(c.rlike(_ISO_DATE), c.try_cast("date")).otherwise(parsed)


def try_parse_time(c: Column, fmt: str = "HH:mm:ss") -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def ntz_lit(x) -> Column:
    """A wall-clock timestamp literal (TIMESTAMP_NTZ) built from text, so no
    time zone (Python's or the session's) shifts it."""
    if isinstance(x, _dt.datetime):
        x = x.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(str(x)).cast("timestamp_ntz")


def utc_now() -> Column:
    """Current UTC wall-clock time as TIMESTAMP_NTZ, whatever the session
    time zone."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def value_lit(v) -> Column:
    """Literal for a filter value: naive datetimes become wall-clock
    (TIMESTAMP_NTZ) literals, everything else ``F.lit``."""
    if isinstance(v, _dt.datetime) and v.tzinfo is None:
        return ntz_lit(v)
    return F.lit(v)
