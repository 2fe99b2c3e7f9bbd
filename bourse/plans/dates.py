"""Python-side date arithmetic for building oracle literals."""

from __future__ import annotations

import calendar as _cal
import datetime as _dt


def add_months(d: _dt.date, n: int) -> _dt.date:
    m = d.month - 1 + n
    y = d.year + m // 12
    m = m % 12 + 1
    return _dt.date(y, m, min(d.day, _cal.monthrange(y, m)[1]))


def lit(d: _dt.date) -> str:
    return f"DATE '{d.isoformat()}'"
