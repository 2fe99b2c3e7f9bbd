"""Registered queries for SURVEY 2.10 (time series) and 2.6 (windows)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..operators import timeseries as ts
from .dates import add_months, lit
from .fixtures import QUOTE_AS_OF, table, v_quote, v_quote_null, with_views
from .registry import register

AS_OF = QUOTE_AS_OF
BASE = AS_OF - _dt.timedelta(days=1)  # base date of the exact job


def _asof_refs(a: _dt.date):
    return [
        ("YEAR_TO_DATE", _dt.date(a.year, 1, 1)),
        ("MONTH_TO_DATE", _dt.date(a.year, a.month, 1)),
        ("LAST_12_MONTH", add_months(a, -12)),
        ("LAST_5_DAY", a - _dt.timedelta(days=5)),
        ("LAST_30_DAY", a - _dt.timedelta(days=30)),
        ("LAST_14_DAY", a - _dt.timedelta(days=14)),
    ]


def _exact_refs(b: _dt.date):
    return [
        ("YEAR_TO_DATE", _dt.date(b.year, 1, 1)),
        ("MONTH_TO_DATE", _dt.date(b.year, b.month, 1)),
        ("LAST_3_MONTH", add_months(b, -3)),
        ("LAST_12_MONTH", add_months(b, -12)),
        ("LAST_6_MONTH", add_months(b, -6)),
        ("LAST_1_MONTH", add_months(b, -1)),
        ("LAST_2_YEAR", add_months(b, -24)),
        ("LAST_5_YEAR", add_months(b, -60)),
        ("LAST_10_YEAR", add_months(b, -120)),
    ]


def _values(refs) -> str:
    rows = ", ".join(f"('{p}', {lit(d)})" for p, d in refs)
    return f"SELECT * FROM (VALUES {rows}) t(period, ref)"


# ------------------------------------------------------------ performance_asof

PERFORMANCE_ASOF_SQL = with_views(
    """
SELECT b.security_code, b.exchange_code, b.base_date, b.base_close, r.reference_date,
       r.reference_close, b.base_close / NULLIF(r.reference_close, 0) - 1 AS performance, r.period
FROM b JOIN r ON b.security_code = r.security_code AND b.exchange_code = r.exchange_code""",
    "v_quote",
    extra={
        "q": f"SELECT security_code, exchange_code, date, adjusted_close FROM v_quote WHERE date <= {lit(AS_OF)}",
        "p": _values(_asof_refs(AS_OF)),
        "b": "SELECT security_code, exchange_code, max(date) AS base_date, "
             "arg_max(adjusted_close, date) AS base_close FROM q GROUP BY ALL",
        "r": "SELECT q.security_code, q.exchange_code, p.period, max(q.date) AS reference_date, "
             "arg_max(q.adjusted_close, q.date) AS reference_close FROM q JOIN p ON q.date <= p.ref GROUP BY ALL",
    },
)


@register("performance_asof", PERFORMANCE_ASOF_SQL)
def q_performance_asof(spark, sf_dir):
    return ts.performance_asof(v_quote(spark, sf_dir), AS_OF)


# ------------------------------------------------------------ performance_exact
# Oracle: a day's close is the latest known close up to that day within the ten
# years and ten days of the calendar, taken per key and reference date by
# arg_max; this is IFNULL(close, LEAD(close) IGNORE NULLS ... DESC) over the dense
# calendar of the reference job without building keys x 3,660 days.

_EX_START = add_months(AS_OF, -120) - _dt.timedelta(days=10)

PERFORMANCE_EXACT_SQL = with_views(
    f"""
SELECT k.security_code, k.exchange_code, {lit(BASE)} AS base_date, p.ref AS reference_date,
       b.close AS base_close, r.close AS reference_close, p.period,
       b.close / NULLIF(r.close, 0) - 1 AS performance
FROM keys k CROSS JOIN p
LEFT JOIN closes b ON b.security_code = k.security_code AND b.exchange_code = k.exchange_code AND b.ref = {lit(BASE)}
LEFT JOIN closes r ON r.security_code = k.security_code AND r.exchange_code = k.exchange_code AND r.ref = p.ref""",
    "v_quote_null",
    extra={
        "keys": "SELECT DISTINCT security_code, exchange_code FROM v_quote_null",
        "p": _values(_exact_refs(BASE)),
        "days": f"SELECT DISTINCT ref FROM (SELECT ref FROM p UNION ALL SELECT {lit(BASE)})",
        "closes": "SELECT q.security_code, q.exchange_code, d.ref, arg_max(q.adjusted_close, q.date) AS close "
                  "FROM v_quote_null q JOIN days d ON q.date <= d.ref WHERE q.adjusted_close IS NOT NULL AND "
                  f"q.date >= {lit(_EX_START)} GROUP BY q.security_code, q.exchange_code, d.ref",
    },
)


@register("performance_exact", PERFORMANCE_EXACT_SQL)
def q_performance_exact(spark, sf_dir):
    return ts.performance_exact(v_quote_null(spark, sf_dir), BASE, AS_OF)


# ------------------------------------------------------------ calendar
_CAL_FROM = _dt.date(AS_OF.year, 1, 1)


@register("calendar", f"""
SELECT CAST(range AS DATE) AS date FROM range(
  LEAST({lit(_EX_START)}, (SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem)), {lit(AS_OF)}, INTERVAL 1 DAY)""")
def q_calendar(spark, sf_dir):
    # one row per day of the ten years and ten days before as_of, or from the
    # first ship date where that is earlier
    first = table(spark, sf_dir, "lineitem").agg(F.least(F.lit(_EX_START), F.min(F.to_date("l_shipdate"))).alias("s"))
    return first.select(F.explode(ts._day_seq(F.col("s"), F.lit(AS_OF))).alias("date"))


# ------------------------------------------------------------ calendar_densify
# Calendar = the year to date of as_of (a calendar window is the operator's
# parameter); every key of the whole quote table is densified over it.

@register("calendar_densify", with_views(f"""
SELECT k.security_code, k.exchange_code, c.date, q.adjusted_close
FROM (SELECT DISTINCT security_code, exchange_code FROM v_quote_null) k
CROSS JOIN (SELECT CAST(range AS DATE) AS date FROM range({lit(_CAL_FROM)}, {lit(AS_OF)}, INTERVAL 1 DAY)) c
LEFT JOIN v_quote_null q ON q.security_code = k.security_code AND q.exchange_code = k.exchange_code
 AND q.date = c.date""", "v_quote_null"))
def q_calendar_densify(spark, sf_dir):
    return ts.calendar_densify(v_quote_null(spark, sf_dir), _CAL_FROM, AS_OF)


# Over the ten years and ten days of the exact job the rows are summed up per key
# and year, so that the result stays small.
@register("calendar_densify_ten_years", with_views(f"""
SELECT k.security_code, k.exchange_code, CAST(year(c.date) AS INTEGER) AS year, count(*) AS n_days,
       count(q.adjusted_close) AS n_quotes, max(q.adjusted_close) AS top_close, min(c.date) AS first_day, max(c.date) AS last_day
FROM (SELECT DISTINCT security_code, exchange_code FROM v_quote_null) k
CROSS JOIN (SELECT CAST(range AS DATE) AS date FROM range({lit(_EX_START)}, {lit(AS_OF)}, INTERVAL 1 DAY)) c
LEFT JOIN v_quote_null q ON q.security_code = k.security_code AND q.exchange_code = k.exchange_code
 AND q.date = c.date GROUP BY ALL""", "v_quote_null"))
def q_calendar_densify_ten_years(spark, sf_dir):
    dense = ts.calendar_densify(v_quote_null(spark, sf_dir), *ts.calendar_bounds(AS_OF))
    return dense.groupBy("security_code", "exchange_code", F.year("date").alias("year")).agg(
        F.count("*").alias("n_days"), F.count("adjusted_close").alias("n_quotes"), F.max("adjusted_close").alias("top_close"),
        F.min("date").alias("first_day"), F.max("date").alias("last_day"))


# ------------------------------------------------------------ forward_fill

@register("forward_fill", with_views("""
SELECT security_code, exchange_code, date,
       last_value(adjusted_close IGNORE NULLS) OVER (PARTITION BY security_code, exchange_code ORDER BY date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS adjusted_close
FROM v_quote_null""", "v_quote_null"))
def q_forward_fill(spark, sf_dir):
    q = v_quote_null(spark, sf_dir).select("security_code", "exchange_code", "date", "adjusted_close")
    return ts.forward_fill(q, ts.KEYS, "date", "adjusted_close")


@register("forward_fill_events", """
SELECT event_id, event_type, ts, last_value(v IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, v NULLS FIRST, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
FROM (SELECT event_id, event_type, ts, CASE WHEN event_id % 5 = 0 THEN user_id END AS v FROM events)""")
def q_forward_fill_events(spark, sf_dir):
    """Few keys, many rows a day: a key is spread over all segments."""
    e = table(spark, sf_dir, "events").select("event_type", "ts", F.when(F.col("event_id") % 5 == 0, F.col("user_id")).alias("v"), "event_id")
    return ts.forward_fill(e, ["event_type"], "ts", "v").select("event_id", "event_type", "ts", "v")


@register("lead_ignore_nulls", with_views("""
SELECT security_code, exchange_code, date,
       IFNULL(adjusted_close, LEAD(adjusted_close, 1 IGNORE NULLS) OVER (
           PARTITION BY security_code, exchange_code ORDER BY date DESC)) AS close
FROM v_quote_null""", "v_quote_null"))
def q_lead_ignore_nulls(spark, sf_dir):
    q = v_quote_null(spark, sf_dir).select("security_code", "exchange_code", "date", "adjusted_close")
    led = ts.lead_ignore_nulls(q, "adjusted_close", ts.KEYS, "date", "earlier")
    return led.select("security_code", "exchange_code", "date", F.coalesce("adjusted_close", "earlier").alias("close"))


# ------------------------------------------------------------ missing_date_ranges
_GAP_AS_OF = _dt.date(2001, 12, 31)


@register("missing_date_ranges", with_views(f"""
SELECT exchange_code, last_date, CAST(d AS DATE) AS missing_date
FROM (SELECT exchange_code, max(date) AS last_date FROM v_quote GROUP BY ALL) l,
     LATERAL (SELECT unnest(range(CAST(l.last_date + 1 AS TIMESTAMP), CAST({lit(_GAP_AS_OF)} AS TIMESTAMP),
                                  INTERVAL 1 DAY)) AS d)""", "v_quote"))
def q_missing_date_ranges(spark, sf_dir):
    return ts.missing_date_ranges(v_quote(spark, sf_dir), _GAP_AS_OF, keys=("exchange_code",))


@register("max_date_per_exchange", with_views("""
SELECT exchange_code, max(date) AS last_date FROM v_quote GROUP BY exchange_code""", "v_quote"))
def q_max_date_per_exchange(spark, sf_dir):
    return ts.max_date_per_group(v_quote(spark, sf_dir))


@register("latest_row_per_group", with_views("""
SELECT security_code, exchange_code, date, open, high, low, close, adjusted_close, volume
FROM v_quote QUALIFY row_number() OVER (PARTITION BY security_code, exchange_code ORDER BY date DESC) = 1""",
                                             "v_quote"))
def q_latest_row_per_group(spark, sf_dir):
    return ts.latest_row_per_group(v_quote(spark, sf_dir))


@register("truncate_period", with_views("""
SELECT security_code, exchange_code, date,
       CAST(date_trunc('year', date) AS DATE) AS period_year,
       CAST(date_trunc('quarter', date) AS DATE) AS period_quarter
FROM v_quote""", "v_quote"))
def q_truncate_period(spark, sf_dir):
    q = v_quote(spark, sf_dir).select("security_code", "exchange_code", "date")
    q = ts.truncate_period(q, "date", "year", "period_year")
    return ts.truncate_period(q, "date", "quarter", "period_quarter")


@register("shift_date", with_views("""
SELECT DISTINCT date,
       CAST(date - INTERVAL 1 MONTH AS DATE) AS minus_1_month,
       CAST(date - INTERVAL 3 MONTH AS DATE) AS minus_3_month,
       CAST(date - INTERVAL 1 YEAR AS DATE) AS minus_1_year,
       CAST(date_trunc('month', date) AS DATE) AS month_start
FROM v_quote""", "v_quote"))
def q_shift_date(spark, sf_dir):
    from ..functions.dates import shift_months, shift_years, trunc_date
    d = F.col("date")
    return v_quote(spark, sf_dir).select(
        d, shift_months(d, -1).alias("minus_1_month"), shift_months(d, -3).alias("minus_3_month"),
        shift_years(d, -1).alias("minus_1_year"), trunc_date(d, "month").alias("month_start")).distinct()


# ------------------------------------------------------------ asof_join_backward
# Trades (lineitem lines) look up the last quote strictly before their ship
# date, per (security, exchange).

@register("asof_join_backward", with_views("""
SELECT t.l_orderkey, t.l_linenumber, t.security_code, t.exchange_code, t.ref_date,
       q.adjusted_close, q.date AS date_matched
FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS security_code,
             l_linestatus AS exchange_code, CAST(l_shipdate AS DATE) - 1 AS ref_date FROM lineitem) t
ASOF LEFT JOIN v_quote q ON t.security_code = q.security_code AND t.exchange_code = q.exchange_code
 AND t.ref_date >= q.date""", "v_quote"))
def q_asof_join_backward(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_partkey").cast("string").alias("security_code"),
        F.col("l_linestatus").alias("exchange_code"),
        F.date_sub(F.to_date("l_shipdate"), 1).alias("ref_date"))
    q = v_quote(spark, sf_dir).select("security_code", "exchange_code", "date", "adjusted_close")
    return ts.asof_join_backward(li, q, ts.KEYS, "ref_date", "date", ["adjusted_close"]) \
        .withColumnRenamed("date_matched", "date_matched")
