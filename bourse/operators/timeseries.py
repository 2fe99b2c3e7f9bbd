"""Time-series operators: calendars, gap filling, as-of lookups, performance.

Design notes (scale):
* As-of lookups at a handful of fixed reference dates are written as ONE
  ``groupBy(key)`` with conditional ``max_by`` aggregates. ``max_by`` is a
  declarative aggregate, so Spark computes it map-side (partial aggregation)
  before the shuffle: a key holding a third of all rows costs one partial
  row per map task, not a third of the data in one reducer.
* Gap filling that must emit every row (``forward_fill``) is a segmented
  scan: rows are windowed per segment of about equal row counts instead of per
  key, and the value carried into a segment comes from one summary row for
  each earlier one. A hot key, month or day is split like any other rows.
* Calendars are generated per key with ``explode(sequence(...))``; there is no
  Cartesian product in any plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.dates import as_date_col, shift_months, shift_years
from ..session import scratch_path

KEYS = ("security_code", "exchange_code")


def _asof_periods(as_of: Column) -> list[tuple[str, Column]]:
    """Periods of the as-of performance job, with their reference date."""
    # Fixed period names (must equal the reference's labels).
    return [
        ("YEAR_TO_DATE", F.trunc(as_of, "year")),
        ("MONTH_TO_DATE", F.trunc(as_of, "month")),
        ("LAST_12_MONTH", shift_months(as_of, -12)),
        ("LAST_5_DAY", F.date_sub(as_of, 5)),
        ("LAST_30_DAY", F.date_sub(as_of, 30)),
        ("LAST_14_DAY", F.date_sub(as_of, 14)),
    ]


def _exact_periods(base: Column, legacy_last_3_month: bool = False) -> list[tuple[str, Column]]:
    """Periods of the calendar (exact-date) performance job."""
    return [
        ("YEAR_TO_DATE", F.trunc(base, "year")),
        ("MONTH_TO_DATE", F.trunc(base, "month")),
        ("LAST_3_MONTH", shift_months(base, -1 if legacy_last_3_month else -3)),
        ("LAST_12_MONTH", shift_months(base, -12)),
        ("LAST_6_MONTH", shift_months(base, -6)),
        ("LAST_1_MONTH", shift_months(base, -1)),
        ("LAST_2_YEAR", shift_years(base, -2)),
        ("LAST_5_YEAR", shift_years(base, -5)),
        ("LAST_10_YEAR", shift_years(base, -10)),
    ]


def _last_on_or_before(date_col: Column, value_col: Column, bound: Column,
                       lower: Column | None = None, skip_null_values: bool = False) -> Column:
    """Aggregate: the (date, value) struct of the latest row with
    ``lower <= date <= bound``; NULL when there is none."""
    cond = date_col <= bound
    if lower is not None:
        cond = cond & (date_col >= lower)
    if skip_null_values:
        cond = cond & value_col.isNotNull()
    rec = F.struct(date_col.alias("d"), value_col.alias("v"))
    return F.max_by(F.when(cond, rec), F.when(cond, date_col))


def performance_asof(q: DataFrame, as_of, keys: Sequence[str] = KEYS, date_col: str = "date",
                     value_col: str = "adjusted_close", periods=None) -> DataFrame:
    """Base = latest quote on or before ``as_of``; reference = latest quote on or
    before each period's date; performance = base / reference - 1.

    Keys without a reference quote for a period get no row for it (inner-join
    semantics). One shuffle, no join. Every aggregate has a fixed-width
    buffer (``max`` of a date, ``max_by`` of a double by a date), so Spark
    plans a hash aggregation with map-side partial results."""
    asof = as_date_col(as_of)
    periods = periods or _asof_periods(asof)
    d, v = F.col(date_col), F.col(value_col)
    src = q.select(*keys, date_col, value_col).where(d <= asof)
    aggs = [F.max(d).alias("_bd"), F.max_by(v, d).alias("_bv")]
    for i, (_, ref) in enumerate(periods):
        cond = d <= ref
        aggs += [F.max(F.when(cond, d)).alias(f"_rd{i}"), F.max_by(F.when(cond, v), F.when(cond, d)).alias(f"_rv{i}")]
    g = src.groupBy(*keys).agg(*aggs)
    per = F.array(*[F.struct(F.lit(name).alias("period"), F.col(f"_rd{i}").alias("rd"), F.col(f"_rv{i}").alias("rv"))
                    for i, (name, _) in enumerate(periods)])
    long = g.select(*keys, "_bd", "_bv", F.inline(per)).where(F.col("rd").isNotNull())
    return long.select(
        *keys,
        F.col("_bd").alias("base_date"),
        F.col("_bv").alias("base_close"),
        F.col("rd").alias("reference_date"),
        F.col("rv").alias("reference_close"),
        (F.try_divide(F.col("_bv"), F.col("rv")) - F.lit(1.0)).alias("performance"),
        "period",
    )


def calendar_bounds(as_of, years: int = 10, days: int = 10) -> tuple[Column, Column]:
    """Half-open window [as_of - years - days, as_of) of the exact job."""
    end = as_date_col(as_of)
    start = F.date_sub(shift_years(end, -years), days)
    return start, end


def calendar(spark, start, end) -> DataFrame:
    """One row per day in [start, end); empty when start >= end."""
    s, e = as_date_col(start), as_date_col(end)
    return spark.range(1).select(
        F.explode(F.when(s < e, F.sequence(s, F.date_sub(e, 1))).otherwise(F.array().cast("array<date>"))).alias("date")
    )


def _day_seq(start: Column, end_excl: Column) -> Column:
    """``sequence`` over [start, end_excl), guarded so that an empty range
    yields an empty array (an unguarded descending sequence would not)."""
    return F.when(start < end_excl, F.sequence(start, F.date_sub(end_excl, 1))).otherwise(
        F.array().cast("array<date>"))


def calendar_densify(q: DataFrame, start, end, keys: Sequence[str] = KEYS, date_col: str = "date",
                     value_cols: Sequence[str] = ("adjusted_close",)) -> DataFrame:
    """Every key of ``q`` times every day of [start, end), left-joined to the
    quotes of that day. Only the quotes are shuffled, by key: each gives its own
    day and the days without a quote up to the next one of its key (the first
    also those before it), so the dense rows are made where they are used and
    stay partitioned by key. A key with a NULL part has days but no quotes, and
    one without quotes in the window has its days."""
    s, e = as_date_col(start), as_date_col(end)
    d = F.col(date_col)
    held = (d >= s) & (d < e)
    for k in keys:
        held = held & F.col(k).isNotNull()
    # quotes outside the window stand on the day before it: they only name their key
    at = q.select(*keys, F.when(held, d).otherwise(F.date_sub(s, 1)).alias("_at"), *value_cols)
    w = W.partitionBy(*keys).orderBy("_at")
    at = at.withColumn("_from", F.when(F.lag("_at").over(w).isNull(), s).otherwise(F.greatest("_at", s)))
    at = at.withColumn("_to", F.greatest(F.coalesce(F.lead("_at").over(w), e), F.date_add("_at", 1)))
    days = at.select(*keys, "_at", *value_cols, F.explode(_day_seq(F.col("_from"), F.col("_to"))).alias(date_col))
    return days.select(*keys, date_col, *[F.when(d == F.col("_at"), F.col(c)).alias(c) for c in value_cols])


def _segmented_last(df: DataFrame, keys: Sequence[str], order_col: str, value_col: str, out_col: str,
                    last_row: int) -> DataFrame:
    """``out_col`` = last non-null value of the key's rows up to ``last_row``
    (0: this row, -1: the row before), by ``order_col``; rows of one key and
    order follow their value, null first, and then their other columns.

    Segmented scan with segments of about equal row counts, whatever a key or a
    day holds: rows are range-partitioned by key, order and the columns that
    break ties, and written down with their segment, so that segments stay
    the same when an executor is lost. The window runs per segment and key; the
    value carried into a segment comes from the segments before it that end
    with the same key, one summary row for each."""
    spark = df.sparkSession
    plain = [c for c, t in df.dtypes if not t.startswith(("map<", "variant"))]
    order = [order_col, *[c for c in (value_col, *plain) if c not in keys and c != order_col]]
    order = list(dict.fromkeys(order))
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "segments")
    df.repartitionByRange(n, *by).withColumn("_seg", F.spark_partition_id()).write.parquet(path)
    base = spark.read.schema(StructType([*df.schema.fields, StructField("_seg", IntegerType())])).parquet(path)
    v, key = F.col(value_col), F.struct(*[F.col(c) for c in keys])
    last = F.max(F.when(v.isNotNull(), F.struct(key.alias("k"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], v.alias("v")))).alias("last")
    ends = base.groupBy("_seg").agg(F.min(key).alias("head"), F.max(key).alias("tail"), last)
    # a segment asks for the value of its first key and gives that of its last
    asks = ends.select(F.col("head").alias("k"), "_seg", F.lit(0).alias("kind"), F.lit(None).cast(df.schema[value_col].dataType).alias("v"))
    gives = ends.select(F.col("tail").alias("k"), "_seg", F.lit(1).alias("kind"), F.when(F.col("last.k") == F.col("tail"), F.col("last.v")).alias("v"))
    before = W.partitionBy("k").orderBy("_seg", "kind").rowsBetween(W.unboundedPreceding, -1)
    carry = asks.unionByName(gives).withColumn("carry", F.last("v", ignorenulls=True).over(before)).where("kind = 0 and carry is not null")
    carry = carry.select(F.col("_seg").alias("_s"), *[F.col("k")[c].alias(f"_k{i}") for i, c in enumerate(keys)], F.col("carry").alias("_carry"))
    same = F.col("_seg") == F.col("_s")
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    inside = W.partitionBy("_seg", *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(W.unboundedPreceding, last_row)
    filled = base.join(carry, same, "left").withColumn(out_col + "__", F.coalesce(F.last(v, ignorenulls=True).over(inside), F.col("_carry")))
    return filled.select(*[c for c in df.columns if c != out_col], F.col(out_col + "__").alias(out_col))


def forward_fill(df: DataFrame, keys: Sequence[str], order_col: str, value_col: str,
                 out_col: str | None = None) -> DataFrame:
    """``value = coalesce(value, last earlier non-null value)`` per key, ordered
    by ``order_col`` (a date); a segmented scan."""
    out_col = out_col or value_col
    filled = _segmented_last(df, keys, order_col, value_col, "_filled", 0)
    return filled.withColumn(out_col, F.col("_filled")).drop("_filled")


def lead_ignore_nulls(df: DataFrame, value_col: str, keys: Sequence[str], order_col: str, out_col: str) -> DataFrame:
    """``LEAD(value, 1) IGNORE NULLS OVER (PARTITION BY keys ORDER BY order DESC)``,
    as written in the reference: the next non-null value going back in time,
    which is the last non-null value of the rows before; a segmented scan."""
    return _segmented_last(df, keys, order_col, value_col, out_col, -1)


def performance_exact(q: DataFrame, base_date, as_of=None, keys: Sequence[str] = KEYS,
                      date_col: str = "date", value_col: str = "adjusted_close",
                      years: int = 10, days: int = 10, legacy_last_3_month: bool = False) -> DataFrame:
    """Calendar performance: the forward-filled close at ``base_date`` against
    the forward-filled close at each period's reference date.

    Equal to densify-then-fill over the calendar [as_of - years - days, as_of)
    followed by nine LEFT self joins, but computed as one conditional
    aggregation per key: only ten as-of values per key are needed, so the
    ten-year calendar is never materialized. A reference date before the
    calendar start has no calendar row and gives NULLs, as the join would.
    """
    b = as_date_col(base_date)
    end = as_date_col(as_of) if as_of is not None else F.date_add(b, 1)
    start, _ = calendar_bounds(end, years, days)
    periods = _exact_periods(b, legacy_last_3_month)
    d, v = F.col(date_col), F.col(value_col)
    src = q.select(*keys, date_col, value_col)
    in_cal = (d >= start) & (d < end)

    def fill_at(ref: Column) -> Column:
        cond = in_cal & (d <= ref) & v.isNotNull()
        return F.max_by(F.when(cond, v), F.when(cond, d))

    aggs = [fill_at(b).alias("_b")] + [fill_at(ref).alias(f"_r{i}") for i, (_, ref) in enumerate(periods)]
    g = src.groupBy(*keys).agg(*aggs)
    per = F.array(*[
        F.struct(F.lit(name).alias("period"),
                 F.when((ref >= start) & (ref < end), ref).alias("reference_date"),
                 F.col(f"_r{i}").alias("reference_close"))
        for i, (name, ref) in enumerate(periods)
    ])
    base_in_cal = (b >= start) & (b < end)
    out = g.where(base_in_cal).select(*keys, F.col("_b").alias("base_close"), F.inline(per))
    return out.select(
        *keys,
        b.alias("base_date"),
        "reference_date",
        "base_close",
        F.col("reference_close"),
        "period",
        (F.try_divide(F.col("base_close"), F.col("reference_close")) - F.lit(1.0)).alias("performance"),
    )


def missing_date_ranges(q: DataFrame, as_of, keys: Sequence[str] = ("exchange_code",),
                        date_col: str = "date") -> DataFrame:
    """Per key, the days strictly between its last quote and ``as_of``
    (one row per day). Guarded: a last quote on or after the day before
    ``as_of`` gives no rows."""
    a = as_date_col(as_of)
    last = q.groupBy(*keys).agg(F.max(date_col).alias("last_date"))
    s = F.date_add(F.col("last_date"), 1)
    return last.select(*keys, "last_date", F.explode(_day_seq(s, a)).alias("missing_date"))


def max_date_per_group(q: DataFrame, keys: Sequence[str] = ("exchange_code",), date_col: str = "date") -> DataFrame:
    return q.groupBy(*keys).agg(F.max(date_col).alias("last_date"))


def latest_row_per_group(q: DataFrame, keys: Sequence[str] = KEYS, date_col: str = "date") -> DataFrame:
    """Last row by date per key, all columns, via ``max_by(struct)`` (partial
    aggregation; no sort of the group)."""
    others = [c for c in q.columns if c not in keys]
    rec = F.struct(*[F.col(c) for c in others])
    return q.groupBy(*keys).agg(F.max_by(rec, F.col(date_col)).alias("_r")).select(*keys, "_r.*")


def truncate_period(df: DataFrame, col: str, grain: str, out_col: str | None = None) -> DataFrame:
    """Statement date -> first day of its year / quarter / month (stays DATE)."""
    return df.withColumn(out_col or col, F.trunc(F.col(col), grain))


def asof_join_backward(left: DataFrame, right: DataFrame, keys: Sequence[str], left_on: str,
                       right_on: str, right_cols: Sequence[str]) -> DataFrame:
    """For each left row, the right row of the same key with the latest
    ``right_on <= left_on`` (dates); of several right rows of one key and day
    the greatest by its other columns. A NULL key or date finds nothing.

    Works on days, not rows: both sides are reduced to one row per (key, day)
    map-side, a window over the days of a key carries the last right row
    forward, and the left rows join the day they fall on. The window sees as
    many rows as a key has days, however many trades it has, and the join can
    be split where a (key, day) is hot.
    """
    payload = F.struct(F.col(right_on).alias("_t"), *[F.col(c).alias(c) for c in right_cols])
    r = right.where(F.col(right_on).isNotNull()).select(*keys, F.col(right_on).alias("_at"), payload.alias("_rec"))
    asked = left.where(F.col(left_on).isNotNull()).select(
        *keys, F.col(left_on).alias("_at"), F.lit(None).cast(r.schema["_rec"].dataType).alias("_rec"))
    days = r.unionByName(asked).groupBy(*keys, "_at").agg(F.max("_rec").alias("_rec"))
    w = W.partitionBy(*keys).orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    carried = days.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_at",
                          F.last("_rec", ignorenulls=True).over(w).alias("_hit"))
    on = [F.col(k) == F.col(f"_k_{k}") for k in keys] + [F.col(left_on) == F.col("_at")]
    return left.join(carried, on, "left").select(
        *left.columns, *[F.col("_hit")[c].alias(c) for c in right_cols], F.col("_hit._t").alias(f"{right_on}_matched"))


def performance_exact_plain(q: DataFrame, base_date, as_of=None, keys: Sequence[str] = KEYS,
                            date_col: str = "date", value_col: str = "adjusted_close", years: int = 10,
                            days: int = 10) -> DataFrame:
    """The reference's plain form, kept as a baseline for measurements only:
    densify every key over the whole calendar, fill each day from the last
    earlier value, then look up each period's reference day with an equi
    join. ``performance_exact`` gives the same rows without the calendar."""
    b = as_date_col(base_date)
    end = as_date_col(as_of) if as_of is not None else F.date_add(b, 1)
    start, _ = calendar_bounds(end, years, days)
    dense = calendar_densify(q, start, end, keys, date_col, [value_col])
    w = W.partitionBy(*keys).orderBy(date_col).rowsBetween(W.unboundedPreceding, 0)
    filled = dense.select(*keys, date_col, F.last(value_col, ignorenulls=True).over(w).alias("close"))
    base = filled.where(F.col(date_col) == b).select(*keys, F.col("close").alias("base_close"))
    per = base.select(*keys, "base_close", F.inline(F.array(*[
        F.struct(F.lit(n).alias("period"), r.alias("_ref")) for n, r in _exact_periods(b)])))
    ref = filled.select(*keys, F.col(date_col).alias("_ref"), F.col("close").alias("reference_close"))
    j = per.join(ref.hint("merge"), [*keys, "_ref"], "left")     # the dense side grows with the data
    return j.select(*keys, b.alias("base_date"),
                    F.when(F.col("reference_close").isNotNull() | (F.col("_ref") >= start), F.col("_ref"))
                    .alias("reference_date"), "base_close", "reference_close", "period",
                    (F.try_divide(F.col("base_close"), F.col("reference_close")) - F.lit(1.0)).alias("performance"))
