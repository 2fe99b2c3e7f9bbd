"""Data-quality checks: split a frame into (valid, violations) with one flag
column, so that each check is a single pass (SURVEY 2.12)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _split(df: DataFrame, bad: Column, rule: str) -> tuple[DataFrame, DataFrame]:
    flagged = df.withColumn("_bad", F.coalesce(bad, F.lit(False)))
    valid = flagged.where(~F.col("_bad")).drop("_bad")
    viol = flagged.where(F.col("_bad")).drop("_bad").withColumn("violation", F.lit(rule))
    return valid, viol


def check_not_null(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return _split(df, bad, "not_null")


def check_null(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    bad = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])
    return _split(df, bad, "null")


def check_unique(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key occurs more than once are violations (all copies).

    Counts per key by aggregation (partial, map-side) joined back, rather than
    a window over the key: a duplicated hot key does not gather its rows in
    one task for the count; the join side is split by AQE skew handling."""
    valid, viol = _split(_with_count(df, cols), F.col("_n") > 1, "unique")
    return valid.drop("_n"), viol.drop("_n")


def _with_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with ``_n``, the number of rows with the same key; NULLs are
    equal to one another, as in a grouping."""
    keys = {c: f"_k{i}" for i, c in enumerate(cols)}
    counts = df.groupBy(*[F.col(c).alias(k) for c, k in keys.items()]).agg(F.count(F.lit(1)).alias("_n"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()])
    return df.join(counts, same, "left").drop(*keys.values())


def observe_checks(df: DataFrame, name: str, not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """The rows that pass, and an observation of the pass that reads them:
    ``rows``, ``nulls_<column>`` and, with ``unique``, ``repeated`` (rows whose
    key occurs more than once). Its values are there after the first action; no
    further pass is run for them."""
    seen = Observation(name)
    flagged = _with_count(df, unique) if unique else df.withColumn("_n", F.lit(1))
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in not_null]]
    if unique:
        metrics.append(F.count_if(F.col("_n") > 1).alias("repeated"))
    good = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in not_null], F.col("_n") == 1)
    return flagged.observe(seen, *metrics).where(good).drop("_n"), seen


def _required(df: DataFrame, bad: Column, message: Column) -> DataFrame:
    """The rows of ``df``, or an error at the action where one is bad."""
    return df.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All rows; the action fails on the first with a NULL in ``cols``."""
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return _required(df, bad, F.concat(F.lit("NULL in "), F.concat_ws(", ", *[F.when(F.col(c).isNull(), c) for c in cols])))


def require_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All rows; the action fails on a key that occurs more than once."""
    key = F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
    return _required(_with_count(df, cols), F.col("_n") > 1, F.concat(F.lit("repeated key "), key)).drop("_n")


def require_result_size(requests: DataFrame, responses: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """``check_result_size``; the action fails on a batch whose answers are not
    as many as its requests."""
    sizes = check_result_size(requests, responses, batch_col)
    said = F.concat(F.lit(f"{batch_col} "), F.col(batch_col).cast("string"), F.lit(": "), F.col("n_responses").cast("string"), F.lit(" answers to "), F.col("n_requests").cast("string"), F.lit(" requests"))
    return _required(sizes, ~F.col("ok"), F.coalesce(said, F.lit(f"{batch_col} without a value")))


def violation_report(df: DataFrame, violations: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """length, violation count and distinct violating ids (as a count)."""
    return violations.groupBy("violation").agg(
        F.count(F.lit(1)).alias("violations"),
        F.count_distinct(*[F.col(c) for c in id_cols]).alias("distinct_ids"),
    )


def check_single_value(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of ``col`` and whether there is more than one."""
    return df.agg(F.count_distinct(col).alias("n_values")).withColumn("ok", F.col("n_values") <= 1)


def check_result_size(requests: DataFrame, responses: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    r = requests.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n_requests"))
    s = responses.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n_responses"))
    return (r.join(s, batch_col, "full")
            .select(batch_col, F.coalesce("n_requests", F.lit(0)).alias("n_requests"),
                    F.coalesce("n_responses", F.lit(0)).alias("n_responses"))
            .withColumn("ok", F.col("n_requests") == F.col("n_responses")))


def unique_flag(df: DataFrame, col: str, out: str = "is_unique") -> DataFrame:
    """Whether a row's value occurs once; several NULLs are not unique."""
    return _with_count(df, [col]).withColumn(out, F.col("_n") == 1).drop("_n")
