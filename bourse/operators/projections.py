"""Projections and row-local derivations. All of them are one
``select`` that stays inside whole-stage codegen."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date_col, ntz_lit, utc_now


def _q(name: str):
    """Column by name; back-quoted so that dotted vendor names work."""
    return F.col(f"`{name}`")


def project_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select the listed (possibly dotted) columns and rename them."""
    return df.select(*[_q(src).alias(dst) for src, dst in mapping.items()])


_QUOTE_VALUES = ("open", "high", "low", "close", "adjusted_close")


def normalize_quote_history(raw: DataFrame, as_of, loaded_at=None) -> DataFrame:
    """Vendor history layout (Date, exchange, security, Open..Adjusted_close,
    Volume) -> snake case, typed, ``year`` partition column, load stamp; rows
    dated on or after ``as_of`` (today) are dropped."""
    a = as_date_col(as_of)
    # UTC wall-clock stamp without time zone
    stamp = ntz_lit(loaded_at) if loaded_at is not None else utc_now()
    d = F.col("Date").cast("date")
    return raw.where(d < a).select(
        d.alias("date"),
        F.col("security").alias("security_code"),
        F.col("exchange").alias("exchange_code"),
        *[F.col(c.capitalize() if c != "adjusted_close" else "Adjusted_close").cast("double").alias(c)
          for c in _QUOTE_VALUES],
        F.col("Volume").cast("bigint").alias("volume"),
        F.year(d).alias("year"),
        stamp.alias("loaded_at"),
    )


def normalize_quote_update(raw: DataFrame) -> DataFrame:
    """Bulk-day layout (``Code`` -> security_code); no date filter."""
    d = F.col("Date").cast("date")
    return raw.select(
        d.alias("date"),
        F.col("Code").alias("security_code"),
        F.col("exchange").alias("exchange_code"),
        *[F.col(c.capitalize() if c != "adjusted_close" else "Adjusted_close").cast("double").alias(c)
          for c in _QUOTE_VALUES],
        F.col("Volume").cast("bigint").alias("volume"),
        F.year(d).alias("year"),
    )


def normalize_quote_legacy(q: DataFrame, listing_id: int, interval_id: int) -> DataFrame:
    """Legacy quote rows: date as timestamp text, ``adj_close``, constant
    listing and interval ids."""
    return q.select(
        F.date_format(F.col("date").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("date"),
        "open", "high", "low", "close",
        F.col("adjusted_close").alias("adj_close"),
        "volume",
        F.lit(listing_id).cast("bigint").alias("security_listing_id"),
        F.lit(interval_id).cast("bigint").alias("interval_id"),
    )


def force_schema(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns to their declared types; a value that does not
    convert becomes NULL (``try_cast``) instead of failing the job."""
    return df.select(*[_q(c).try_cast(types[c]).alias(c) if c in types else _q(c) for c in df.columns])


def case_id_type(df: DataFrame, isin: str = "isin", ticker: str = "ticker") -> DataFrame:
    """Request id: ISIN first, else ticker, else NULL (value and type)."""
    i, t = F.col(isin), F.col(ticker)
    value = F.when(i.isNotNull(), i).when(t.isNotNull(), t)
    kind = F.when(i.isNotNull(), F.lit("ID_ISIN")).when(t.isNotNull(), F.lit("TICKER"))
    return df.select("*", value.alias("idValue"), kind.alias("idType"))


def case_id_type_second_attempt(df: DataFrame, isin: str = "isin", ticker: str = "ticker") -> DataFrame:
    """Second attempt: rows that have an ISIN are retried by ticker."""
    return df.where(F.col(isin).isNotNull()).select("*", F.col(ticker).alias("idValue"),
                                                   F.lit("TICKER").alias("idType"))


def derive_with_aliases(df: DataFrame) -> DataFrame:
    """Later select items use earlier aliases (lateral column alias, SQL)."""
    return df.sparkSession.sql(
        """SELECT code, exchange_code, code || '_' || exchange_code AS security_uid,
                  security_uid || '_' || type AS security_ticker_uid,
                  IF(currency = 'USD', 'vendor', NULL) AS quote_source,
                  IF(quote_source IS NOT NULL, currency, NULL) AS currency
           FROM {src}""", src=df)
