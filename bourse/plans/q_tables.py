"""Registered queries for SURVEY 2.12 (keys, quality), 2.2 (sinks and table
maintenance) and 2.1 (sources). Writers are checked by writing data derived
from the driver's tables to a fresh folder under the session's checkpoint
folder and reading it back."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import ntz_lit
from ..operators import aggregates as A
from ..operators import keys as K
from ..operators import lookup as L
from ..operators import quality as Q
from ..operators.key_registry import KeyRegistry
from ..session import scratch_path
from ..sinks import merge as M
from ..sinks import partitioned as P
from ..sinks import writers as WR
from ..sources import readers as R
from .fixtures import table, v_entity, v_exchange, v_figi, v_mapping, v_quote, v_security, with_views
from .registry import register

_SEC = "code, name, type, exchange_code, isin, currency, id, size"

# ------------------------------------------------------------------ 2.12


def _known_keys(spark, d):
    s = v_security(spark, d)
    return s.where(F.col("id") % 2 == 0).select(F.col("code").alias("uid"),
                                                (F.col("id") * 10).alias("surrogate_key"))


@register("assign_surrogate_keys", with_views("""
SELECT s.code, s.name, k.k AS security_id
FROM v_security s JOIN (
  SELECT uid, k FROM known
  UNION ALL
  SELECT uid, (SELECT max(k) FROM known) + row_number() OVER (ORDER BY uid) AS k
  FROM (SELECT DISTINCT code AS uid FROM v_security WHERE code NOT IN (SELECT uid FROM known))) k
ON s.code = k.uid""", "v_security", extra={"known": "SELECT code AS uid, id * 10 AS k FROM v_security WHERE id % 2 = 0"}))
def q_assign_surrogate_keys(spark, sf_dir):
    s = v_security(spark, sf_dir).select("code", "name")
    out, _new = K.assign_surrogate_keys(s, _known_keys(spark, sf_dir), "code", "security_id")
    return out


_REGISTRY_SQL = """
SELECT uid, k FROM known UNION ALL
SELECT uid, (SELECT max(k) FROM known) + row_number() OVER (ORDER BY substr(md5(uid), 1, 3), uid) AS k
FROM (SELECT DISTINCT code AS uid FROM v_security WHERE code NOT IN (SELECT uid FROM known))"""
_REGISTRY_CTE = {"known": "SELECT code AS uid, id * 10 AS k FROM v_security WHERE id % 2 = 0", "keys": _REGISTRY_SQL}


def _stored_registry(spark, sf_dir):
    registry = KeyRegistry(spark, scratch_path(spark, "registry"))
    registry.commit(_known_keys(spark, sf_dir))
    return registry


@register("key_registry", with_views("SELECT s.code, s.name, keys.k AS security_id FROM v_security s JOIN keys ON s.code = keys.uid", "v_security", extra=_REGISTRY_CTE))
def q_key_registry(spark, sf_dir):
    """New uids are numbered from the stored high mark on; no job runs for it
    while the plan is built."""
    s = v_security(spark, sf_dir).select("code", "name")
    return _stored_registry(spark, sf_dir).assign(s, "code", "security_id")[0]


@register("key_registry_committed", with_views("SELECT uid, k AS surrogate_key FROM keys", "v_security", extra=_REGISTRY_CTE))
def q_key_registry_committed(spark, sf_dir):
    """The registry after two runs over the same securities: the second finds
    nothing new."""
    registry = _stored_registry(spark, sf_dir)
    for _ in range(2):
        registry.commit(registry.assign(v_security(spark, sf_dir), "code")[1])
    return registry.keys().select("uid", "surrogate_key")


@register("observed_checks", with_views("""
SELECT count(*) AS rows, count(*) FILTER (WHERE isin IS NULL) AS nulls_isin, count(*) FILTER (WHERE n > 1) AS repeated,
       count(*) FILTER (WHERE isin IS NOT NULL AND n = 1) AS written
FROM (SELECT *, count(*) OVER (PARTITION BY name, exchange_code, type) AS n FROM v_security)""", "v_security"))
def q_observed_checks(spark, sf_dir):
    """Counts from the pass that writes the valid rows."""
    path = scratch_path(spark, "checked")
    valid, seen = Q.observe_checks(v_security(spark, sf_dir), "securities", not_null=["isin"], unique=["name", "exchange_code", "type"])
    WR.overwrite_table(valid, path)
    counts = seen.get
    return spark.read.parquet(path).agg(*[F.lit(counts[c]).cast("bigint").alias(c) for c in ("rows", "nulls_isin", "repeated")], F.count(F.lit(1)).alias("written"))


@register("require_checks", with_views(f"SELECT {_SEC} FROM v_security", "v_security"))
def q_require_checks(spark, sf_dir):
    """All rows, which meet both rules; the action would fail otherwise."""
    return Q.require_unique(Q.require_not_null(v_security(spark, sf_dir), ["code", "name"]), ["code"])


def _key_registry(spark, d):
    s = v_security(spark, d)
    n = table(spark, d, "nation")
    return s.select(F.lit("security").alias("product"), F.col("code").alias("uid"),
                    (F.col("id") * 10).alias("surrogate_key"), (F.col("id") % 3 != 0).alias("is_active")) \
        .unionByName(n.select(F.lit("exchange").alias("product"), F.col("n_name").alias("uid"),
                              F.col("n_nationkey").cast("bigint").alias("surrogate_key"), F.lit(True).alias("is_active")))


@register("read_surrogate_keys", with_views("""
SELECT code AS uid, id * 10 AS surrogate_key FROM v_security WHERE id % 3 <> 0""", "v_security"))
def q_read_surrogate_keys(spark, sf_dir):
    return R.read_surrogate_keys(_key_registry(spark, sf_dir), "security")


@register("check_not_null", with_views(f"SELECT {_SEC} FROM v_security WHERE isin IS NOT NULL", "v_security"))
def q_check_not_null(spark, sf_dir):
    valid, _viol = Q.check_not_null(v_security(spark, sf_dir), ["isin"])
    return valid


@register("check_not_null_violations", with_views(
    f"SELECT {_SEC}, 'not_null' AS violation FROM v_security WHERE isin IS NULL", "v_security"))
def q_check_not_null_violations(spark, sf_dir):
    _valid, viol = Q.check_not_null(v_security(spark, sf_dir), ["isin"])
    return viol


@register("check_null", with_views(f"SELECT {_SEC} FROM v_security WHERE isin IS NULL", "v_security"))
def q_check_null(spark, sf_dir):
    valid, _viol = Q.check_null(v_security(spark, sf_dir), ["isin"])
    return valid


@register("check_unique", with_views(f"""
SELECT {_SEC}, 'unique' AS violation FROM v_security
WHERE (name, exchange_code, type) IN (SELECT (name, exchange_code, type) FROM v_security
                                      GROUP BY ALL HAVING count(*) > 1)""", "v_security"))
def q_check_unique(spark, sf_dir):
    _valid, viol = Q.check_unique(v_security(spark, sf_dir), ["name", "exchange_code", "type"])
    return viol.select(*_SEC.split(", "), "violation")


@register("violation_report", with_views("""
SELECT 'unique' AS violation, count(*) AS violations, count(DISTINCT code) AS distinct_ids FROM v_security
WHERE (name, exchange_code, type) IN (SELECT (name, exchange_code, type) FROM v_security
                                      GROUP BY ALL HAVING count(*) > 1)""", "v_security"))
def q_violation_report(spark, sf_dir):
    s = v_security(spark, sf_dir)
    _valid, viol = Q.check_unique(s, ["name", "exchange_code", "type"])
    return Q.violation_report(s, viol, ["code"])


@register("check_single_value", with_views("""
SELECT count(DISTINCT exchange_code) AS n_values, count(DISTINCT exchange_code) <= 1 AS ok FROM v_quote""",
                                           "v_quote"))
def q_check_single_value(spark, sf_dir):
    return Q.check_single_value(v_quote(spark, sf_dir), "exchange_code")


@register("check_result_size", with_views("""
SELECT batch_id, count(*) AS n_requests, count(*) FILTER (WHERE id % 3 = 0 OR id % 4 = 0) AS n_responses,
       count(*) = count(*) FILTER (WHERE id % 3 = 0 OR id % 4 = 0) AS ok
FROM (SELECT id, CAST((row_number() OVER (ORDER BY code) - 1) // 60 AS BIGINT) AS batch_id FROM v_security)
GROUP BY batch_id""", "v_security"))
def q_check_result_size(spark, sf_dir):
    req = A.slice_batches(v_security(spark, sf_dir).select("code", "id"), 60, ["code"])
    resp = req.where((F.col("id") % 3 == 0) | (F.col("id") % 4 == 0))
    return Q.check_result_size(req, resp)


# ------------------------------------------------------------------ 2.2

_QCOLS = "security_code, exchange_code, date, open, high, low, close, adjusted_close, volume"
_HALF = "DATE '2001-01-01'"
_FROM = "DATE '2000-07-01'"


def _halves(spark, d):
    q = v_quote(spark, d)
    target = q.where(F.col("date") < F.lit(_dt.date(2001, 1, 1)))
    source = q.where(F.col("date") >= F.lit(_dt.date(2000, 7, 1))).withColumn("close", F.col("close") * 2)
    return target, source


_KEYS = ["date", "security_code", "exchange_code"]


@register("merge_insert_new", with_views(f"""
SELECT {_QCOLS} FROM v_quote WHERE date < {_HALF}
UNION ALL
SELECT security_code, exchange_code, date, open, high, low, close * 2, adjusted_close, volume
FROM v_quote WHERE date >= {_HALF}""", "v_quote"))
def q_merge_insert_new(spark, sf_dir):
    target, source = _halves(spark, sf_dir)
    return M.merge_insert_new(target, source, _KEYS)


@register("insert_ignore", with_views(f"""
SELECT {_QCOLS} FROM v_quote WHERE date < {_HALF}
UNION ALL
SELECT security_code, exchange_code, date, open, high, low, close * 2, adjusted_close, volume
FROM v_quote WHERE date >= {_HALF}""", "v_quote"))
def q_insert_ignore(spark, sf_dir):
    target, source = _halves(spark, sf_dir)
    dup = source.withColumn("close", F.col("close") * 3)     # same keys, larger close
    return M.insert_ignore(target, source.unionByName(dup), _KEYS, order=[F.col("close")])


def _exchange_updates(spark, d):
    n = table(spark, d, "nation")
    k = F.col("n_nationkey").cast("bigint")
    upd = n.where(k % 2 == 0).select((k + 100).alias("id"), F.lower("n_name").alias("name"),
                                     F.lit(None).cast("bigint").alias("operating_exchange_id"),
                                     F.col("n_name").alias("mic"))
    new = n.where(k % 5 == 0).select((k + 200).alias("id"), F.concat(F.lit("new "), F.col("n_name")).alias("name"),
                                     F.lit(7).cast("bigint").alias("operating_exchange_id"),
                                     F.concat(F.lit("N"), F.col("n_name")).alias("mic"))
    return upd.unionByName(new)


_EX_UPD_SQL = {
    "src": "SELECT CAST(n_nationkey AS BIGINT) + 100 AS id, lower(n_name) AS name, "
           "CAST(NULL AS BIGINT) AS operating_exchange_id, n_name AS mic FROM nation WHERE n_nationkey % 2 = 0 "
           "UNION ALL SELECT CAST(n_nationkey AS BIGINT) + 200, 'new ' || n_name, CAST(7 AS BIGINT), 'N' || n_name "
           "FROM nation WHERE n_nationkey % 5 = 0",
}


@register("upsert_columns", with_views("""
SELECT COALESCE(t.id, s.id) AS id,
       CASE WHEN t.id IS NOT NULL AND s.id IS NOT NULL THEN 'UPDATED' WHEN t.id IS NULL THEN s.mic ELSE t.mic END AS mic,
       CASE WHEN s.id IS NOT NULL THEN s.name ELSE t.name END AS name,
       CASE WHEN s.id IS NOT NULL THEN s.operating_exchange_id ELSE t.operating_exchange_id END AS operating_exchange_id
FROM v_exchange t FULL OUTER JOIN src s ON t.id = s.id""", "v_exchange", extra=_EX_UPD_SQL))
def q_upsert_columns(spark, sf_dir):
    return M.upsert_columns(v_exchange(spark, sf_dir), _exchange_updates(spark, sf_dir), ["id"],
                            set_from_source=["name", "operating_exchange_id"], set_const={"mic": "UPDATED"})


def _exchange_folders(spark, sf_dir):
    """The exchanges in folders of their operator, which an upsert changes."""
    path = scratch_path(spark, "exchange")
    WR.write_partitioned(v_exchange(spark, sf_dir), path, ["operating_exchange_id"])
    return path


@register("upsert_partitions", with_views("""
SELECT COALESCE(t.id, s.id) AS id, COALESCE(t.mic, s.mic) AS mic, CASE WHEN s.id IS NOT NULL THEN s.name ELSE t.name END AS name,
       CASE WHEN s.id IS NOT NULL THEN s.operating_exchange_id ELSE t.operating_exchange_id END AS operating_exchange_id
FROM v_exchange t FULL OUTER JOIN src s ON t.id = s.id""", "v_exchange", extra=_EX_UPD_SQL))
def q_upsert_partitions(spark, sf_dir):
    """Only folders that an updated exchange leaves or enters are written."""
    path = _exchange_folders(spark, sf_dir)
    P.change_partitions(path, _exchange_updates(spark, sf_dir), ["id"],
                        lambda t, s: M.upsert_columns(t, s, ["id"], set_from_source=["name", "operating_exchange_id"]))
    return spark.read.parquet(path).select("id", "mic", "name", F.col("operating_exchange_id").cast("bigint").alias("operating_exchange_id"))


@register("bulk_upsert_table", with_views("""
SELECT COALESCE(t.id, s.id) AS id, COALESCE(t.mic, s.mic) AS mic, CASE WHEN s.id IS NOT NULL THEN s.name ELSE t.name END AS name,
       CASE WHEN s.id IS NOT NULL THEN s.operating_exchange_id ELSE t.operating_exchange_id END AS operating_exchange_id
FROM v_exchange t FULL OUTER JOIN src s ON t.id = s.id""", "v_exchange", extra=_EX_UPD_SQL))
def q_bulk_upsert_table(spark, sf_dir):
    """The table that ``bulk_upsert`` returns beside its counts."""
    return M.bulk_upsert(v_exchange(spark, sf_dir), _exchange_updates(spark, sf_dir), ["id"], ["name", "operating_exchange_id"])[0]


def _quote_folders(spark, q):
    path = scratch_path(spark, "quotes")
    WR.write_partitioned(q.withColumn("year", F.year("date")), path, ["exchange_code", "year"])
    return path


_QUOTE_LAYOUT = ["exchange_code", "year"]


@register("bulk_upsert_partitions", with_views(f"""
SELECT security_code, exchange_code, date, open, high, low, CASE WHEN exchange_code = 'F' AND date >= DATE '1994-07-01' THEN close * 2 ELSE close END AS close,
       adjusted_close, volume, CAST(year(date) AS INTEGER) AS year FROM v_quote
WHERE date < DATE '1995-03-01' OR exchange_code = 'F'""", "v_quote"))
def q_bulk_upsert_partitions(spark, sf_dir):
    """Corrections from July 1994 on and new quotes of one exchange: its years
    from 1994 on are written, all other folders keep their files."""
    q = v_quote(spark, sf_dir)
    path = _quote_folders(spark, q.where(F.col("date") < F.lit(_dt.date(1995, 3, 1))))
    source = q.where((F.col("exchange_code") == "F") & (F.col("date") >= F.lit(_dt.date(1994, 7, 1)))).withColumn("close", F.col("close") * 2).withColumn("year", F.year("date"))
    P.change_partitions(path, source, _KEYS, lambda t, s: M.upsert_columns(t, s, _KEYS, set_from_source=["close"]), _QUOTE_LAYOUT, key_fixes_partition=True)
    return spark.read.parquet(path).select(*_QCOLS.split(", "), "year")


@register("bulk_update_partitions", with_views(f"""
SELECT {_SEC.replace("name,", "CASE WHEN id % 1000 = 7 THEN upper(name) ELSE name END AS name,")} FROM v_security""", "v_security"))
def q_bulk_update_partitions(spark, sf_dir):
    """The key does not say where a security lies: its folders are looked up."""
    s = v_security(spark, sf_dir)
    path = scratch_path(spark, "securities")
    WR.write_partitioned(s, path, ["exchange_code"])
    upd = s.where(F.col("id") % 1000 == 7).select("code", F.upper("name").alias("name"))
    P.change_partitions(path, upd, ["code"], lambda t, u: M.bulk_update_by_key(t, u, "code", ["name"]))
    return spark.read.parquet(path).select(*_SEC.split(", "))


@register("insert_ignore_append", with_views(f"""
SELECT {_QCOLS}, CAST(year(date) AS INTEGER) AS year FROM v_quote WHERE date < {_HALF}
UNION ALL
SELECT security_code, exchange_code, date, open, high, low, close * 2, adjusted_close, volume, CAST(year(date) AS INTEGER)
FROM v_quote WHERE date >= {_HALF}""", "v_quote"))
def q_insert_ignore_append(spark, sf_dir):
    """New keys are appended in the table's layout; nothing is rewritten."""
    target, source = _halves(spark, sf_dir)
    path = _quote_folders(spark, target)
    dup = source.withColumn("close", F.col("close") * 3)
    P.append_new(path, source.unionByName(dup).withColumn("year", F.year("date")), _KEYS, _QUOTE_LAYOUT, key_fixes_partition=True)
    return spark.read.parquet(path).select(*_QCOLS.split(", "), "year")


@register("bulk_upsert", with_views("""
SELECT count(*) AS affected, count(t.id) AS updated, count(*) - count(t.id) AS inserted
FROM (SELECT DISTINCT id FROM src) s LEFT JOIN (SELECT DISTINCT id FROM v_exchange) t ON s.id = t.id""",
                                    "v_exchange", extra=_EX_UPD_SQL))
def q_bulk_upsert(spark, sf_dir):
    _table, counts = M.bulk_upsert(v_exchange(spark, sf_dir), _exchange_updates(spark, sf_dir), ["id"],
                                   ["name", "operating_exchange_id"])
    return counts


@register("bulk_update_by_key", with_views(f"""
SELECT code, CASE WHEN id % 7 = 0 THEN upper(name) ELSE name END AS name, type, exchange_code, isin,
       CASE WHEN id % 7 = 0 THEN NULL ELSE currency END AS currency, id, size FROM v_security""", "v_security"))
def q_bulk_update_by_key(spark, sf_dir):
    s = v_security(spark, sf_dir)
    upd = s.where(F.col("id") % 7 == 0).select("code", F.upper("name").alias("name"),
                                               F.lit(None).cast("string").alias("currency"))
    return M.bulk_update_by_key(s, upd, "code", ["name", "currency"])


_SNAP_AS_OF = _dt.datetime(2024, 1, 31)
_T0 = _dt.datetime(2020, 1, 1)


def _entity_current(spark, d):
    e = v_entity(spark, d)
    t0 = ntz_lit(_T0)
    return e.where(F.col("id") % 3 != 0).select(
        "id", "name", "legal_address_country", "status", F.lit(True).alias("is_active"), t0.alias("active_from"),
        F.lit(None).cast("timestamp_ntz").alias("active_until"), t0.alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"))


@register("snapshot_refresh", with_views("""
SELECT COALESCE(c.id, s.id) AS id,
       CASE WHEN s.id IS NULL THEN c.name ELSE s.name END AS name,
       CASE WHEN s.id IS NULL THEN c.legal_address_country ELSE s.legal_address_country END AS legal_address_country,
       CASE WHEN s.id IS NULL THEN c.status ELSE s.status END AS status,
       s.id IS NOT NULL AS is_active,
       CASE WHEN c.id IS NULL THEN TIMESTAMP '2024-01-31 00:00:00' ELSE TIMESTAMP '2020-01-01 00:00:00' END AS active_from,
       CASE WHEN s.id IS NULL THEN TIMESTAMP '2024-01-31 00:00:00' END AS active_until,
       CASE WHEN c.id IS NULL THEN TIMESTAMP '2024-01-31 00:00:00' ELSE TIMESTAMP '2020-01-01 00:00:00' END AS created_at,
       CASE WHEN c.id IS NULL THEN NULL ELSE TIMESTAMP '2024-01-31 00:00:00' END AS updated_at
FROM (SELECT * FROM v_entity WHERE id % 3 <> 0) c
FULL OUTER JOIN (SELECT id, name, legal_address_country, lower(status) AS status FROM v_entity WHERE id % 3 <> 1) s
  ON c.id = s.id""", "v_entity"))
def q_snapshot_refresh(spark, sf_dir):
    e = v_entity(spark, sf_dir)
    snap = e.where(F.col("id") % 3 != 1).select("id", "name", "legal_address_country",
                                                F.lower("status").alias("status"))
    return M.snapshot_refresh(_entity_current(spark, sf_dir), snap, ["id"], _SNAP_AS_OF,
                              ["name", "legal_address_country", "status"])


@register("snapshot_refresh_scope", with_views("""
SELECT COALESCE(c.id, s.id) AS id, COALESCE(s.name, c.name) AS name, COALESCE(s.status, c.status) AS status,
       c.id IS NULL OR s.id IS NOT NULL OR NOT c.scope AS is_active,
       CASE WHEN c.id IS NULL THEN TIMESTAMP '2024-01-31 00:00:00' ELSE TIMESTAMP '2020-01-01 00:00:00' END AS active_from,
       CASE WHEN c.scope AND s.id IS NULL THEN TIMESTAMP '2024-01-31 00:00:00' END AS active_until,
       CASE WHEN c.id IS NULL THEN TIMESTAMP '2024-01-31 00:00:00' ELSE TIMESTAMP '2020-01-01 00:00:00' END AS created_at,
       CASE WHEN c.scope THEN TIMESTAMP '2024-01-31 00:00:00' END AS updated_at,
       COALESCE(c.legal_address_country, s.legal_address_country) AS legal_address_country
FROM (SELECT *, legal_address_country IN ('FRANCE', 'JAPAN') AS scope FROM v_entity WHERE id % 3 <> 0) c
FULL OUTER JOIN (SELECT id, name, legal_address_country, lower(status) AS status FROM v_entity
                 WHERE id % 3 <> 1 AND legal_address_country IN ('FRANCE', 'JAPAN')) s ON c.id = s.id""", "v_entity"))
def q_snapshot_refresh_scope(spark, sf_dir):
    """A snapshot of two countries refreshes their folders only."""
    path = scratch_path(spark, "entities")
    WR.write_partitioned(_entity_current(spark, sf_dir), path, ["legal_address_country"])
    e = v_entity(spark, sf_dir)
    snap = e.where((F.col("id") % 3 != 1) & F.col("legal_address_country").isin("FRANCE", "JAPAN")).select(
        "id", "name", "legal_address_country", F.lower("status").alias("status"))
    P.change_partitions(path, snap, ["id"], lambda t, s: M.snapshot_refresh(t, s, ["id"], _SNAP_AS_OF, ["name", "legal_address_country", "status"]),
                        key_fixes_partition=True)
    return spark.read.parquet(path)


_STAMP = _dt.datetime(2024, 1, 31, 6, 0)


@register("overwrite_table", with_views(f"""
SELECT {_SEC}, TIMESTAMP '2024-01-31 06:00:00' AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
FROM v_security WHERE size > 20""", "v_security"))
def q_overwrite_table(spark, sf_dir):
    s = v_security(spark, sf_dir)
    path = scratch_path(spark, "overwrite")
    WR.overwrite_table(WR.stamp_overwrite(s, _STAMP), path)
    WR.overwrite_table(WR.stamp_overwrite(s.where(F.col("size") > 20), _STAMP), path)   # replaces all
    return spark.read.parquet(path).select(*_SEC.split(", "), "created_at", "updated_at")


@register("overwrite_table_dynamic", with_views(f"""
SELECT {_SEC} FROM v_security WHERE exchange_code <> 'Brand#1'
UNION ALL
SELECT code, upper(name), type, exchange_code, isin, currency, id, size FROM v_security
WHERE exchange_code = 'Brand#1' AND size > 10""", "v_security"))
def q_overwrite_table_dynamic(spark, sf_dir):
    s = v_security(spark, sf_dir)
    path = scratch_path(spark, "overwrite-dyn")
    WR.overwrite_table(s, path, ["exchange_code"])
    b1 = s.where((F.col("exchange_code") == "Brand#1") & (F.col("size") > 10)).withColumn("name", F.upper("name"))
    WR.overwrite_table(b1, path, ["exchange_code"], mode="dynamic")   # only Brand#1 is replaced
    return spark.read.parquet(path).select(*_SEC.split(", "))


@register("append_table", with_views(f"SELECT {_QCOLS} FROM v_quote", "v_quote"))
def q_append_table(spark, sf_dir):
    q = v_quote(spark, sf_dir)
    path = scratch_path(spark, "append")
    cut = F.lit(_dt.date(1998, 1, 1))
    WR.append_table(q.where(F.col("date") < cut), path)
    WR.append_table(q.where(F.col("date") >= cut), path)
    return spark.read.parquet(path)


@register("write_partitioned", with_views(f"""
SELECT {_QCOLS}, CAST(year(date) AS INTEGER) AS year FROM v_quote""", "v_quote"))
def q_write_partitioned(spark, sf_dir):
    q = v_quote(spark, sf_dir).withColumn("year", F.year("date"))
    path = scratch_path(spark, "partitioned")
    WR.write_partitioned(q, path, ["exchange_code", "year"])
    return spark.read.parquet(path).select(*_QCOLS.split(", "), "year")


@register("scan_partition", with_views(f"""
SELECT {_QCOLS} FROM v_quote WHERE exchange_code = 'F' AND year(date) = 1999""", "v_quote"))
def q_scan_partition(spark, sf_dir):
    q = v_quote(spark, sf_dir).withColumn("year", F.year("date"))
    path = scratch_path(spark, "partitioned")
    WR.write_partitioned(q, path, ["exchange_code", "year"])
    t = spark.read.parquet(path)
    return R.scan_partition(R.scan_partition(t, "exchange_code", "F"), "year", 1999).select(*_QCOLS.split(", "))


@register("write_sized_files", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem""")
def q_write_sized_files(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_quantity")
    path = scratch_path(spark, "sized")
    WR.write_sized_files(li, path, max_rows_per_file=5000, row_group_bytes=1024 * 1024)
    return spark.read.parquet(path)


_SEC_SCHEMA = T.StructType([T.StructField("code", T.StringType()), T.StructField("name", T.StringType()),
                            T.StructField("type", T.StringType()), T.StructField("exchange_code", T.StringType()),
                            T.StructField("isin", T.StringType()), T.StructField("id", T.LongType()),
                            T.StructField("size", T.IntegerType())])
_SEC5 = "code, name, type, exchange_code, isin, id, size"


@register("write_format", with_views(f"SELECT {_SEC5}, 'csv' AS fmt FROM v_security UNION ALL "
                                     f"SELECT {_SEC5}, 'json' FROM v_security", "v_security"))
def q_write_format(spark, sf_dir):
    s = v_security(spark, sf_dir).select(*_SEC5.split(", "))
    out = None
    for fmt in ("csv", "json"):
        path = scratch_path(spark, f"fmt-{fmt}")
        WR.write_format(s, path, fmt)
        r = spark.read.schema(_SEC_SCHEMA)
        r = r.option("header", True).csv(path) if fmt == "csv" else r.json(path)
        r = r.withColumn("fmt", F.lit(fmt))
        out = r if out is None else out.unionByName(r)
    return out


_Q_SCHEMA = T.StructType([
    T.StructField("security_code", T.StringType()), T.StructField("exchange_code", T.StringType()),
    T.StructField("date", T.DateType()), *[T.StructField(c, T.DoubleType()) for c in
                                          ["open", "high", "low", "close", "adjusted_close"]],
    T.StructField("volume", T.LongType())])


@register("read_csv_typed", with_views(f"SELECT {_QCOLS} FROM v_quote", "v_quote"))
def q_read_csv_typed(spark, sf_dir):
    path = scratch_path(spark, "csv-typed")
    WR.write_format(v_quote(spark, sf_dir).select(*_QCOLS.split(", ")), path, "csv")
    return R.read_csv_typed(spark, path, _Q_SCHEMA)


@register("read_csv_inferred", with_views("""
SELECT code, name, type, exchange_code, CASE WHEN id % 2 = 0 THEN isin END AS isin,
       CAST(NULL AS VARCHAR) AS country FROM v_security""", "v_security"))
def q_read_csv_inferred(spark, sf_dir):
    s = v_security(spark, sf_dir)
    a, b = scratch_path(spark, "csv-a"), scratch_path(spark, "csv-b")
    WR.write_format(s.where(F.col("id") % 2 == 0).select("code", "name", "type", "exchange_code", "isin"), a, "csv")
    WR.write_format(s.where(F.col("id") % 2 == 1).select("exchange_code", "code", "type", "name"), b, "csv")
    return R.read_csv_inferred(spark, [a, b], required=["isin", "country"]).select(
        "code", "name", "type", "exchange_code", "isin", "country")


@register("read_csv_layouts", with_views("""
SELECT code, name, type, CASE WHEN id % 2 = 0 THEN isin END AS isin FROM v_security""", "v_security"))
def q_read_csv_layouts(spark, sf_dir):
    """Many files of two layouts: two scans."""
    s = v_security(spark, sf_dir)
    paths = [scratch_path(spark, f"csv-{k}") for k in range(6)]
    for k, path in enumerate(paths):
        some = s.where(F.col("id") % 6 == k)
        WR.write_format(some.select("code", "name", "type", "isin") if k % 2 == 0 else some.select("type", "code", "name"), path, "csv")
    return R.read_csv_inferred(spark, paths, required=["isin"]).select("code", "name", "type", "isin")


@register("read_csv_encoded", """
SELECT c_custkey AS id, c_name || ' Soci' || chr(233) || 't' || chr(233) AS name FROM customer""")
def q_read_csv_encoded(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"),
                                                F.concat("c_name", F.lit(" Société")).alias("name"))
    path = scratch_path(spark, "latin1")
    c.write.mode("overwrite").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return R.read_csv_encoded(spark, path, "ISO-8859-1", schema="id bigint, name string")


_EX_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("mic", T.StringType()),
                           T.StructField("name", T.StringType()),
                           T.StructField("operating_exchange_id", T.LongType())])


@register("read_json_records", with_views("SELECT id, mic, name, operating_exchange_id FROM v_exchange",
                                          "v_exchange"))
def q_read_json_records(spark, sf_dir):
    path = scratch_path(spark, "json-arrays")
    WR.write_json_arrays(v_exchange(spark, sf_dir), path, rows_per_file=10, key="id")
    return R.read_json_records(spark, path, _EX_SCHEMA)


_DOC_SCHEMA = T.StructType([T.StructField("Code", T.StringType()), T.StructField("Name", T.StringType()),
                            T.StructField("Region", T.LongType())])


@register("read_json_documents", """
SELECT n_name AS Code, lower(n_name) AS Name, CAST(n_regionkey AS BIGINT) AS Region FROM nation
WHERE n_nationkey <> 24""")
def q_read_json_documents(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    text = F.to_json(F.struct(F.col("n_name").alias("Code"), F.lower("n_name").alias("Name"),
                              F.col("n_regionkey").cast("bigint").alias("Region")))
    # one malformed document (cut short) lands in the reject frame
    text = F.when(F.col("n_nationkey") == 24, F.substring(text, 1, 10)).otherwise(text)
    path = scratch_path(spark, "docs")
    WR.write_documents(n.select(F.col("n_name").alias("doc"), text.alias("text")), path, "doc", "text")
    ok, _rejects = R.read_json_documents(spark, f"{path}/doc=*/*.txt", _DOC_SCHEMA, required="Code")
    return ok.select("doc.Code", "doc.Name", "doc.Region")


@register("read_parquet_dir", """
SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem""")
def q_read_parquet_dir(spark, sf_dir):
    return R.read_parquet_dir(spark, [f"{sf_dir}/line*.parquet"]).select("l_orderkey", "l_partkey", "l_shipdate")


@register("read_hive_partitioned", with_views("""
SELECT code, name, exchange_code, lpad(CAST(id % 10 AS VARCHAR), 3, '0') AS bucket FROM v_security""",
                                              "v_security"))
def q_read_hive_partitioned(spark, sf_dir):
    s = v_security(spark, sf_dir).select("code", "name", "exchange_code",
                                         F.lpad((F.col("id") % 10).cast("string"), 3, "0").alias("bucket"))
    path = scratch_path(spark, "hive")
    WR.write_partitioned(s, path, ["exchange_code", "bucket"])
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("name", T.StringType()),
                           T.StructField("exchange_code", T.StringType()), T.StructField("bucket", T.StringType())])
    return R.read_hive_partitioned(spark, path, schema)


@register("scan_table", """
SELECT l_orderkey, l_extendedprice, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '2001-01-01 00:00:00' AND l_returnflag = 'R'""")
def q_scan_table(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    pred = (F.col("l_shipdate") >= ntz_lit(_dt.datetime(2001, 1, 1))) & (F.col("l_returnflag") == "R")
    return R.scan_table(li, pred, ["l_orderkey", "l_extendedprice", "l_shipdate"])


@register("read_zip_csv", with_views("SELECT code, name, type, exchange_code, isin FROM v_security", "v_security"))
def q_read_zip_csv(spark, sf_dir):
    cols = ["code", "name", "type", "exchange_code", "isin"]
    folder = scratch_path(spark, "zip")
    R.write_zip_csv(v_security(spark, sf_dir), folder, cols, rows_per_archive=500).collect()  # small manifest
    rows = R.read_zip_csv(spark, folder, cols)
    return rows.select(*cols).withColumn("isin", F.nullif(F.col("isin"), F.lit("")))


@register("read_mapping", with_views("""
SELECT product, source, field, source_value, mapping_value, is_active FROM v_mapping
WHERE product = 'security' AND field = 'exchange_code' AND is_active""", "v_mapping"))
def q_read_mapping(spark, sf_dir):
    return R.read_mapping(v_mapping(spark, sf_dir), product="security", field="exchange_code")


@register("read_table_batches", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def q_read_table_batches(spark, sf_dir):
    return R.read_table_batches(table(spark, sf_dir, "orders"), scratch_path(spark, "unload"), rows_per_file=4000)


_MAP_CSV_SCHEMA = T.StructType([
    T.StructField("product", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("field", T.StringType()), T.StructField("source_value", T.StringType()),
    T.StructField("mapping_value", T.StringType()), T.StructField("is_active", T.BooleanType())])


@register("seed_mapping", with_views("""
SELECT product, source, field, source_value, mapping_value, is_active FROM v_mapping""", "v_mapping"))
def q_seed_mapping(spark, sf_dir):
    m = v_mapping(spark, sf_dir)
    csv_path, tbl = scratch_path(spark, "seed-csv"), scratch_path(spark, "mapping")
    WR.write_format(m.select(*_MAP_CSV_SCHEMA.fieldNames()), csv_path, "csv")
    seed = R.read_csv_typed(spark, csv_path, _MAP_CSV_SCHEMA)
    # by name into the table layout (partition columns last), never positional
    WR.overwrite_table(seed.select("field", "source_value", "mapping_value", "is_active", "product", "source"),
                       tbl, ["product", "source"])
    return spark.read.parquet(tbl).select(*_MAP_CSV_SCHEMA.fieldNames())


@register("create_curated_tables", with_views("""
SELECT code, name, isin, CAST(NULL AS VARCHAR) AS country, currency, type, exchange_code FROM v_security""",
                                              "v_security"))
def q_create_curated_tables(spark, sf_dir):
    import uuid
    db = f"curated_{uuid.uuid4().hex[:8]}"
    WR.create_curated_tables(spark, scratch_path(spark, "curated"), db)
    s = v_security(spark, sf_dir).select("code", "name", "isin", F.lit(None).cast("string").alias("country"),
                                         "currency", "type", "exchange_code")
    WR.insert_by_name(s, f"{db}.security", overwrite=True)
    return spark.table(f"{db}.security").select("code", "name", "isin", "country", "currency", "type",
                                                "exchange_code")


@register("anti_join_missing_figi", with_views("""
SELECT code, isin FROM v_security s WHERE NOT EXISTS (SELECT 1 FROM v_figi f WHERE f.isin_source = s.isin)""",
                                               "v_security", "v_figi"))
def q_anti_join_missing_figi(spark, sf_dir):
    s = v_security(spark, sf_dir).select("code", "isin")
    f = v_figi(spark, sf_dir).where(F.col("isin_source").isNotNull()).select(F.col("isin_source").alias("isin"))
    return L.anti_join_missing(s, f, s.isin == f.isin)
