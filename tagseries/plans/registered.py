"""Collection of registered queries with their DuckDB counterparts, and shared SQL views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query and, where SQL can say the same, its counterpart."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def sql_uuid(expr: str) -> str:
    h = f"md5({expr})"
    return (
        f"concat(substr({h},1,8),'-',substr({h},9,4),'-3',substr({h},14,3),'-',"
        f"substr('89ab89ab89ab89ab',instr('0123456789abcdef',substr({h},17,1)),1),substr({h},18,3),'-',substr({h},21,12))"
    )


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

POINTS = f"""points AS (
  SELECT concat('histprov:h:/sys:gw:/prov:default:/tag:', event_type, '/u', user_id) AS qpath,
         concat('Plant/default/', event_type, '/u', user_id) AS series_name,
         concat('Plant/type/', event_type) AS type_series,
         epoch_us(ts) // 1000 AS ts_ms, value AS value_num, {K} AS k, event_type, user_id, event_id AS seq,
         CASE WHEN {K} < 10 THEN 0 WHEN {K} < 25 THEN 64 ELSE 192 END AS quality_code,
         CASE WHEN {K} < 10 THEN 'Bad' WHEN {K} < 25 THEN 'Uncertain' ELSE 'Good' END AS status
  FROM events)"""

SHIP = """ship AS (
  SELECT concat('Plant/ship/s', l_suppkey) AS series_name,
         concat('Plant/line/', l_returnflag, l_linestatus) AS line_series,
         epoch_us(l_shipdate) // 1000 AS ts_ms, l_extendedprice AS value_num,
         ((l_orderkey * 16 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS seq
  FROM lineitem)"""

MEASUREMENTS = f"""series AS (
  SELECT event_type, user_id, min(ts) AS created_at, max(ts) AS updated_at, arg_max({K}, event_id) AS last_k
  FROM events GROUP BY ALL),
measurements AS (
  SELECT concat('Plant/default/', event_type, '/u', user_id) AS name,
         {sql_uuid("concat('Plant/default/', event_type, '/u', user_id)")} AS uuid,
         CASE WHEN c_acctbal < 0 THEN 'deleted' WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Active'
              ELSE 'active' END AS status,
         'number' AS datatype, concat('db_', lower(c_mktsegment)) AS database,
         concat('collector-', c_nationkey) AS collector_uuid, c_mktsegment, event_type, user_id,
         CASE WHEN last_k < 10 THEN 'Bad' WHEN last_k < 25 THEN 'Uncertain' ELSE 'Good' END AS quality,
         created_at, updated_at
  FROM series JOIN customer ON user_id = c_custkey),
active AS (SELECT * FROM measurements WHERE lower(status) = 'active')"""

ASSETS = """assets AS (
  SELECT concat('r', r_regionkey) AS uuid, r_name AS name, CAST(NULL AS VARCHAR) AS parent_uuid FROM region
  UNION ALL
  SELECT concat('n', n_nationkey), concat(r_name, '/', n_name), concat('r', r_regionkey)
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT concat('s', s_suppkey), concat(r_name, '/', n_name, '/', s_name), concat('n', n_nationkey)
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

PROPERTIES = f"""props AS (
  SELECT concat('p', s_suppkey, '-', t) AS uuid, concat('s', s_suppkey) AS asset_uuid,
         concat('Plant/default/', t, '/u', s_suppkey) AS series_name,
         {sql_uuid("concat('Plant/default/', t, '/u', s_suppkey)")} AS measurement_uuid, t AS name, 'number' AS datatype
  FROM supplier, (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) AS v(t))"""
