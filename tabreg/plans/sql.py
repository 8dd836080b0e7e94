"""SQL fragments shared by the DuckDB oracles (mirror of ``plans.data``)."""

from tabreg.functions.hashing import hash_bucket_sql

ORDERS_PROFILED = """op AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderpriority,
         CASE WHEN o_totalprice < 400000.0 THEN 'lo' ELSE 'hi' END AS price_flag,
         CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS priority_null,
         CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price_if_f
  FROM orders)"""

ORDERS_CUSTOMERS = """oc AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, c_acctbal, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

LINEITEM_NET = """li AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS net
  FROM lineitem)"""

PREDICTORS = LINEITEM_NET + """,
pc AS (
  SELECT l_orderkey, l_linenumber, net AS label, l_extendedprice AS p_a,
         l_extendedprice * (1 - l_discount) AS p_b, l_extendedprice * (1 + l_tax) AS p_c
  FROM li)"""


def bucket(key_sql: str, n: int = 100, salt: str = "") -> str:
    return hash_bucket_sql(key_sql, n, salt)


def is_test(key_sql: str, salt: str = "", pct: int = 20) -> str:
    return f"({bucket(key_sql, 100, salt)} < {pct})"
