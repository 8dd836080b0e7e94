"""Shared inputs of the registered queries, all derived from the given tables.

Nulls and dominant values do not occur in the driver tables, so the
queries inject them with expressions that the SQL oracles repeat exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.sources.tables import read_table

# Fixed values used by queries and oracles alike.
PRIORITY_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]  # '5-LOW' unseen -> -1
PRICE_FLAG_LIMIT = 400000.0


def orders_customers(spark: SparkSession, sf: str) -> DataFrame:
    """``orders`` joined to ``customer``: only the needed columns are scanned."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                         "o_totalprice", "o_orderpriority"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_acctbal", "c_mktsegment"])
    return o.join(c, o.o_custkey == c.c_custkey).drop("o_custkey", "c_custkey")


def orders_profiled(spark: SparkSession, sf: str) -> DataFrame:
    """``orders`` with an injected null code and a dominant derived flag."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice",
                                         "o_orderpriority"])
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        "o_orderpriority",
        F.when(F.col("o_totalprice") < PRICE_FLAG_LIMIT, "lo").otherwise("hi").alias("price_flag"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority"))
        .alias("priority_null"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("price_if_f"),
    )


def lineitem_net(spark: SparkSession, sf: str) -> DataFrame:
    """``lineitem`` with the regression target ``net`` and predictor columns."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity",
                                            "l_extendedprice", "l_discount", "l_tax"])
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")))
        .alias("net"),
    )


def predictor_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Deterministic 'model predictions' on lineitem (exactly checkable)."""
    li = lineitem_net(spark, sf)
    return li.select(
        "l_orderkey", "l_linenumber",
        F.col("net").alias("label"),
        F.col("l_extendedprice").alias("p_a"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("p_b"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("p_c"),
    )
