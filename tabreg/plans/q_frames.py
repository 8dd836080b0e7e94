"""Registered queries: projections, keys, previews, keyed combination and
dictionary lookups (P1-P12, J1-J4, S2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabreg.operators import frames as J
from tabreg.operators import profile as P
from tabreg.plans.data import orders_profiled, predictor_columns
from tabreg.plans.sql import ORDERS_PROFILED, PREDICTORS
from tabreg.sources.tables import read_table

QUERIES = {}
ORACLES = {}

ORDER_COLS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]

# A small data dictionary for two order code columns; '5-LOW'
# and 'P' are deliberately absent (out-of-domain codes).
DICTIONARY = [
    ("o_orderpriority", "1-URGENT", "Urgent"),
    ("o_orderpriority", "2-HIGH", "High"),
    ("o_orderpriority", "3-MEDIUM", "Medium"),
    ("o_orderpriority", "4-NOT SPECIFIED ", "Not specified"),
    ("o_orderstatus", "F", "Fulfilled"),
    ("o_orderstatus", "O", "Open"),
]


def q(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _orders(spark, sf):
    return read_table(spark, sf, "orders", ORDER_COLS)


@q("project_drop_rename")
def project_drop_rename(spark, sf):
    df = J.select_group(_orders(spark, sf), ORDER_COLS)
    df = J.drop_columns(df, ["o_orderpriority"])
    return J.rename_all(df, ["key", "status", "price"])


ORACLES["project_drop_rename"] = """
SELECT o_orderkey AS "key", o_orderstatus AS status, o_totalprice AS price FROM orders"""


@q("single_column")
def single_column(spark, sf):
    return J.select_group(_orders(spark, sf), ["o_totalprice"])


ORACLES["single_column"] = "SELECT o_totalprice FROM orders"


@q("features_and_label")
def features_and_label(spark, sf):
    df = J.with_derived(_orders(spark, sf), {
        "price_k": F.col("o_totalprice") / 1000.0,
        "is_urgent": F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).otherwise(0.0)})
    out = J.features_and_label(df, ["price_k", "is_urgent"], "o_totalprice", ["o_orderkey"])
    return out.select("o_orderkey", F.round("price_k", 9).alias("price_k"), "is_urgent", "label")


ORACLES["features_and_label"] = """
SELECT o_orderkey, round(o_totalprice / 1000.0, 9) AS price_k,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_urgent,
       CAST(o_totalprice AS DOUBLE) AS label FROM orders"""


@q("stable_row_key")
def stable_row_key(spark, sf):
    return J.with_row_key(_orders(spark, sf).select("o_orderkey"), ["o_orderkey"])


ORACLES["stable_row_key"] = "SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS row_key FROM orders"


@q("preview_head")
def preview_head(spark, sf):
    return P.preview_head(_orders(spark, sf), ["o_orderkey"], 5)


ORACLES["preview_head"] = f"SELECT {', '.join(ORDER_COLS)} FROM orders ORDER BY o_orderkey LIMIT 5"


@q("shape_and_columns")
def shape_and_columns(spark, sf):
    return P.shape(read_table(spark, sf, "orders"))


ORACLES["shape_and_columns"] = "SELECT count(*) AS n_rows, 6 AS n_cols FROM orders"


@q("drop_nulls_one_column")
def drop_nulls_one_column(spark, sf):
    return P.drop_nulls(orders_profiled(spark, sf), "priority_null").select(
        "o_orderkey", "priority_null")


ORACLES["drop_nulls_one_column"] = f"""
WITH {ORDERS_PROFILED} SELECT o_orderkey, priority_null FROM op WHERE priority_null IS NOT NULL"""


@q("prediction_table")
def prediction_table(spark, sf):
    df = predictor_columns(spark, sf)
    out = J.prediction_table(df, ["l_orderkey", "l_linenumber"],
                             {"model_a": "p_a", "model_b": "p_b", "model_c": "p_c"})
    return out.select("l_orderkey", "l_linenumber",
                      *[F.round(c, 6).alias(c) for c in ["model_a", "model_b", "model_c"]])


ORACLES["prediction_table"] = f"""
WITH {PREDICTORS} SELECT l_orderkey, l_linenumber, round(p_a, 6) AS model_a,
round(p_b, 6) AS model_b, round(p_c, 6) AS model_c FROM pc"""


def _two_frames(spark, sf):
    o = _orders(spark, sf)
    a = o.filter(F.col("o_orderstatus") != "P").select("o_orderkey", "o_totalprice")
    b = o.filter(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderpriority")
    return a, b


@q("keyed_concat")
def keyed_concat(spark, sf):
    a, b = _two_frames(spark, sf)
    return J.keyed_concat([a, b], ["o_orderkey"])


ORACLES["keyed_concat"] = """
WITH a AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'),
b AS (SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F')
SELECT o_orderkey, o_totalprice, o_orderpriority FROM a FULL OUTER JOIN b USING (o_orderkey)"""


@q("stack_predictions")
def stack_predictions(spark, sf):
    o = _orders(spark, sf)
    a = o.select("o_orderkey", (F.col("o_totalprice") * 0.9).alias("p1"))
    b = o.filter(F.col("o_orderstatus") != "P").select(
        "o_orderkey", (F.col("o_totalprice") * 1.1).alias("p2"))
    out = J.stack_predictions(a, b, ["o_orderkey"])
    return out.select("o_orderkey", F.round("p1", 6).alias("p1"), F.round("p2", 6).alias("p2"))


ORACLES["stack_predictions"] = """
SELECT a.o_orderkey, round(a.o_totalprice * 0.9, 6) AS p1, round(b.o_totalprice * 1.1, 6) AS p2
FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey WHERE b.o_orderstatus <> 'P'"""


@q("aligned_subtract")
def aligned_subtract(spark, sf):
    o = _orders(spark, sf)
    labels = o.select("o_orderkey", "o_totalprice")
    preds = o.select("o_orderkey", (F.floor(F.col("o_totalprice") / 1000) * 1000).alias("pred"))
    out = J.aligned_subtract(labels, preds, ["o_orderkey"], "o_totalprice", "pred", "residual")
    return out.select("o_orderkey", F.round("residual", 6).alias("residual"))


ORACLES["aligned_subtract"] = """
SELECT o_orderkey, round(o_totalprice - floor(o_totalprice / 1000) * 1000, 6) AS residual
FROM orders"""


def _dict_sql():
    rows = ", ".join(f"('{c}', '{k.strip()}', '{m}')" for c, k, m in DICTIONARY)
    return f"d AS (SELECT * FROM (VALUES {rows}) AS t(\"column\", code, meaning))"


@q("dictionary_lookup")
def dictionary_lookup(spark, sf):
    d = J.dictionary_frame(spark, DICTIONARY)
    df = J.lookup(_orders(spark, sf), "o_orderpriority", d, "priority_meaning")
    df = J.lookup(df, "o_orderstatus", d, "status_meaning")
    return df.select("o_orderkey", "o_orderpriority", "priority_meaning",
                     "o_orderstatus", "status_meaning")


ORACLES["dictionary_lookup"] = f"""
WITH {_dict_sql()}
SELECT o_orderkey, o_orderpriority, p.meaning AS priority_meaning,
       o_orderstatus, s.meaning AS status_meaning
FROM orders
LEFT JOIN d p ON p."column" = 'o_orderpriority' AND p.code = trim(o_orderpriority)
LEFT JOIN d s ON s."column" = 'o_orderstatus' AND s.code = trim(o_orderstatus)"""


@q("out_of_domain_codes")
def out_of_domain_codes(spark, sf):
    d = J.dictionary_frame(spark, DICTIONARY)
    return J.out_of_domain(_orders(spark, sf), ["o_orderpriority", "o_orderstatus"], d)


ORACLES["out_of_domain_codes"] = f"""
WITH {_dict_sql()},
l AS (SELECT 'o_orderpriority' AS "column", trim(o_orderpriority) AS code FROM orders
      UNION ALL SELECT 'o_orderstatus', trim(o_orderstatus) FROM orders)
SELECT "column", code, count(*) AS n FROM l
WHERE NOT EXISTS (SELECT 1 FROM d WHERE d."column" = l."column" AND d.code = l.code)
GROUP BY "column", code"""
