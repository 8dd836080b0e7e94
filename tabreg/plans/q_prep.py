"""Registered queries: row features (X1-X4), encoders, scalers, imputers,
outliers, splits, the fitted pipeline (F1-F14) and the CSV reader (IO1, IO4)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabreg.functions.rowwise import ratio, sum_skipnull
from tabreg.operators import prep as R
from tabreg.plans.data import PRIORITY_ORDER, lineitem_net, orders_customers, orders_profiled
from tabreg.plans.sql import LINEITEM_NET, ORDERS_CUSTOMERS, ORDERS_PROFILED, bucket, is_test
from tabreg.session import shared_scratch
from tabreg.sources.tables import read_table
from tabreg.sources.text import read_csv

QUERIES = {}
ORACLES = {}


def q(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ row features

def _li_nulls(spark, sf):
    li = lineitem_net(spark, sf)
    n = F.col("l_linenumber")
    return li.select(
        "l_orderkey", "l_linenumber", "net", "l_tax",
        F.when(n != 1, F.col("l_quantity")).alias("q_null"),
        F.when(n != 1, F.col("l_tax")).alias("tax_null"),
        F.when(~n.isin(1, 2), F.col("l_discount")).alias("disc_null"),
    )


LI_NULLS = LINEITEM_NET + """,
ln AS (SELECT l_orderkey, l_linenumber, net, l_tax,
  CASE WHEN l_linenumber <> 1 THEN l_quantity END AS q_null,
  CASE WHEN l_linenumber <> 1 THEN l_tax END AS tax_null,
  CASE WHEN l_linenumber NOT IN (1, 2) THEN l_discount END AS disc_null FROM li)"""


@q("row_sum_skipnull")
def row_sum_skipnull(spark, sf):
    df = _li_nulls(spark, sf)
    return df.select("l_orderkey", "l_linenumber", F.round(
        sum_skipnull(["q_null", "tax_null", "disc_null"]), 9).alias("total"))


ORACLES["row_sum_skipnull"] = f"""
WITH {LI_NULLS}
SELECT l_orderkey, l_linenumber,
       round(coalesce(q_null, 0.0) + coalesce(tax_null, 0.0) + coalesce(disc_null, 0.0), 9) AS total
FROM ln"""


@q("weighted_row_sum")
def weighted_row_sum(spark, sf):
    df = _li_nulls(spark, sf)
    full = sum_skipnull(["q_null", "l_tax"])
    half = sum_skipnull(["disc_null", "tax_null"])
    return df.select("l_orderkey", "l_linenumber",
                     F.round(full + half * 0.5, 9).alias("weighted_total"))


ORACLES["weighted_row_sum"] = f"""
WITH {LI_NULLS}
SELECT l_orderkey, l_linenumber,
       round(coalesce(q_null, 0.0) + coalesce(l_tax, 0.0)
             + (coalesce(disc_null, 0.0) + coalesce(tax_null, 0.0)) * 0.5, 9) AS weighted_total
FROM ln"""


@q("ratio_feature")
def ratio_feature(spark, sf):
    df = _li_nulls(spark, sf)
    return df.select("l_orderkey", "l_linenumber", F.round(
        ratio("net", sum_skipnull(["q_null", "tax_null"])), 9).alias("price_per_area"))


ORACLES["ratio_feature"] = f"""
WITH {LI_NULLS}, d AS (SELECT *, coalesce(q_null, 0.0) + coalesce(tax_null, 0.0) AS den FROM ln)
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN den = 0 THEN NULL ELSE net / den END, 9) AS price_per_area FROM d"""

# ------------------------------------------------------------------ encoders


def _orders_years(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderdate"])
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        F.year("o_orderdate").cast("string").alias("order_year"),
        (F.year("o_orderdate") < 1999).alias("is_train"))


ORDERS_YEARS = """o AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
         CAST(year(o_orderdate) AS VARCHAR) AS order_year, year(o_orderdate) < 1999 AS is_train
  FROM orders),
tr AS (SELECT * FROM o WHERE is_train), te AS (SELECT * FROM o WHERE NOT is_train),
cats AS (SELECT DISTINCT 'o_orderstatus' AS col, o_orderstatus AS v FROM tr
         UNION ALL SELECT DISTINCT 'order_year', order_year FROM tr)"""

ENC_COLS = ["o_orderstatus", "order_year"]


def _one_hot_long(spark, sf, drop_first):
    df = _orders_years(spark, sf)
    train, test = df.filter("is_train"), df.filter("NOT is_train")
    model = R.OneHotEncoder(ENC_COLS, drop_first=drop_first).fit(train)
    wide = model.transform(test, keep=["o_orderkey"])
    return wide.unpivot(["o_orderkey"], model.output_columns(), "feature", "value")


def _one_hot_sql(drop_first):
    keep = ("WHERE NOT (v IS NOT NULL AND v = (SELECT min(c2.v) FROM cats c2 "
            "WHERE c2.col = cats.col))") if drop_first else ""
    hit = " OR ".join(
        f"(k.col = '{c}' AND (te.{c} = k.v OR (te.{c} IS NULL AND k.v IS NULL)))"
        for c in ENC_COLS)
    return f"""
WITH {ORDERS_YEARS}, k AS (SELECT * FROM cats {keep})
SELECT te.o_orderkey, k.col || '_' || coalesce(k.v, 'nan') AS feature,
       CASE WHEN {hit} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
FROM te CROSS JOIN k"""


@q("one_hot_ignore_unknown")
def one_hot_ignore_unknown(spark, sf):
    return _one_hot_long(spark, sf, False)


ORACLES["one_hot_ignore_unknown"] = _one_hot_sql(False)


@q("one_hot_drop_first")
def one_hot_drop_first(spark, sf):
    return _one_hot_long(spark, sf, True)


ORACLES["one_hot_drop_first"] = _one_hot_sql(True)


@q("ordinal_explicit")
def ordinal_explicit(spark, sf):
    df = orders_profiled(spark, sf)
    model = R.OrdinalEncoder({"priority_null": PRIORITY_ORDER}).fit(df)
    return model.transform(df).select("o_orderkey",
                                      F.col("priority_null").alias("ord_priority"))


_ORDER_SQL = "[" + ", ".join(f"'{v}'" for v in PRIORITY_ORDER) + "]"
ORACLES["ordinal_explicit"] = f"""
WITH {ORDERS_PROFILED}
SELECT o_orderkey, CAST(coalesce(list_position({_ORDER_SQL}, priority_null) - 1, -1) AS DOUBLE)
       AS ord_priority FROM op"""


@q("label_encode")
def label_encode(spark, sf):
    df = _orders_years(spark, sf)
    train, test = df.filter("is_train"), df.filter("NOT is_train")
    model = R.label_encoder(ENC_COLS).fit(train)
    return model.transform(test).select("o_orderkey", *ENC_COLS)


ORACLES["label_encode"] = f"""
WITH {ORDERS_YEARS},
codes AS (SELECT col, v, dense_rank() OVER (PARTITION BY col ORDER BY v) - 1 AS code
          FROM (SELECT DISTINCT col, v FROM cats WHERE v IS NOT NULL))
SELECT te.o_orderkey,
       CAST(coalesce(a.code, -1) AS DOUBLE) AS o_orderstatus,
       CAST(coalesce(b.code, -1) AS DOUBLE) AS order_year
FROM te
LEFT JOIN codes a ON a.col = 'o_orderstatus' AND a.v = te.o_orderstatus
LEFT JOIN codes b ON b.col = 'order_year' AND b.v = te.order_year"""

# ------------------------------------------------------------------ scalers


def _customer_split(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_acctbal"])
    return R.train_test_split(c, "c_custkey", 0.2)


CUST_SPLIT = f"""c AS (SELECT c_custkey, c_acctbal, {is_test('c_custkey')} AS is_test FROM customer),
tr AS (SELECT * FROM c WHERE NOT is_test), te AS (SELECT * FROM c WHERE is_test)"""


@q("standard_scale")
def standard_scale(spark, sf):
    train, test = _customer_split(spark, sf)
    model = R.StandardScaler(["c_acctbal"]).fit(train)
    return model.transform(test).select("c_custkey", F.round("c_acctbal", 9).alias("c_acctbal"))


ORACLES["standard_scale"] = f"""
WITH {CUST_SPLIT}, s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM tr)
SELECT c_custkey, round((c_acctbal - m) / CASE WHEN sd > 0 THEN sd ELSE 1.0 END, 9) AS c_acctbal
FROM te, s"""


@q("standard_scale_refit")
def standard_scale_refit(spark, sf):
    _, test = _customer_split(spark, sf)
    out = R.standard_scale_refit(test, ["c_acctbal"])
    return out.select("c_custkey", F.round("c_acctbal", 9).alias("c_acctbal"))


ORACLES["standard_scale_refit"] = f"""
WITH {CUST_SPLIT}, s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM te)
SELECT c_custkey, round((c_acctbal - m) / CASE WHEN sd > 0 THEN sd ELSE 1.0 END, 9) AS c_acctbal
FROM te, s"""


@q("minmax_scale")
def minmax_scale(spark, sf):
    train, test = _customer_split(spark, sf)
    model = R.MinMaxScaler(["c_acctbal"]).fit(train)
    return model.transform(test).select("c_custkey", F.round("c_acctbal", 9).alias("c_acctbal"))


ORACLES["minmax_scale"] = f"""
WITH {CUST_SPLIT}, s AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM tr)
SELECT c_custkey,
       round((c_acctbal - lo) / CASE WHEN hi <> lo THEN hi - lo ELSE 1.0 END, 9) AS c_acctbal
FROM te, s"""

# ------------------------------------------------------------------ imputation


def _customer_nulls(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_acctbal", "c_nationkey",
                                           "c_mktsegment"])
    return c.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_acctbal")).alias("acct_null"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")).alias("nation_null"))


CUST_NULLS = """cn AS (SELECT c_custkey,
  CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_acctbal END AS acct_null,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS nation_null FROM customer)"""


def _impute(spark, sf, strategy, col):
    df = _customer_nulls(spark, sf)
    model = R.Imputer([col], strategy).fit(df)
    out = model.transform(df)
    c = F.round(col, 6) if strategy != "mode" else F.col(col)
    return out.select("c_custkey", c.alias(col))


@q("impute_mean")
def impute_mean(spark, sf):
    return _impute(spark, sf, "mean", "acct_null")


ORACLES["impute_mean"] = f"""
WITH {CUST_NULLS}, s AS (SELECT avg(acct_null) AS f FROM cn)
SELECT c_custkey, round(coalesce(acct_null, f), 6) AS acct_null FROM cn, s"""


@q("impute_median")
def impute_median(spark, sf):
    return _impute(spark, sf, "median", "acct_null")


ORACLES["impute_median"] = f"""
WITH {CUST_NULLS}, s AS (SELECT quantile_disc(acct_null, 0.5) AS f FROM cn)
SELECT c_custkey, round(coalesce(acct_null, f), 6) AS acct_null FROM cn, s"""


@q("impute_mode")
def impute_mode(spark, sf):
    return _impute(spark, sf, "mode", "nation_null")


ORACLES["impute_mode"] = f"""
WITH {CUST_NULLS},
s AS (SELECT nation_null AS f FROM cn WHERE nation_null IS NOT NULL
      GROUP BY nation_null ORDER BY count(*) DESC, nation_null LIMIT 1)
SELECT c_custkey, coalesce(nation_null, f) AS nation_null FROM cn, s"""

# ------------------------------------------------------------------ outliers

OUTLIER_SQL = """q AS (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
      FROM events),
f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"""


@q("outlier_flags")
def outlier_flags(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "value"])
    return R.outlier_flags(ev, "value").select("event_id", "is_outlier")


ORACLES["outlier_flags"] = f"""
WITH {OUTLIER_SQL}
SELECT event_id, coalesce(value < lo OR value > hi, false) AS is_outlier FROM events, f"""


@q("outlier_removed")
def outlier_removed(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "value"])
    return R.remove_outliers(ev, "value")


ORACLES["outlier_removed"] = f"""
WITH {OUTLIER_SQL}
SELECT event_id, value FROM events, f WHERE NOT coalesce(value < lo OR value > hi, false)"""

# ------------------------------------------------------------------ splits


@q("train_test_split")
def train_test_split(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey"])
    return R.with_split(o, "o_orderkey", 0.2)


ORACLES["train_test_split"] = f"SELECT o_orderkey, {is_test('o_orderkey')} AS is_test FROM orders"


@q("three_way_split")
def three_way_split(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey"])
    return R.three_way_split(o, "o_orderkey", 0.2, 0.2)


ORACLES["three_way_split"] = f"""
SELECT o_orderkey, CASE WHEN {bucket('o_orderkey')} < 20 THEN 'test'
                        WHEN {bucket('o_orderkey', 100, 'val')} < 20 THEN 'val'
                        ELSE 'train' END AS split FROM orders"""


@q("kfold_sizes")
def kfold_sizes(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey"])
    return R.with_kfold(o, "o_orderkey", 5).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


ORACLES["kfold_sizes"] = f"""
SELECT {bucket('o_orderkey', 5, 'fold')} AS fold, count(*) AS n FROM orders GROUP BY 1"""

# ------------------------------------------------------------------ pipeline

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
STATUSES = ["F", "O", "P"]


@q("feature_pipeline")
def feature_pipeline(spark, sf):
    df = orders_customers(spark, sf)
    train, test = R.train_test_split(df, "o_orderkey", 0.2)
    spec = R.FeatureSpec(numerical=("c_acctbal",), nominal=("o_orderstatus", "c_mktsegment"),
                         ordinal={"o_orderpriority": PRIORITY_ORDER})
    model = R.FeaturePipeline(spec, key=("o_orderkey",), label="o_totalprice",
                              dominance_threshold=0.7, null_threshold=0.7).fit(train)
    out = model.transform(test)
    return out.select(*[F.round(c, 9).alias(c) if c in ("c_acctbal", "label") else F.col(c)
                        for c in out.columns])


ORACLES["feature_pipeline"] = f"""
WITH {ORDERS_CUSTOMERS},
s AS (SELECT {is_test('o_orderkey')} AS is_test, * FROM oc),
tr AS (SELECT * FROM s WHERE NOT is_test), te AS (SELECT * FROM s WHERE is_test),
m AS (SELECT avg(c_acctbal) AS mu, stddev_pop(c_acctbal) AS sd FROM tr)
SELECT o_orderkey, round(o_totalprice, 9) AS label,
       round((c_acctbal - mu) / CASE WHEN sd > 0 THEN sd ELSE 1.0 END, 9) AS c_acctbal,
       {', '.join(f"CASE WHEN o_orderstatus = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS o_orderstatus_{v}"
                  for v in STATUSES)},
       {', '.join(f"CASE WHEN c_mktsegment = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS c_mktsegment_{v}"
                  for v in SEGMENTS)},
       CAST(coalesce(list_position({_ORDER_SQL}, o_orderpriority) - 1, -1) AS DOUBLE)
         AS ord_o_orderpriority
FROM te, m"""

# ------------------------------------------------------------------ CSV with missing tokens (IO1, IO4)

CSV_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("status_none", T.StringType()),
    T.StructField("price_if_f", T.DoubleType()),
    T.StructField("priority_null", T.StringType()),
])


@q("csv_null_tokens")
def csv_null_tokens(spark, sf):
    """Write orders as CSV with 'NA' and 'None' tokens to the shared folder,
    read it back with an explicit schema: the tokens come back as null."""
    df = orders_profiled(spark, sf).select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "F", "F").otherwise("None").alias("status_none"),
        "price_if_f", "priority_null")
    path = shared_scratch(spark, "csv-null-tokens")
    df.write.option("header", True).option("nullValue", "NA").csv(path)
    return read_csv(spark, path, CSV_SCHEMA)


ORACLES["csv_null_tokens"] = f"""
WITH {ORDERS_PROFILED}
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'F' END AS status_none,
       price_if_f, priority_null FROM op"""
