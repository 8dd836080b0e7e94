"""Registered queries: the flagship slice and column profiling (A*, S3, S5, P11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabreg.operators import profile as P
from tabreg.operators.evaluate import metrics
from tabreg.operators.models import fit, linear_regression
from tabreg.operators.prep import FeaturePipeline, FeatureSpec, train_test_split
from tabreg.plans.data import PRIORITY_ORDER, lineitem_net, orders_customers, orders_profiled
from tabreg.plans.sql import LINEITEM_NET, ORDERS_PROFILED
from tabreg.sources.tables import read_table

QUERIES = {}
ORACLES = {}


def q(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ flagship

def flagship(spark, sf):
    """orders x customer -> hash split -> profile-driven pipeline fitted on
    train -> OLS -> metric table on the test rows."""
    df = orders_customers(spark, sf)
    train, test = train_test_split(df, "o_orderkey", 0.2)
    spec = FeatureSpec(numerical=("c_acctbal",), nominal=("o_orderstatus", "c_mktsegment"),
                       ordinal={"o_orderpriority": PRIORITY_ORDER})
    pipe = FeaturePipeline(spec, key=("o_orderkey",), label="o_totalprice",
                           dominance_threshold=0.7, null_threshold=0.7).fit(train)
    tr = pipe.transform(train, assemble_vector=True)
    te = pipe.transform(test, assemble_vector=True)
    model = fit(linear_regression(), tr)
    pred = model.transform(te)
    return metrics(pred, "label", {"linear_regression": "prediction"})


QUERIES["flagship_ols_pipeline"] = flagship

# ------------------------------------------------------------------ dominance / nulls

CAT_COLS = ["o_orderstatus", "o_orderpriority", "price_flag", "priority_null"]
NULL_COLS = ["o_orderstatus", "priority_null", "price_if_f", "o_totalprice"]


def _union_text(cols, src="op"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM {src}" for c in cols)


@q("profile_dominance")
def profile_dominance(spark, sf):
    d = P.dominance(orders_profiled(spark, sf), CAT_COLS)
    return d.select("column", F.round("top_freq", 9).alias("top_freq"))


ORACLES["profile_dominance"] = f"""
WITH {ORDERS_PROFILED},
v AS ({_union_text(CAT_COLS)}),
c AS (SELECT "column", value, count(*) AS cnt FROM v GROUP BY "column", value)
SELECT "column", round(max(cnt) / sum(cnt), 9) AS top_freq FROM c GROUP BY "column"
"""


@q("low_information_columns")
def low_information_columns(spark, sf):
    d = P.low_information_columns(orders_profiled(spark, sf), CAT_COLS, 0.7)
    return d.select("column", F.round("top_freq", 9).alias("top_freq"))


ORACLES["low_information_columns"] = f"""
WITH {ORDERS_PROFILED},
v AS ({_union_text(CAT_COLS)}),
c AS (SELECT "column", value, count(*) AS cnt FROM v GROUP BY "column", value),
d AS (SELECT "column", max(cnt) / sum(cnt) AS top_freq FROM c GROUP BY "column")
SELECT "column", round(top_freq, 9) AS top_freq FROM d WHERE top_freq >= 0.7
"""


def _null_union(cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) "
        f"AS nan_ratio FROM op" for c in cols)


@q("profile_nulls")
def profile_nulls(spark, sf):
    d = P.null_ratio(orders_profiled(spark, sf), NULL_COLS)
    return d.select("column", F.round("nan_ratio", 9).alias("nan_ratio"))


ORACLES["profile_nulls"] = f"""
WITH {ORDERS_PROFILED}, n AS ({_null_union(NULL_COLS)})
SELECT "column", round(nan_ratio, 9) AS nan_ratio FROM n
"""


@q("excessive_null_columns")
def excessive_null_columns(spark, sf):
    d = P.excessive_null_columns(orders_profiled(spark, sf), NULL_COLS, 0.5)
    return d.select("column", F.round("nan_ratio", 9).alias("nan_ratio"))


ORACLES["excessive_null_columns"] = f"""
WITH {ORDERS_PROFILED}, n AS ({_null_union(NULL_COLS)})
SELECT "column", round(nan_ratio, 9) AS nan_ratio FROM n WHERE nan_ratio > 0.5
"""


@q("drop_union")
def drop_union(spark, sf):
    df = orders_profiled(spark, sf)
    cols = sorted(set(CAT_COLS) | set(NULL_COLS))
    return P.drop_union(P.low_information_columns(df, cols, 0.7),
                        P.excessive_null_columns(df, cols, 0.5))


_ALL = sorted(set(CAT_COLS) | set(NULL_COLS))
ORACLES["drop_union"] = f"""
WITH {ORDERS_PROFILED},
v AS ({_union_text(_ALL)}),
c AS (SELECT "column", value, count(*) AS cnt FROM v GROUP BY "column", value),
d AS (SELECT "column" FROM c GROUP BY "column" HAVING max(cnt) / sum(cnt) >= 0.7),
n AS ({_null_union(_ALL)})
SELECT "column" FROM d UNION SELECT "column" FROM n WHERE nan_ratio > 0.5
"""

# ------------------------------------------------------------------ column profile (part)

PART_COLS = ["p_brand", "p_type", "p_size", "p_retailprice"]
PART_NUMERIC = {"p_size", "p_retailprice"}


@q("column_profile")
def column_profile(spark, sf):
    part = read_table(spark, sf, "part", PART_COLS)
    prof = P.column_profile(part, PART_COLS)
    return prof.select("column", "n_rows", F.round("null_ratio", 9).alias("null_ratio"),
                       "n_distinct", F.round("top_freq", 9).alias("top_freq"),
                       F.round("min", 6).alias("min"), F.round("max", 6).alias("max"),
                       F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def _profile_sql():
    parts = []
    for c in PART_COLS:
        num = c in PART_NUMERIC
        x = f"CAST({c} AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"
        parts.append(f"""
SELECT '{c}' AS "column", count(*) AS n_rows,
       round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 9) AS null_ratio,
       (SELECT count(DISTINCT {c}) FROM part) AS n_distinct,
       round((SELECT max(cnt) FROM (SELECT count(*) AS cnt FROM part GROUP BY {c})) / count(*), 9)
         AS top_freq,
       round(min({x}), 6) AS "min", round(max({x}), 6) AS "max",
       round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std
FROM part""")
    return " UNION ALL ".join(parts)


ORACLES["column_profile"] = _profile_sql()


@q("distinct_sorted_values")
def distinct_sorted_values(spark, sf):
    part = read_table(spark, sf, "part", ["p_type", "p_size", "p_retailprice"])
    return P.distinct_sorted_values(part, ["p_type", "p_size", "p_retailprice"])


ORACLES["distinct_sorted_values"] = """
SELECT DISTINCT 'p_type' AS "column", p_type AS value FROM part WHERE p_type IS NOT NULL
UNION ALL SELECT DISTINCT 'p_size', CAST(p_size AS VARCHAR) FROM part WHERE p_size IS NOT NULL
UNION ALL SELECT DISTINCT 'p_retailprice',
  CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR)
       ELSE CAST(p_retailprice AS VARCHAR) END
FROM part WHERE p_retailprice IS NOT NULL
"""

# ------------------------------------------------------------------ correlation (lineitem)

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net"]


@q("corr_matrix_long")
def corr_matrix_long(spark, sf):
    c = P.corr_long(lineitem_net(spark, sf), LI_NUM)
    return c.select("Feature1", "Feature2", F.round("Correlation", 9).alias("Correlation"))


def _corr_sql(a, b):
    if a == b:
        return f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END"
    return (f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 "
            f"THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END")


ORACLES["corr_matrix_long"] = f"WITH {LINEITEM_NET} " + " UNION ALL ".join(
    f"SELECT '{a}' AS Feature1, '{b}' AS Feature2, round({_corr_sql(a, b)}, 9) AS Correlation "
    f"FROM li" for a in LI_NUM for b in LI_NUM)


@q("top_correlated")
def top_correlated(spark, sf):
    t = P.top_correlated(lineitem_net(spark, sf), LI_NUM[:-1], "net", 3)
    return t.select("feature", F.round("correlation", 9).alias("correlation"))


ORACLES["top_correlated"] = f"""
WITH {LINEITEM_NET}, c AS (
""" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature, {_corr_sql(a, 'net')} AS correlation FROM li" for a in LI_NUM[:-1]
) + """)
SELECT feature, round(correlation, 9) AS correlation FROM c WHERE correlation IS NOT NULL
ORDER BY abs(correlation) DESC, feature LIMIT 3
"""

# ------------------------------------------------------------------ distributions (events)


@q("target_skewness")
def target_skewness(spark, sf):
    ev = read_table(spark, sf, "events", ["value"])
    return P.skewness(ev, "value").select(F.round("skewness", 9).alias("skewness"))


ORACLES["target_skewness"] = """
WITH m AS (SELECT avg(value) AS mu FROM events)
SELECT round(avg(power(value - mu, 3)) / power(avg(power(value - mu, 2)), 1.5), 9) AS skewness
FROM events, m
"""

HIST_SQL = """
WITH x AS ({src}),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
c AS (SELECT CAST(least(CASE WHEN (hi - lo) / {n}.0 > 0 THEN floor((x - lo) / ((hi - lo) / {n}.0))
                             ELSE 0 END, {last}) AS INTEGER) AS bin, count(*) AS cnt
      FROM x, b GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(0, {n}))
SELECT g.bin, round(lo + g.bin * ((hi - lo) / {n}.0), 6) AS bin_lo,
       round(lo + (g.bin + 1) * ((hi - lo) / {n}.0), 6) AS bin_hi,
       coalesce(cnt, 0) AS "count"
FROM g CROSS JOIN b LEFT JOIN c ON g.bin = c.bin WHERE b.lo IS NOT NULL
"""


def hist_sql(src: str, n: int = 30, prefix: str = "") -> str:
    body = HIST_SQL.format(src=src, n=n, last=n - 1)
    if prefix:
        body = body.replace("WITH x AS", f"WITH {prefix}, x AS", 1)
    return body


def rounded_hist(h):
    return h.select("bin", F.round("bin_lo", 6).alias("bin_lo"),
                    F.round("bin_hi", 6).alias("bin_hi"), "count")


@q("histogram_30")
def histogram_30(spark, sf):
    return rounded_hist(P.histogram(read_table(spark, sf, "events", ["value"]), "value", 30))


ORACLES["histogram_30"] = hist_sql("SELECT value AS x FROM events WHERE value IS NOT NULL")


BOX_COLS = ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "whisker_lo",
            "whisker_hi"]


def rounded_box(b, g):
    return b.select(*g, *[F.round(c, 6).alias(c) for c in BOX_COLS], "n", "n_outliers")


def box_sql(src: str, g: str, prefix: str = "") -> str:
    gsel = f"{g}, " if g else ""
    gby = f"GROUP BY {g}" if g else ""
    join_f = f"JOIN f USING ({g})" if g else "CROSS JOIN f"
    join_w = f"JOIN w USING ({g})" if g else "CROSS JOIN w"
    inside = "x >= lower_fence AND x <= upper_fence"
    return f"""
WITH {prefix + ',' if prefix else ''} x AS ({src}),
q AS (SELECT {gsel} quantile_disc(x, 0.25) AS q1, quantile_disc(x, 0.5) AS median,
             quantile_disc(x, 0.75) AS q3 FROM x {gby}),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence,
             q3 + 1.5 * (q3 - q1) AS upper_fence FROM q),
w AS (SELECT {gsel} count(*) AS n,
             min(CASE WHEN {inside} THEN x END) AS whisker_lo,
             max(CASE WHEN {inside} THEN x END) AS whisker_hi,
             CAST(sum(CASE WHEN {inside} THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
      FROM x {join_f} {gby})
SELECT {gsel} {', '.join(f'round({c}, 6) AS {c}' for c in BOX_COLS)}, n, n_outliers
FROM f {join_w}
"""


@q("box_summary")
def box_summary(spark, sf):
    ev = read_table(spark, sf, "events", ["event_type", "value"])
    return rounded_box(P.box_summary(ev, "value", ["event_type"]), ["event_type"])


ORACLES["box_summary"] = box_sql(
    "SELECT event_type, value AS x FROM events WHERE value IS NOT NULL", "event_type")


@q("feature_distributions")
def feature_distributions(spark, sf):
    ev = read_table(spark, sf, "events", ["value", "user_id"])
    d = P.feature_distributions(ev, ["value", "user_id"], 30)
    return d.select("column", "bin", F.round("bin_lo", 6).alias("bin_lo"),
                    F.round("bin_hi", 6).alias("bin_hi"), "count")


ORACLES["feature_distributions"] = " UNION ALL ".join(
    "SELECT '{c}' AS \"column\", * FROM ({h})".format(
        c=c, h=hist_sql(f"SELECT CAST({c} AS DOUBLE) AS x FROM events WHERE {c} IS NOT NULL"))
    for c in ["value", "user_id"])


@q("label_min_max")
def label_min_max(spark, sf):
    from tabreg.operators.evaluate import prediction_line
    return prediction_line(lineitem_net(spark, sf), "net").select(
        F.round("label_min", 6).alias("label_min"), F.round("label_max", 6).alias("label_max"))


ORACLES["label_min_max"] = f"""
WITH {LINEITEM_NET} SELECT round(min(net), 6) AS label_min, round(max(net), 6) AS label_max FROM li
"""


@q("scaling_moments")
def scaling_moments(spark, sf):
    li = lineitem_net(spark, sf)
    return li.agg(*[f for c in ["net", "l_extendedprice"] for f in (
        F.round(F.avg(c), 6).alias(f"mean_{c}"), F.round(F.stddev_pop(c), 6).alias(f"std_{c}"))])


ORACLES["scaling_moments"] = f"""
WITH {LINEITEM_NET} SELECT round(avg(net), 6) AS mean_net, round(stddev_pop(net), 6) AS std_net,
  round(avg(l_extendedprice), 6) AS mean_l_extendedprice,
  round(stddev_pop(l_extendedprice), 6) AS std_l_extendedprice FROM li
"""
