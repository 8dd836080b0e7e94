import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabreg.operators import profile as P


def rows(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_dominance_counts_null_as_value(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), ("a",)], "c string")
    assert rows(P.dominance(df, ["c"]), "column", "top_freq") == {("c", 0.75)}


def test_dominance_threshold_is_inclusive_and_null_threshold_strict(spark):
    vals = ["a"] * 7 + ["b"] * 3
    nulls = [None] * 7 + [1.0] * 3
    df = spark.createDataFrame(list(zip(vals, nulls)), "c string, x double")
    assert rows(P.low_information_columns(df, ["c"], 0.7), "column") == {("c",)}
    assert rows(P.excessive_null_columns(df, ["x"], 0.7), "column") == set()
    assert rows(P.excessive_null_columns(df, ["x"], 0.69), "column") == {("x",)}


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert rows(P.null_ratio(df, ["x"]), "nan_ratio") == {(0.5,)}


def test_empty_frame_gives_empty_profile(spark):
    df = spark.createDataFrame([], "c string, x double")
    assert P.dominance(df, ["c"]).count() == 0
    assert P.excessive_null_columns(df, ["x"], 0.5).count() == 0


def test_corr_pairwise_complete_and_constant_is_null(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0, None], "b": [2.0, 1.0, 4.0, 3.0, 9.0],
                        "k": [5.0] * 5})
    df = spark.createDataFrame(pdf)
    got = {(r.Feature1, r.Feature2): r.Correlation for r in P.corr_long(df, ["a", "b", "k"]).collect()}
    exp = pdf.corr()
    assert math.isclose(got[("a", "b")], exp.loc["a", "b"], rel_tol=1e-12)
    assert got[("a", "k")] is None and got[("k", "k")] is None
    assert got[("a", "a")] == 1.0


def test_histogram_counts_and_edges(spark):
    data = np.random.default_rng(1).normal(size=500)
    df = spark.createDataFrame([(float(x),) for x in data], "x double")
    h = P.histogram(df, "x", 30).orderBy("bin").collect()
    counts, edges = np.histogram(data, bins=30)
    assert [r["count"] for r in h] == counts.tolist()
    assert math.isclose(h[0]["bin_lo"], edges[0]) and math.isclose(h[-1]["bin_hi"], edges[-1])


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(2.0,)] * 4, "x double")
    h = P.histogram(df, "x", 5).collect()
    assert sum(r["count"] for r in h) == 4 and len(h) == 5


@pytest.mark.parametrize("n", [1, 2, 7, 10, 101])
def test_exact_quantiles_rank_rule(spark, n):
    vals = np.random.default_rng(n).permutation(np.arange(n, dtype=float))
    df = spark.createDataFrame([(float(v), i % 3) for i, v in enumerate(vals)], "x double, g int")
    q = P.exact_quantiles(df, "x", [0.25, 0.5, 0.75]).first()
    s = np.sort(vals)
    exp = [s[max(1, math.ceil(p * n)) - 1] for p in (0.25, 0.5, 0.75)]
    assert [q["q0"], q["q1"], q["q2"]] == exp


def test_box_summary_grouped(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]] +
                               [("b", float(v)) for v in [5, 5, 5]], "g string, x double")
    b = {r["g"]: r for r in P.box_summary(df, "x", ["g"]).collect()}
    assert b["a"]["n_outliers"] == 1 and b["a"]["whisker_hi"] == 4.0
    assert b["b"]["iqr"] == 0.0 and b["b"]["n_outliers"] == 0


def test_skewness_population(spark):
    data = np.random.default_rng(3).exponential(size=300)
    df = spark.createDataFrame([(float(x),) for x in data], "x double")
    m = data.mean()
    exp = ((data - m) ** 3).mean() / ((data - m) ** 2).mean() ** 1.5
    assert math.isclose(P.skewness(df, "x").first()[0], exp, rel_tol=1e-9)


def test_distinct_sorted_values_whole_numbers(spark):
    df = spark.createDataFrame([(1900.0,), (2.5,), (1900.0,), (None,)], "x double")
    got = [r["value"] for r in P.distinct_sorted_values(df, ["x"]).collect()]
    assert got == ["2.5", "1900"]


def test_result_independent_of_partitioning(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("c"),
                                  (F.col("id") * 1.5).alias("x"))
    a = rows(P.column_profile(df.repartition(1), ["c", "x"]), "column", "n_distinct", "top_freq")
    b = rows(P.column_profile(df.repartition(17), ["c", "x"]), "column", "n_distinct", "top_freq")
    assert a == b


def test_exact_quantiles_refinement_rounds(spark):
    rng = np.random.default_rng(9)
    g = np.where(rng.random(6000) < 0.8, 0, 1)       # one hot group
    x = np.round(rng.lognormal(0, 2, 6000), 2)        # heavy tail, many ties
    x[:900] = 7.0                                     # one hot value
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, x)], "g int, x double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = {r.g: [r[f"q{i}"] for i in range(5)] for r in
           P.exact_quantiles(df, "x", probs, ["g"], buckets=4, final_rows=50).collect()}
    for k in (0, 1):
        s = np.sort(x[g == k])
        assert got[k] == [s[max(1, math.ceil(p * len(s))) - 1] for p in probs]


def test_wide_profile_eighty_columns(spark):
    exprs = [((F.col("id") + i) % 7).cast("double" if i % 2 else "string").alias(f"c{i}")
             for i in range(80)]
    df = spark.range(500).select(*exprs)
    prof = P.column_profile(df, df.columns)
    rows = prof.collect()
    assert len(rows) == 80 and all(r.n_rows == 500 and r.n_distinct == 7 for r in rows)
    assert P.null_ratio(df, df.columns).count() == 80
