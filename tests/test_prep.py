import math

import pytest
from pyspark.sql import functions as F

from tabreg.functions.rowwise import sum_skipnull
from tabreg.operators import prep as R


def test_split_partitions_rows_and_is_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    tr, te = R.train_test_split(df, "k", 0.2)
    a, b = {r.k for r in tr.collect()}, {r.k for r in te.collect()}
    assert a.isdisjoint(b) and len(a | b) == 5000
    assert 0.15 < len(b) / 5000 < 0.25
    _, te2 = R.train_test_split(df.repartition(17), "k", 0.2)
    assert {r.k for r in te2.collect()} == b


def test_three_way_and_kfold_sizes(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    s = R.three_way_split(df, "k").groupBy("split").count().collect()
    assert sum(r["count"] for r in s) == 3000 and len(s) == 3
    f = R.with_kfold(df, "k", 5).groupBy("fold").count().collect()
    assert sum(r["count"] for r in f) == 3000 and {r.fold for r in f} == set(range(5))


def test_one_hot_unseen_null_and_row_sums(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    m = R.OneHotEncoder(["c"]).fit(train)
    assert m.output_columns() == ["c_a", "c_b", "c_nan"]
    out = m.transform(test).collect()
    assert [tuple(r) for r in out] == [(1.0, 0.0, 0.0), (0.0, 0.0, 0.0), (0.0, 0.0, 1.0)]
    d = R.OneHotEncoder(["c"], drop_first=True).fit(train)
    assert d.output_columns() == ["c_b", "c_nan"]


def test_one_hot_numeric_categories_sorted_numerically(spark):
    df = spark.createDataFrame([(10,), (9,), (100,)], "c int")
    assert R.OneHotEncoder(["c"]).fit(df).output_columns() == ["c_9", "c_10", "c_100"]


def test_ordinal_unseen_and_missing_are_minus_one(spark):
    df = spark.createDataFrame([("mid",), ("huge",), (None,), ("tiny",)], "q string")
    out = R.OrdinalEncoder({"q": ["tiny", "mid", "large"]}).fit(df).transform(df)
    assert [r.q for r in out.collect()] == [1.0, -1.0, -1.0, 0.0]


def test_label_encoder_sorted_codes(spark):
    tr = spark.createDataFrame([("b",), ("a",), ("c",)], "x string")
    te = spark.createDataFrame([("c",), ("zz",)], "x string")
    out = R.label_encoder(["x"]).fit(tr).transform(te)
    assert [r.x for r in out.collect()] == [2.0, -1.0]


def test_standard_scaler_train_moments_and_constant(spark):
    df = spark.createDataFrame([(float(i), 3.0) for i in range(10)], "x double, k double")
    out = R.StandardScaler(["x", "k"]).fit(df).transform(df)
    s = out.agg(F.avg("x"), F.stddev_pop("x"), F.max("k")).first()
    assert abs(s[0]) < 1e-12 and math.isclose(s[1], 1.0) and s[2] == 0.0


def test_minmax_scaler(spark):
    df = spark.createDataFrame([(2.0,), (4.0,), (6.0,)], "x double")
    out = R.MinMaxScaler(["x"]).fit(df).transform(df)
    assert [r.x for r in out.collect()] == [0.0, 0.5, 1.0]


def test_imputers(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 3), (None, 1), (10.0, None), (None, 1)],
                               "x double, n int")
    assert R.Imputer(["x"], "mean").fit(df).fill["x"] == 13.0 / 3
    assert R.Imputer(["x"], "median").fit(df).fill["x"] == 2.0
    assert R.Imputer(["n"], "mode").fit(df).fill["n"] == 1


def test_outlier_flags_and_removal(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "x double")
    assert R.outlier_flags(df, "x").filter("is_outlier").count() == 1
    assert R.remove_outliers(df, "x").count() == 8


def test_sum_skipnull_all_null_is_zero(spark):
    df = spark.createDataFrame([(None, None), (1.0, None)], "a double, b double")
    out = df.select(sum_skipnull(["a", "b"]).alias("s"), sum_skipnull(["a", "b"], [2, 0.5]).alias("w"))
    assert [tuple(r) for r in out.collect()] == [(0.0, 0.0), (1.0, 2.0)]


def test_feature_pipeline_fit_once_apply_twice(spark):
    train = spark.createDataFrame([(i, float(i), "a" if i % 2 else "b", "x",
                                    "Gd" if i % 2 else "Ex") for i in range(20)], "k long, v double, n string, d string, o string")
    test = spark.createDataFrame([(100, 5.0, "c", "x", "Ex")], "k long, v double, n string, d string, o string")
    spec = R.FeatureSpec(numerical=("v",), nominal=("n", "d"), ordinal={"o": ["Ex", "Gd"]})
    m = R.FeaturePipeline(spec, key=("k",), dominance_threshold=0.7).fit(train)
    assert m.dropped == ["d"]  # constant column dominates
    r = m.transform(test).first()
    assert r["n_a"] == 0.0 and r["n_b"] == 0.0 and r["ord_o"] == 0.0
    mean = sum(range(20)) / 20
    std = (sum((i - mean) ** 2 for i in range(20)) / 20) ** 0.5
    assert math.isclose(r["v"], (5.0 - mean) / std)
    vec = m.transform(test, assemble_vector=True).first()["features"]
    assert len(vec) == len(m.feature_columns)


def test_one_hot_vector_chain_unseen_and_null(spark):
    from pyspark.ml import Pipeline
    train = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    model = Pipeline(stages=R.one_hot_vector_stages("c", "c_vec")).fit(train)
    vecs = [r.c_vec.toArray().tolist() for r in model.transform(test).collect()]
    assert vecs == [[1.0, 0.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 1.0]]


def test_imputers_many_columns_in_one_pass(spark):
    rows = [(1.0, 9, "b", None), (None, 9, "a", None), (3.0, 10, "a", None),
            (float("nan"), 10, "b", None), (5.0, None, None, None)]
    df = spark.createDataFrame(rows, "x double, n int, s string, e double")
    med = R.Imputer(["x", "n", "e"], "median").fit(df).fill
    assert med == {"x": 3.0, "n": 9.0, "e": None}
    mode = R.Imputer(["n", "s", "x"], "mode").fit(df).fill
    assert mode == {"n": 9, "s": "a", "x": 1.0}  # ties go to the smallest value


def test_pipeline_single_pass_fit_equals_separate_operators(spark):
    from tabreg.operators import profile as P
    rows = [(i, ["a", "b", "b", None][i % 4], ["x", "x", "x", "y"][i % 4],
             float(i % 7) if i % 5 > 1 else None, ["L", "M", "H"][i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, nom string, dom string, v double, o string")
    spec = R.FeatureSpec(numerical=("v",), nominal=("nom", "dom"), ordinal={"o": None})
    m = R.FeaturePipeline(spec, key=("k",), dominance_threshold=0.75, null_threshold=0.3).fit(df)
    # dom: top share 0.75 (>=); v: 24/60 null (> 0.3); nom: 15/60 null, kept
    expected = {r.column for r in P.low_information_columns(df, ["dom", "nom", "o"], 0.75)
                .collect()} | {r.column for r in P.excessive_null_columns(
                    df, ["v", "dom", "nom", "o"], 0.3).collect()}
    assert m.dropped == sorted(expected) == ["dom", "v"]
    assert m.one_hot.categories == R.OneHotEncoder(["nom"]).fit(df).categories
    assert m.ordinal.orders == {"o": ["H", "L", "M"]}
    got = R.FeaturePipeline(spec, key=("k",)).fit(df).scaler.stats["v"]
    exp = R.StandardScaler(["v"]).fit(df).stats["v"]
    assert all(abs(a - b) < 1e-12 for a, b in zip(got, exp))


def test_category_limit_is_per_column(spark):
    df = spark.createDataFrame([(i, i) for i in range(8)], "a int, b int")
    assert len(R.OneHotEncoder(["a", "b"], max_categories=8).fit(df).output_columns()) == 16
    with pytest.raises(ValueError, match="categories in"):
        R.OneHotEncoder(["a", "b"], max_categories=7).fit(df)


def test_pipeline_derives_and_drops(spark):
    train = spark.createDataFrame([(1, 1.0, 2.0, 3.0), (2, 3.0, 4.0, 5.0)], "id int, w double, h double, z double")
    test = spark.createDataFrame([(3, 5.0, 6.0, 7.0)], "id int, w double, h double, z double")
    pipe = R.FeaturePipeline(
        R.FeatureSpec(numerical=("w", "h", "z", "total", "twice"), nominal=("big",)), key=["id"],
        derive={"total": F.col("w") + F.col("h"), "twice": F.col("total") * 2, "big": F.col("total") > 5},
        drop=["w", "h"])
    m = pipe.fit(train)
    assert m.numerical == ["z", "total", "twice"]
    r = m.transform(test).first()
    assert "w" not in r.asDict() and math.isclose(r["total"], (11 - 5) / 2.0) and math.isclose(r["twice"], (22 - 10) / 4.0)
    assert r["id"] == 3
