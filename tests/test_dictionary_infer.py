"""Dictionary tables for many-valued columns; column types inferred from text."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tabreg.operators import dictionary as D
from tabreg.operators import prep as R
from tabreg.sources import infer_csv, type_profile


def _codes(d):
    return {r["value"]: r["code"] for r in d.table.collect()}


@pytest.mark.parametrize("kind,values", [
    ("bigint", [5, -3, 5, None, 2 ** 60, 2 ** 60 + 1]),
    ("double", [1.5, float("nan"), -0.0, 0.0, float("inf"), None]),
    ("string", ["b", "", "B", "ä", None, "10", "9"]),
    ("decimal(20,4)", ["1.5", "10.25", "-2", "1.5"]),
    ("date", [datetime.date(2020, 2, 1), datetime.date(1999, 1, 1)]),
    ("boolean", [True, False, None]),
    ("bigint", []), ("string", [None, None])])
def test_codes_are_dense_in_the_values_order(spark, kind, values):
    df = spark.createDataFrame([(None if v is None else v,) for v in values],
                               "v string" if kind.startswith("decimal") else f"v {kind}").withColumn("v", F.col("v").cast(kind))
    d = D.fit_dictionary(df, "v")
    distinct = [r["v"] for r in df.select(D._value(df, "v").alias("v")).distinct().filter("v IS NOT NULL").orderBy("v").collect()]
    want = {v: i for i, v in enumerate(distinct)}
    assert {k: c for k, c in _codes(d).items() if k is not None} == want
    has_null = any(v is None or v != v for v in values)
    assert d.n_values == len(want) and d.null_code == (len(want) if has_null else None)
    own = d.with_code(df, "code", null="own").collect()
    assert len(own) == len(values) and all(r["code"] >= 0 for r in own)
    plain = d.with_code(df, "code").collect()
    assert all((r["code"] == -1) == (r["v"] is None or r["v"] != r["v"]) for r in plain)


def test_many_values_many_partitions_and_a_hot_one(spark):
    n = 60_000
    df = spark.range(0, 2 * n, 1, 13).select(
        "id", F.when(F.col("id") % 3 == 0, 11).otherwise((F.col("id") * 7919) % n).alias("v"))
    d = D.fit_dictionary(df, "v")
    values = sorted({11} | {(i * 7919) % n for i in range(2 * n) if i % 3})
    assert _codes(d) == {v: i for i, v in enumerate(values)} and d.size == len(values)
    assert d.heavy == [(11, values.index(11))]
    coded = d.with_code(df.unionByName(spark.range(1).select((F.col("id") - 1).alias("id"), F.lit(-7).cast("long").alias("v"))), "c")
    assert coded.filter("v = -7 AND c = -1").count() == 1
    assert coded.join(d.table, coded.v == d.table.value).filter(F.col("c") != F.col("code")).count() == 0
    assert coded.count() == 2 * n + 1


def test_hot_rows_are_dealt_to_all_tasks(spark):
    df = spark.range(0, 40_000, 1, 8).select("id", F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("v"))
    d = D.fit_dictionary(df, "v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in d.with_code(df, "c").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(sizes) == 8 and max(sizes) < 1.3 * 40_000 / 8


def test_clashing_column_names(spark):
    df = spark.createDataFrame([(1, "x", 3, "a"), (2, "y", 4, "b")], "code long, _dict_value string, _dict_salt long, value string")
    got = D.fit_dictionary(df, "value").with_code(df, "value").orderBy("code").collect()
    assert [tuple(r) for r in got] == [(1, "x", 3, 0), (2, "y", 4, 1)]


def test_encoders_go_on_with_a_table(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, *map(str, range(40))]), rng.choice("ab")) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, many string, few string")
    small, big = (R.OrdinalEncoder({"many": None, "few": None}, literals=m).fit(df) for m in (1000, 10))
    assert not small.tables and set(big.tables) == {"many"}
    key = lambda m: sorted(map(tuple, m.transform(df).select("id", "many", "few").collect()))
    assert key(small) == key(big)
    with pytest.raises(ValueError, match="join"):
        big.columns()

    for drop in (False, True):
        wide = R.OneHotEncoder(["many", "few"], drop_first=drop).fit(df)
        table = R.OneHotEncoder(["many", "few"], drop_first=drop, literals=10).fit(df)
        names = [n for n in wide.output_columns() if n.startswith("many_")]
        want = {r["id"]: [r[n] for n in names] for r in wide.transform(df).collect()}
        got = table.transform(df)
        assert set(got.columns) == {"id", "many_onehot"} | {n for n in wide.output_columns() if n.startswith("few_")}
        assert {r["id"]: r["many_onehot"].toArray().tolist() for r in got.collect()} == want
        slots = {r["slot"]: r["name"] for r in table.tables["many"].one_hot_names(drop).collect()}
        assert [slots[i] for i in range(len(slots))] == names

    unseen = spark.createDataFrame([(0, "never", "a")], "id long, many string, few string")
    assert R.OneHotEncoder(["many"], literals=10).fit(df).transform(unseen).first()["many_onehot"].numNonzeros() == 0
    with pytest.raises(Exception, match="unknown category"):
        R.OneHotEncoder(["many"], handle_unknown="error", literals=10).fit(df).transform(unseen).collect()


# --- inference ------------------------------------------------------------

CASES = {
    "whole": (["1", "-2", "+3", "NA", " 4 "], "long", 0),
    "huge": (["1", "99999999999999999999"], "double", 0),
    "number": (["1", "2.5", "1e3", ".5", "inf"], "double", 0),
    "truth": (["True", "false", "TRUE"], "boolean", 0),
    "day": (["2020-02-29", "1999-01-01"], "date", 0),
    "no_day": (["2020-02-30", "1999-01-01", "1999-01-02"], "string", 1),
    "moment": (["2020-02-29", "2020-02-29 12:00", "2020-02-29T12:00:01.5"], "timestamp", 0),
    "mixed": (["1", "2", "three", "2.5"], "string", 1),
    "words": (["a", "b"], "string", 0),
    "truth_and_number": (["true", "1"], "string", 1),
    "missing": (["NA", "None", None, ""], "double", 0),
}


@pytest.mark.parametrize("name", CASES)
def test_inferred_types(spark, name):
    values, inferred, conflicts = CASES[name]
    got = type_profile(spark.createDataFrame([(v,) for v in values], "`a.b` string")).first()
    assert (got["column"], got["inferred"], got["n_conflicts"]) == ("a.b", inferred, conflicts)
    assert got["n_rows"] == len(values) and (got["conflict"] is None) == (conflicts == 0)


def test_inference_merges_over_any_partitioning(spark):
    text = spark.range(1000).select(F.when(F.col("id") == 999, "x").otherwise(F.col("id").cast("string")).alias("late"),
                                    F.when(F.col("id") == 0, "0.5").otherwise("7").alias("early"))
    for n in (1, 7):
        got = {r["column"]: (r["inferred"], r["n_long"], r["conflict"]) for r in type_profile(text.repartition(n)).collect()}
        assert got == {"late": ("string", 999, "x"), "early": ("double", 999, None)}


def test_read_with_inferred_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Id,1stFlr,Name,Empty\n1,856,"a, ""b""",NA\n2,NA,NA,\n3,12.5,c,None\n')
    df = infer_csv(spark, str(tmp_path / "a.csv"))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("Id", "bigint"), ("1stFlr", "double"), ("Name", "string"), ("Empty", "double")]
    assert [tuple(r) for r in df.orderBy("Id").collect()] == [(1, 856.0, 'a, "b"', None), (2, None, None, None), (3, 12.5, "c", None)]
    (tmp_path / "b.csv").write_text("x,y\n")
    assert infer_csv(spark, str(tmp_path / "b.csv")).columns == ["x", "y"]
    assert infer_csv(spark, str(tmp_path / "b.csv")).count() == 0
    (tmp_path / "c.tsv").write_text("1\tx\n2\ty\n")
    assert [tuple(r) for r in infer_csv(spark, str(tmp_path / "c.tsv"), sep="\t", header=False).orderBy("_c0").collect()] == [(1, "x"), (2, "y")]
