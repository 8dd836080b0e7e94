"""Inputs beyond the given tables: null keys, quoted fields, infinities,
repeated keys, wide ranges, unknown categories."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabreg.functions.attach import attach
from tabreg.operators import frames, models, prep, profile
from tabreg.sources.text import read_csv


def _quantile(values, p, linear):
    values = sorted(values)
    if not linear:
        return values[max(1, math.ceil(p * len(values))) - 1]
    h = (len(values) - 1) * p
    low, high = values[math.floor(h)], values[math.ceil(h)]
    return low if low == high else low + (high - low) * (h - math.floor(h))


@pytest.mark.parametrize("linear", [False, True])
def test_quantiles_of_wide_ranges_ties_and_infinities(spark, linear):
    groups = {"log": [10.0 ** (i % 300 - 150) * (1 + i) for i in range(400)],
              "ties": [5.0] * 380 + [float(i) for i in range(20)],
              "inf": [float(i) for i in range(300)] + [math.inf] * 40 + [-math.inf],
              None: [float(i * i) for i in range(200)], "one": [3.0]}
    df = spark.createDataFrame([(g, x) for g, v in groups.items() for x in v], "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = profile.exact_quantiles(df, "x", probs, ["g"], buckets=16, final_rows=60, linear=linear).collect()
    assert len(got) == len(groups)
    for r in got:
        for i, p in enumerate(probs):
            want = _quantile(groups[r["g"]], p, linear)
            assert r[f"q{i}"] == want or math.isclose(r[f"q{i}"], want, rel_tol=1e-12)


def test_quantile_rounds_keep_the_partition_count(spark, monkeypatch):
    import tabreg.session as S
    seen = []
    plain = S.cut_lineage
    monkeypatch.setattr(S, "cut_lineage", lambda df: seen.append(df.rdd.getNumPartitions()) or plain(df))
    df = spark.createDataFrame([(2.0 ** i,) for i in range(-60, 60)], "x double")
    profile.exact_quantiles(df, "x", [0.1, 0.9], buckets=4, final_rows=20)
    assert len(seen) > 4 and max(seen) <= 8


def test_box_summary_and_attach_keep_null_groups(spark):
    df = spark.createDataFrame([(g, float(i)) for g in ("a", None) for i in range(50)], "g string, x double")
    box = {r["g"]: r for r in profile.box_summary(df, "x", ["g"]).collect()}
    assert set(box) == {"a", None} and box[None]["median"] == box["a"]["median"]
    small = spark.createDataFrame([(None, 1), ("a", 2)], "g string, v int")
    for limit in (10, 1):
        got = attach(df, small, ["g"], ["v"], max_rows=limit).groupBy("g", "v").count().collect()
        assert sorted(map(str, got)) == sorted(["Row(g='a', v=2, count=50)", "Row(g=None, v=1, count=50)"])


def test_csv_quotes_line_breaks_and_bad_records(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('id,name,x\n1,"say ""hi"", ok",2.5\n2,"two\nlines",NA\n3,plain,abc\n4,short\n')
    schema = T.StructType().add("id", "integer").add("name", "string").add("x", "double")
    got = read_csv(spark, str(path), schema, multi_line=True, corrupt_column="bad").orderBy("id").collect()
    assert [(r["id"], r["name"], r["x"]) for r in got] == [
        (1, 'say "hi", ok', 2.5), (2, "two\nlines", None), (3, "plain", None), (4, "short", None)]
    assert [r["bad"] is not None for r in got] == [False, False, True, True]
    with pytest.raises(Exception):
        read_csv(spark, str(path), schema, multi_line=True, malformed="fail").collect()


def test_unknown_category_is_an_error_and_names_are_unique(spark):
    train = spark.createDataFrame([("a",), ("nan",), (None,)], "c string")
    strict = prep.OneHotEncoder(["c"], handle_unknown="error").fit(train)
    names = strict.output_columns()
    assert len(set(names)) == 3
    assert sorted(tuple(r) for r in strict.transform(train).collect()) == [(0.0, 0.0, 1.0), (0.0, 1.0, 0.0), (1.0, 0.0, 0.0)]
    with pytest.raises(Exception, match="unknown category"):
        strict.transform(spark.createDataFrame([("zz",)], "c string")).collect()


def test_keyed_concat_rejects_repeated_keys(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "k int, a string")
    b = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, b double")
    with pytest.raises(Exception, match="repeated key"):
        frames.keyed_concat([a, b], ["k"]).collect()
    assert frames.keyed_concat([a.limit(1), b], ["k"]).count() == 2


def test_depth_beyond_the_limit_is_an_error():
    for build in (models.decision_tree, lambda d: models.random_forest(max_depth=d), lambda d: models.gbt(max_depth=d)):
        with pytest.raises(ValueError):
            build(50)
