import os
import tempfile

import pytest
from pyspark.sql import types as T

from tabreg.operators import frames as J
from tabreg.sources.text import read_csv, read_training_log


def test_keyed_concat_is_outer(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, x double")
    b = spark.createDataFrame([(2, "b"), (3, "c")], "k int, s string")
    out = sorted(tuple(r) for r in J.keyed_concat([a, b], ["k"]).collect())
    assert out == [(1, 1.0, None), (2, 2.0, "b"), (3, None, "c")]


def test_drop_unknown_column_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(KeyError):
        J.drop_columns(df, ["b"])


def test_lookup_trims_codes_and_anti_join(spark):
    d = J.dictionary_frame(spark, [("t", "WD ", "Warranty deed")])
    df = spark.createDataFrame([("WD",), ("New",)], "t string")
    got = {r.t: r.t_meaning for r in J.lookup(df, "t", d).collect()}
    assert got == {"WD": "Warranty deed", "New": None}
    assert [r.code for r in J.out_of_domain(df, ["t"], d).collect()] == ["New"]


def test_csv_null_tokens(spark):
    folder = tempfile.mkdtemp(prefix="tabreg-test-")
    path = os.path.join(folder, "h.csv")
    with open(path, "w") as f:
        f.write("id,MasVnrType,LotFrontage,1stFlrSF\n1,None,NA,856\n2,BrkFace,65,\n3,NA,80.5,1262\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("MasVnrType", T.StringType()),
                           T.StructField("LotFrontage", T.DoubleType()), T.StructField("1stFlrSF", T.DoubleType())])
    rows = [tuple(r) for r in read_csv(spark, path, schema).orderBy("id").collect()]
    assert rows == [(1, None, None, 856.0), (2, "BrkFace", 65.0, None), (3, None, 80.5, 1262.0)]


def test_training_log_tsv(spark):
    folder = tempfile.mkdtemp(prefix="tabreg-test-")
    path = os.path.join(folder, "learn_error.tsv")
    with open(path, "w") as f:
        f.write("iter\tRMSE\n0\t70287.73361\n1\t68000.5\n")
    rows = [tuple(r) for r in read_training_log(spark, path).orderBy("iter").collect()]
    assert rows == [(0, 70287.73361), (1, 68000.5)]


def test_literal_dictionary_is_bounded(spark):
    n = J.MAX_DICTIONARY_ROWS + 1
    with pytest.raises(ValueError):
        J.dictionary_frame(spark, [("c", str(i), "m") for i in range(n)])
