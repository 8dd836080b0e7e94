"""Data dictionaries as text, and the scan that carries their columns forward."""

import random

import pytest
from pyspark.sql import functions as F

from tabreg.functions.scan import running_last
from tabreg.sources import read_dictionary

TEXT = """preface without a column

Zone: Identifies the zone of the sale.\t

       A\tFarm land
       RL \tResidential,
            low density
       W d\tTwo words
       NA\tNone: no zone\t

Front: Feet along the street
Qual: Rates the work,
  from 10 to 1

        10\tBest\tof all
        9\t
"""

WANT = [
    (None, None, "preface without a column"), ("Zone", None, "Identifies the zone of the sale."), ("Zone", "A", "Farm land"),
    ("Zone", "RL", "Residential, low density"), ("Zone", "W d", "Two words"), ("Zone", "NA", "None: no zone"),
    ("Front", None, "Feet along the street"), ("Qual", None, "Rates the work, from 10 to 1"),
    ("Qual", "10", "Best\tof all"), ("Qual", "9", "")]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("block", [None, 40, 7])
def test_lines_meet_their_column_wherever_a_file_is_split(spark, tmp_path, block):
    (tmp_path / "d.txt").write_text(TEXT)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        if block:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            assert spark.read.text(str(tmp_path / "d.txt")).rdd.getNumPartitions() > 3
        assert _rows(read_dictionary(spark, str(tmp_path / "d.txt"))) == sorted(WANT, key=repr)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty_dictionary(spark, tmp_path):
    (tmp_path / "d.txt").write_text("\n \n")
    assert read_dictionary(spark, str(tmp_path / "d.txt")).collect() == []


@pytest.mark.parametrize("kind", ["string", "long", "double"])
@pytest.mark.parametrize("grouped", [False, True])
def test_running_last_equals_a_loop(spark, kind, grouped):
    rng = random.Random(hash((kind, grouped)) % 100)
    make = {"string": lambda: rng.choice("abc"), "long": lambda: 2 ** 60 + rng.randrange(9), "double": lambda: rng.random()}[kind]
    rows = [(i, rng.choice([None, "x", "y", "y", "y"]), make() if rng.random() < 0.15 else None) for i in range(400)]
    df = spark.createDataFrame(rows, f"i long, g string, v {kind}").repartition(7)
    got = {r["i"]: r["w"] for r in running_last(df, ["i"], "v", "w", ["g"] if grouped else []).collect()}
    last, want = {}, {}
    for i, g, v in rows:
        key = g if grouped else 0
        last[key] = v if v is not None else last.get(key)
        want[i] = last[key]
    assert got == want


def test_running_last_over_many_partitions(spark):
    df = spark.range(5000).select("id", F.when(F.col("id").isin(3, 4000), F.col("id").cast("string")).alias("v"))
    got = running_last(df, ["id"], "v", "w").groupBy("w").count().collect()
    assert {r["w"]: r["count"] for r in got} == {None: 3, "3": 3997, "4000": 1000}
