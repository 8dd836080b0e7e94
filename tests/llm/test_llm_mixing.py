"""Exponents of the mixture: halfway targets, targets below the sources' own entropy."""

import math
import warnings

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabreg.llm import mixing


def _sources(spark, tokens):
    return spark.createDataFrame([(f"s{i}", 1, t) for i, t in enumerate(tokens)], "source string, n_docs long, tokens long")


def _state(tokens, a):
    w = [(t / sum(tokens)) ** a for t in tokens]
    w = [x / sum(w) for x in w]
    return -sum(x * math.log(x) for x in w if x) / math.log(len(w)), max(x * sum(tokens) / t for x, t in zip(w, tokens))


@pytest.mark.parametrize("target", [0.95, 0.9, 0.7, 0.4, 0.1])
def test_exponent_meets_the_entropy_on_both_sides_of_one(spark, target):
    tokens = [1000, 500, 400, 300, 100, 7]
    own = _state(tokens, 1.0)[0]
    with warnings.catch_warnings():
        warnings.filterwarnings("error", message="mixing")
        a, z = mixing.fit_exponent(_sources(spark, tokens), target_entropy=target, most=64.0)
    assert abs(_state(tokens, a)[0] - target) < 1e-6 and (a > 1) == (target < own)
    assert abs(z - sum((t / sum(tokens)) ** a for t in tokens)) < 1e-9


def test_repetition_limit_beyond_one(spark):
    tokens = [1000, 500, 400, 300, 100, 7]
    with pytest.warns(UserWarning, match="out of reach"):
        a, _ = mixing.fit_exponent(_sources(spark, tokens), target_entropy=0.1, max_repeats=1.5, most=64.0)
    assert a > 1 and abs(_state(tokens, a)[1] - 1.5) < 1e-6
    with pytest.warns(UserWarning, match="out of reach"):  # the largest sources are alike
        a, _ = mixing.fit_exponent(_sources(spark, [50, 50, 1]), target_entropy=0.3, most=16.0)
    assert a == 16.0


def test_halfway_mixes_nearly_equal_sources(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a word or two").alias("text"),
                                    F.concat(F.lit("s"), F.least(F.col("id") % 21, F.lit(19))).alias("source"))
    rows = mixing.rows_of(docs)
    with warnings.catch_warnings():
        warnings.filterwarnings("error", message="mixing")
        plan = mixing.schedule(rows, budget_epochs=1.0, target_entropy=mixing.HALFWAY, max_repeats=2.0)
    n = {r["source"]: r["count"] for r in docs.groupBy("source").count().collect()}
    a, _ = mixing.fit_exponent(mixing.source_table(rows), target_entropy=mixing.halfway_entropy(mixing.source_table(rows)))
    assert 0.3 < a < 0.95
    epochs = {r["source"]: r["epochs"] for r in plan.select("source", "epochs").distinct().collect()}
    assert epochs["s19"] == min(epochs.values()) < 0.9 and max(epochs.values()) <= 2.0 and set(epochs) == set(n)


def test_pipeline_mix_reweights_the_given_sources(spark):
    for sf in ("sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        sources = mixing.source_table(mixing.rows_of(docs)).cache()
        total = float(sources.agg(F.sum("tokens")).first()[0])
        with warnings.catch_warnings():
            warnings.filterwarnings("error", message="mixing")
            a, _ = mixing.fit_exponent(sources, total, mixing.halfway_entropy(sources), 2.0)
            mixed = corpus_pipeline.mix(spark, docs, "")
        assert a < 0.95
        if sf == "sf0.01":
            assert mixed.columns == docs.columns and 0.9 * docs.count() < mixed.count() < 1.1 * docs.count()
