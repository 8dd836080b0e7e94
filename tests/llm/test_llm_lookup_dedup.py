"""Token lookup by places of a segment; which of equal rows stays; the language sample."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.llm import dac, exact_dedup, langid, queries


def test_many_places_of_one_segment(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(120)
    folder = dac.write(docs, queries.tokenizer("word_bpe_49k.json"), 2)
    seg = max(dac.segments(spark, folder).collect(), key=lambda r: r["n_ids"])
    tokens, n = dac.Segment(bytes(seg["data"])).tokens(), seg["n_ids"]
    spots = np.random.default_rng(0).integers(0, n, 5000)
    assert (dac.Segment(bytes(seg["data"])).tokens_at(spots) == tokens[spots]).all()
    assert [dac.Segment(bytes(seg["data"])).token(int(i)) for i in spots[:50]] == tokens[spots[:50]].tolist()
    # int places, repeated ones, and places that the segment doesn't have
    asked = spark.range(100_000).select(F.lit(seg["part"]).alias("part"), F.lit(seg["seg"]).alias("seg"),
                                        (F.pmod(F.col("id") * 7919, F.lit(n + 3)) - 1).cast("int").alias("place"))
    t = time.time()
    found = dac.read_tokens(spark, folder, asked).collect()
    assert time.time() - t < 30 and len(found) == 100_000
    assert all(r["token"] == (tokens[r["place"]] if 0 <= r["place"] < n else None) for r in found)
    assert dac.read_tokens(spark, folder, asked.limit(0)).collect() == []


def test_the_same_of_equal_rows_stays_on_every_run(spark):
    rows = [(1, "a b", "s2"), (1, "a b", "s1"), (1, "b a", "s1"), (1, " ab", "s3"), (1, "ab ", "s3"), (None, "x", "q"), (None, "x", "p"),
            (2, "a b", "s0"), (3, "ab", "s9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [sorted(map(tuple, exact_dedup.kept_documents(docs.repartition(n, "source", "text")).collect()), key=repr) for n in (1, 3, 7)]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 3
    assert {r[1].replace(" ", "") for r in kept[0]} == {"ab", "ba", "x"}


def test_a_hot_text_is_kept_once(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot text").otherwise(
        F.concat(F.lit("text "), "id")).alias("text"))
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == 3000 and sum(r["kept"] for r in got) == 2001
    assert {r["keep_id"] for r in got if r["group_size"] == 1000} == {0}
    assert [r["id"] for r in got if r["kept"] and r["group_size"] == 1000] == [0]


def test_language_sample_is_the_least_hashes(spark, monkeypatch):
    rows = spark.range(9000).select("id", F.concat(F.lit("text of "), "id").alias("text"),
                                    F.when(F.col("id") % 50 == 0, "rare").otherwise("common").alias("lang"))
    seen = {}
    monkeypatch.setattr(langid, "train", lambda windows, labels, languages, *a, **k: seen.update(
        windows=windows, labels=labels, languages=languages))
    langid.fit(rows, sample_docs=300)
    assert seen["languages"] == ["common", "rare"]
    assert np.bincount(seen["labels"]).tolist() == [300 * langid.SAMPLE_WINDOWS, 180 * langid.SAMPLE_WINDOWS]
    least = rows.filter("lang = 'common'").orderBy(F.xxhash64("id", F.lit(1)), "id").limit(300).collect()
    texts = {bytes(w).split(b" text")[0].strip() for w, y in zip(seen["windows"], seen["labels"]) if y == 0}
    assert texts == {r["text"].encode() for r in least}
    assert langid.fit(rows.limit(0)) is None
