"""Winnowing fingerprints, in DataFrame functions only.

Every run of ``k`` words (white space parts words) gets a rolling hash: a
cyclic polynomial, the words' 64-bit hashes rotated by their place in the run
and combined by exclusive or, so that the next hash follows from the last.
Of each window of ``window`` hashes the smallest is chosen, of equal ones the
rightmost; a hash chosen by several windows counts once, with its position.
Two texts that share ``window + k - 1`` words in a row share a fingerprint.

Minima are found by doubling: windows of 1, 2, 4, ... hashes, each from two
of the size before. A hash keeps 60 bits; the low four hold 15 minus the
place in the window, which makes the rightmost of equal hashes the smallest.

Defined cases: a null text is empty and has no hash; a text of fewer than
``k`` words has one hash, of all its words; one with fewer hashes than a
window is one window. Likeness is the Jaccard index of the sets of hashes;
two texts without any hash have likeness 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.llm.common import ASCII_SPACE, text_or_empty

MARK = 15  # fixed value: the four low bits of a packed hash


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(text, f"{ASCII_SPACE}+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _rotated(h: Column, by: int) -> Column:
    if not by:
        return h
    return F.shiftleft(h, by).bitwiseOR(F.shiftrightunsigned(h, 64 - by))


def kgram_hashes(hashes: Column, k: int) -> Column:
    """Hash of every run of ``k`` words; of all words where they are fewer."""
    def run(first: Column) -> Column:
        out = None
        for j in range(k):
            term = _rotated(F.get(hashes, first + j), 7 * (k - 1 - j) % 64)
            out = term if out is None else out.bitwiseXOR(term)
        return out.bitwiseAND(F.lit(~MARK))
    n = F.size(hashes)
    return (F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), run))
            .when(n > 0, F.array(F.xxhash64(hashes).bitwiseAND(F.lit(~MARK))))
            .otherwise(F.array().cast("array<long>")))


def _doubled(packed: Column, half: int) -> Column:
    """Minima of windows of ``2 * half`` from those of ``half``; past the end
    a window takes what is there."""
    return F.transform(packed, lambda h, i: F.least(h, F.coalesce(F.get(packed, i + half) - half, h)))


def _chain(df: DataFrame, text: Column, prefix: str, k: int, window: int) -> DataFrame:
    """Adds ``{prefix}``: array of (hash, position) in text order.

    Each step is a column of its own, since a lambda would otherwise compute
    the array it indexes anew for each element.
    """
    w, g, m = (f"__{prefix}_{x}" for x in ("w", "g", "m"))
    df = df.withColumn(w, word_hashes(text))
    df = df.withColumn(g, kgram_hashes(F.col(w), k))
    df = df.withColumn(m, F.transform(F.col(g), lambda h: h.bitwiseOR(F.lit(MARK))))
    half = 1
    while half < window:
        df = df.withColumn(f"{m}{half}", _doubled(F.col(m), half))
        m, half = f"{m}{half}", half * 2
    # whole windows only; a text with fewer hashes is one window
    whole = F.greatest(F.size(g) - (window - 1), F.least(F.size(g), F.lit(1)))
    at = f"__{prefix}_at"
    df = df.withColumn(at, F.array_distinct(F.transform(
        F.slice(F.col(m), 1, whole), lambda h, i: i + MARK - h.bitwiseAND(F.lit(MARK)).cast("int"))))
    return df.withColumn(prefix, F.transform(F.col(at), lambda p: F.struct(
        F.get(F.col(g), p).alias("hash"), p.alias("position"))))


def fingerprints(docs: DataFrame, text: Column | None = None, out: str = "fingerprint",
                 k: int = 4, window: int = 8) -> DataFrame:
    """``docs`` with ``out``: the chosen (hash, position) pairs of each text."""
    if window not in (2, 4, 8, 16):
        raise ValueError("window is 2, 4, 8 or 16")
    names = docs.columns
    done = _chain(docs, text_or_empty() if text is None else text, "wn", k, window)
    return done.select(*[F.col(f"`{c}`") for c in names], F.col("wn").alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of different hashes."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def hash_set(fingerprint: Column) -> Column:
    return F.array_distinct(fingerprint["hash"])


def digest(fingerprint: Column) -> Column:
    """Hexadecimal SHA-256 of the pairs ``hash:position``."""
    return F.sha2(F.array_join(F.transform(fingerprint, lambda x: F.concat_ws(
        ":", F.hex(x["hash"]), x["position"].cast("string"))), ","), 256)


def with_next(docs: DataFrame, columns: list[str], id_col: str = "doc_id",
              buckets: int | None = None) -> DataFrame:
    """``docs`` with ``next``: the struct of ``columns`` of the next document by
    ascending id (nulls first, ties by the columns); after the last, the first.

    Documents are dealt to buckets of consecutive ids, whose bounds are ids of
    the table (quantiles: a number of values set by the partitions, not the
    data). The first document of each bucket also goes to the bucket before,
    so every document meets its next one in a window of its bucket.
    """
    spark = docs.sparkSession
    n = buckets or max(8, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.col(id_col)
    seen = docs.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 20 * n).alias("q"),
                    F.min(key).alias("low"), F.max(F.struct(key.isNull().alias("x"))).alias("nulls")).first()
    low = seen["low"]
    bounds = sorted({b for b in (seen["q"] or []) if b != low})
    has_null = bool(seen["nulls"] and seen["nulls"]["x"])
    if has_null and low is not None:
        bounds = [low, *bounds]
    first = None if has_null else low
    coarse = bounds[::32]
    slices = F.array(*[F.array(*[F.lit(b).cast("long") for b in bounds[i:i + 32]]) for i in range(0, len(bounds), 32)]) if bounds else None
    if bounds:
        c = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in coarse]), lambda b: b <= key))
        bucket = F.when(key.isNull() | (c == 0), F.lit(0)).otherwise(
            (c - 1) * 32 + F.size(F.filter(F.get(slices, c - 1), lambda b: b <= key)))
        opens = key.isin(bounds)
    else:
        bucket, opens = F.lit(0), F.lit(False)
    last = len(bounds)
    dealt = docs.withColumn("__bucket", bucket)
    extra = F.when(opens, F.array(F.col("__bucket") - 1)).otherwise(F.array().cast("array<int>"))
    wraps = F.when(key.eqNullSafe(F.lit(first)), F.array(F.lit(last))).otherwise(F.array().cast("array<int>"))
    copies = F.concat(F.array(F.struct(F.col("__bucket").alias("b"), F.lit(0).alias("seg"))),
                      F.transform(extra, lambda b: F.struct(b.alias("b"), F.lit(1).alias("seg"))),
                      F.transform(wraps, lambda b: F.struct(b.alias("b"), F.lit(2).alias("seg"))))
    from pyspark.sql import Window
    order = ["__c.seg", key.asc_nulls_first(), *[F.col(c) for c in columns]]
    w = Window.partitionBy("__c.b").orderBy(*order)
    out = (dealt.withColumn("__c", F.explode(copies))
           .withColumn("next", F.lead(F.struct(*columns)).over(w)))
    return out.filter("__c.seg = 0").drop("__c", "__bucket")
