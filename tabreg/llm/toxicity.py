"""Toxicity as ordinal regression with cumulative links.

Severity grades 0 (none) to ``GRADES - 1`` are ordered; one weight vector is
shared by all thresholds: P(grade <= k) = sigmoid(threshold_k - w x). The
features x are sparse: log(1 + count) of words, and of word beginnings of
``PREFIXES`` bytes (inflected and compound words), that tell toxic from other
labelled documents. The result is the expected severity, sum of P(grade > k).

Labels say toxic or not; the grade of a toxic document follows from how many
hits of telling features it has, in thirds of the sample's toxic documents, so
thresholds are learned from graded data. Fitted on a bounded sample of labelled documents: about
``sample_rows`` toxic and ``sample_rows`` other documents, by hash, dealt evenly
to strata of languages (hashes of ``lang``), so a rare language has its rows.
Features are chosen in each stratum by a likelihood-ratio test and dealt evenly
too. In the fit a stratum counts as its sampled rows, toxic to others as among
all its labels.

Defined cases: a null or empty text has no features. Null labels are left
out. Without both kinds of labels every severity is 0. Several labels of one
document count each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.common import stored

GRADES = 4
PREFIXES = (4, 5, 6, 7, 8)
STRATA = 64
#: Least likelihood-ratio statistic of a feature: one in a thousand by chance.
#: Noise that passes is left to the regression's penalty.
LEAST_RATIO = 10.83
LEAST_DOCS = 3
#: Features that each stratum can have at least.
STRATUM_FEATURES = 60
#: The penalty on all rows: more rows outweigh it, so rare words keep their weight.
PRIOR = 0.4
#: Keeps lower-cased ASCII letters and bytes above 127, blanks out all else.
_LETTERS = bytes(b | 32 if 65 <= b <= 90 or 97 <= b <= 122 else b if b > 127 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8").translate(_LETTERS).split()


def features(word: bytes) -> list[bytes]:
    """A word, and its beginnings, marked by a star."""
    return [word, *(word[:k] + b"*" for k in PREFIXES if len(word) > k)]


@dataclass
class CumulativeLink:
    features: dict[bytes, float]  # feature -> weight
    thresholds: np.ndarray        # ascending, GRADES - 1

    def __post_init__(self):
        # a word with a feature begins with that feature's first bytes
        self.starts = {f.rstrip(b"*")[:PREFIXES[0]] for f in self.features}

    def score(self, text: str | None) -> float:
        counts: dict[bytes, int] = {}
        short, starts = PREFIXES[0], self.starts
        for w in [w for w in words(text) if w[:short] in starts]:
            for f in features(w):
                if f in self.features:
                    counts[f] = counts.get(f, 0) + 1
        return sum(self.features[f] * np.log1p(c) for f, c in counts.items())

    def above(self, eta: np.ndarray) -> np.ndarray:
        """(documents, GRADES - 1): P(grade > k)."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - eta[:, None], -40, 40)))


def train(x: np.ndarray, grade: np.ndarray, weight: np.ndarray, l2: float = 1e-3,
          steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """(w, thresholds) by Adam on the weighted log-likelihood. Thresholds are
    a first value and positive steps, which keeps them ordered."""
    m = GRADES - 1
    p = np.zeros(x.shape[1] + m)
    p[-m:] = [1.0, *np.full(m - 1, np.log(1.0))]
    first, second = np.zeros_like(p), np.zeros_like(p)
    weight = weight / weight.sum()
    rows = np.arange(len(x))
    for step in range(1, steps + 1):
        w, t = p[:-m], np.cumsum(np.concatenate([p[-m:-m + 1], np.exp(p[-m + 1:])]))
        c = 1 / (1 + np.exp(np.clip((x @ w)[:, None] - t[None, :], -40, 40)))  # P(grade <= k)
        c = np.hstack([np.zeros((len(x), 1)), c, np.ones((len(x), 1))])
        prob = np.maximum(c[rows, grade + 1] - c[rows, grade], 1e-12)
        slope = c * (1 - c)
        up, low = weight * slope[rows, grade + 1] / prob, weight * slope[rows, grade] / prob
        g_t = np.zeros(m + 2)
        np.add.at(g_t, grade + 1, -up)
        np.add.at(g_t, grade, low)
        g_t = np.cumsum(g_t[1:-1][::-1])[::-1]  # a step moves all thresholds above
        g = np.concatenate([x.T @ (up - low) + l2 * w, g_t[:1], g_t[1:] * np.exp(p[-m + 1:])])
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        p -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
    return p[:-m], np.cumsum(np.concatenate([p[-m:-m + 1], np.exp(p[-m + 1:])]))


def _rates(counts: dict[int, int], rows: int) -> dict[int, float]:
    """The part of each stratum to draw: ``rows`` dealt evenly, what a small
    stratum leaves goes to the others."""
    rates, left = {}, rows
    for i, (k, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        take = min(n, left / (len(counts) - i))
        rates[k], left = take / n, left - take
    return rates


def _ratio(t: Column, c: Column, n1: Column, n0: Column) -> Column:
    """Likelihood-ratio statistic (G) of a feature in t of n1 toxic and c - t
    of n0 other documents."""
    n = n1 + n0
    cells = ((t, c * n1), (c - t, c * n0), (n1 - t, (n - c) * n1), (n0 - c + t, (n - c) * n0))
    return 2 * sum(F.when(o > 0, o * F.log(o * n / e)).otherwise(F.lit(0.0)) for o, e in cells)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample_rows: int = 3000, max_features: int = 500,
        seed: int = 3, lang_col: str = "lang") -> CumulativeLink | None:
    spark = docs.sparkSession
    stratum = F.pmod(F.xxhash64(lang_col), F.lit(STRATA)).cast("int") if lang_col in docs.columns else F.lit(0)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), stratum.alias("s"))
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("y")).agg(F.count("*").alias("m"))
    known = stored(known.join(texts.select("id", "s").distinct(), "id"), "toxicity-labels")
    counts = known.groupBy("s", "y").agg(F.count("*").alias("n"), F.sum("m").alias("m")).collect()
    if len({r["y"] for r in counts}) < 2:
        return None
    total = {(r["s"], r["y"]): r["m"] for r in counts}
    rate = {(k, y): v for y in (0, 1)
            for k, v in _rates({r["s"]: r["n"] for r in counts if r["y"] == y}, sample_rows).items()}
    rates = spark.createDataFrame([(*k, float(v)) for k, v in rate.items()], "s int, y int, rate double")
    u = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 31)) / F.lit(float(1 << 31))
    sample = spark.createDataFrame(
        known.join(rates, ["s", "y"]).filter(u < F.col("rate")).select("id", "s", "y", "m").collect(),
        "id long, s int, y int, m long")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for s, y, m, text in zip(pdf["s"], pdf["y"], pdf["m"], pdf["text"]):
                bag = Counter(f for w in words(text if isinstance(text, str) else "") for f in features(w))
                # bytes as Latin-1: a beginning may end within a character
                rows.append((s, y, m, [x.decode("latin-1") for x in bag], list(bag.values())))
            yield pd.DataFrame(rows, columns=["s", "y", "m", "words", "n"])

    # about 2 * sample_rows ids at most: a bound for the broadcast
    bags = texts.join(F.broadcast(sample), ["id", "s"]).select("s", "y", "m", "text").mapInPandas(
        counted, "s int, y int, m long, words array<string>, n array<long>").persist()
    try:
        drawn = {(r["s"], r["y"]): r["m"] for r in bags.groupBy("s", "y").agg(F.sum("m").alias("m")).collect()}
        if len({y for _, y in drawn}) < 2:
            return None
        strata = sorted({k for k, _ in drawn})
        sizes = spark.createDataFrame([(k, float(drawn.get((k, 1), 0)), float(drawn.get((k, 0), 0))) for k in strata],
                                      "s int, n1 double, n0 double").filter("n1 > 0 and n0 > 0")
        # words that are significantly more frequent in a stratum's toxic documents, or less
        turn = Window.partitionBy("s").orderBy(F.desc("ratio"), "word")
        limit = max(max_features, STRATUM_FEATURES * len(strata))
        found = (bags.select("s", "y", "m", F.explode("words").alias("word")).groupBy("s", "word")
                 .agg(F.sum(F.col("y") * F.col("m")).alias("t"), F.sum("m").alias("c"))
                 .filter(F.col("c") >= LEAST_DOCS).join(sizes, "s")
                 .withColumn("ratio", _ratio(*[F.col(x) for x in ("t", "c", "n1", "n0")]))
                 .filter(F.col("ratio") > LEAST_RATIO)
                 .withColumn("turn", F.row_number().over(turn))
                 .withColumn("more", F.col("t") * F.col("n0") > (F.col("c") - F.col("t")) * F.col("n1"))
                 .orderBy("turn", F.desc("ratio"), "word").limit(limit).select("word", "more").collect())
        if not found:
            return None
        names = list(dict.fromkeys(r["word"] for r in found))
        telling = {r["word"] for r in found if r["more"]}
        at = {w: i for i, w in enumerate(names)}

        def hit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                own = [[(at[w], k) for w, k in zip(ws, ns) if w in at] for ws, ns in zip(pdf["words"], pdf["n"])]
                yield pdf[["s", "y", "m"]].assign(at=[[i for i, _ in x] for x in own], n=[[k for _, k in x] for x in own])

        rows = bags.mapInPandas(hit, "s int, y int, m long, at array<int>, n array<long>").collect()
    finally:
        bags.unpersist()
    x, hits, y = np.zeros((len(rows), len(names))), np.zeros(len(rows)), np.array([r["y"] for r in rows])
    for i, r in enumerate(rows):
        for j, n in zip(r["at"], r["n"]):
            x[i, j] = np.log1p(n)
            hits[i] += n if names[j] in telling else 0
    steps = np.quantile(hits[y > 0], np.arange(1, GRADES - 1) / (GRADES - 1))
    grade = np.where(y > 0, 1 + (hits[:, None] > steps).sum(1), 0)
    both = {k: (sum(drawn.get((k, v), 0) for v in (0, 1)), sum(total.get((k, v), 0) for v in (0, 1))) for k in strata}
    weight = np.array([r["m"] * total[r["s"], r["y"]] / drawn[r["s"], r["y"]] * both[r["s"]][0] / both[r["s"]][1]
                       for r in rows])
    w, thresholds = train(x, grade, weight, l2=PRIOR / len(rows))
    return CumulativeLink({n.encode("latin-1"): float(v) for n, v in zip(names, w)}, thresholds)


def predict(docs: DataFrame, model: CumulativeLink | None, id_col: str = "doc_id",
            text_col: str = "text", flag_at: float = 0.5) -> DataFrame:
    """(id, expected_severity, grade, p_toxic, toxic) of every row; a document
    is toxic where P(grade > 0) is ``flag_at`` or more."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if model is None:
                above = np.zeros((len(pdf), GRADES - 1))
            else:
                above = model.above(np.array([model.score(t if isinstance(t, str) else "") for t in pdf["text"]]))
            yield pd.DataFrame({
                id_col: pdf["id"], "expected_severity": above.sum(1),
                "grade": (above >= 0.5).sum(1).astype(np.int32), "p_toxic": above[:, 0],
                "toxic": above[:, 0] >= flag_at})

    schema = docs.select(F.col(id_col)).schema
    for name, kind in (("expected_severity", "double"), ("grade", "integer"), ("p_toxic", "double"), ("toxic", "boolean")):
        schema = schema.add(name, kind)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInPandas(run, schema)
