"""Language identification by a bidirectional GRU over bytes.

Two gated recurrent networks read a text's bytes forwards and backwards; every
position gets the probabilities of all languages, and a document's are the
mean over its positions. Texts are read whole, in windows of ``WINDOW`` bytes
with fresh state (memory is bounded by a batch of windows, however long a text
is). Trained in numpy by backpropagation through time on a bounded sample:
``sample_docs`` labelled documents of each language, by hash, and
``SAMPLE_WINDOWS`` windows of each.

Defined cases: a text that is null or has no letter is ``und`` with score 0.
Null labels are not learned from. Without any labelled document everything is
``und``. Ties go to the language first in alphabetical order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 96
SAMPLE_WINDOWS = 4
BATCH = 2048  # windows computed at once
UNDECIDED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def has_letter(text: str) -> bool:
    """Signs such as a superscript two are neither digits nor letters."""
    return any(c.isalpha() for m in _LETTERS.finditer(text) for c in m[0])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


@dataclass
class BiGru:
    """``x``: input weights of each byte (256, 3H) with biases; ``u``: (H, 3H)."""
    languages: list[str]
    x: list[np.ndarray]
    u: list[np.ndarray]
    v: np.ndarray
    c: np.ndarray

    @property
    def params(self) -> list[np.ndarray]:
        return [*self.x, *self.u, self.v, self.c]

    def states(self, bytes_: np.ndarray, d: int, tape: list | None = None) -> np.ndarray:
        """(T, B, H) states in direction d of byte windows (T, B)."""
        x, u = self.x[d], self.u[d]
        steps, n = bytes_.shape
        size = u.shape[0]
        out = np.empty((steps, n, size), np.float32)
        h = np.zeros((n, size), np.float32)
        for t in (range(steps) if d == 0 else range(steps - 1, -1, -1)):
            a = x[bytes_[t]]
            hu = h @ u
            gates = a[:, :2 * size] + hu[:, :2 * size]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1.0
            np.reciprocal(gates, out=gates)
            z, r = gates[:, :size], gates[:, size:]
            un = hu[:, 2 * size:]
            n_t = np.tanh(a[:, 2 * size:] + r * un)
            if tape is not None:
                tape.append((t, h, z, r, n_t, un))
            h = n_t + z * (h - n_t)
            out[t] = h
        return out

    def position_probabilities(self, bytes_: np.ndarray) -> np.ndarray:
        """(T, B, languages) for byte windows (T, B) of full length."""
        size = self.u[0].shape[0]
        logits = self.states(bytes_, 0) @ self.v[:size] + self.states(bytes_, 1) @ self.v[size:] + self.c
        return _softmax(logits)

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """(documents, languages): probabilities pooled over all bytes."""
        total = np.zeros((len(texts), len(self.languages)))
        size = np.array([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), np.uint8)
        at = np.concatenate([[0], np.cumsum(size)])[:-1]
        full = size // WINDOW
        owner = np.repeat(np.arange(len(texts)), full)
        first = np.concatenate([[0], np.cumsum(full)])[:-1]
        starts = at[owner] + WINDOW * (np.arange(len(owner)) - first[owner])
        for lo in range(0, len(starts), BATCH):
            s = starts[lo:lo + BATCH]
            p = self.position_probabilities(data[s + np.arange(WINDOW)[:, None]]).sum(0)
            np.add.at(total, owner[lo:lo + BATCH], p)
        # the ends of the texts, by their length
        rest = size % WINDOW
        for n in np.unique(rest[rest > 0]):
            docs = np.flatnonzero(rest == n)
            s = at[docs] + size[docs] - n
            total[docs] += self.position_probabilities(data[s + np.arange(n)[:, None]]).sum(0)
        return total / np.maximum(size, 1)[:, None]


def _backward(model: BiGru, bytes_: np.ndarray, d: int, tape: list, dh_out: np.ndarray):
    """Gradients of x and u in direction d by backpropagation through time."""
    x, u = model.x[d], model.u[d]
    size = u.shape[0]
    gx, gu = np.zeros_like(x), np.zeros_like(u)
    carry = np.zeros_like(dh_out[0])
    for t, h, z, r, n_t, un in reversed(tape):
        dh = dh_out[t] + carry
        dn = dh * (1 - z) * (1 - n_t * n_t)
        dz = dh * (h - n_t) * z * (1 - z)
        dr = dn * un * r * (1 - r)
        da = np.concatenate([dz, dr, dn], 1)
        dhu = np.concatenate([dz, dr, dn * r], 1)
        np.add.at(gx, bytes_[t], da)
        gu += h.T @ dhu
        carry = dh * z + dhu @ u.T
    return gx, gu


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], hidden: int = 8,
          steps: int = 160, batch: int = 96, rate: float = 0.02, seed: int = 1) -> BiGru:
    """Fits byte windows (n, T) with language numbers by Adam on the mean
    cross-entropy of all positions."""
    rng = np.random.default_rng(seed)
    k = len(languages)
    model = BiGru(languages, [rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32) for _ in range(2)],
                  [rng.normal(0, 0.3, (hidden, 3 * hidden)).astype(np.float32) for _ in range(2)],
                  rng.normal(0, 0.3, (2 * hidden, k)).astype(np.float32), np.zeros(k, np.float32))
    first = [np.zeros_like(p) for p in model.params]
    second = [np.zeros_like(p) for p in model.params]
    by_language = [np.flatnonzero(labels == i) for i in range(k)]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(own, max(1, batch // k)) for own in by_language])
        b, y = windows[pick].T, labels[pick]
        tapes: list[list] = [[], []]
        h = np.concatenate([model.states(b, 0, tapes[0]), model.states(b, 1, tapes[1])], 2)
        g = _softmax(h @ model.v + model.c)
        g[:, np.arange(len(y)), y] -= 1
        g /= g.shape[0] * g.shape[1]
        dh = g @ model.v.T
        grads = [_backward(model, b, d, tapes[d], dh[:, :, d * hidden:(d + 1) * hidden]) for d in (0, 1)]
        grads = [grads[0][0], grads[1][0], grads[0][1], grads[1][1],
                 np.einsum("tbh,tbk->hk", h, g), g.sum((0, 1))]
        lr = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, q, m, s in zip(model.params, grads, first, second):
            m += 0.1 * (q - m)
            s += 0.01 * (q * q - s)
            p -= (lr * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


def remainder(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3))


def learning_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """Documents to learn from: labelled, and not held out."""
    return docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                       & (remainder(id_col) != 1)).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))


def fit(rows: DataFrame, sample_docs: int = 300, hidden: int = 8, steps: int = 160,
        seed: int = 1) -> BiGru | None:
    """Trains on ``sample_docs`` documents of each ``lang`` (the bound of what
    the driver sees), each with ``SAMPLE_WINDOWS`` windows."""
    # hashes below a bound that half as many again of a language should pass: a filter
    # without any shuffle leaves so few rows that they can be ranked
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    enough = 1.5 * sample_docs + 200
    bound = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (
        lang, float("inf") if n <= enough else 2.0 ** 64 * enough / n - 2.0 ** 63)]), F.col("lang"))
    rank = Window.partitionBy("lang").orderBy("h", "id")
    chosen = (rows.withColumn("h", F.xxhash64("id", F.lit(seed))).filter(F.col("h") < bound)
              .select("lang", "id", "h", *[F.substring(F.col("text"), (1 + F.pmod(F.xxhash64("id", F.lit(i)), F.greatest(
                  F.length("text") - WINDOW + 1, F.lit(1)))).cast("int"), F.lit(WINDOW)).alias(f"w{i}")
                  for i in range(SAMPLE_WINDOWS)])
              .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= sample_docs))
    got = chosen.orderBy("lang", "rank").collect()
    languages = sorted({r["lang"] for r in got})
    windows, labels = [], []
    for r in got:
        for i in range(SAMPLE_WINDOWS):
            b = r[f"w{i}"].encode()[:WINDOW]
            if b:  # a short text is repeated to a whole window
                windows.append(np.resize(np.frombuffer(b + b" ", np.uint8), WINDOW))
                labels.append(languages.index(r["lang"]))
    if not windows:
        return None
    present = sorted(set(labels))
    labels = [present.index(y) for y in labels]
    return train(np.stack(windows), np.array(labels), [languages[i] for i in present], hidden, steps, seed=seed)


def predict(docs: DataFrame, model: BiGru | None, id_col: str = "doc_id", text_col: str = "text",
            carry: list[str] = ()) -> DataFrame:
    """(id, the columns of ``carry``, lang_pred, score) of every row."""
    kept = [id_col, *carry]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for lo in range(0, len(whole), 1000):
                pdf = whole.iloc[lo:lo + 1000]
                texts = [t if isinstance(t, str) else "" for t in pdf["_text"]]
                known = [model is not None and has_letter(t) for t in texts]
                lang, score = np.full(len(pdf), UNDECIDED, object), np.zeros(len(pdf))
                if any(known):
                    where = np.flatnonzero(known)
                    p = model.documents([texts[i].encode() for i in where])
                    best = p.argmax(1)
                    lang[where] = [model.languages[i] for i in best]
                    score[where] = np.clip(p[np.arange(len(best)), best], 0, 1)
                yield pdf.iloc[:, :-1].assign(lang_pred=lang, score=score)

    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*kept, F.col(text_col).cast("string").alias("_text")).mapInPandas(run, schema)


def accepted_documents(docs: DataFrame, model: BiGru | None, min_score: float = 0.5,
                       text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a language, with all their columns: not
    ``und``, and pooled probability of ``min_score`` or more. Without a model
    nothing is rejected but texts without letters."""
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for lo in range(0, len(whole), 1000):
                pdf = whole.iloc[lo:lo + 1000]
                texts = [t if isinstance(t, str) else "" for t in pdf.iloc[:, at]]
                keep = np.array([has_letter(t) for t in texts], bool)
                if model is not None and keep.any():
                    where = np.flatnonzero(keep)
                    p = model.documents([texts[i].encode() for i in where]).max(1)
                    keep[where] = p >= min_score
                yield pdf[keep]

    return docs.mapInPandas(run, schema)
