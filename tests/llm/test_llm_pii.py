"""The semi-Markov CRF: enumeration, gradient, blocks, strata, held-out forms."""

import itertools
import random
import resource
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.llm import pii

SCHEMA = "doc_id long, text string, id string, base string, spans string, kind string"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "i", "b", "s", "k") for i, t in zip(ids, texts)], SCHEMA)


def _planted(rng):
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    card = n(15)
    card += next(c for c in "0123456789" if pii.luhn(card + c))
    return rng.choice([
        f"+{rng.choice(['1', '44', '351'])} ({n(3)}) {n(3)}-{n(4)}", f"{rng.choice(['ann', 'bob.m', 'x_1'])}@mail{n(1)}.example.com",
        ".".join(str(rng.randrange(256)) for _ in range(4)), card])


@pytest.fixture(scope="module")
def model():
    rng = random.Random(0)
    return pii.train(pii.samples_of([f" {_planted(rng)} " for _ in range(200)] + ["in 1999 ", " 12,345 items", " v2.0 "]) + pii.plain_numbers())


def _readings(n, segs):
    """All sets of segments that don't overlap."""
    def go(i):
        if i >= n:
            yield ()
            return
        yield from go(i + 1)
        for k, (a, b) in enumerate(segs):
            if a == i:
                for rest in go(b + 1):
                    yield (k, *rest)
    return go(0)


@pytest.mark.parametrize("text", ["+1 (528) 555", "a@b.example", "10.2.3.4 1999", "12 34-5678", "x(at)yy.zz"])
def test_sums_and_best_reading_equal_enumeration(text):
    rng = np.random.default_rng(len(text))
    model = pii.SemiCrf(rng.normal(0, 0.5, (len(pii.KINDS), pii.N_FEATURES)))
    units = pii.Units(text, [(0, len(text))])
    starts, ends, segs, x = model.lattice(text, 0, len(text))
    assert segs
    scores = x @ model.weights.T
    z, p = model.marginals(len(starts), segs, scores)
    weight, best, mass = 0.0, (-np.inf, None), np.zeros_like(scores)
    for reading in _readings(len(starts), segs):
        for kinds in itertools.product(range(len(pii.KINDS)), repeat=len(reading)):
            s = sum(scores[k, t] for k, t in zip(reading, kinds))
            weight += np.exp(s)
            best = max(best, (s, [(*segs[k], t) for k, t in zip(reading, kinds)]), key=lambda b: b[0])
            for k, t in zip(reading, kinds):
                mass[k, t] += np.exp(s)
    assert np.isclose(z, np.log(weight)) and np.allclose(p, mass / weight)
    got = model.decode(units)
    assert [(i, j, k) for i, j, k, _ in got] == best[1]
    at = {s: k for k, s in enumerate(segs)}
    assert np.allclose([m for *_, m in got], [p[at[i, j], k] for i, j, k, _ in got], atol=1e-5)


def test_samples_side_by_side_and_their_gradient():
    rng = np.random.default_rng(1)
    texts = ["+1 (528) 555-3435", "in 1999 12345678", "a@b.example.com 10.0.0.1"]
    samples = [(t, 0, len(t), pii.base_spans(t)) for t in texts]
    ready = pii.Samples(pii.SemiCrf(np.zeros((4, pii.N_FEATURES))), samples)
    w = rng.normal(0, 0.3, (4, pii.N_FEATURES))
    alone = pii.SemiCrf(w)
    _, z, p = ready.marginals(w)
    own = [alone.lattice(t, 0, len(t)) for t in texts]
    want = [alone.marginals(len(s), segs, x @ w.T) for s, _, segs, x in own]
    assert np.allclose(z, [a for a, _ in want]) and np.allclose(p, np.concatenate([b for _, b in want]))
    loss, g = ready.objective(w, 0.01)
    for _ in range(40):
        i, j = rng.integers(4), rng.integers(pii.N_FEATURES)
        step = np.zeros_like(w)
        step[i, j] = 1e-5
        slope = (ready.objective(w + step, 0.01)[0] - ready.objective(w - step, 0.01)[0]) / 2e-5
        assert abs(slope - g[i, j]) < 1e-6


def test_blocks_change_nothing(model, monkeypatch):
    rng = random.Random(3)
    text = " ".join(rng.choice(["word", _planted(rng), pii.DISGUISES[3][1](f"+1{rng.randrange(10**9, 10**10)}"), "7 8 9", "1.5"])
                    for _ in range(120))
    want = model.spans(text, pii.base_spans(text))
    for block in (1, 7, 50):
        monkeypatch.setattr(pii, "BLOCK", block)
        assert model.spans(text, pii.base_spans(text)) == want
    assert len(want) > len(pii.base_spans(text))
    # regions alone find the same
    parts = []
    for a, b in pii.regions(text):
        base = [s for s in pii.base_spans(text) if s[0] < b and s[2] > a]
        units = pii.Units(text, [(a, b)])
        parts += base + [(int(units.start[i]), k, int(units.end[j])) for i, j, k, m in model.decode(units)
                         if m >= pii.CERTAIN and not any(s[0] < units.end[j] and s[2] > units.start[i] for s in base)]
    assert sorted(set(parts)) == want


def test_forms_that_were_not_trained(model):
    """Recall by kind on written forms outside the training, precision on all."""
    rng = random.Random(9)
    truth, hit, wrong = {}, {}, 0
    for _ in range(300):
        text = f"so {_planted(rng)} then"
        for kind in pii.HELD_OUT:
            for t, a, b, spans in pii.disguised(text, 0, len(text), pii.base_spans(text), {kind: pii.HELD_OUT[kind]}):
                base = pii.base_spans(t)
                want = {s for s in spans if s not in base}
                got = set(model.spans(t, base)) - set(base)
                truth[kind], hit[kind] = truth.get(kind, 0) + len(want), hit.get(kind, 0) + len(want & got)
                wrong += len(got - want)
    assert hit[0] >= 0.9 * truth[0] and hit[2] >= 0.9 * truth[2] and hit[3] >= 0.7 * truth[3]
    assert wrong <= 0.02 * sum(hit.values())
    others = [t for t, *_ in pii.plain_numbers(seed=77, rounds=10)]
    assert sum(bool(model.spans(t, [])) for t in others) <= 0.01 * len(others)
    assert model.spans("call 212-555-0199 now", []) == [(5, 3, 17)]
    assert model.spans("bob(at)mail.example.com", []) == [(0, 0, 23)]


def test_what_the_patterns_swallow(model):
    """Leftmost matches run into their neighbours and fail; the model parts them."""
    two = "7536784127813050 4845168114407329"
    assert pii.base_spans(two) == [] and model.spans(two, []) == [(0, 2, 16), (17, 2, 33)]
    text = "+1 (826) 555-4081 190.137.223.7"
    base = pii.base_spans(text)
    assert [k for _, k, _ in base] == [1] and (0, 3, 17) in model.spans(text, base)


def test_rare_spans_are_learned_and_none_is_told(spark):
    texts = [f"item {i} of {i * 7} in 19{i % 90 + 10}" for i in range(4000)]
    for i in range(0, 4000, 400):
        texts[i] = f"phone +1 (2{i // 400}1) 555-{1000 + i}"
    docs = frame(spark, texts).repartition(6)
    found = pii.sampled_regions(docs)
    assert sum(bool(pii.base_spans(t)) for t in found) == 10 and len(found) == 10 + pii.SAMPLE_REGIONS
    assert found == pii.sampled_regions(docs.repartition(2))
    assert pii.fit(docs).spans("at (743) 555-3824 now", []) == [(3, 3, 17)]
    with pytest.warns(UserWarning, match="no document holds"):
        assert pii.fit(frame(spark, ["in 1999", "12 of 13"])) is None


def test_odd_rows(spark, model):
    mail = "to a@b.example.org and (743) 555-3824"
    texts, ids = [None, "", mail, mail, "no", mail, "x" * 50_000], [1, 2, 3, 3, None, None, 7]
    got = sorted(((r["id"], len(r["base"]), len(r["spans"])) for r in pii.find(frame(spark, texts, ids), model).collect()), key=repr)
    assert got == sorted([(1, 0, 0), (2, 0, 0), (3, 1, 2), (3, 1, 2), (None, 0, 0), (None, 1, 2), (7, 0, 0)], key=repr)


def test_long_digit_texts_in_bounded_memory(model):
    for text in ("1 2 3 4 5 6 7 8 9 0 " * 15_000, "12345678901234567890" * 15_000, "1." * 40_000, "a@" * 40_000):
        before, t = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
        model.spans(text, pii.base_spans(text))
        assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 150_000 and time.time() - t < 90
    many = "a@b.example.org " * 20_000  # linear in the number of base spans
    t = time.time()
    assert len(model.spans(many, pii.base_spans(many))) == 20_000 and time.time() - t < 90
