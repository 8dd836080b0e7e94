"""Personal data by patterns and a semi-Markov conditional random field.

Base spans are pattern matches with a check (``base_spans``); they always
stay. Around them a semi-Markov CRF reads every region of a text (neighbouring
words with a digit, an ``@`` or a bracketed "at") as a row of units (digit
runs, letter runs, single signs). It scores whole candidate segments of up to
``MAX_UNITS`` units by features of the whole span (numbers of digits, lengths
of the digit groups, checksum, kinds and sameness of separators, brackets, both
neighbours) and dynamic programming over segment ends chooses boundaries and
types jointly. Segments of the best reading are added where they meet no base
span and their marginal probability is ``CERTAIN`` or more.

The weights are learned in numpy, by gradient steps on the conditional
log-likelihood, from a bounded sample in strata: up to ``SAMPLE_REGIONS``
regions of each kind of base span, and as many without any, by hash of the
region over all documents; so kinds that are rare in the corpus are learned
too. Base spans are the truth. Each also stands in other written forms
(``DISGUISES``: telephone numbers without country code or with other
separators, cards with other separators, bracketed signs), beside numbers of
other kinds (``plain_numbers``), so that the model learns which layouts make a
span. Features describe layout, none of them matches a disguise; forms that
were not trained (``HELD_OUT``) measure what is learned.

Defined cases: a null or empty text has no spans. A region may be as long as
the text: the lattice is scored in blocks of ``BLOCK`` units that are made anew
for the way back, so it holds some 40 bytes a unit beside the text. Offsets are
code points. Equal texts have equal spans, ties go to fewer and earlier
segments. Null ids and repeated rows are read like others; only the id and the
text are read. Without documents, or without any base span in all of them, there
is no model (with a warning), and only base spans are found.
"""

from __future__ import annotations

import bisect
import itertools
import random
import re
import warnings
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
MAX_UNITS = 18
#: Regions of each stratum (the four kinds, and none) that are learned from.
SAMPLE_REGIONS = 40
#: Longer regions are not learned from.
SAMPLE_LENGTH = 100
CERTAIN = 0.9
#: Units whose segments are scored at once.
BLOCK = 4096
Span = tuple[int, int, int]  # start, kind number, end

# fixed values: the base patterns. Possessive runs and the look-behind don't
# change what is found, they keep long runs of digits linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_CUE = re.compile(r"[0-9@]|[\[({<][aA][tT][\])}>]")
_UNIT = re.compile(r"[0-9]+|[A-Za-z]+|[^\sA-Za-z0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: from every ``@`` back over the run before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """(start, kind number, end) of the pattern matches that pass their check."""
    found: list[Span] = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    if "." in text:
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found)


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Spans of neighbouring words that hold a digit, an ``@`` or a bracketed "at"."""
    if not _CUE.search(text):
        return
    start = end = -1
    for m in re.finditer(r"\S+", text):
        if _CUE.search(m[0]):
            if start >= 0 and m.start() - end <= 2 and "\n" not in text[end:m.start()]:
                end = m.end()
            else:
                if start >= 0:
                    yield start, end
                start, end = m.start(), m.end()
    if start >= 0:
        yield start, end


SIGNS = "@.-/,_()[]+"
#: Brackets that only disguises use; they count as ``(`` and ``)``.
_SAME = str.maketrans("{}<>", "()()")


class Units:
    """The units of some regions of a text, in order; no segment leaves a region."""

    def __init__(self, text: str, spans: list[tuple[int, int]]):
        start, end, region = array("i"), array("i"), array("i")
        for r, (a, b) in enumerate(spans):
            for m in _UNIT.finditer(text, a, b):
                start.append(m.start())
                end.append(m.end())
                region.append(r)
        self.text = text
        self.start, self.end, self.region = (np.frombuffer(x, np.int32) if len(x) else np.zeros(0, np.int32)
                                             for x in (start, end, region))

    def __len__(self) -> int:
        return len(self.start)

    def longest(self) -> int:
        """Units of the longest region, ``MAX_UNITS`` at most."""
        return int(min(MAX_UNITS, np.bincount(self.region).max())) if len(self) else 0


def _cumulated(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


class Block:
    """Candidate segments that start at units ``lo`` to ``hi``: ``x[k]`` holds the
    features of those of ``k + 1`` units, ``valid[k]`` which of them are candidates."""

    def __init__(self, units: Units, lo: int, hi: int, longest: int):
        # neighbours on both sides belong to the features
        begin, stop = max(0, lo - 1), min(len(units), hi + longest + 2)
        text, region = units.text, units.region[begin:stop]
        st, en = units.start[begin:stop].astype(np.int64), units.end[begin:stop].astype(np.int64)
        words = [text[a:b] for a, b in zip(st, en)]
        digit = np.array([w[0] in "0123456789" for w in words])
        letter = np.array([w[0].isascii() and w[0].isalpha() for w in words])
        size = en - st
        sign = [w.translate(_SAME) if not (d or c) else "" for w, d, c in zip(words, digit, letter)]
        at_word = letter & np.array([w.lower() == "at" for w in words])
        dot_word = letter & np.array([w.lower() == "dot" for w in words])
        gap = np.concatenate([[False], st[1:] > en[:-1]])
        # sums up to each unit: those of a segment are two of them apart
        total = {
            "digits": _cumulated(size * digit), "groups": _cumulated(digit), "letters": _cumulated(size * letter),
            "gap": _cumulated(gap), "at": _cumulated(at_word), "dot": _cumulated(dot_word),
            "three": _cumulated(digit & (size == 3)), "four": _cumulated(digit & (size == 4)),
            "two": _cumulated(digit & (size == 2)),
            "octet": _cumulated([bool(d) and (len(w) > 3 or int(w) > 255) for w, d in zip(words, digit)])}
        total |= {c: _cumulated([x == c for x in sign]) for c in SIGNS}
        other = _cumulated([bool(x) and x not in SIGNS for x in sign])
        # checksums: digits at even and odd places of the row of all digits, doubled or not
        row = [int(c) for w, d in zip(words, digit) if d for c in w]
        doubled = [2 * d if d < 5 else 2 * d - 9 for d in row]
        sums = [_cumulated([a if k % 2 == p else b for k, (a, b) in enumerate(zip(row, doubled))]) for p in (0, 1)]
        at = np.arange(len(words))
        last = np.maximum.accumulate(np.where(digit, at, -1)) if len(at) else at
        before = np.concatenate([[-1], last[:-1]])[np.maximum(last, 0)]
        first = np.minimum.accumulate(np.where(digit, at, len(at))[::-1])[::-1] if len(at) else at
        cue = _cumulated(digit | np.array([x == "@" for x in sign]) | at_word)
        length = np.append(size, 0)
        joined = np.concatenate([[False], (st[1:] == en[:-1]) & (region[1:] == region[:-1])])
        code = np.array([SIGNS.find(x) if x else -1 for x in sign])
        n = hi - lo
        self.valid, self.x = [], []
        for k in range(longest):
            i = lo - begin + np.arange(max(0, min(n, len(words) - (lo - begin) - k)))
            j = i + k
            ok = (region[i] == region[j]) & (digit[i] | letter[i] | (code[i] == SIGNS.find("+")) | (code[i] == SIGNS.find("(")))
            ok &= (digit[j] | letter[j]) & (cue[j + 1] > cue[i]) & (en[j] - st[i] >= 7)
            i, j = i[ok], j[ok]
            t = {c: v[j + 1] - v[i] for c, v in total.items()}
            t["gap"] = total["gap"][j + 1] - total["gap"][i + 1]
            d, g = t["digits"], t["groups"]
            q = total["digits"][j + 1]  # the checksum counts from the last digit
            check = np.where(q % 2 == 1, sums[0][q] - sums[0][q - d], sums[1][q] - sums[1][q - d])
            luhn_ok = (d >= 14) & (d <= 19) & (check % 10 == 0)
            f, e = np.minimum(first[i], len(words)), last[j]
            tail, penult = length[np.where(g > 0, e, -1)], length[np.where((g > 1) & (before[j] >= i), before[j], -1)]
            head = length[np.where(g > 0, f, -1)]
            used = [t["gap"] > 0, t["."] > 0, t["-"] > 0, t["/"] > 0, t[","] > 0, t["_"] > 0]
            kinds = sum(u.astype(int) for u in used)
            brackets = t["("] + t["["]
            left, right = joined[i], np.append(joined, False)[j + 1]
            left_code, right_code = code[np.maximum(i - 1, 0)], np.append(code, -1)[j + 1]
            next_on = np.append(joined, [False, False])[j + 2] & np.append(digit | letter, [False, False])[j + 2]
            near_left = ~left & (i > 0) & digit[np.maximum(i - 1, 0)] & (region[np.maximum(i - 1, 0)] == region[i])
            near_right = ~right & np.append(digit, False)[j + 1] & (np.append(region, -1)[j + 1] == region[j])
            no_letters = t["letters"] == 0
            domain = letter[j] & (size[j] <= 10) & (np.append(code, -1)[j - 1] == SIGNS.find(".")) & (k > 1)
            marks = t["@"] + t["at"]
            columns = [
                np.ones(len(i), bool), d == 0, (d > 0) & (d < 7), (d >= 7) & (d < 10), d == 10, (d > 10) & (d < 14),
                (d >= 14) & (d <= 19), d > 19, t["letters"] > 0, (t["letters"] > 0) & (d > 0), marks == 1, marks > 1,
                (t["@"] == 1) & (brackets == 0), (t["at"] == 1) & (brackets > 0), (t["@"] == 1) & (brackets > 0), domain, domain & (marks == 1),
                t["dot"] > 0, luhn_ok & no_letters, (d >= 14) & (d <= 19) & ~luhn_ok, luhn_ok & (g == 4) & (t["four"] == 4),
                code[i] == SIGNS.find("+"), code[i] == SIGNS.find("("), (head >= 2) & digit[i] & _opens(words, i, "00"), digit[i], letter[i],
                left & (digit | letter)[np.maximum(i - 1, 0)], right & np.append(digit | letter, False)[j + 1],
                left & (left_code == SIGNS.find("+")), left & (left_code == SIGNS.find("(")),
                left & np.isin(left_code, [SIGNS.find(c) for c in ".-/,_@"]), right & (right_code == SIGNS.find("@")),
                right & np.isin(right_code, [SIGNS.find(c) for c in ".-/,_"]) & next_on, near_left, near_right,
                (t["("] == t[")"]) & (t["("] > 0) & no_letters, (t["("] != t[")"]) | (t["["] != t["]"]), kinds == 0, kinds == 1, kinds > 1, *used,
                g == 1, g == 2, g == 3, g == 4, g > 4, (g >= 3) & (t["four"] == g), (g >= 3) & (t["four"] == g - 1) & (tail < 4),
                (tail == 4) & (penult == 3), (tail == 4) & (penult == 3) & (d == 10) & no_letters, (tail == 4) & (penult == 3) & (d > 10) & (d < 14) & no_letters,
                (tail == 4) & (penult != 3) & (g > 1), (g == 4) & (t["."] == 3) & (t["octet"] == 0) & no_letters, (t["octet"] > 0) & (t["."] == 3),
                (g > 1) & (t["three"] == g - 1) & (head < 4) & (t[","] + t["."] == g - 1), (g == 3) & (t["two"] == 2) & (t["four"] == 1),
                other[j + 1] > other[i], t["+"] > (code[i] == SIGNS.find("+"))]
            full = np.zeros(n, bool)
            full[i - (lo - begin)] = True
            self.valid.append(full)
            self.x.append(np.stack(columns, 1).astype(np.float32) if len(i) else np.zeros((0, N_FEATURES), np.float32))


N_FEATURES = 63


def _opens(words: list[str], i: np.ndarray, begin: str) -> np.ndarray:
    return np.array([words[k].startswith(begin) for k in i], bool)


class SemiCrf:
    """``weights``: (kinds, features); units outside segments score zero."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def lattice(self, text: str, a: int, b: int):
        """(unit starts, ends, segments, features) of a short region, whole."""
        units = Units(text, [(a, b)])
        segs, x = [], []
        if len(units):
            block = Block(units, 0, len(units), units.longest())
            for k, (valid, own) in enumerate(zip(block.valid, block.x)):
                segs += [(int(i), int(i) + k) for i in np.flatnonzero(valid)]
                x.append(own)
        return (units.start.tolist(), units.end.tolist(), segs,
                np.concatenate(x).astype(np.float64) if segs else np.zeros((0, N_FEATURES)))

    def marginals(self, n: int, segs: list, scores: np.ndarray) -> tuple[float, np.ndarray]:
        """log Z and the probability of each (segment, kind), forwards and backwards."""
        by_end: list[list[int]] = [[] for _ in range(n)]
        by_start: list[list[int]] = [[] for _ in range(n)]
        for k, (i, j) in enumerate(segs):
            by_end[j].append(k)
            by_start[i].append(k)
        total = np.logaddexp.reduce(scores, axis=1) if len(segs) else np.zeros(0)
        alpha, beta = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(n):
            alpha[j + 1] = np.logaddexp.reduce([alpha[j], *(alpha[segs[k][0]] + total[k] for k in by_end[j])])
        for i in range(n - 1, -1, -1):
            beta[i] = np.logaddexp.reduce([beta[i + 1], *(beta[segs[k][1] + 1] + total[k] for k in by_start[i])])
        z = alpha[n]
        base = np.array([alpha[i] + beta[j + 1] - z for i, j in segs]).reshape(-1, 1)
        return z, np.exp(base + scores)

    def _scores(self, units: Units, lo: int, hi: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the block's segments, by number of units and start: the log of the
        summed kinds, the best kind's score and that kind; -inf where there is none."""
        block = Block(units, lo, hi, longest)
        shape = (longest, hi - lo)
        every, best, kind = np.full(shape, -np.inf), np.full(shape, -np.inf), np.zeros(shape, np.int8)
        for k, (valid, x) in enumerate(zip(block.valid, block.x)):
            if len(x):
                s = x @ self.weights.T
                every[k, valid] = np.logaddexp.reduce(s, axis=1)
                kind[k, valid] = s.argmax(1)
                best[k, valid] = s.max(1)
        return every, best, kind

    def decode(self, units: Units) -> list[tuple[int, int, int, float]]:
        """(first unit, last unit, kind, marginal) of the best reading's segments.

        Block after block forwards for the best reading and the sums up to each
        unit; if there is a segment, backwards again for the sums after it.
        """
        n, longest = len(units), units.longest()
        if not n:
            return []
        blocks = [(lo, min(n, lo + BLOCK)) for lo in range(0, n, BLOCK)]
        # the score of the last part: room for segments that would end after the last unit
        top, alpha = np.full(n + longest + 1, -np.inf), np.full(n + longest + 1, -np.inf)
        came, label, score = np.zeros(n + longest + 1, np.int8), np.zeros(n + longest + 1, np.int8), np.zeros(n + longest + 1, np.float32)
        top[0] = alpha[0] = 0.0
        for lo, hi in blocks:
            every, best, kind = self._scores(units, lo, hi, longest)
            some = np.isfinite(best).any(0)
            for i in range(lo, hi):
                if top[i] > top[i + 1]:
                    top[i + 1], came[i + 1] = top[i], 0
                alpha[i + 1] = np.logaddexp(alpha[i + 1], alpha[i])
                if some[i - lo]:
                    reach = slice(i + 1, i + 1 + longest)
                    new = top[i] + best[:, i - lo]
                    better = np.flatnonzero(new > top[reach])
                    if len(better):
                        at = i + 1 + better
                        top[at], came[at], label[at] = new[better], better + 1, kind[better, i - lo]
                        score[at] = best[better, i - lo]
                    alpha[reach] = np.logaddexp(alpha[reach], alpha[i] + every[:, i - lo])
        found, j = [], n
        while j > 0:
            if came[j]:
                found.append((j - int(came[j]), j - 1, int(label[j]), float(score[j])))
            j -= max(1, int(came[j]))
        if not found:
            return []
        beta = np.zeros(n + longest + 1)
        beta[n + 1:] = -np.inf
        for lo, hi in reversed(blocks):
            every, _, _ = self._scores(units, lo, hi, longest)
            some = np.isfinite(every).any(0)
            for i in range(hi - 1, lo - 1, -1):
                beta[i] = beta[i + 1]
                if some[i - lo]:
                    beta[i] = np.logaddexp.reduce(np.append(every[:, i - lo] + beta[i + 1:i + 1 + longest], beta[i]))
        return [(i, j, k, float(np.exp(alpha[i] + s + beta[j + 1] - alpha[n]))) for i, j, k, s in found[::-1]]

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        """Base spans and those that the model adds, by start and kind."""
        units = Units(text, list(regions(text)))
        if not len(units):
            return list(base)
        begins = [s[0] for s in base]
        ends = list(itertools.accumulate((s[2] for s in base), max))
        out = list(base)
        for i, j, kind, sure in self.decode(units):
            lo, hi = int(units.start[i]), int(units.end[j])
            # the base spans that begin before the segment's end reach at most this far
            k = bisect.bisect_left(begins, hi)
            if sure >= CERTAIN and not (k and ends[k - 1] > lo):
                out.append((lo, kind, hi))
        return sorted(out)


class Samples:
    """Regions side by side, padded with units outside segments: the sums of all
    of them go on unit by unit together. A sample is (text, region start, region
    end, true spans)."""

    def __init__(self, model: SemiCrf, samples: list[tuple[str, int, int, list[Span]]]):
        x, gold, place, self.n, self.units = [], [], [], 0, 0
        for text, a, b, truth in samples:
            starts, ends, segs, own = model.lattice(text, a, b)
            if segs:
                at = {(starts[i], ends[j]): k for k, (i, j) in enumerate(segs)}
                right = np.zeros((len(segs), len(KINDS)))
                for lo, kind, hi in truth:
                    if (lo, hi) in at:
                        right[at[lo, hi], kind] = 1
                x.append(own)
                gold.append(right)
                place += [(self.n, i, j - i) for i, j in segs]
                self.n, self.units = self.n + 1, max(self.units, len(starts))
        self.x = np.concatenate(x) if x else np.zeros((0, N_FEATURES))
        self.gold = np.concatenate(gold) if x else np.zeros((0, len(KINDS)))
        self.place = np.array(place, np.int64).reshape(-1, 3).T

    def marginals(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scores, log Z of each region, probabilities of each segment and kind)."""
        scores = self.x @ weights.T
        r, i, k = self.place
        total = np.full((self.units, self.n, MAX_UNITS), -np.inf)
        total[i, r, k] = np.logaddexp.reduce(scores, axis=1)
        alpha = np.full((self.n, self.units + MAX_UNITS + 1), -np.inf)
        beta = np.full_like(alpha, -np.inf)
        alpha[:, 0] = beta[:, self.units] = 0.0
        for u in range(self.units):
            alpha[:, u + 1] = np.logaddexp(alpha[:, u + 1], alpha[:, u])
            reach = slice(u + 1, u + 1 + MAX_UNITS)
            alpha[:, reach] = np.logaddexp(alpha[:, reach], alpha[:, u, None] + total[u])
        for u in range(self.units - 1, -1, -1):
            ways = np.concatenate([total[u] + beta[:, u + 1:u + 1 + MAX_UNITS], beta[:, u + 1, None]], axis=1)
            beta[:, u] = np.logaddexp.reduce(ways, axis=1)
        z = alpha[:, self.units]
        return scores, z, np.exp(scores + (alpha[r, i] + beta[r, i + k + 1] - z[r])[:, None])

    def objective(self, weights: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
        """Mean negative log-likelihood with the penalty, and its gradient."""
        scores, z, p = self.marginals(weights)
        n = max(1, self.n)
        return (0.5 * l2 * float((weights ** 2).sum()) + (float(z.sum()) - float((scores * self.gold).sum())) / n,
                l2 * weights + (p - self.gold).T @ self.x / n)


def train(samples: list[tuple[str, int, int, list[Span]]], steps: int = 150, rate: float = 0.25,
          l2: float = 0.0005) -> SemiCrf:
    """Gradient steps on the samples' likelihood."""
    model = SemiCrf(np.zeros((len(KINDS), N_FEATURES)))
    ready = Samples(model, samples)
    first, second = np.zeros_like(model.weights), np.zeros_like(model.weights)
    for step in range(1, steps + 1):
        _, g = ready.objective(model.weights, l2)
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        model.weights = model.weights - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return model


def _groups(digits: str, sizes: tuple[int, ...]) -> list[str]:
    at = [0, *itertools.accumulate(sizes)]
    return [digits[a:b] for a, b in zip(at, at[1:])]


def _phone_form(pattern: str):
    def form(s: str) -> str | None:
        d = _digits(s)
        if len(d) < 10:
            return None
        a, b, c = _groups(d[-10:], (3, 3, 4))
        return pattern.format(cc=d[:-10] or "1", a=a, b=b, c=c)
    return form


def _card_form(separator: str):
    def form(s: str) -> str | None:
        d = _digits(s)
        return separator.join(_groups(d, (4, 4, 4, len(d) - 12))) if len(d) >= 14 else None
    return form


def _mail_form(sign: str):
    return lambda s: s.replace("@", sign)


# fixed values: written forms that the base patterns miss, to learn from and to measure with
DISGUISES = {
    3: [_phone_form(p) for p in ("({a}) {b}-{c}", "{a}-{b}-{c}", "{a}.{b}.{c}", "00{cc} {a} {b} {c}", "{cc}-{a}-{b}-{c}", "{a} {b} {c}")],
    2: [_card_form(x) for x in (".", "/")],
    0: [_mail_form(x) for x in ("(at)", "[at]", "[@]")],
}
HELD_OUT = {
    3: [_phone_form(p) for p in ("({a}){b}-{c}", "({a}) {b} {c}", "00{cc}-{a}-{b}-{c}", "{cc} {a} {b} {c}", "{cc}.{a}.{b}.{c}", "{a}/{b}-{c}")],
    2: [_card_form(x) for x in ("_", ",")],
    0: [_mail_form(x) for x in ("(@)", "{at}", "<at>")],
}


def disguised(text: str, a: int, b: int, truth: list[Span], forms=None) -> Iterator[tuple[str, int, int, list[Span]]]:
    """The region with one of its spans in another written form."""
    for lo, kind, hi in truth:
        for form in (forms or DISGUISES).get(kind, ()):
            other = form(text[lo:hi])
            if other and not any(lo < y and hi > x for x, k, y in truth if (x, k, y) != (lo, kind, hi)):
                grown = len(other) - (hi - lo)
                yield text[a:lo] + other + text[hi:b], 0, b - a + grown, [
                    (x - a + grown * (x > lo), k, y - a + grown * (y >= hi)) for x, k, y in truth if x >= a and y <= b]


# fixed values: layouts of numbers that are no personal data (each 9 a digit)
PLAIN = ("9", "99", "999", "9999", "99999", "999999", "9999999", "99999999", "999999999", "9999999999", "999999999999", "9999999999999",
         "9,999", "99,999", "999,999,999", "9.999.999", "9.99", "999.9999999", "9999-99-99", "99.99.9999", "99/99/9999", "99:99:99",
         "9999-9999", "999-999", "9.9.9", "999.999.999.999", "99-99", "A-999999999", "v9.99.9", "999-9-99-999999-9", "99999-9999",
         "9999 9999", "99 99 99", "9 9 9 9 9 9 9 9 9 9", "999 999 999", "9999999999999999999999", "99999999999999999999999999999999", "9e-99",
         "99%", "9x9", "(99)", "(9999)", "No. 999", "999:999-999", "99,99 99,99 99,99", "9999999999999999")


def plain_numbers(seed: int = 11, rounds: int = 3) -> list[tuple[str, int, int, list[Span]]]:
    """Regions of other numbers, without spans."""
    rng, out = random.Random(seed), []
    for layout in PLAIN * rounds:
        text = re.sub("9", lambda _: rng.choice("0123456789"), layout)
        if not base_spans(text):
            out.append((text, 0, len(text), []))
    return out


def sampled_regions(docs: DataFrame, text_col: str = "text", per_stratum: int = SAMPLE_REGIONS, seed: int = 5) -> list[str]:
    """Of all documents, up to ``per_stratum`` regions of each kind of base span
    and as many without any, by hash of the region: the same on any layout."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the least hashes of each stratum: so many rows leave the task
        least: list[dict[int, str]] = [{} for _ in range(len(KINDS) + 1)]
        for pdf in batches:
            for t in pdf["text"]:
                if isinstance(t, str) and _CUE.search(t):
                    base = base_spans(t)
                    for a, b in regions(t):
                        if b - a <= SAMPLE_LENGTH:
                            region = t[max(0, a - 1):b + 1]
                            h = zlib.crc32(region.encode("utf-8", "surrogatepass"), seed)
                            for k in {k for x, k, y in base if x < b and y > a} or {len(KINDS)}:
                                least[k][h] = region
            for own in least:
                for h in sorted(own)[per_stratum:]:
                    del own[h]
        rows = [(k, h, region) for k, own in enumerate(least) for h, region in own.items()]
        yield pd.DataFrame(rows, columns=["kind", "h", "region"]).astype({"kind": np.int32, "h": np.int64, "region": object})

    some = stored(docs.select(F.col(text_col).cast("string").alias("text")).mapInPandas(cut, "kind int, h long, region string"),
                  "pii-regions")
    found = set()
    for k in range(len(KINDS) + 1):
        found |= {r["region"] for r in some.filter(F.col("kind") == k).select("h", "region").distinct().orderBy(
            "h", "region").limit(per_stratum).collect()}
    return sorted(found)


def samples_of(found: list[str], forms=None) -> list[tuple[str, int, int, list[Span]]]:
    """The regions as they are, and with their spans in other forms."""
    out = []
    for text in found:
        truth = base_spans(text)
        out.append((text, 0, len(text), truth))
        out += disguised(text, 0, len(text), truth, forms)
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 5) -> SemiCrf | None:
    """Learns from ``sampled_regions`` of all documents; see the module."""
    samples = samples_of(sampled_regions(docs, text_col, seed=seed))
    if not any(s[3] for s in samples):
        if samples:
            warnings.warn("pii: no document holds a base span to learn from; only base spans are found", stacklevel=2)
        return None
    return train(samples + plain_numbers())


def find(docs: DataFrame, model: SemiCrf | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): arrays of (kind, start, end) by start, then kind."""
    entry = "array<struct<kind:string,start:int,end:int>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            base, every = [], []
            for t in pdf["text"]:
                t = t if isinstance(t, str) else ""
                b = base_spans(t) if _CUE.search(t) else []
                s = model.spans(t, b) if model is not None and _CUE.search(t) else b
                base.append([{"kind": KINDS[k], "start": x, "end": y} for x, k, y in b])
                every.append([{"kind": KINDS[k], "start": x, "end": y} for x, k, y in s])
            yield pd.DataFrame({"id": pdf["id"], "base": base, "spans": every})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInPandas(
        run, f"id {kind}, base {entry}, spans {entry}")


def redacted(docs: DataFrame, model: SemiCrf | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.copy()
            pdf.isetitem(at, [redact(t, model) if isinstance(t, str) else None for t in pdf.iloc[:, at]])
            yield pdf

    return docs.mapInPandas(run, docs.schema)


def redact(text: str, model: SemiCrf | None) -> str:
    base = base_spans(text)
    out, end = [], 0
    for a, kind, b in (model.spans(text, base) if model is not None else base):
        if b > end:  # overlapping kinds: the first names the place
            out += [text[end:a], f"[{KINDS[kind]}]"] if a >= end else []
            end = b
    return "".join(out) + text[end:]
