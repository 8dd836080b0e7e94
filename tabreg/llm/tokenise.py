"""Token ids of whole texts with a public tokenizer file, batch by batch.

Words repeat, so a batch is cut at its blanks, each different piece is
encoded once by the ``tokenizers`` library (and kept in a bounded cache of
the worker), and the ids of the texts are gathered from the pieces' ids.

The cut is exact. Both kinds of file pre-tokenise with a pattern none of
whose matches runs from a character that isn't white space into a blank, and
merges stay inside a match. So in ``bytes`` mode a text may be cut before
any blank whose predecessor isn't white space, the blank staying with the
piece it opens; in ``words`` mode (white space is dropped) at any blank.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker keeps (about 60 bytes each, in Arrow arrays). When there
#: are more, the half that was used last stays. It changes speed and memory,
#: never the ids.
CACHE_PIECES = 800_000
_UNSAFE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] "
_CUT = re.compile(r"(?<=\S) ")
_MARKS = ".,;:!?|$%&#*"
_BEFORE_MARKS = f"^[^{_MARKS}]+"
_encoders: dict[tuple[str, str], "Encoder"] = {}


def encoder(path: str, mode: str, cache: int = CACHE_PIECES) -> "Encoder":
    """The worker's encoder for a file; ``mode`` is ``bytes`` or ``words``."""
    if (path, mode) not in _encoders:
        _encoders[path, mode] = Encoder(path, mode)
    _encoders[path, mode].limit = cache
    return _encoders[path, mode]


def _gathered(start: np.ndarray, flat: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of the lists (start, flat) numbered ``rows``."""
    lists = pa.LargeListArray.from_arrays(pa.array(start), pa.array(flat))
    values = np.asarray(lists.take(pa.array(rows)).flatten(), dtype=np.uint32)
    return np.concatenate([[0], np.cumsum(np.diff(start)[rows])]), values


class Encoder:
    def __init__(self, path: str, mode: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        if mode not in ("bytes", "words"):
            raise ValueError(f"mode {mode!r}")
        self.mode = mode
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.limit = CACHE_PIECES
        self.turn = 0
        self.known = pa.array([], pa.large_string())
        self.used = np.zeros(0, np.int64)   # turn of each known piece's last use
        self.start = np.zeros(1, np.int64)  # where its ids begin in flat
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, pieces: pa.Array) -> None:
        """Encodes new pieces and puts them behind the known ones."""
        ids, size = array("I"), []
        for lo in range(0, len(pieces), 20_000):  # the library's results are large
            for e in self.tokenizer.encode_batch_fast(pieces[lo:lo + 20_000].to_pylist(), add_special_tokens=False):
                size.append(len(e))
                ids.fromlist(e.ids)
        self.known = pa.concat_arrays([self.known, pieces])
        self.used = np.concatenate([self.used, np.zeros(len(pieces), np.int64)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(size, dtype=np.int64)])
        self.flat = np.concatenate([self.flat, np.frombuffer(ids, np.uint32)])

    def _forget(self) -> None:
        stay = np.sort(np.argsort(-self.used, kind="stable")[:self.limit // 2])
        self.start, self.flat = _gathered(self.start, self.flat, stay)
        self.known, self.used = self.known.take(pa.array(stay)), self.used[stay]

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The pieces' places among the known ones, which they join."""
        if len(self.known) > self.limit:
            self._forget()
        self.turn += 1
        found = pc.index_in(pieces, value_set=self.known)
        at = found.fill_null(-1).to_numpy().astype(np.int64)
        if found.null_count:
            new = pieces.filter(pc.is_null(found)).dictionary_encode()
            at[at < 0] = len(self.known) + np.asarray(new.indices, dtype=np.int64)
            self._learn(new.dictionary)
        self.used[at] = self.turn
        return at

    def pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``len(pieces) + 1`` offsets and the ids of all pieces."""
        if self.mode == "words":
            pieces = pc.if_else(pc.string_is_ascii(pieces), pc.ascii_lower(pieces), pieces)
        # a word and the marks behind it are encoded apart: they never merge
        word = pc.utf8_rtrim(pieces, characters=_MARKS)
        two = pc.and_(pc.utf8_is_alpha(pc.utf8_ltrim(word, characters=" ")), pc.not_equal(word, pieces))
        marks = pc.replace_substring_regex(pieces.filter(two), pattern=_BEFORE_MARKS, replacement="")
        number = self._numbers(pa.concat_arrays([pc.if_else(two, word, pieces), marks]))
        two = two.to_numpy(zero_copy_only=False)
        parts = np.concatenate([[0], np.cumsum(1 + two)])
        row = np.empty(parts[-1], np.int64)
        row[parts[:-1]] = number[:len(pieces)]
        row[parts[1:][two] - 1] = number[len(pieces):]
        start, flat = _gathered(self.start, self.flat, row)
        return start[parts], flat

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and ``len(texts) + 1`` offsets."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.mode == "bytes":
            odd = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
        else:
            odd = np.zeros(len(texts), bool)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        cut = pc.split_pattern(plain, " ")
        at = np.asarray(cut.offsets, dtype=np.int64)
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary
        code = np.asarray(coded.indices, dtype=np.int64)
        if self.mode == "bytes":
            # a text's first piece has no blank before it
            first = at[:-1]
            heads, head_of = np.unique(code[first], return_inverse=True)
            none, blank = (pa.scalar(x, pa.large_string()) for x in ("", " "))
            words = pa.concat_arrays([pc.binary_join_element_wise(none, words, blank), words.take(pa.array(heads))])
            code[first] = len(coded.dictionary) + head_of
        ends, out = _gathered(*self.pieces(words), code)
        offsets = ends[at]
        if not odd.any():
            return out, offsets
        # texts with white space before a blank: cut in Python, pieces encoded alike
        parts, lens = [], np.diff(offsets)
        for i, is_odd in enumerate(odd):
            part = out[offsets[i]:offsets[i + 1]]
            if is_odd:
                head, *rest = _CUT.split(texts[i].as_py())
                part = self.pieces(pa.array([head, *(" " + x for x in rest)], pa.large_string()))[1]
                lens[i] = len(part)
            parts.append(part)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(lens)])
