"""Fill-in-middle transformation by repeated captures.

A text's units are runs of ASCII letters and single other characters. One
fullmatch of ``(unit)*`` by the ``regex`` library keeps every repetition of
its group, so ``match.ends(1)`` is the list of all unit ends: its length is
the number of units and two of its entries are the offsets of both cuts. No
code walks over units.

The cuts and the form follow from a SHA-256 of the seed and the id, so they
are the same on every run and layout, and a text is read alone: no shuffle.

Texts of more than ``SEGMENT`` code points are matched in segments that end
after a character that isn't a letter (a unit of its own, so no unit is cut):
a match holds about 120 bytes a unit, which bounds a worker's memory at about
130 MB beside 8 bytes a unit. A single longer letter run is one segment.

Defined cases: a null text is empty, and plain with no units; a null id stands
for an empty one in the hash, as decimal text; repeated rows are transformed
alike, each on its own; an empty table gives no rows. Only the id and the text
are read, so other columns never clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.llm.common import text_or_empty

#: Prefix, suffix, middle.
MARKERS = ("<P>", "<S>", "<M>")
SEGMENT = 1 << 20
#: Rows whose outputs a worker holds at once.
ROWS = 256

# possessive, so that the library keeps no way back
_UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")
_OTHER = regex.compile(r"[^A-Za-z]")


def unit_ends(text: str, segment: int = SEGMENT) -> np.ndarray:
    """The end of every unit of ``text``, ascending."""
    if len(text) <= segment:
        return np.array(_UNITS.fullmatch(text).ends(1), np.int64)
    ends, at = [], 0
    while at < len(text):
        stop = len(text)
        if at + segment < stop and (m := _OTHER.search(text, at + segment - 1)):
            stop = m.end()
        ends.append(np.array(_UNITS.fullmatch(text, at, stop).ends(1), np.int64))
        at = stop
    return np.concatenate(ends)


def hash_numbers(id_: Column, seed: int = 1) -> list[Column]:
    """The first four 8-digit groups of the hex SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def cut(text: str, h: tuple[int, int, int, int], fim_percent: int, spm_percent: int,
        markers: tuple[str, str, str]) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, prefix length, middle length, output) of one text."""
    ends = unit_ends(text)
    n = len(ends)
    if not text or any(m in text for m in markers) or h[2] % 100 >= fim_percent:
        return n, "plain", None, None, text
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (int(ends[i - 1]) if i else 0 for i in (first, second))
    p, s, m = markers
    if h[3] % 100 < spm_percent:
        return n, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
    return n, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
              fim_percent: int = 90, spm_percent: int = 20, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output), one row for each of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            h = [batch.column(i).to_numpy(zero_copy_only=False).tolist() for i in range(2, 6)]
            done = [cut(t.as_py(), x, fim_percent, spm_percent, markers)
                    for t, *x in zip(batch.column(1), *h)]
            n, form, prefix, middle, output = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("string").alias("text"),
                       *hash_numbers(F.col(id_col), seed)).mapInArrow(
        run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``transform`` read, rebuilt from its output and form.

    A text that holds a marker stays plain and no marker overlaps another, so
    the markers of an output are its three cuts.
    """
    parts = F.split(output, "|".join(re.escape(m) for m in markers), -1)
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (F.when(form == "psm", F.concat(first, middle, second))
            .when(form == "spm", F.concat(second, middle, first)).otherwise(output))
