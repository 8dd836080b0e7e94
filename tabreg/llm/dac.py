"""Token ids in directly addressable codes, in files of the shared folder.

An id is split into 8-bit chunks, lowest first. Level 0 holds the first chunk
of every id and a bitmap that tells which ids continue; level 1 holds the
second chunk of those that do, and so on. The place of an id's next chunk is
the number of continuation bits before it: a rank directory holds that number
at every 512th bit, so any id is read in a few steps, without decoding others.

A file is a sequence of segments of at most about ``segment_ids`` ids (a
longer document is a segment of its own), in ascending document order. A
segment stands on its own: its bytes hold the document table, the levels,
the bitmaps and the rank directories. Segments are the rows of a Parquet
table (binary column), which Spark writes to and reads from any store.

Defined cases: a null text is empty and holds its end id alone; null ids come
first; of repeated ids the texts decide the order; an empty table gives no
segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.llm.tokenise import encoder
from tabreg.session import shared_scratch

MAGIC = b"DAC1"
RANK_BITS = 512


def build(doc_ids: np.ndarray, has_id: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of a segment. ``offsets`` has one entry more than documents."""
    parts = [np.asarray(doc_ids, "<i8").tobytes(), np.asarray(has_id, np.uint8).tobytes(),
             np.asarray(offsets, "<i8").tobytes()]
    values, levels = np.asarray(ids, np.uint64), 0
    while True:
        rest = values >> np.uint64(8)
        goes_on = rest > 0
        bits = np.packbits(goes_on, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(goes_on)])[:len(values):RANK_BITS]
        parts += [np.array([len(values), len(bits), len(ranks)], "<i8").tobytes(),
                  (values & np.uint64(255)).astype(np.uint8).tobytes(), bits.tobytes(), ranks.astype("<i8").tobytes()]
        levels += 1
        values = rest[goes_on]
        if not len(values):
            break
    return MAGIC + np.array([len(doc_ids), levels], "<i8").tobytes() + b"".join(parts)


class Segment:
    """A segment's bytes, read in place."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment")
        self._data, self._at = data, 4
        n_docs, n_levels = self._take("<i8", 2)
        self.doc_ids = self._take("<i8", n_docs)
        self.has_id = self._take(np.uint8, n_docs)
        self.offsets = self._take("<i8", n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            n, n_bits, n_ranks = self._take("<i8", 3)
            self.levels.append((self._take(np.uint8, n), self._take(np.uint8, n_bits), self._take("<i8", n_ranks)))

    def _take(self, kind, n) -> np.ndarray:
        out = np.frombuffer(self._data, kind, int(n), self._at)
        self._at += out.nbytes
        return out

    def token(self, i: int) -> int:
        """The i-th id of the segment, without decoding any other."""
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            lo = i // RANK_BITS
            before = np.unpackbits(bits[lo * RANK_BITS // 8:(i >> 3) + 1], bitorder="little")
            i = int(ranks[lo]) + int(before[:i - lo * RANK_BITS].sum())
        return value

    def tokens_at(self, places: np.ndarray) -> np.ndarray:
        """The ids at some places; only the 64 bytes of each rank block are read."""
        out, rest, at = np.zeros(len(places), np.int64), np.arange(len(places)), np.asarray(places, np.int64)
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            out[rest] |= chunks[at].astype(np.int64) << (8 * k)
            on = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            rest, at = rest[on], at[on]
            block, size = at // RANK_BITS, RANK_BITS // 8
            whole = np.minimum(block[:, None] * size + np.arange(size), len(bits) - 1)
            before = np.unpackbits(bits[whole], axis=1, bitorder="little").cumsum(1, dtype=np.int64)
            inside = at - block * RANK_BITS
            at = ranks[block] + np.where(inside > 0, before[np.arange(len(at)), np.maximum(inside - 1, 0)], 0)
        return out

    def tokens(self) -> np.ndarray:
        """All ids of the segment, level by level."""
        out = None
        for chunks, bits, _ in reversed(self.levels):
            value = chunks.astype(np.uint32)
            if out is not None:
                value[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)] |= out << np.uint32(8)
            out = value
        return out


def write(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None,
          id_col: str = "doc_id", text_col: str = "text", mode: str = "words",
          segment_ids: int = 1 << 18) -> str:
    """Encode every whole text and write the segments; returns their folder.

    Documents are range-partitioned by id, so partition and segment numbers
    give the order of the documents.
    """
    path = path or shared_scratch(docs.sparkSession, "dac")
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .repartitionByRange("id").sortWithinPartitions("id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seg = TaskContext.get().partitionId(), 0
        enc = encoder(tokenizer_path, mode)
        names, have, sizes, ids, held, first = [], [], [0], [], 0, 0

        def close() -> pa.RecordBatch:
            data = build(np.array(names, np.int64), np.array(have, np.uint8), np.cumsum(sizes),
                         np.concatenate(ids))
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seg": pa.array([seg], pa.int32()),
                "first": pa.array([first], pa.int64()), "n_ids": pa.array([held], pa.int64()),
                "data": pa.array([data], pa.binary())})

        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                batch = whole.slice(lo, 2000)
                flat, at = enc.batch(batch.column(1))
                for i, name in enumerate(batch.column(0).to_pylist()):
                    n = int(at[i + 1] - at[i]) + 1
                    if held and held + n > segment_ids:
                        yield close()
                        names, have, sizes, ids, first, held, seg = [], [], [0], [], first + held, 0, seg + 1
                    names.append(name or 0); have.append(name is not None); sizes.append(n)
                    ids += [flat[at[i]:at[i + 1]], np.array([end_id], np.uint32)]
                    held += n
        if held:
            yield close()

    rows.mapInArrow(run, "part int, seg int, first long, n_ids long, data binary").write.parquet(path)
    return path


def segments(spark, path: str) -> DataFrame:
    """The written segments: part, seg, first (ids before it in its part), n_ids, data."""
    return spark.read.schema("part int, seg int, first long, n_ids long, data binary").parquet(path)


def read_documents(spark, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) of every document, from the files.

    ``start`` counts the ids of all documents before. What the driver sees is
    one sum for each written part.
    """
    segs = segments(spark, path)
    sums = sorted((r["part"], r["n"]) for r in segs.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    bases, base = {}, 0
    for part, n in sums:
        bases[part] = base
        base += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                seg, base = Segment(data), bases[part]
                ids, at = seg.tokens().astype("<u4"), seg.offsets
                names = [int(x) if h else None for x, h in zip(seg.doc_ids, seg.has_id)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(names, pa.int64()), pa.array(base + first + at[:-1]), pa.array(np.diff(at)),
                    pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, at[1:])], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.view("<i4")))],
                    names=["id", "start", "n_tokens", "ids_crc32", "ids"])

    return segs.select("part", "first", "data").mapInArrow(
        run, "id long, start long, n_tokens long, ids_crc32 long, ids array<int>")


def read_tokens(spark, path: str, places: DataFrame) -> DataFrame:
    """Random access: (part, seg, place) -> with ``token``, the id at that place
    of the segment; null where the segment has no such place.

    The different places of a segment, at most as many as it has ids, meet its
    bytes as one row: bytes are read once a segment, not once a place.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seg, spots, data in zip(*(batch.column(i) for i in range(4))):
                own, segment = np.asarray(spots.values), Segment(data.as_py())
                for lo in range(0, len(own), 4096):
                    some = own[lo:lo + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.as_py()] * len(some), pa.int32()), pa.array([seg.as_py()] * len(some), pa.int32()),
                         pa.array(some, pa.int64()), pa.array(segment.tokens_at(some), pa.int64())],
                        names=["part", "seg", "place", "token"])

    place = ["part", "seg"]
    asked = places.select(*[F.col(c).cast("int").alias(c) for c in place], F.col("place").cast("long").alias("place"))
    written = segments(spark, path)
    known = asked.distinct().join(written.select(*place, "n_ids"), place).filter("place >= 0 AND place < n_ids")
    found = (known.groupBy(*place).agg(F.collect_list("place").alias("places")).join(written, place)
             .select(*place, "places", "data").mapInArrow(run, "part int, seg int, place long, token long"))
    return asked.join(found, [*place, "place"], "left")
