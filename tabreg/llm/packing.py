"""Best-fit packing by hierarchical residual packing.

Pieces are dealt to groups of about ``group_items``; each group is packed
best fit (longest first). Bins with at most ``nearly`` places left are
emitted; the underfull ones go on as items of their filled length. A tree of
rounds merges underfull bins of ``fan_in`` groups and packs them best fit
again, until a round no longer saves a bin worth a thousandth. No task ever
holds more than a group; what goes through a round are (bin, length) rows,
never tokens.

Defined cases: a null text is empty and yields its end id alone; repeated
rows are packed separately; a null id is kept as it is. An empty table gives
no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.llm.common import stored
from tabreg.llm.tokenise import CACHE_PIECES, encoder

PIECES = "id long, piece int, start long, length long, ids array<int>, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
                 cache: int = CACHE_PIECES) -> DataFrame:
    """Pieces of at most ``size`` ids of every whole text with its end id.

    Only longer texts are cut; their pieces hold ``size`` ids but for the
    first, which holds the rest. ``ids`` is null unless ``with_ids``.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, "bytes", cache)
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                batch = whole.slice(lo, 2000)
                flat, at = enc.batch(batch.column(1))
                out: dict[str, list] = {k: [] for k in ("i", "piece", "start", "length", "ids", "crc")}
                for i in range(batch.num_rows):
                    ids = np.append(flat[at[i]:at[i + 1]], np.uint32(end_id)).astype("<u4")
                    first = (len(ids) - 1) % size + 1
                    cuts = [0, *range(first, len(ids) + 1, size)]
                    for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        part = ids[a:b]
                        out["i"].append(i); out["piece"].append(p); out["start"].append(a)
                        out["length"].append(b - a); out["crc"].append(zlib.crc32(part.tobytes()))
                        out["ids"].append(part.view(np.int32) if with_ids else None)
                take = pa.array(out["i"], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), pa.array(out["piece"], pa.int32()),
                     pa.array(out["start"], pa.int64()), pa.array(out["length"], pa.int64()),
                     pa.array(out["ids"], pa.list_(pa.int32())), pa.array(out["crc"], pa.int64())],
                    names=["id", "piece", "start", "length", "ids", "ids_crc32"])

    return rows.mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin number and offset of each item, longest items first, each into the
    fullest bin that holds it; and the number of bins."""
    bin_of, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]  # by places left
    left_set, n = 0, 0  # bit r of left_set: there is a bin with r places left
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        fits = left_set >> need
        if fits:
            left = need + (fits & -fits).bit_length() - 1
            b = open_bins[left].pop()
            if not open_bins[left]:
                left_set &= ~(1 << left)
        else:
            left, b, n = size, n, n + 1
        bin_of[i], offset[i] = b, size - left
        left -= need
        if left:
            if not open_bins[left]:
                left_set |= 1 << left
            open_bins[left].append(b)
    return bin_of, offset, n


def _packer(base: int, size: int):
    """Packs one group; bins are numbered by round, group and place."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "item"], ascending=[False, True], ignore_index=True)
        bin_of, offset, _ = best_fit(pdf["length"].to_numpy(), size)
        fill = np.bincount(bin_of, weights=pdf["length"]).astype(np.int64)
        return pd.DataFrame({"item": pdf["item"], "bin": base + (int(key[0]) << 28) + bin_of,
                             "offset": offset, "fill": fill[bin_of]})
    return run


def pack(items: DataFrame, size: int = 2048, nearly: int = 8, group_items: int = 20_000,
         fan_in: int = 8) -> DataFrame:
    """(item, length) with lengths of 1 to ``size`` -> (item, bin, offset)."""
    if group_items < 2 or fan_in < 2:
        raise ValueError("group_items and fan_in are 2 at least")
    placed: list[DataFrame] = []
    rest = items.select("item", "length")
    level, groups, n = 0, 0, rest.count()
    while n:
        # a round merges the bins of at most fan_in groups of the round before
        groups = max(-(-n // group_items), -(-groups // fan_in) if groups else 1)
        dealt = rest.withColumn("g", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(groups)))
        packed = stored(dealt.groupBy("g").applyInPandas(
            _packer(level << 58, size), "item long, bin long, offset long, fill long"), f"packed-{level}")
        placed.append(packed)
        bins = packed.filter(F.col("fill") < size - nearly).filter("offset = 0").select(
            F.col("bin").alias("item"), F.col("fill").alias("length"))
        left = bins.count()
        # one group holds all: nothing is gained by packing it again
        if groups == 1 or left > n - max(1, n // 1000):
            break
        rest, n, level = bins, left, level + 1
    if not placed:
        return items.sparkSession.createDataFrame([], "item long, bin long, offset long")
    # where an item ends: through the bins of all rounds, the last one first
    above = None
    for packed in reversed(placed):
        here = packed.select("item", "bin", "offset")
        if above is not None:
            up = above.select(F.col("item").alias("bin"), F.col("bin").alias("top"), F.col("offset").alias("more"))
            here = here.join(up, "bin", "left").select(
                "item", F.coalesce("top", "bin").alias("bin"),
                (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"))
        above = here
    return above


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
                   group_items: int = 20_000, cache: int = CACHE_PIECES) -> DataFrame:
    """Pieces of all texts with their ``sequence_id`` and ``offset`` there."""
    # numbered once and written: the numbers hold when a task is run again
    pieces = stored(token_pieces(docs, tokenizer_path, size, end_id, id_col, text_col, with_ids, cache)
                    .withColumn("item", F.monotonically_increasing_id()), "pieces")
    spots = pack(pieces, size, group_items=group_items)
    return pieces.join(spots, "item").select(
        "id", "piece", "start", "length", "ids", "ids_crc32",
        F.col("bin").alias("sequence_id"), "offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed training sequences: (sequence_id, ids), at most ``size`` ids."""
    return (pieces.groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids")))
