"""SimHash near-dedup in a segment-popcount embedding.

A fingerprint's 64 bits are cut into segments of two bits; the bit counts of
the segments are a point on an integer grid. Changing one bit moves one
coordinate by one, so the Manhattan distance of two points is a lower bound
of the Hamming distance. With ``max_bits`` d, the segments are dealt to two
bands; of two fingerprints within d bits one band holds points within d // 2.
Points are joined on the grid of each band: a point visits its own cell and
those a step of d // 4 (rounded up) around it, so that two points within
d // 2 meet in a cell between them. Every pair of blocks that meets is then
verified exactly on the 64-bit fingerprints.

Skew: equal fingerprints are one node. The nodes of one cell are split into
blocks of about ``block`` members (salted by hash), and what is joined are
blocks, never members. A block's own links are reduced to a forest first;
of two blocks only links between different trees are given, so groups of near
copies don't emit their pairs. The exact links decide alone: no cap on
partners, blocks or buckets.

Defined cases: a null text is empty; a text without words has fingerprint
zero, one with fewer words than the shingle length has its whole word
sequence as its one shingle. Null ids take part and never name a class that
has another id. Repeated rows share fingerprint and class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.common import free_name, stored, text_or_empty
from tabreg.llm.components import connected_components

BITS = 64


def text_fingerprint(text: str | None, shingle_words: int = 4, seed: int = 42) -> int:
    """Signed 64-bit SimHash of a text's word shingles (repeats included)."""
    import xxhash
    words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    k = shingle_words
    grams = [b" ".join(words)] if len(words) < k else map(b" ".join, zip(*(words[i:] for i in range(k))))
    h = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), np.uint64)
    set_bits = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 65536):  # bounded memory for very long texts
        part = np.unpackbits(h[i:i + 65536].view(np.uint8), bitorder="little")
        set_bits += part.reshape(-1, BITS).sum(0, dtype=np.int64)
    packed = np.packbits(2 * set_bits > len(h), bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle_words: int = 4,
                 out: str = "fp") -> DataFrame:
    """``docs`` without its text, with the signed fingerprint in ``out``."""
    others = [c for c in docs.columns if c != text_col]
    rest = docs.select(*[F.col(f"`{c}`") for c in others], F.col(text_col))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = [text_fingerprint(t, shingle_words) for t in pdf.iloc[:, -1]]
            yield pdf.iloc[:, :-1].assign(**{out: np.array(fp, np.int64)})

    schema = docs.select(*[F.col(f"`{c}`") for c in others]).schema.add(out, "long")
    return rest.mapInPandas(run, schema)


def _band(fp, band: int):
    """Bit counts of a band's two-bit segments as one long, two bits each.

    x - ((x >> 1) & 0101..) leaves in every bit pair the count of its bits.
    """
    half = (F.shiftrightunsigned(fp, 32 * band)).bitwiseAND(F.lit(0xFFFFFFFF))
    return half - F.shiftright(half, 1).bitwiseAND(F.lit(0x55555555))


def _blocks(nodes: DataFrame, block: int) -> DataFrame:
    """(band, point, no, fps): the nodes of each point in salted blocks."""
    both = nodes.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(b).cast("byte").alias("band"), _band(F.col("fp"), b).alias("point"))
                                  for b in (0, 1)])).alias("x")).select("fp", "x.band", "x.point")
    size = both.groupBy("band", "point").count()
    crowded = size.filter(F.col("count") > block)
    salted = both.join(crowded, ["band", "point"], "left").withColumn(
        "no", F.pmod(F.xxhash64("fp"), F.ceil(F.coalesce("count", F.lit(1)) / F.lit(block))).cast("int"))
    return salted.groupBy("band", "point", "no").agg(F.sort_array(F.collect_list("fp")).alias("fps"))


def _visits(blocks: DataFrame, signs: tuple[int, ...]) -> DataFrame:
    """Blocks with the cells they visit: own (step 0) and one step around.

    A segment's count runs from 0 to 2; steps that leave the range are left
    out. ``step`` is the change of the packed point.
    """
    options = [F.array(F.lit(0).cast("long"))]
    for sign in signs:
        edge = 0 if sign < 0 else 2
        for i in range(16):
            s = sign * (1 << (2 * i))
            count = F.shiftright(F.col("point"), 2 * i).bitwiseAND(F.lit(3))
            options.append(F.when(count != edge, F.array(F.lit(s).cast("long"))).otherwise(F.array().cast("array<long>")))
    steps = F.flatten(F.array(*options))
    return blocks.select("*", F.explode(steps).alias("step")).withColumn(
        "cell", F.col("point") + F.col("step"))


def _near(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    """(x, y) matrix: within ``max_bits`` bits. Unsigned: of a negative number
    numpy counts the bits of its absolute value."""
    return np.bitwise_count(x.view(np.uint64)[:, None] ^ y.view(np.uint64)[None, :]) <= max_bits


def _local_roots(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """The smallest linked member's index for each member of a block."""
    n = len(fps)
    near = _near(fps, fps, max_bits)
    root = np.arange(n)
    while True:
        low = np.where(near, root[None, :], n).min(1)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _forest(max_bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            a, b = [], []
            for fps in pdf["fps"]:
                fps = np.asarray(fps, np.int64)
                if len(fps) > 1:
                    root = _local_roots(fps, max_bits)
                    own = root != np.arange(len(fps))
                    a.append(fps[own]); b.append(fps[root[own]])
            yield pd.DataFrame({"a": np.concatenate(a or [np.empty(0, np.int64)]),
                                "b": np.concatenate(b or [np.empty(0, np.int64)])})
    return run


def _cross(max_bits: int):
    """Links between the trees of two blocks, one for each pair of trees."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            a, b = [], []
            for x, y in zip(pdf["x_fps"], pdf["y_fps"]):
                x, y = np.asarray(x, np.int64), np.asarray(y, np.int64)
                i, j = np.nonzero(_near(x, y, max_bits))
                if len(i) > 1:
                    rx, ry = x[_local_roots(x, max_bits)[i]], y[_local_roots(y, max_bits)[j]]
                    _, one = np.unique(np.stack([rx, ry]), axis=1, return_index=True)
                    i, j = i[one], j[one]
                a.append(x[i]); b.append(y[j])
            yield pd.DataFrame({"a": np.concatenate(a or [np.empty(0, np.int64)]),
                                "b": np.concatenate(b or [np.empty(0, np.int64)])})
    return run


def links(nodes: DataFrame, max_bits: int = 4, block: int = 512) -> DataFrame:
    """(a, b): between the different fingerprints ``fp`` of ``nodes``, so that
    just those are connected that chains of steps within ``max_bits`` bits
    connect. Within a block a member's link goes to the root of its tree."""
    if not 0 <= max_bits <= 5:
        raise ValueError("two bands with visits of one step find up to 5 bits")
    blocks = stored(_blocks(nodes, block), "simhash-blocks")
    forest = blocks.filter(F.size("fps") > 1).mapInPandas(_forest(max_bits), "a long, b long")
    x = _visits(blocks, (-1,)).select("band", "cell", *[F.col(c).alias(f"x_{c}") for c in ("point", "no", "step", "fps")])
    y = _visits(blocks, (-1, 1)).select("band", "cell", *[F.col(c).alias(f"y_{c}") for c in ("point", "no", "step", "fps")])
    near = F.exists("x_fps", lambda p: F.exists(
        "y_fps", lambda q: F.bit_count(p.bitwiseXOR(q)) <= max_bits))
    # each pair of blocks once: own with own; own with a step down of the higher
    # point; both a step down; a step up of the lower with a step down of the higher
    once = (((F.col("x_step") == 0) & (F.col("y_step") == 0) & (F.col("x_no") < F.col("y_no")))
            | ((F.col("x_step") < 0) & (F.col("y_step") == 0))
            | ((F.col("x_step") < F.col("y_step")) & (F.col("y_step") < 0))
            | ((F.col("x_step") < 0) & (F.col("y_step") > 0) & (F.col("x_point") != F.col("y_point"))))
    met = x.join(y, ["band", "cell"]).filter(once & near).select("x_fps", "y_fps")
    return forest.unionByName(met.mapInPandas(_cross(max_bits), "a long, b long"))


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, max_bits: int) -> DataFrame:
    """One row for each row of ``docs``: ``id``, ``fp``, ``root`` (one for each
    class, a fingerprint), ``component_id``."""
    fps = stored(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                              "text", shingle_words), "simhash-fps")
    nodes = fps.groupBy("fp").agg(F.min("id").alias("id"))
    roots = connected_components(links(nodes.select("fp"), max_bits))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "simhash-roots")
    ids = named.groupBy("root").agg(F.min("id").alias("component_id"))
    return fps.join(named.select("fp", "root").join(ids, "root"), "fp").select("id", "fp", "root", "component_id")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """One row for each row of ``docs``: ``id``, ``fp``, ``component_id``."""
    return _rooted(docs, id_col, text_col, shingle_words, max_bits).drop("root")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay: one for each class, of its smallest id,
    of that id's fingerprints the smallest, of its texts the first by hash."""
    found = _rooted(docs, id_col, text_col, shingle_words, max_bits)
    stay = stored(found.filter(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("id").alias("id"), F.min("fp").alias("fp")).select("id", "fp"), "simhash-stay")
    # ids that don't tell the class: without one, or with several fingerprints
    several = found.filter(F.col("id").isNotNull()).groupBy("id").agg(
        F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a != b").select("id")
    several = stored(several.unionByName(stay.filter("id is null").select("id").distinct()), "simhash-several")
    fp, rank = free_name(docs, "_fp"), free_name(docs, "_rank")
    sole = stay.join(several, stay["id"].eqNullSafe(several["id"]), "left_anti").select(F.col("id").alias("s_id"))
    hit = docs.join(sole, docs[id_col] == F.col("s_id"), "left_semi").withColumn(fp, F.lit(None).cast("long"))
    if not several.isEmpty():
        finger = F.pandas_udf(lambda texts: texts.map(lambda t: text_fingerprint(t, shingle_words)).astype("int64"), "long")
        unsure = docs.join(several, docs[id_col].eqNullSafe(several["id"]), "left_semi").withColumn(
            fp, finger(F.col(f"`{text_col}`")))
        kept = stay.select(F.col("id").alias("s_id"), F.col("fp").alias("s_fp"))
        hit = hit.unionByName(unsure.join(
            kept, unsure[id_col].eqNullSafe(F.col("s_id")) & (unsure[fp] == F.col("s_fp")), "left_semi"))
    text = text_or_empty(f"`{text_col}`")
    turn = Window.partitionBy(F.col(f"`{id_col}`"), fp).orderBy(F.xxhash64(text), text)
    return hit.withColumn(rank, F.row_number().over(turn)).filter(F.col(rank) == 1).drop(fp, rank)
