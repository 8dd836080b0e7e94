"""Exact dedup by skew-safe combining.

Texts are equal when they are identical after all ASCII white space
(``[\\x20\\x09-\\x0D]``) is deleted. Of equal texts the row with the most code
points, then the smallest id stays. Groups are combined in three stages, each
of which compares the full normalised content, never the digest alone:

1. locally: the partial aggregation of every map task,
2. per (digest, salt, content): a text that fills a third of the table meets
   in ``n_salts`` tasks, as one row for each task and salt,
3. per (digest, content): one row for each salt.

Contents under one digest are then numbered, so that rows find their group by
(digest, number). Only where a digest has several contents (a collision) the
content itself is joined again.

Defined cases: a null text is an empty text; texts of white space only equal
it. A null id sorts after all others. Of rows that repeat the winning id and
length one stays. Columns beside id and text pass through ``kept_documents``
untouched, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.llm.common import ASCII_SPACE, free_name, stored, text_or_empty


def _sha256(content: Column) -> Column:
    return F.sha2(F.encode(content, "UTF-8"), 256)


def _prepared(docs: DataFrame, id_col: str, text_col: str, digest: Callable) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("id"), F.length(text).alias("n"),
        F.regexp_replace(text, f"{ASCII_SPACE}+", "").alias("content"),
    ).withColumn("digest", digest(F.col("content")))


def _winners(rows: DataFrame, n_salts: int) -> DataFrame:
    """One row for each content: digest, content_no, keep_id, keep_n, group_size."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "n"), F.lit(n_salts)))
    merged = (salted.groupBy("digest", "salt", "content", "n")
              .agg(F.min("id").alias("id"), F.count("*").alias("c")))
    # dealt by digest once: the aggregates and the numbering below need no other exchange
    dealt = merged.repartition("digest")
    lengths = (dealt.groupBy("digest", "content", "n")
               .agg(F.min("id").alias("id"), F.sum("c").alias("c")))
    winners = (lengths.groupBy("digest", "content")
               .agg(F.max_by("id", "n").alias("keep_id"), F.max("n").alias("keep_n"),
                    F.sum("c").alias("group_size")))
    # (content, number) of a digest; more than one only in a collision
    per_digest = winners.groupBy("digest").agg(
        F.sort_array(F.collect_list(F.struct("content", "keep_id", "keep_n", "group_size"))).alias("w"))
    return per_digest.select("digest", F.size("w").alias("n_contents"),
                             F.posexplode("w").alias("content_no", "x")).select(
        "digest", "content_no", "n_contents", "x.keep_id", "x.keep_n", "x.group_size",
        # the content is needed further on only where the digest doesn't tell it
        F.when(F.col("n_contents") > 1, F.col("x.content")).alias("content"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                n_salts: int = 16, digest: Callable[[Column], Column] = _sha256) -> DataFrame:
    """One row for each row of ``docs``: ``id``, ``n`` (code points),
    ``digest``, ``content_no``, ``keep_id``, ``group_size``, ``kept``."""
    rows = _prepared(docs, id_col, text_col, digest)
    winners = stored(_winners(rows, n_salts), "dedup-winners")
    sole = winners.filter("n_contents = 1").drop("n_contents", "content")
    shared = winners.filter("n_contents > 1").drop("n_contents")
    small = rows.select("id", "n", "digest")
    found = small.join(sole, "digest")
    if not shared.isEmpty():  # else the join would shuffle all contents to meet no row
        found = found.unionByName(rows.join(shared, ["digest", "content"]).drop("content"))
    found = stored(found.withColumn("row", F.monotonically_increasing_id())
                   .withColumn("best", F.col("id").eqNullSafe(F.col("keep_id"))
                               & (F.col("n") == F.col("keep_n"))), "dedup-rows")
    # only rows that repeat the winner compete for its place: few of a group, so a
    # hot text's other rows go nowhere again
    best = found.filter("best")
    first = best.groupBy("digest", "content_no").agg(F.min("row").alias("first_row"))
    chosen = best.join(first, ["digest", "content_no"])
    columns = ["id", "n", "digest", "content_no", "keep_id", "group_size"]
    return found.filter("NOT best").select(*columns, F.lit(False).alias("kept")).unionByName(
        chosen.select(*columns, (F.col("row") == F.col("first_row")).alias("kept")))


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   n_salts: int = 16) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that repeat both the id and the content of the winner count as one.
    """
    kept = (exact_dedup(docs, id_col, text_col, n_salts).filter("kept")
            .select(F.col("id").alias("k_id"), F.col("n").alias("k_n"),
                    F.col("digest").alias("k_digest")))
    names = {x: free_name(docs, f"_{x}") for x in ("n", "digest", "rank")}
    text = text_or_empty(text_col)
    own = docs.withColumns({
        names["n"]: F.length(text),
        names["digest"]: _sha256(F.regexp_replace(text, f"{ASCII_SPACE}+", ""))})
    rest = [c for c, kind in docs.dtypes if not kind.startswith("map") and "map<" not in kind and c != text_col]
    hit = own.join(kept, own[id_col].eqNullSafe(kept["k_id"])
                   & (own[names["n"]] == kept["k_n"])
                   & (own[names["digest"]] == kept["k_digest"]), "left_semi")
    # of those that differ in white space or in other columns the same one on every run
    return one_row_each(hit, [id_col, names["n"], names["digest"]], [
        F.col(f"`{text_col}`"), F.xxhash64(F.lit(0), *[F.col(f"`{c}`") for c in rest])]).select(
        *[hit[f"`{c}`"] for c in docs.columns])


def one_row_each(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """The first in ``order`` of the rows that share ``keys``, with its columns whole;
    the rows that share them are few (repeated rows of one document)."""
    from pyspark.sql import Window
    rank = free_name(df, "_rank")
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*(order or [F.lit(0)]))
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) == 1).drop(rank)
