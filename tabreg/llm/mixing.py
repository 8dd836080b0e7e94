"""Temperature mixing of sources, in DataFrame functions only.

A source's share of all tokens is raised to an exponent, 0 for all sources
alike, 1 as they are, and normalised. The exponent is bisected on aggregates of
the source table: the smallest one whose mixture has at most the target entropy
and repeats no source more than ``max_repeats`` times within the budget. A
target below the entropy of the sources as they are is out of reach: the
exponent is 1, the sources stay as they are, and a warning says so. With
``most`` above 1 such a target is met too, by an exponent of at most ``most``
that favours the large sources. Those repeat more as it grows; where that
meets the repetition limit first, the largest exponent within the limit is
taken, with the warning.
``halfway_entropy`` (target ``HALFWAY``) gives a target within reach of any
sources that differ, with an exponent below 1.

The weights are realised as budgeted block permutations. A source's documents
are hashed to blocks of about the square root of its size; every pass over
the source takes the blocks in another pseudo-random order, and the documents
of a block likewise. Passes repeat until the source's part of the budget is
used; the last pass ends within a block, at the last document that fits. No
window holds more than the blocks of a source or the documents of a block.

Defined cases: a null source is a source of its own; a null or empty text
counts one token, so every document can be drawn; repeated rows are drawn
one by one; an empty table gives an empty mixture.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.common import ASCII_SPACE, free_name, stored, text_or_empty

WAYS = 16  # an interval of exponents is cut in so many parts a round
HALFWAY = "halfway"


def word_count(text: Column) -> Column:
    """White-space words of a text, one at least."""
    words = F.filter(F.split(text, f"{ASCII_SPACE}+"), lambda w: w != "")
    return F.greatest(F.size(words), F.lit(1)).cast("long")


def source_table(rows: DataFrame) -> DataFrame:
    """(source, n_docs, tokens) of (source, tokens) rows."""
    return rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("tokens").alias("tokens"))


def fit_exponent(sources: DataFrame, budget: float | None = None, target_entropy: float | None = None,
                 max_repeats: float | None = None, tolerance: float = 1e-9, most: float = 1.0) -> tuple[float, float]:
    """(exponent, normaliser Z): weights are share ** exponent / Z.

    ``target_entropy`` is a part of the largest one, ln(number of sources).
    Without a budget repeats are counted against all tokens.
    """
    total = sources.agg(F.sum("tokens").cast("double").alias("t"), F.count("*").alias("n")).first()
    if not total["n"]:
        return 1.0, 1.0
    t, n = total["t"], total["n"]
    share = F.col("tokens") / F.lit(t)

    def state(exponents: list[float]) -> list[tuple[float, float, float]]:
        """Z, entropy and the most repeats at each exponent, in one aggregate."""
        sums = sources.agg(*[x for i, a in enumerate(exponents) for x in (
            F.sum(F.pow(share, F.lit(a))).alias(f"z{i}"),
            F.sum(F.pow(share, F.lit(a)) * F.log(share)).alias(f"l{i}"),
            F.max(F.pow(share, F.lit(a - 1))).alias(f"r{i}"))]).first()
        out = []
        for i, a in enumerate(exponents):
            z = sums[f"z{i}"]
            out.append((z, math.log(z) - a * sums[f"l{i}"] / z, (budget or t) / t * sums[f"r{i}"] / z))
        return out

    def flat(x: tuple[float, float, float]) -> bool:
        return target_entropy is None or x[1] <= target_entropy * math.log(n) + 1e-12

    def spared(x: tuple[float, float, float]) -> bool:
        return max_repeats is None or x[2] <= max_repeats * (1 + 1e-12)

    def first(low: float, high: float, holds) -> float:
        """The least exponent that holds, of an interval at whose end it does;
        what holds goes on to hold as the exponent grows."""
        while high - low > tolerance:
            inner = [low + (high - low) * i / WAYS for i in range(1, WAYS)]
            done = [holds(x) for x in state(inner)]
            i = done.index(True) if True in done else len(inner)
            low, high = ([low] + inner)[i], (inner + [high])[i]
        return high

    zero, one = state([0.0, 1.0])
    if flat(zero) and spared(zero):
        return 0.0, zero[0]
    # up to 1 a smaller exponent repeats the small sources more, beyond 1 a larger one the large ones
    if flat(one) and spared(one):
        exponent, reached = first(0.0, 1.0, lambda x: flat(x) and spared(x)), True
    elif not spared(one):
        exponent, reached = 1.0, False
    else:
        widest = sources.agg(F.max(share)).first()[0]
        if widest < 1:  # powers stay above the least double
            most = max(1.0, min(most, -290.0 / math.log10(widest)))
        reached = most > 1 and flat(state([most])[0])
        exponent = first(1.0, most, flat) if reached else most
        if not spared(state([exponent])[0]):
            exponent, reached = first(1.0, exponent, lambda x: not spared(x)) - 2 * tolerance, False
    if not reached:
        warnings.warn(f"mixing: the limits (entropy {target_entropy}, repeats {max_repeats}) are out of reach; "
                      + ("the sources stay as they are" if exponent == 1 else f"the exponent is {exponent:.6g}"), stacklevel=2)
    return exponent, state([exponent])[0][0]


def halfway_entropy(sources: DataFrame) -> float:
    """As a part of the largest one, the entropy halfway between that of the
    sources as they are and the largest; 1 for a single source or none."""
    total = sources.agg(F.sum("tokens").cast("double").alias("t"), F.count("*").alias("n")).first()
    if total["n"] < 2:
        return 1.0
    share = F.col("tokens") / F.lit(total["t"])
    return (1 + sources.agg(-F.sum(share * F.log(share))).first()[0] / math.log(total["n"])) / 2


def weights(sources: DataFrame, exponent: float, z: float, budget: float | None) -> DataFrame:
    """``sources`` with share, weight, quota (tokens) and epochs.

    Without a budget the largest is taken that repeats no document.
    """
    total = sources.agg(F.sum("tokens").cast("double")).first()[0] or 1.0
    share = F.col("tokens") / F.lit(total)
    out = sources.withColumn("share", share).withColumn("weight", F.pow(share, F.lit(exponent)) / F.lit(z))
    if budget is None:
        budget = out.agg(F.min(F.col("tokens") / F.col("weight"))).first()[0] or 0.0
        epochs = F.least(F.lit(1.0), F.lit(budget) * F.col("weight") / F.col("tokens"))
        # the source that sets the budget is taken whole, whatever rounding says
        epochs = F.when(epochs > 1 - 1e-9, F.lit(1.0)).otherwise(epochs)
    else:
        epochs = F.lit(float(budget)) * F.col("weight") / F.col("tokens")
    return out.withColumn("epochs", epochs).withColumn("quota", epochs * F.col("tokens"))


def schedule(rows: DataFrame, budget: float | None = None, target_entropy: float | str | None = None,
             max_repeats: float | None = None, seed: int = 7, budget_epochs: float | None = None,
             most: float = 1.0) -> DataFrame:
    """(id, source, tokens) -> one row for each drawn copy: id, source, tokens,
    weight, epochs, pass_no, block, place.

    ``budget_epochs`` gives the budget as a multiple of all tokens, the target
    ``HALFWAY`` stands for ``halfway_entropy``. ``place`` (0 to 1) is where the
    copy's block begins in the run: sorted by it, the sources interleave at
    their weights all along.
    """
    rows = stored(rows, "mix-rows")
    sources = stored(source_table(rows), "mix-sources")
    if budget_epochs is not None:
        budget = budget_epochs * (sources.agg(F.sum("tokens").cast("double")).first()[0] or 0.0)
    if target_entropy == HALFWAY:
        target_entropy = halfway_entropy(sources)
    exponent, z = fit_exponent(sources, budget, target_entropy, max_repeats, most=most)
    plan = stored(weights(sources, exponent, z, budget).withColumn(
        "n_blocks", F.ceil(F.sqrt("n_docs"))), "mix-plan").withColumnRenamed("source", "p_source")

    dealt = rows.join(plan.select("p_source", "n_blocks"), F.col("source").eqNullSafe(F.col("p_source"))).select(
        "id", "source", "tokens",
        F.pmod(F.xxhash64("id", "tokens", F.lit(seed)), F.col("n_blocks")).alias("block"))
    blocks = (dealt.groupBy("source", "block").agg(F.sum("tokens").alias("b_tokens"))
              .join(plan, F.col("source").eqNullSafe(F.col("p_source")))
              .filter("epochs > 0")
              .withColumn("pass_no", F.explode(F.sequence(F.lit(0), F.ceil("epochs").cast("int") - 1))))
    turn = Window.partitionBy("source", "pass_no").orderBy(F.xxhash64("block", "pass_no", F.lit(seed + 1)), "block")
    before = F.sum("b_tokens").over(turn.rowsBetween(Window.unboundedPreceding, 0)) - F.col("b_tokens")
    blocks = (blocks.withColumn("begins", F.col("pass_no") * F.col("tokens") + before)
              .withColumn("room", F.col("quota") - F.col("begins"))
              # rounding of shares and powers never costs a document
              .withColumn("room", F.when(F.abs(F.col("room") - F.col("b_tokens")) < 1e-6 * F.col("quota") + 1e-9,
                                         F.col("b_tokens").cast("double")).otherwise(F.col("room")))
              .filter("room > 0")
              .select(F.col("source").alias("b_source"), F.col("block").alias("b_block"), "pass_no", "weight",
                      "epochs", "room", "b_tokens", (F.col("begins") / F.col("quota")).alias("place")))
    drawn = dealt.join(blocks, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("block") == F.col("b_block")))
    whole = drawn.filter("b_tokens <= room")
    # of the last pass's last block, the documents that fit
    inner = Window.partitionBy("source", "block", "pass_no").orderBy(
        F.xxhash64("id", "pass_no", F.lit(seed + 2)), "id", "tokens")
    cut = (drawn.filter("b_tokens > room")
           .withColumn("upto", F.sum("tokens").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
           .filter("upto <= room").drop("upto"))
    return whole.unionByName(cut).select(
        "id", "source", "tokens", "weight", "epochs", "pass_no", "block", "place")


def rows_of(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       word_count(text_or_empty(text_col)).alias("tokens"))


def mixed_documents(docs: DataFrame, budget: float | None = None, target_entropy: float | str | None = None,
                    max_repeats: float | None = None, id_col: str = "doc_id", source_col: str = "source",
                    text_col: str = "text", seed: int = 7, budget_epochs: float | None = None,
                    most: float = 1.0) -> DataFrame:
    """The mixture as rows of ``docs`` with all their columns, one for each copy."""
    drawn = schedule(rows_of(docs, id_col, source_col, text_col), budget, target_entropy, max_repeats, seed,
                     budget_epochs, most)
    copies = drawn.groupBy(F.col("id").alias("m_id"), F.col("source").alias("m_source"),
                           F.col("tokens").alias("m_tokens")).agg(F.count("*").alias("m_copies"))
    tokens, again = free_name(docs, "_tokens"), free_name(docs, "_again")
    own = docs.withColumn(tokens, word_count(text_or_empty(text_col)))
    # rows that share id, source and length share the copies drawn of them
    alike = own.groupBy(F.col(id_col).alias("s_id"), F.col(source_col).alias("s_source"),
                        F.col(tokens).alias("s_tokens")).agg(F.count("*").alias("s_rows"))
    each = copies.join(alike, F.col("m_id").eqNullSafe(F.col("s_id")) & F.col("m_source").eqNullSafe(F.col("s_source"))
                       & (F.col("m_tokens") == F.col("s_tokens"))).select(
        "m_id", "m_source", "m_tokens", F.ceil(F.col("m_copies") / F.col("s_rows")).cast("int").alias("m_each"))
    hit = own.join(each, own[id_col].eqNullSafe(F.col("m_id")) & own[source_col].eqNullSafe(F.col("m_source"))
                   & (own[tokens] == F.col("m_tokens")))
    return hit.withColumn(again, F.explode(F.array_repeat(F.lit(0), F.col("m_each")))).select(
        *[own[f"`{c}`"] for c in docs.columns])
