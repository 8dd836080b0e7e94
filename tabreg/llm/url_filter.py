"""URL filters by hashed expressions.

A URL is expanded into host suffixes and path prefixes; every expression is
hashed, joined with the rules on a short hash prefix, and confirmed by the
full digest and the rule's own host and path. Of the rules that fit the
longest wins.

The prefixes tried are those of a length that some rule's path has, so any
prefix of a path can be a rule. Expressions are made of the different (host,
path) pairs of the table: a URL or host that fills a third of it is expanded
once, and the verdicts are joined back with skew-join splitting.

Defined cases: a null URL or one without ``://`` has empty host and path and
gets the default verdict. Of rules that are equally long the one with the
longer host wins, of equal rules ``block``. Rows repeat as they come; columns
beside the URL pass through. A rule table may be empty.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.llm.common import free_name

PREFIX_HEX = 8  # hexadecimal digits of a short hash prefix: 32 bits


def host_and_path(url: Column) -> tuple[Column, Column]:
    found = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(found > 0, F.substring(url, found + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """Rules as (verdict, "host/path") -> rule, r_host, r_path, r_verdict."""
    rows = [(rule, rule.partition("/")[0].lower(), "/" + rule.partition("/")[2], verdict)
            for verdict, rule in rules]
    return spark.createDataFrame(rows, "rule string, r_host string, r_path string, r_verdict string")


def _expression(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def expressions(pairs: DataFrame, path_lengths: list[int]) -> DataFrame:
    """(host, path) -> with ``e_host``, ``e_path``: all suffixes and prefixes."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_distinct(F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring(F.col("path"), 1, n)) for n in path_lengths]),
        lambda p: p.isNotNull()))
    return (pairs.select("host", "path", F.explode(suffixes).alias("e_host"), prefixes.alias("p"))
            .select("host", "path", "e_host", F.explode("p").alias("e_path")))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (the names
    get underscores before them where ``pages`` has such columns)."""
    names = [free_name(pages, x) for x in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col(url_col))
    own = pages.withColumns({names[0]: host, names[1]: path})
    pairs = own.select(F.col(names[0]).alias("host"), F.col(names[1]).alias("path")).distinct()
    lengths = [r[0] for r in rules.select(F.length("r_path")).distinct().collect()]
    short = F.substring(F.col("digest"), 1, PREFIX_HEX)
    if lengths:
        made = expressions(pairs, sorted(lengths)).withColumn("digest", _expression(F.col("e_host"), F.col("e_path")))
        listed = rules.withColumn("r_digest", _expression(F.col("r_host"), F.col("r_path"))).withColumn(
            "r_short", F.substring("r_digest", 1, PREFIX_HEX))
        hits = made.withColumn("short", short).join(listed, F.col("short") == F.col("r_short")).filter(
            (F.col("digest") == F.col("r_digest")) & (F.col("e_host") == F.col("r_host"))
            & (F.col("e_path") == F.col("r_path")))
        best = hits.groupBy("host", "path").agg(F.max(F.struct(
            F.length("rule"), F.length("r_host"), F.col("r_verdict"), F.col("rule"))).alias("b")).select(
            F.col("host").alias("b_host"), F.col("path").alias("b_path"), F.col("b.rule").alias("b_rule"),
            F.col("b.r_verdict").alias("b_verdict"))
    else:
        best = pairs.filter(F.lit(False)).select(
            F.col("host").alias("b_host"), F.col("path").alias("b_path"),
            F.lit(None).cast("string").alias("b_rule"), F.lit(None).cast("string").alias("b_verdict"))
    found = own.join(best, (own[names[0]] == F.col("b_host")) & (own[names[1]] == F.col("b_path")), "left")
    return found.select(*[own[f"`{c}`"] for c in own.columns], F.col("b_rule").alias(names[2]),
                        F.coalesce("b_verdict", F.lit(default)).alias(names[3]))
