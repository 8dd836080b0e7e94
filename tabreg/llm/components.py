"""Connected components of a link table by alternating star contractions.

Every round writes its links to the shared folder; the driver only sees a
count and a checksum. Links of one node may be a third of all links: the
minima are pre-aggregated, the joins are left to the skew-join splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.filter("b > a").join(low, "a").filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that a link (a, b) names; the root is the
    smallest node reachable. Self links and repeated links do no harm."""
    links = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    before = None
    while True:
        state = links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before or not state[0]:
            break
        before = state
        links = stored(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
