"""Connected components of a link table by alternating large and small stars.

Every round is an aggregate and a join; the least node of a component ends as
the centre of a star that holds all others. Nothing is collected but one row
that tells whether a round changed anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One round: every node passes its least neighbour to its larger (or smaller) ones."""
    both = links.union(links.select("v", "u")) if large else links
    least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "star_centres")
    moved = both.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return written(out.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v); root is the least node it reaches."""
    links = written(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _state(links)
    while before[0]:
        links = _star(_star(links, large=True), large=False)
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
