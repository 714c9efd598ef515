"""Connected components of a table of links, by alternating stars.

Every round links each node's larger neighbours to its smallest one, then its smaller neighbours
likewise, so that components turn into stars around their smallest node in about as many rounds as
the logarithm of their size. Rounds are aggregations that combine before the shuffle and lookups in
them, in stages of their own, so that adaptive execution can split the partition of a star's centre. Each round is written, so that
plans stay short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import saved
from tallyline.operators.skew import lookup


def _mark(links: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(links.agg(F.count("*"), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.bit_xor(h)).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row ``(node, root)`` for every node of a link but the roots themselves; the root is the
    smallest node that can be reached. Links without one end or of a node to itself are ignored,
    repeated ones count once."""
    x, y = F.col(a), F.col(b)
    links = saved(links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (lookup(both.where("v > u"), least, "u").where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (lookup(large, low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        links = saved(small, "stars")
        after = _mark(links)
        if after == mark:
            break
        mark = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
