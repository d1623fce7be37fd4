"""Connected components of a table of links by alternating star contraction, one written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.shared import write_once


def _measure(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v: long) -> (node, root): root is the smallest node that node is linked to, directly or not.

    Only nodes with a link to another node appear. Every round hangs each node's larger neighbours under its smallest one,
    then each node's smaller neighbours; the number of rounds is logarithmic. Links stay in tables, nothing is collected.
    """
    links = write_once(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before = None
    while (now := _measure(links)) != before and now[0]:
        before = now
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = write_once(large.filter("u <> v"), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        links = write_once(small, "links")
    return links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
