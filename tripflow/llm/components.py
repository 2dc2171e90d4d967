"""Connected components by alternating stars.

Every node links to the smallest node it knows (large star), then the smaller neighbours of a node
link to the smallest of them (small star), until only stars are left: as many rounds as the logarithm
of the longest chain, none where links are stars from the start. A node's smallest neighbour is an
aggregate with partial sums, and links are joined with it, so the links of a hot node are never
gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.tables import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step over links (a, b) with a > b."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a")
    if large:
        made = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return made.where("a > b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether the links are stars already: a node links up once, or is linked to, but not both."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(links.select("b", F.lit(0)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return not nodes.agg(F.max((F.col("up") > 0) & (F.col("n") > 1))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(node, component): each linked node with the smallest node it reaches.

    ``links`` has two columns of comparable ids, in any direction and number. Rows with a null are
    left out; nodes without links don't appear.
    """
    a, b = links.columns
    now = stored(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links"
    )
    while not _settled(now):
        now = stored(_star(_star(now, large=True), large=False), "links")
    tops = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(tops)
