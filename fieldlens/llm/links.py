"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.session import stored


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has a link: columns node, root.

    ``links`` has two columns of one orderable type; direction, repeats and links of a node to itself
    do not matter, null ends are no links. Large-star and small-star steps alternate until nothing
    changes, which takes a number of rounds that grows with the logarithm of the largest component.
    Each round is written to the shared folder, so a lost executor repeats one round at most, and
    the driver sees only a count and a checksum.
    """
    a, b = links.columns
    edges = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges, mark = _kept(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, now = _kept(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    saved, rows = stored(edges, "links")
    total = saved.agg(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()["s"]
    return saved, (rows, total)
