"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import materialize


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).head())


def components(links: DataFrame) -> DataFrame:
    """``node, component``, written, for every node of ``links (a, b)``; a component is named by its smallest node.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest one, then
    all its smaller neighbours and itself. Both need one minimum per node, which is summed up before the shuffle;
    a node with very many neighbours is a hot key on the left side of a join, where the adaptive skew join
    splits it. Every round is written, so nothing is computed twice after a loss.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links")
    state = _checksum(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m"))
        low = F.least("a", "m")
        edges = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), low.alias("b")).distinct()
        edges = materialize(edges, "links")
        lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
        down = edges.join(lowest, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(down.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = _checksum(edges)
        if after == state:
            break
        state = after
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return materialize(ends.unionByName(ends.select(F.col("component").alias("node"), "component")).distinct(), "components")
