"""Connected components of a link table by alternating star contractions.

Every round makes each node point at smaller neighbours (large star, then small
star); after a few rounds every node points at the smallest of its component.
Tables between rounds are written, so a lost executor costs one round at most.
Minima are combined before the shuffle, so a node with very many links is one
row per task; the join that hands the minimum back is one AQE can split.
"""

from pyspark.sql import DataFrame, functions as F

from ratemill.llm.tables import written


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _lowest(both).select("a", F.least("a", "low").alias("low"))
    return (
        both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined = down.join(_lowest(down), "a")
    onward = joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return onward.union(joined.select("a", F.col("low").alias("b"))).where("a <> b").distinct()


def _mark(links: DataFrame) -> tuple:
    sums = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), sums).first())


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(a, b) for every linked node a that is not its component's smallest, b.

    ``links`` has numbers a and b, in any direction and number of times. Nodes
    without links, and an empty table, give no rows.
    """
    links = written(links.where("a <> b").distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        nearer = written(_small_star(_large_star(links)), "links")
        before, mark, links = mark, _mark(nearer), nearer
        if mark == before:
            break
    return links
