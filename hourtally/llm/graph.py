"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourtally.llm import stored


def _pointed(links: DataFrame) -> DataFrame:
    """Every link once, from its larger end to its smaller one."""
    one_way = links.where(F.col("a") != F.col("b"))
    return one_way.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a table, and their number and a sum, by which two tables are told apart."""
    seen = Observation()
    counted = links.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))
    table = stored.written(counted, "graph")
    return table, (seen.get["n"], seen.get["sum"])


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node with a link; the component is its smallest node.

    Links are ``a, b``. Alternating large-star and small-star steps: each step hangs the
    neighbours of a node on the smallest of them. The number of links never grows, steps
    are few (about the logarithm of the longest path), and every step is written to the
    shared folder. Nothing but a count and a sum comes to the driver.
    """
    links, mark = _written(_pointed(links))
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        larger = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
        hung = larger.join(least, "a").select(F.greatest("b", "low").alias("a"), F.least("b", "low").alias("b"))
        # A node has few smaller neighbours, however many hang on it.
        low = F.min("b").over(Window.partitionBy("a"))
        small = hung.where(F.col("a") != F.col("b")).select("a", "b", low.alias("low"))
        ends = F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b"))))
        before = links
        links, now = _written(_pointed(small.select(ends.alias("link")).select("link.*")))
        stored.released(before)
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
