"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.common import discard, written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every end of a link in columns ``a`` and ``b``; the component is its smallest node.

    Large-star and small-star steps take turns: first every node's larger neighbours are linked to its smallest one,
    then its smaller neighbours. After a logarithmic number of turns each component is a star. Minima are taken within
    the tasks before rows are shuffled. Minima and links are written to the shared folder, so the joins are of two plain
    tables and Spark can split them at a hot node.
    """
    links = written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), "links")
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least")),
                        "least")
        large = written(both.filter("b > a").join(least, "a").select(F.col("least").alias("a"), "b")
                        .filter("a <> b").distinct(), "links")
        smallest = written(large.groupBy("b").agg(F.min("a").alias("least")), "least")
        small = large.join(smallest, "b")
        new = written(small.select(F.col("least").alias("a"), "b")
                      .union(small.select(F.col("least").alias("a"), F.col("a").alias("b")))
                      .filter("a <> b").distinct(), "links")
        same = _digest(new) == _digest(links)
        discard(least, large, smallest, links)
        links = new
        if same:
            break
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")) \
        .union(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def _digest(links: DataFrame):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))
                     ).first()
