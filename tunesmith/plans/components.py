"""Connected components of an edge table, in rounds that each halve what is left or better."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.session import stored_once


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of each connected component of ``edges`` (u, v), for every
    node that isn't itself the smallest.

    Alternating stars: every node links its larger neighbours to the smallest of its neighbourhood,
    then its smaller ones. Only edges travel, a node of many edges is a partial aggregate, each
    round is written to the shared folder, and there are as many rounds as it takes (logarithmic in
    practice), until nothing changes."""
    e = stored_once(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "component-edges")
    state = None
    while True:
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("m", "u").alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        small = large.join(down, F.col("u") == F.col("w")).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored_once(small.union(down.select("w", "m")).distinct(), "component-edges")
        seen = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:  # each component is a star around its smallest node
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
