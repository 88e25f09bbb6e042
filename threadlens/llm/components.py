"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` that is not its component's least node.

    Alternates large stars and small stars: each node hands its larger neighbours, then
    its smaller ones, to the least node it knows. Rounds grow with the logarithm of the
    component size; a hub meets only as a minimum, which is combined before the
    shuffle. Repeated edges and loops are allowed; without edges the result is empty.
    """
    now = settle(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, F.col("u") == F.col("k"))
                 .filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = (large.join(least, F.col("u") == F.col("k")).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least).distinct())
        now = settle(small)
        was, state = state, tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if was == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
