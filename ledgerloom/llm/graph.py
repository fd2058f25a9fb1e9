"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.storage import saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root) for every id that has a link; the root is the smallest id of its component.

    Alternating large-star and small-star rounds: every round links each id to a smaller one of its neighbourhood, and
    their number grows with the logarithm of the longest path. Minima are taken by partial aggregates and joined back, so
    a hub is never gathered. A round is a written table, so lineage does not grow and a lost executor costs one round.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    edges = saved(links.filter(F.col(a) != F.col(b)).select(high.alias("v"), low.alias("m")).distinct(), "links")
    mark = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            return edges.select(F.col("v").alias("id"), F.col("m").alias("root")).union(edges.select("m", "m").distinct())
        mark = tuple(state)
        both = edges.select(F.col("v").alias("u"), F.col("m").alias("n")).union(edges.select("m", "v"))
        least = both.groupBy("u").agg(F.min("n").alias("least"))
        least = least.select("u", F.least("u", "least").alias("least"))
        large = both.filter("n > u").join(least, "u").select(F.col("n").alias("v"), F.col("least").alias("m")).distinct()
        best = large.groupBy("v").agg(F.min("m").alias("best"))
        small = large.join(best, "v")
        edges = saved(
            small.select("v", F.col("best").alias("m"))
            .union(small.filter("m <> best").select(F.greatest("m", "best"), F.least("m", "best")))
            .distinct(),
            "links",
        )
