"""Connected components of links between 64-bit values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.llm.store import stored


def _star(links: DataFrame, small: bool) -> DataFrame:
    """One star step on links (a, b), a > b: hang neighbours on the least value around.

    The small star of a value joins its smaller neighbours and itself to the least of them; the
    large star joins its larger neighbours to the least value around it.  Minima combine before
    the shuffle, so a value with very many links costs each task one row.
    """
    both = links if small else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if not small:
        return joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    hung = joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _digest(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
        F.sum(F.col("a").cast("decimal(38,0)")).alias("a"),
        F.sum(F.col("b").cast("decimal(38,0)")).alias("b"),
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(a, root) for every value in links (a, b) but the least of each component, its root.

    Alternating star steps shrink every component to a star in a number of rounds that grows with
    the logarithm of the links.  Each round is written to the shared folder; the driver only sees
    counts and sums.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(ordered.where("a > b").distinct(), "links")
    state = _digest(links)
    while True:
        large = _star(links, small=False)
        links = stored(_star(large, small=True), "links")
        before, state = state, _digest(links)
        if state == before:
            return links.select("a", F.col("b").alias("root"))
