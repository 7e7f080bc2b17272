"""Connected components by joins: alternate between linking neighbours to the least one seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import Staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    links = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return links.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b long): label is the least node of its component.

    Each round reads and writes a table in the shared folder; a star of any size needs two rounds, a path
    of n nodes about log n. Loops (a = b) and repeated edges don't matter; no edges give no rows.
    """
    now = Staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    before = mark(now.df)
    while before[0]:
        large = Staged(_large_star(now.df), "edges")
        now.drop()
        small = Staged(_small_star(large.df), "edges")
        large.drop()
        now, after = small, mark(small.df)
        if after == before:
            break
        before = after
    stars = now.df
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
