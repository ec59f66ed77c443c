"""Connected components of a large edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.session import shared_path, staged, unstaged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for each node of ``edges`` (u long, v long) but the roots, which are the smallest nodes.

    Each step is written to the shared folder, and all but the last two are deleted. A hub's edges are joined to one row of its minimum, so
    adaptive execution can split them; minima are combined before the shuffle. No nulls are allowed.
    """
    spark = edges.sparkSession
    paths = [shared_path(spark, "edges")]
    edges = staged(edges.where("u <> v").select("u", "v"), "edges", path=paths[0])
    before = None
    while (now := _state(edges)) != before and now[0]:
        before = now
        paths.append(shared_path(spark, "edges"))
        edges = staged(_small_star(_large_star(edges)), "edges", path=paths[-1])
        if len(paths) > 2:  # what the table before last was read for is written
            unstaged(spark, paths[-3])
    return edges.select("u", F.col("v").alias("root"))
