"""Connected components of a link table, by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014), as joins and minima: a
node's smallest neighbour is an aggregate that tasks prepare before the shuffle, so a node with
very many links is no group that one task must hold. Every round is written to the scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.sources.scratch import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component, for every node of links (a, b), a > b, longs."""
    links = materialize(links.distinct(), "links")
    while True:
        stars = materialize(small_star(large_star(links)), "stars")
        # A fixed point of both steps is a set of stars.
        changed = stars.join(links, ["a", "b"], "left_anti").limit(1).count() + links.join(stars, ["a", "b"], "left_anti").limit(1).count()
        links = stars
        if not changed:
            break
    roots = links.select("b").distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("root")))


def large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour or itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("at"), F.least("a", "m").alias("m"))
    larger = both.where(F.col("b") > F.col("a"))
    return larger.join(least, F.col("a") == F.col("at")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of these."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least.withColumnRenamed("a", "at"), F.col("a") == F.col("at")).where(F.col("b") > F.col("m"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()
