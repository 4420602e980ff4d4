"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlekit.session import stage

ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in the columns `a`, `b` of `links`; a component is
    named by its smallest id.

    Alternates two steps until all links are stars: every id hands the smallest id around
    it to its larger neighbours, then to its smaller ones and itself. Each step keeps
    the components, moves links towards the smallest id, and is one aggregation and
    one join over the links; chains shrink to stars in a number of rounds that grows
    with the logarithm of their length. An id with many links is aggregated on the
    map side. Each round is written to the shared folder, which cuts the lineage.
    Links that are stars already take no round.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "links"
    )
    rounds = 0
    while not _are_stars(edges):
        if rounds == ROUNDS:
            raise RuntimeError(f"Components are not complete after {ROUNDS} rounds")
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(down.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        edges = stage(small, "links")
        rounds += 1
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every id of the links (u, v), u > v, has one smaller neighbour only or larger ones only."""
    ends = edges.select("u", F.lit(1).alias("smaller")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("smaller")))
    wrong = ends.groupBy("u").agg(F.sum("smaller").alias("smaller"), F.count("*").alias("all"))
    return not wrong.agg(F.count_if((F.col("smaller") > 0) & (F.col("all") > 1))).first()[0]
