"""Connected components of a link table, as Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.sources.storage import materialize


def _minimum(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m) with m the smallest of u and all its v."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(least, "u")


def _turned(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _tangled(edges: DataFrame) -> bool:
    """Whether the edges are not yet stars around their smaller ends."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    roles = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not roles.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (u, v); component is the
    smallest id that links reach.

    Large-star and small-star steps alternate until the edges are stars around
    their smallest id; the number of rounds is logarithmic in the diameter.
    Minima are combined per task before the shuffle, and joins on a hot id are
    left to the skew handling of AQE. Each round is written to the shared
    folder, so a lost executor repeats one round at most. Self links and
    repeated links do no harm; no link gives no row.
    """
    edges = materialize(_turned(links.where("u is not null and v is not null")), "component-edges")
    while _tangled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _minimum(large.where("u <> v")).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(_turned(small), "component-edges")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
