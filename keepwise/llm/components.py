"""Connected components of a link table by alternating large-star and small-star steps.

The steps are many small jobs. None of their joins is a broadcast: the driver would give each its own thread, keep its
pages until it collects its garbage and grow with the number of steps, not with the links.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keepwise.llm.common import salted
from keepwise.session import materialize

_SALTS = 64


def _with_min(neighbours: DataFrame) -> DataFrame:
    """neighbours (u, v) + m = the smallest of u's neighbours and u; hot nodes are split by salt."""
    rows = salted(neighbours, "v", _SALTS)
    # a node has at most ``_SALTS`` rows in its window
    least = (rows.groupBy("u", "_salt").agg(F.min("v").alias("m"))
             .withColumn("m", F.least("u", F.min("m").over(Window.partitionBy("u")))))
    return rows.join(least.hint("merge"), ["u", "_salt"]).drop("_salt")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_min(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u != v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _with_min(down)
    return (near.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(near.select("u", F.col("m").alias("v"))).filter("u != v").distinct())


def _all_stars(links: DataFrame) -> bool:
    """Whether in ``links`` (u, v), all with u > v, every u has one v that is no u: then v is the root."""
    ends = links.select(F.col("u").alias("id"), F.lit(1).alias("as_u"), F.lit(0).alias("as_v"))
    ends = ends.union(links.select("v", F.lit(0), F.lit(1)))
    return (ends.groupBy("id").agg(F.sum("as_u").alias("as_u"), F.max("as_v").alias("as_v"))
            .filter("as_u > 1 or as_u + as_v > 1").isEmpty())


def components(links: DataFrame) -> DataFrame:
    """links (a, b) between ids -> (id, root) for every id in a link; root is the smallest id reachable.

    Self links and repeated links are ignored; an empty table gives an empty table.
    """
    links = materialize(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _all_stars(links):
        links = materialize(_small_star(materialize(_large_star(links))))
    return (links.select(F.col("u").alias("id"), F.col("v").alias("root"))
            .union(links.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct())
