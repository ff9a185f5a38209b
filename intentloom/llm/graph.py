"""Connected components of links, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentloom.session import settle


def _outward(links: DataFrame) -> DataFrame:
    """Every neighbour above a node goes to the smallest of that node's neighbourhood."""
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = links.unionByName(turned)
    lowest = around.groupBy("a").agg(F.min("b").alias("m"))
    lowest = settle(lowest.select("a", F.least("a", "m").alias("m")), "lowest")
    # of both directions only (a, b) with b above a moves: that is `turned`
    return turned.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _inward(links: DataFrame) -> DataFrame:
    """Every node, and its neighbours below, go to the smallest of these neighbours."""
    lowest = settle(links.groupBy("a").agg(F.min("b").alias("m")), "lowest")
    moved = links.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a > b").unionByName(lowest.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has links; root is the component's smallest node.

    `links` has the bigint columns a and b. Large and small stars alternate until
    nothing moves: a number of rounds that grows with the logarithm of a component's
    size. Minima are combined before they are shuffled, and no neighbourhood is ever
    collected, so a node may have any number of links. Nothing is sent to the driver
    but two sums per round.
    """
    stars = settle(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b")
        .distinct(),
        "links",
    )
    seen = None
    while True:
        mark = stars.agg(
            F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(a % 65521 + b % 65521)")
        ).first()
        if mark[0] == 0 or mark == seen:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = mark
        stars = settle(_inward(_outward(stars).distinct()).distinct(), "stars")
