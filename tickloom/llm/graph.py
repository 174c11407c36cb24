"""Connected components: of links in one task's arrays, and of a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, written

#: Copies of each node's minimum, among which the links of a hub are dealt.
SALTS = 8


def union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the classes of a and b; labels stay the smallest place of their class."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label != (up := label[label])).any():
            label[:] = up


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (a, b): root is the smallest node of its connected component.

    Alternating large and small stars, each a minimum per node joined back to its links; both are partial aggregations, and
    the links of a hub are dealt among SALTS copies of its minimum. Each round is written, so lineage stays short. Minima are
    joined by merging, as their number grows with the links.
    """

    def star(links: DataFrame, both: bool) -> DataFrame:
        ways = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        if both:
            ways = ways.unionByName(ways.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        met = ways.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(low.hint("merge"), ["u", "salt"])
        if both:
            out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = met.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(low.where("salt = 0").select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a != b").distinct()

    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = written(links.where("a != b").distinct(), "links")
    seen = state(now)
    while seen[0]:
        new = written(star(star(now, True), False), "links")
        removed(now)
        now, before, seen = new, seen, state(new)
        if seen == before:
            break
    # A fixed point is a set of stars: every node but the roots has one link, to its root.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
