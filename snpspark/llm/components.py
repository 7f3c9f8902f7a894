"""Connected components of a table of links, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each node to the least node of its component, in place of the given links; for use inside a task."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    other = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[other], nodes[root[other]]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u")
    return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v): each node that isn't the least of its component, with that least node. links: u, v of one type.

    Every step is a group-by and a join over the links, written to the checkpoint folder; the number of rounds grows
    with the logarithm of the longest chain. Two numbers a round reach the driver. Nodes that no link names don't come.
    """
    links = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        mark = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("v", "u"), 24))).first()
        if mark == seen or not mark[0]:
            return links
        seen = mark
        links = stored(_small_star(_large_star(links)))
