"""Closed intervals of positions: marking, merging, and the duplicated regions that self-alignments tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calls as C


def ordered(intervals: DataFrame) -> DataFrame:
    """Intervals with their smaller end first."""
    return intervals.select("contig", F.least("start_pos", "end_pos").alias("start_pos"), F.greatest("start_pos", "end_pos").alias("end_pos"))


def merged(intervals: DataFrame) -> DataFrame:
    """The union of overlapping intervals: an interval starts a new one if it starts behind all earlier ends."""
    own = Window.partitionBy("contig").orderBy("start_pos", "end_pos")
    before = F.max("end_pos").over(own.rowsBetween(Window.unboundedPreceding, -1))
    rows = ordered(intervals).withColumn("new_", F.coalesce(F.col("start_pos") > before, F.lit(True)).cast("int"))
    rows = rows.withColumn("island_", F.sum("new_").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("contig", "island_").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("island_")


def marked(reference: DataFrame, intervals: DataFrame, cell: int = 4096) -> DataFrame:
    """reference with `marked`: whether a position lies in an interval.

    Intervals are merged and cut at multiples of `cell`; positions meet those of their cell by an equi-join, so a long
    interval or contig is spread over many tasks.
    """
    pieces = merged(intervals).select("contig", "start_pos", "end_pos", F.explode(F.sequence(F.floor(F.col("start_pos") / cell), F.floor(F.col("end_pos") / cell))).alias("cell_"))
    inside = pieces.groupBy("contig", "cell_").agg(F.collect_list(F.struct("start_pos", "end_pos")).alias("in_"))
    rows = reference.withColumn("cell_", F.floor(F.col("pos") / cell)).join(inside, ["contig", "cell_"], "left")
    hit = F.exists("in_", lambda i: (F.col("pos") >= i["start_pos"]) & (F.col("pos") <= i["end_pos"]))
    return rows.withColumn("marked", F.coalesce(hit, F.lit(False))).drop("cell_", "in_")


def duplicated(alignments: DataFrame) -> DataFrame:
    """Intervals that alignments of a reference with itself show to be repeated, trivial hits left out."""
    real = ~C.is_self_hit("ref_name", "query_name", "ref_start", "ref_end", "query_start", "query_end")
    hits = alignments.where(real)
    one = hits.select(F.col("ref_name").alias("contig"), F.col("ref_start").alias("start_pos"), F.col("ref_end").alias("end_pos"))
    two = hits.select(F.col("query_name").alias("contig"), F.col("query_start").alias("start_pos"), F.col("query_end").alias("end_pos"))
    return ordered(one.union(two))


def mask(reference: DataFrame, intervals: DataFrame) -> DataFrame:
    """(contig, pos, mask): 1 inside intervals, 0 outside."""
    return marked(reference, intervals).select("contig", "pos", F.when(F.col("marked"), "1").otherwise("0").alias("mask"))
