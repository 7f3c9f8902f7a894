"""Aligned assemblies: each reference position's base as the alignments of an assembly tell it.

An alignment's signed distances say after how many bases one of the two sequences has a base that the other lacks:
positive the reference (a deletion in the assembly), negative the assembly (an insertion, skipped). Prefix sums over
the distances give copied segments; these are exploded into positions and joined with the assembly's bases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import InvalidContigName
from ..functions.calls import reverse_complement


def segments(alignments: DataFrame) -> DataFrame:
    """(…, ref_from, query_from, step, length, deleted): segments copied one base for one.

    alignments: record_ord, alignment_ord, ref_name, query_name, ref_start, ref_end, query_start, query_end, distances.
    Each segment is followed by one deleted reference position if `deleted`. step: 1, or -1 on the other strand.
    """
    key = ["record_ord", "alignment_ord"]
    rows = alignments.select(*key, "ref_name", "query_name", "ref_start", "ref_end", "query_start", F.when(F.col("query_end") >= F.col("query_start"), 1).otherwise(-1).alias("step"), F.posexplode(F.concat(F.filter("distances", lambda d: d != 0), F.array(F.lit(0).cast("long")))).alias("k", "d"))
    before = Window.partitionBy(*key).orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    copied = F.when(F.col("d") == 0, 0).otherwise(F.abs("d") - 1)
    sums = lambda more: F.coalesce(F.sum(copied + more.cast("long")).over(before), F.lit(0))
    rows = rows.withColumn("ref_from", F.col("ref_start") + sums(F.col("d") > 0)).withColumn("query_from", F.col("query_start") + F.col("step") * sums(F.col("d") < 0))
    return rows.select(*key, "ref_name", "query_name", "ref_from", "query_from", "step", F.when(F.col("d") == 0, F.col("ref_end") - F.col("ref_from") + 1).otherwise(copied).alias("length"), (F.col("d") > 0).alias("deleted"))


def missing_sequences(alignments: DataFrame, assembly: DataFrame) -> DataFrame:
    """Names of aligned sequences that the assembly lacks."""
    return alignments.select("query_name").distinct().join(assembly.select(F.col("contig").alias("query_name")).distinct(), "query_name", "left_anti")


def aligned(alignments: DataFrame, assembly: DataFrame, deletion="X", check=True) -> DataFrame:
    """(contig, pos, call): what the assembly (contig, pos, call) has at the reference positions that it covers.

    deletion: how a position that the assembly lacks is written (X or a dot). Within a record a later alignment wins;
    where records disagree the call is N.
    """
    if check and (lost := missing_sequences(alignments, assembly).head()):
        raise InvalidContigName(f"aligned, but not in the assembly: {lost[0]}")
    rows = segments(alignments)
    steps = F.sequence(F.lit(0).cast("long"), F.col("length") - F.when(F.col("deleted"), 0).otherwise(1))
    rows = rows.where("length > 0 or deleted").select("*", F.explode(steps).alias("i"))
    gone = F.col("deleted") & (F.col("i") == F.col("length"))
    rows = rows.select("record_ord", "alignment_ord", F.col("ref_name").alias("contig"), (F.col("ref_from") + F.col("i")).alias("pos"), F.when(~gone, F.col("query_name")).alias("q_"), (F.col("query_from") + F.col("step") * F.col("i")).alias("p_"), "step")
    own = assembly.select(F.col("contig").alias("q_"), F.col("pos").alias("p_"), F.upper("call").alias("base_"))
    found = rows.where("q_ is not null").join(own, ["q_", "p_"], "left").unionByName(rows.where("q_ is null").withColumn("base_", F.lit(None).cast("string")))
    base = F.when(F.col("q_").isNull(), deletion).otherwise(F.coalesce(F.when(F.col("step") == 1, F.col("base_")).otherwise(reverse_complement("base_")), F.lit("X")))
    each = found.withColumn("call", base).groupBy("contig", "pos", "record_ord").agg(F.max_by("call", "alignment_ord").alias("call"))
    return overlapped(each)


def overlapped(each: DataFrame) -> DataFrame:
    """One call for each position of (contig, pos, call): what all set ones agree on, N where they don't, X if none is."""
    set_ = F.when(F.col("call") != "X", F.col("call"))
    return each.groupBy("contig", "pos").agg(F.min(set_).alias("a"), F.max(set_).alias("b")).select("contig", "pos", F.when(F.col("a").isNull(), "X").when(F.col("a") == F.col("b"), F.col("a")).otherwise("N").alias("call"))


def on_reference(reference: DataFrame, calls: DataFrame) -> DataFrame:
    """The calls at all reference positions, X where there is none."""
    return reference.select("contig", "pos").join(calls, ["contig", "pos"], "left").withColumn("call", F.coalesce("call", F.lit("X")))
