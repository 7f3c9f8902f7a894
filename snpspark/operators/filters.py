"""Filters and reports over matrices, given as (contig, pos, ref_call, calls)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calls as C


def _every():
    return F.concat(F.array("ref_call"), F.col("calls"))


def keep_coordinates(rows: DataFrame, coords: DataFrame) -> DataFrame:
    return rows.join(coords.select("contig", "pos").distinct(), ["contig", "pos"], "left_semi")


def remove_coordinates(rows: DataFrame, coords: DataFrame) -> DataFrame:
    return rows.join(coords.select("contig", "pos").distinct(), ["contig", "pos"], "left_anti")


def choose_samples(rows: DataFrame, identifiers: list[str], names: list[str], action: str = "keep") -> tuple[DataFrame, list[str]]:
    """`rows` with the calls of some samples, and their identifiers; the counters stay as they are."""
    own = [i for i, x in enumerate(identifiers) if (x in set(names)) == (action == "keep")]
    return rows.withColumn("calls", F.array(*(F.col("calls")[i] for i in own)).cast("array<string>")), [identifiers[i] for i in own]


def complete(rows: DataFrame, share: float) -> DataFrame:
    """Positions at which at least this share of the reference and all samples are bases."""
    return rows.where(C.is_complete(_every(), share))


def without_missing(rows: DataFrame) -> DataFrame:
    return rows.where(~C.has_missing(_every()))


def without_indels(rows: DataFrame) -> DataFrame:
    return rows.where(~C.has_indel(_every()))


def informative(rows: DataFrame) -> DataFrame:
    """Positions that tell about descent: two states with two calls each at least, the reference's included."""
    return rows.where(C.is_informative(_every()))


def dashed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("calls", F.transform("calls", C.dash_if_missing)).withColumn("ref_call", C.dash_if_missing("ref_call"))


def singles(rows: DataFrame) -> DataFrame:
    """(contig, pos, sample_ord, call): bases that one sample alone has."""
    every = _every()
    cells = rows.select("contig", "pos", every.alias("all_"), F.posexplode("calls").alias("sample_ord", "call"))
    return cells.where(C.is_single("all_", F.col("call"))).drop("all_")


def _greedy(batches, distance: int):
    """Of (contig, pos), sorted, those that lie `distance` from the last one kept; the state is one contig and position."""
    contig, last = None, None
    for batch in batches:
        names, pos = batch.column(0), batch.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero(pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)) + 1).tolist(), len(pos)] if len(pos) else [0]
        kept = []
        for lo, hi in zip(cuts, cuts[1:]):
            name = names[lo].as_py()
            if name != contig:
                contig, last = name, None
            at = lo if last is None else lo + int(np.searchsorted(pos[lo:hi], last + distance))
            while at < hi:
                kept.append(at)
                last = int(pos[at])
                at += int(np.searchsorted(pos[at:hi], last + distance))
        yield batch.take(pa.array(kept, pa.int64()))


def thinned(rows: DataFrame, lengths: DataFrame, distance: int) -> DataFrame:
    """Positions that lie `distance` from the last one kept and half of it from the contig's ends.

    lengths: contig, length. What is kept depends on what was kept before, so a contig's positions pass through one
    task, sorted, as a stream; no contig is held in memory.
    """
    edge = -(-distance // 2)
    near = rows.join(F.broadcast(lengths.select("contig", F.col("length").alias("length_"))), "contig").where((F.col("pos") >= edge) & (F.col("pos") <= F.col("length_") - edge))
    places = near.select("contig", F.col("pos").cast("long").alias("pos")).distinct().repartition("contig").sortWithinPartitions("contig", "pos")
    return rows.join(places.mapInArrow(lambda b: _greedy(b, max(1, distance)), "contig string, pos long"), ["contig", "pos"], "left_semi")


def renamed(rows: DataFrame, names: DataFrame) -> DataFrame:
    """`rows` with their contigs' other names from (contig, other); null where there is none."""
    return rows.join(F.broadcast(names.select("contig", "other")), "contig", "left")


def annotated(rows: DataFrame, annotations: DataFrame) -> DataFrame:
    """`rows` with kind, locus and protein from annotations (contig, pos, info), N/A where there is none."""
    fields = annotations.select("contig", "pos", C.effect_fields("info").alias("e")).select("contig", "pos", "e.*")
    out = rows.join(fields, ["contig", "pos"], "left")
    return out.withColumns({c: F.coalesce(c, F.lit("N/A")) for c in ("kind", "locus", "protein")})


def contig_numbers(rows: DataFrame) -> DataFrame:
    """(contig, number) in the order of first appearance by contig_ord."""
    first = rows.groupBy("contig").agg(F.min("contig_ord").alias("first_"))
    return first.select("contig", F.row_number().over(Window.orderBy("first_", "contig")).cast("int").alias("number"))


def states(rows: DataFrame) -> DataFrame:
    """(contig, pos, call, n): how often each state occurs among the samples."""
    return rows.select("contig", "pos", F.explode("calls").alias("call")).groupBy("contig", "pos", "call").agg(F.count("*").alias("n"))
