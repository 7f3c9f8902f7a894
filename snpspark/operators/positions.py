"""The core: one row for each reference position, with all samples' calls, flags, counters and the pattern.

Inputs: reference (contig, pos, ref_call, in_dup; contig_ord if contigs have an order of their own), cells (contig, pos,
sample_ord, call, depth, prop; `line` where the first of repeated positions counts) and samples (sample_ord from 0,
identifier, source). Cells are shuffled once, by position: repeated cells, grouping and the join with the reference all
use that partitioning. Samples without a cell get X within the group's array, so no position x sample table is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calls as C

MIN_DEPTH, MIN_PROPORTION = 10, 0.915


def first_cells(cells: DataFrame, keep: str = "first") -> DataFrame:
    """One cell for each position and sample: the first (or the last) by `line`."""
    pick = F.min_by if keep == "first" else F.max_by
    value = F.struct("call", "depth", "prop")
    rows = cells.repartition("contig", "pos").groupBy("contig", "pos", "sample_ord").agg(pick(value, "line").alias("v"))
    return rows.select("contig", "pos", "sample_ord", "v.*")


def mark_duplicates(reference: DataFrame, mask: DataFrame) -> DataFrame:
    """reference with in_dup from mask (contig, pos, mask); positions that the mask lacks aren't duplicated."""
    out = reference.drop("in_dup").join(mask.select("contig", "pos", F.col("mask").alias("mask_")), ["contig", "pos"], "left")
    return out.withColumn("in_dup", F.coalesce(F.col("mask_") == "1", F.lit(False))).drop("mask_")


def check_reference(reference: DataFrame, records: DataFrame) -> DataFrame:
    """Records (contig, pos, ref_call) whose base isn't the reference's."""
    own = reference.select("contig", "pos", F.upper("ref_call").alias("expected"))
    return records.join(own, ["contig", "pos"]).where(F.upper("ref_call") != F.col("expected"))


def dense_cells(reference: DataFrame, cells: DataFrame, n_samples: int) -> DataFrame:
    """reference with cells, an array of (call, depth, prop, there) in the order of the samples."""
    if "line" in cells.columns:
        cells = first_cells(cells)
    value = F.struct(F.upper("call").alias("call"), F.col("depth").cast("double").alias("depth"), F.col("prop").cast("double").alias("prop"))
    entry = F.struct(F.col("sample_ord").cast("int").alias("key"), value.alias("value"))
    grouped = cells.groupBy("contig", "pos").agg(F.collect_list(entry).alias("m_"))
    kind = "array<struct<key:int,value:struct<call:string,depth:double,prop:double>>>"
    rows = reference.join(grouped, ["contig", "pos"], "left").withColumn("m_", F.coalesce("m_", F.array().cast(kind)))
    none = F.struct(F.lit("X").alias("call"), F.lit(None).cast("double").alias("depth"), F.lit(None).cast("double").alias("prop"))
    # The samples that aren't there are added and all are sorted: no search for each sample.
    every = F.sequence(F.lit(0), F.lit(n_samples - 1)) if n_samples else F.array().cast("array<int>")
    absent = F.transform(F.array_except(every, F.transform("m_", lambda x: x["key"])), lambda k: F.struct(k.alias("key"), none.alias("value"))).cast(kind)
    full = F.array_sort(F.concat("m_", absent))
    twice = F.raise_error(F.concat(F.lit("several cells of one sample at "), "contig", F.lit(":"), F.col("pos").cast("string"))).cast(kind)
    full = F.when(F.size("m_") + F.size(absent) == n_samples, full).otherwise(twice)
    return rows.withColumn("cells", F.transform(full, lambda x: x["value"])).drop("m_")


def positions(reference: DataFrame, cells: DataFrame, unfiltered: list[bool], *, min_depth=MIN_DEPTH, min_proportion=MIN_PROPORTION, missing="pass", extra=()) -> DataFrame:
    """One row for each position with everything that the matrices and statistics need.

    unfiltered: for each sample whether it has no filters (assemblies). missing: whether a depth or proportion that is
    unknown passes ("pass") or can't be checked ("fail"). extra: further columns of the reference to keep.
    """
    rows = dense_cells(reference, cells, len(unfiltered))
    plain = F.array(*(F.lit(bool(x)) for x in unfiltered)).cast("array<boolean>")

    def flag(call, value, least, free):
        unknown = F.lit("-") if missing == "pass" else F.lit("?")
        return F.when(free, "-").when(call == "X", "?").when(value.isNull(), unknown).when(value >= least, "Y").otherwise("N")

    cell = F.transform(
        F.arrays_zip(F.col("cells").alias("c"), plain.alias("free")),
        lambda z: F.struct(z["c"]["call"].alias("call"), flag(z["c"]["call"], z["c"]["depth"], min_depth, z["free"]).alias("cov"), flag(z["c"]["call"], z["c"]["prop"], min_proportion, z["free"]).alias("prop")),
    )
    rows = rows.withColumn("cell", cell).drop("cells")
    good = lambda c: c["cov"].isin("Y", "-") & c["prop"].isin("Y", "-")
    base = lambda c: c["call"].isin(*C.BASES)
    called = lambda c: ~c["call"].isin("X", "N")
    of = lambda b: lambda c: c["call"] == b
    count = lambda f: F.size(F.filter("cell", f)).cast("long")
    join = lambda f: F.array_join(F.transform("cell", f), "")
    ref_base = F.col("ref").isin(*C.BASES)
    rows = rows.withColumn("ref", F.upper("ref_call"))
    ref = F.col("ref")
    rows = rows.select(
        "contig",
        "pos",
        F.col("ref").alias("ref_call"),
        "in_dup",
        *extra,
        F.transform("cell", lambda c: c["call"]).alias("calls"),
        F.transform("cell", lambda c: F.when(~called(c) | (good(c) & base(c)), c["call"]).otherwise("N")).alias("masked"),
        F.transform("cell", lambda c: good(c)).alias("passed"),
        F.when(ref_base, count(lambda c: called(c) & good(c) & base(c) & (c["call"] != ref))).otherwise(F.lit(0).cast("long")).alias("n_snp"),
        F.when(ref_base, count(lambda c: called(c) & good(c) & (c["call"] == ref))).otherwise(F.lit(0).cast("long")).alias("n_ref"),
        F.when(ref_base, count(lambda c: called(c) & good(c) & ~base(c))).otherwise(F.lit(0).cast("long")).alias("n_degen"),
        count(called).alias("n_called"),
        count(lambda c: c["cov"].isin("Y", "-")).alias("n_cov"),
        count(lambda c: c["prop"].isin("Y", "-")).alias("n_prop"),
        *(count(of(b)).alias(f"n_{b.lower()}") for b in C.BASES),
        count(lambda c: ~base(c)).alias("n_other"),
        join(lambda c: F.when(called(c), "Y").otherwise("N")).alias("call_flags"),
        join(lambda c: c["cov"]).alias("cov_flags"),
        join(lambda c: c["prop"]).alias("prop_flags"),
        C.pattern(F.concat(F.array(ref), F.transform("cell", lambda c: c["call"])), F.concat(F.array(ref_base), F.transform("cell", lambda c: good(c) & base(c)))).alias("pattern"),
        F.forall("cell", lambda c: good(c) & base(c)).alias("consensus"),
        ref_base.alias("ref_base"),
    )
    n = len(unfiltered)
    return rows.select(
        "*",
        (F.col("n_called") == n).alias("all_called"),
        (F.col("n_cov") == n).alias("all_cov"),
        (F.col("n_prop") == n).alias("all_prop"),
        (F.col("consensus") & F.col("ref_base") & ~F.col("in_dup")).alias("quality"),
        ((F.col("n_snp") > 0) & ~F.col("in_dup")).alias("any_snp"),
        (F.col("consensus") & F.col("ref_base") & ~F.col("in_dup") & (F.col("n_snp") > 0)).alias("best_snp"),
    )


def with_unfiltered(samples: DataFrame | list[dict]) -> list[bool]:
    """For each sample, in order, whether it is an assembly; the list of samples is small by nature."""
    rows = samples if isinstance(samples, list) else [r.asDict() for r in samples.orderBy("sample_ord").collect()]
    return [r["source"] == "fasta" for r in rows]


def agreed(rows: DataFrame, nicknames: list[str]) -> DataFrame:
    """`rows` with consensus and what follows from it as the older rule has it: the analyses of one sample must agree.

    nicknames: each sample's nickname, in order.
    """
    ok = F.col("consensus")
    for name in sorted(set(nicknames)):
        own = [k for k, x in enumerate(nicknames) if x == name]
        for k in own[1:]:
            ok = ok & (F.col("calls")[own[0]] == F.col("calls")[k])
    rows = rows.withColumn("consensus", ok)
    rows = rows.withColumn("quality", F.col("consensus") & F.col("ref_base") & ~F.col("in_dup"))
    return rows.withColumn("best_snp", F.col("quality") & (F.col("n_snp") > 0))


def with_pattern_ids(rows: DataFrame, order=("contig", "pos"), pattern="pattern") -> DataFrame:
    """`rows` with pattern_id, patterns numbered by first appearance in the given order.

    The patterns are first grouped with their first place; only they, far fewer than the rows, are numbered.
    """
    first = rows.groupBy(pattern).agg(F.min(F.struct(*order)).alias("first_"))
    numbered = first.select(F.col(pattern).alias("pattern_"), F.row_number().over(Window.orderBy("first_")).cast("long").alias("pattern_id"))
    return rows.join(numbered, F.col(pattern) == F.col("pattern_")).drop("pattern_")
