"""Merging matrices of the same reference with different samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import DuplicateSample
from ..functions import calls as C

COUNTERS = ["n_snp", "n_ref", "n_degen", "n_called", "n_cov", "n_prop", "n_a", "n_c", "n_g", "n_t", "n_other"]


def check_samples(*identifiers: list[str]) -> list[str]:
    """All samples in order; the same one twice is an error."""
    every = [x for xs in identifiers for x in xs]
    if twice := sorted({x for x in every if every.count(x) > 1}):
        raise DuplicateSample(", ".join(twice))
    return every


def repeated_samples(samples: DataFrame) -> DataFrame:
    return samples.groupBy("identifier").agg(F.count("*").alias("n")).where("n > 1")


def merged(*parts: DataFrame) -> DataFrame:
    """Positions with the samples of all parts, in order; only positions that all parts have.

    Counters are added, flags and calls put side by side, and what depends on all samples is made anew: the pattern,
    and consensus, which also needs the parts' first samples to agree.
    """

    def two(a: DataFrame, b: DataFrame) -> DataFrame:
        other = b.select("contig", "pos", *(F.col(c).alias(f"{c}_b") for c in b.columns if c not in ("contig", "pos", "ref_call", "in_dup", "ref_base")))
        both = a.join(other, ["contig", "pos"])
        text = {c: F.concat(c, f"{c}_b") for c in ("calls", "masked", "passed", "call_flags", "cov_flags", "prop_flags")}
        agree = F.col("consensus") & F.col("consensus_b") & (F.col("calls")[0] == F.col("calls_b")[0])
        new = {c: F.col(c) + F.col(f"{c}_b") for c in COUNTERS} | text | {c: F.col(c) & F.col(f"{c}_b") for c in ("all_called", "all_cov", "all_prop")}
        return both.withColumns(new | {"consensus": agree}).select(*(c for c in a.columns))

    out = reduce(two, parts)
    usable = F.zip_with("calls", "passed", lambda c, p: p & c.isin(*C.BASES))
    out = out.withColumn("pattern", C.pattern(F.concat(F.array("ref_call"), F.col("calls")), F.concat(F.array("ref_base"), usable)))
    sound = F.col("consensus") & F.col("ref_base") & ~F.col("in_dup")
    return out.withColumns({"quality": sound, "any_snp": (F.col("n_snp") > 0) & ~F.col("in_dup"), "best_snp": sound & (F.col("n_snp") > 0)})


def merged_files(rows: DataFrame) -> DataFrame:
    """Inputs (path, …, priority) named twice, by options and by a configuration: the one of the smaller priority."""
    others = [c for c in rows.columns if c != "path"]
    return rows.groupBy("path").agg(F.min_by(F.struct(*others), "priority").alias("v")).select("path", "v.*")
