"""Column expressions over the fields of a VCF record: calls, depths and proportions, as different callers state them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .calls import _col, is_base


def info_map(info) -> Column:
    """INFO as a map; a key without a value has null, of repeated keys the first counts."""
    pairs = F.transform(F.split(F.coalesce(_col(info), F.lit("")), ";"), lambda x: F.split(x, "=", 2))
    keys = F.array_distinct(F.transform(pairs, lambda p: p[0]))
    value = lambda k: F.get(F.get(F.filter(pairs, lambda p: p[0] == k), F.lit(0)), F.lit(1))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), value(k).alias("value"))))


def sample_map(format_, sample) -> Column:
    """FORMAT's keys with a sample's values; fields that the sample drops at its end are absent."""
    pairs = F.arrays_zip(F.split(F.coalesce(_col(format_), F.lit("")), ":").alias("k"), F.split(F.coalesce(_col(sample), F.lit("")), ":").alias("v"))
    good = F.filter(pairs, lambda p: p["k"].isNotNull() & p["v"].isNotNull())
    keys = F.array_distinct(F.transform(good, lambda p: p["k"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), F.get(F.filter(good, lambda p: p["k"] == k), F.lit(0))["v"].alias("value"))))


def leading_int(text) -> Column:
    """The digits at the start as a number; null if there are none."""
    return F.regexp_extract(F.coalesce(_col(text), F.lit("")), r"^(\d+)", 1).try_cast("int")


def prefix_int(text) -> Column:
    return F.coalesce(leading_int(text), F.lit(0))


def number(text) -> Column:
    return _col(text).try_cast("double")


def call(ref, alt, gt) -> Column:
    """The base that a record calls for one sample.

    Without an alternate it is the reference's first base, without a genotype the reference too, X for a dot; of a
    heterozygous genotype the first allele counts. A deletion written as the reference's rest calls the first base.
    """
    ref, alt, gt = _col(ref), _col(alt), _col(gt)
    first = F.upper(F.substring(ref, 1, 1))
    chosen = F.get(F.split(alt, ","), F.coalesce(leading_int(gt), F.lit(0)) - 1)
    return (
        F.when(alt == ".", first)
        .when(gt.startswith("."), "X")
        .when(F.coalesce(leading_int(gt), F.lit(0)) == 0, first)
        .when((F.length(ref) > 1) & (F.substring(ref, F.lit(2), F.length(ref)) == chosen), first)
        .otherwise(F.coalesce(F.upper(F.substring(chosen, 1, 1)), F.lit("X")))
    )


def depth(info: Column, sample: Column) -> Column:
    """The sample's DP, else INFO's DP, else its ADP, else null. info, sample: maps."""
    value = lambda m, k: F.when(F.nullif(m[k], F.lit("")).isNotNull(), leading_int(m[k]))
    return F.coalesce(value(sample, "DP"), value(info, "DP"), value(info, "ADP"))


def legacy_depth(info: Column, sample: Column, samples) -> Column:
    """As depth(), but INFO's depth is shared among the samples."""
    per = lambda k: number(info[k]) / _col(samples)
    return F.coalesce(number(sample["DP"]), per("DP"), per("ADP"))


def proportion_by_alleles(sample: Column, of_depth, is_snp) -> Column:
    """AD over depth: of a list the called allele's; of one number the alternate's, with RD the reference's."""
    counts = F.split(sample["AD"], ",")
    listed = number(F.get(counts, F.coalesce(leading_int(sample["GT"]), F.lit(0))))
    single = F.when(is_snp, number(sample["AD"])).otherwise(number(sample["RD"]))
    return F.try_divide(F.when(F.size(counts) > 1, listed).otherwise(single), _col(of_depth).cast("double"))


def proportion_by_strands(info: Column, of_depth, is_snp) -> Column:
    """DP4's two counts for the alternate (or for the reference) over depth."""
    f = F.split(info["DP4"], ",")
    n = lambda i: number(F.get(f, F.lit(i)))
    return F.try_divide(F.when(is_snp, n(2) + n(3)).otherwise(n(0) + n(1)), _col(of_depth).cast("double"))


def proportion_by_ratio(info: Column, sample: Column, is_snp) -> Column:
    """AR, the alternates' ratio; where the reference is called, what is left of 1."""
    ratio = F.coalesce(number(sample["AR"]), number(info["AR"]))
    return F.when(is_snp, ratio).otherwise(1 - ratio)


def proportion(info: Column, sample: Column, of_depth, is_snp) -> Column:
    """The first of the three that a record allows; null if none."""
    return F.coalesce(proportion_by_alleles(sample, of_depth, is_snp), proportion_by_ratio(info, sample, is_snp), proportion_by_strands(info, of_depth, is_snp))


def cells(records, sample_ord=None):
    """(contig, pos, call, depth, prop, line) of records with the columns of a VCF and `sample`."""
    rows = records.withColumn("i_", info_map("INFO")).withColumn("s_", sample_map("FORMAT", "sample"))
    rows = rows.withColumn("call_", call("REF", "ALT", F.coalesce(F.col("s_")["GT"], F.lit("0")))).withColumn("depth_", depth(F.col("i_"), F.col("s_")))
    snp = is_base("call_") & (F.col("call_") != F.upper(F.substring("REF", 1, 1)))
    prop = proportion(F.col("i_"), F.col("s_"), "depth_", snp)
    return rows.select(F.col("CHROM").alias("contig"), F.col("POS").cast("long").alias("pos"), F.col("call_").alias("call"), F.col("depth_").cast("double").alias("depth"), prop.alias("prop"), *(c for c in ("sample_ord", "line") if c in records.columns))
