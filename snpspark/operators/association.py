"""Pedigree files, and how strongly positions go with groups of samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calls as C


def pedigree(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(sample_ord, phenotype, genotypes): a line for each sample of group 1 or 2, its alleles in the positions' order.

    groups: sample_ord, phenotype. A line is as long as the matrix by definition of the format.
    """
    cells = rows.select("contig_ord", "contig", "pos", "ref_call", F.posexplode("calls").alias("sample_ord", "call"))
    cells = cells.withColumn("g", C.pedigree_genotype("call", "ref_call"))
    lines = cells.groupBy("sample_ord").agg(F.array_sort(F.collect_list(F.struct("contig_ord", "pos", "g"))).alias("s"))
    lines = lines.select("sample_ord", F.array_join(F.transform("s", lambda x: x["g"]), "\t").alias("genotypes"))
    return lines.join(F.broadcast(groups.where("phenotype in (1, 2)")), "sample_ord").select("sample_ord", "phenotype", "genotypes")


def pedigree_map(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """(number, locus, pos): the positions' chromosome numbers and names."""
    return rows.join(F.broadcast(numbers), "contig").select("number", C.locus_id("contig", "pos").alias("locus"), "pos")


def _counts(phenotypes) -> list:
    """The four counts of a row, given the array of the samples' phenotypes (0: in no group)."""
    pairs = F.filter(F.arrays_zip(F.col("calls").alias("c"), phenotypes.alias("p")), lambda z: ~z["c"].isin("X", "N", "-") & (z["p"] > 0))
    n = lambda p, same: F.size(F.filter(pairs, lambda z: (z["p"] == p) & ((z["c"] == F.col("ref_call")) == same))).cast("long")
    return [n(2, False).alias("a1"), n(2, True).alias("u1"), n(1, False).alias("a2"), n(1, True).alias("u2")]


def _phenotypes(groups: DataFrame) -> DataFrame:
    """(round, phenotypes): for each round an array of the phenotypes by sample_ord, 0 for samples in no group."""
    known = groups if "round" in groups.columns else groups.withColumn("round", F.lit(0))
    known = known.where("phenotype in (1, 2)").groupBy("round").agg(F.map_from_entries(F.collect_list(F.struct("sample_ord", "phenotype"))).alias("m"))
    of = F.transform(F.sequence(F.lit(0), F.array_max(F.map_keys("m")).cast("int")), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0)))
    return known.select("round", of.alias("phenotypes"))


def allele_counts(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(contig, pos, a1, u1, a2, u2): samples with another base and with the reference's, in group 2 and in group 1.

    A position's calls lie in one row, beside which the groups, one row, are put; nothing is shuffled.
    """
    one = _phenotypes(groups).withColumn("k_", F.lit(1))
    rows = rows.withColumn("k_", F.lit(1)).join(F.broadcast(one), "k_")  # one row, with a number for each column of the matrix
    return rows.select("contig", "pos", *_counts(F.col("phenotypes"))).where("a1 + u1 + a2 + u2 > 0")


def chi_squared(counts: DataFrame) -> DataFrame:
    """counts with chi2, of the two-by-two table of alleles (each sample has two); null where a margin is 0."""
    a, b, c, d = (F.col(x) * 2.0 for x in ("a1", "u1", "a2", "u2"))
    return counts.withColumn("chi2", F.try_divide((a + b + c + d) * (a * d - b * c) * (a * d - b * c), (a + b) * (c + d) * (a + c) * (b + d)))


#: Upper points of the chi-squared distribution with one degree of freedom.
CRITICAL = {0.1: 2.705543, 0.05: 3.841459, 0.01: 6.634897, 0.001: 10.827566}


def significant(rows: DataFrame, groups: DataFrame, alpha=0.05) -> int:
    return chi_squared(allele_counts(rows, groups)).where(F.col("chi2") > CRITICAL[alpha]).count()


def shuffled_groups(groups: DataFrame, times: int, seed=1) -> DataFrame:
    """(round, sample_ord, phenotype): the phenotypes dealt anew, as often as asked, the same for the same seed."""
    known = groups.where("phenotype in (1, 2)")
    rounds = known.select("sample_ord", "phenotype", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("round"))
    by_id = F.row_number().over(Window.partitionBy("round").orderBy("sample_ord"))
    by_hash = F.row_number().over(Window.partitionBy("round").orderBy(F.xxhash64("sample_ord", "round", F.lit(seed)), "sample_ord"))
    a = rounds.select("round", "phenotype", by_id.alias("k"))
    return a.join(rounds.select("round", "sample_ord", by_hash.alias("k")), ["round", "k"]).select("round", "sample_ord", "phenotype")


def permutation_test(rows: DataFrame, groups: DataFrame, alpha=0.05, times=99, seed=1) -> DataFrame:
    """One row: hits (positions that go with the groups), mean_random, better (rounds with as many) and p_value.

    Every round is counted within a position's row, and only the rounds' sums are shuffled.
    """
    dealt = shuffled_groups(groups, times, seed).unionByName(groups.where("phenotype in (1, 2)").select(F.lit(0).alias("round"), "sample_ord", "phenotype"))
    each = _phenotypes(dealt).agg(F.array_sort(F.collect_list(F.struct("round", "phenotypes"))).alias("rounds")).withColumn("k_", F.lit(1))
    rows = rows.select("ref_call", "calls", F.lit(1).alias("k_")).join(F.broadcast(each), "k_")  # one row: samples x rounds numbers
    counts = rows.select("ref_call", "calls", F.explode("rounds").alias("r")).select("r.round", *_counts(F.col("r.phenotypes")))
    hits = chi_squared(counts).groupBy("round").agg(F.count_if(F.col("chi2") > CRITICAL[alpha]).alias("hits"))
    true = F.max(F.when(F.col("round") == 0, F.col("hits")))
    random = F.collect_list(F.when(F.col("round") > 0, F.col("hits")))
    out = hits.agg(true.alias("hits"), F.avg(F.when(F.col("round") > 0, F.col("hits"))).alias("mean_random"), random.alias("r_"))
    better = F.size(F.filter("r_", lambda x: x >= F.col("hits"))).cast("long")
    return out.select("hits", "mean_random", better.alias("better"), (better / F.lit(float(times))).alias("p_value"))


def still_affected(groups: DataFrame, times: int, seed=1) -> DataFrame:
    """(round, affected, both, others): of the affected samples of each round how many are truly affected, and the two sets'
    difference; a round that deals the true group again is of no use for a comparison."""
    true = groups.where("phenotype = 2").agg(F.array_sort(F.collect_set("sample_ord")).alias("true"))
    dealt = shuffled_groups(groups, times, seed).where("phenotype = 2").groupBy("round").agg(F.array_sort(F.collect_set("sample_ord")).alias("affected"))
    both = dealt.withColumn("k_", F.lit(1)).join(F.broadcast(true.withColumn("k_", F.lit(1))), "k_")
    return both.select("round", "affected", F.array_intersect("affected", "true").alias("both"), F.array_except("affected", "true").alias("others"))
