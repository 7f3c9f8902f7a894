"""Statistics by contig and by sample, with whole-genome totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calls as C

CONTIG = {
    "reference_clean": "not in_dup",
    "reference_duplicated": "in_dup",
    "all_called": "all_called",
    "all_passed_coverage": "all_cov",
    "all_passed_proportion": "all_prop",
    "all_passed_consensus": "consensus",
    "quality_breadth": "quality",
    "any_snps": "any_snp",
    "best_snps": "best_snp",
}
SAMPLE = ["was_called", "passed_coverage_filter", "passed_proportion_filter", "quality_breadth", "called_reference", "called_snp", "called_degen"]
WHOLE = "Whole Genome"


def contig_stats(rows: DataFrame, total=True) -> DataFrame:
    """contig, reference_length and counts of positions; with a row for the whole genome, its name in place of a contig."""
    counts = [F.count("*").alias("reference_length"), *(F.count_if(F.expr(c)).alias(n) for n, c in CONTIG.items())]
    if not total:
        return rows.groupBy("contig").agg(*counts)
    out = rows.rollup("contig").agg(F.grouping_id().alias("all_"), *counts)
    return out.withColumn("contig", F.when(F.col("all_") == 1, WHOLE).otherwise(F.col("contig"))).drop("all_")


def with_percents(stats: DataFrame, of="reference_length") -> DataFrame:
    names = [c for c, k in stats.dtypes if k == "bigint" and c != of]
    out = [F.col(c) for c in stats.columns if c not in names]
    for c in names:
        out += [F.col(c), C.percent(c, of).alias(f"{c} (%)")]
    return stats.select(*out)


#: Of the sample statistics those that the older tool counted over all positions, duplicated regions included.
EVERYWHERE = SAMPLE[:3]


def _cell_flags(rows: DataFrame, passed=False) -> DataFrame:
    """A row for each cell outside duplicated regions, with the seven booleans of the sample statistics.

    passed: the cells of duplicated regions too, for the first three alone.
    """
    base = F.col("call").isin(*C.BASES)
    rows = rows if passed else rows.where(~F.col("in_dup"))
    cells = rows.select("contig", "pos", "in_dup", "ref_call", "ref_base", "cov_flags", "prop_flags", F.posexplode(F.arrays_zip("calls", "passed")).alias("sample_ord", "z"))
    cells = cells.select("*", F.col("z.calls").alias("call"), F.col("z.passed").alias("good"))
    char = lambda flags: F.substring(F.col(flags), F.col("sample_ord") + 1, F.lit(1)).isin("Y", "-")
    called = C.was_called("call")
    sure = called & F.col("ref_base") & F.col("good")
    values = [called, char("cov_flags"), char("prop_flags"), sure, sure & (F.col("call") == F.col("ref_call")), sure & base & (F.col("call") != F.col("ref_call")), sure & ~base]
    return cells.select("contig", "pos", "sample_ord", *((v if n in EVERYWHERE else v & ~F.col("in_dup")).alias(n) for n, v in zip(SAMPLE, values)))


def sample_stats(rows: DataFrame, passed=False) -> DataFrame:
    """sample_ord and the number of positions (outside duplicated regions) with each property.

    passed: as the older tool counts; what was called and what passed then count in duplicated regions too.
    """
    return _cell_flags(rows, passed).groupBy("sample_ord").agg(*(F.count_if(n).alias(n) for n in SAMPLE))


def _flag_arrays(rows: DataFrame, passed=False) -> DataFrame:
    """The positions outside duplicated regions with f_, an array of each sample's seven booleans in their order.
    passed: as in _cell_flags."""
    yes = lambda flags, i: F.substring(F.col(flags), i + 1, F.lit(1)).isin("Y", "-")

    def flags(z, i):
        called = ~z["calls"].isin("X", "N")
        base = z["calls"].isin(*C.BASES)
        sure = called & F.col("ref_base") & z["passed"]
        values = [called, yes("cov_flags", i), yes("prop_flags", i), sure, sure & (z["calls"] == F.col("ref_call")), sure & base & (z["calls"] != F.col("ref_call")), sure & ~base]
        values = [v if n in EVERYWHERE else v & ~F.col("in_dup") for n, v in zip(SAMPLE, values)]
        return F.struct(*(F.coalesce(v, F.lit(False)).alias(n) for n, v in zip(SAMPLE, values)))

    return (rows if passed else rows.where(~F.col("in_dup"))).select(F.transform(F.arrays_zip("calls", "passed"), flags).alias("f_"))


def any_all_stats(rows: DataFrame, nicknames: DataFrame | None = None, *, passed=False, judged=False) -> DataFrame:
    """Positions where any and where all analyses have each property: scope (any or all) and counts.

    passed: as in sample_stats. judged: as the older tool has it, the kinds of call (reference, variant, degenerate) hold
    for all analyses if they hold for all whose call can be judged, of which there must be one.
    With nicknames (sample_ord, nickname) for each nickname; else over all samples. A position's cells lie in one row, so
    only sums are shuffled. The names of the samples, the matrix's columns, come to the driver.
    """
    groups: dict = {None: None}
    if nicknames is not None:
        groups = {}
        for r in nicknames.orderBy("sample_ord").collect():
            groups.setdefault(r["nickname"], []).append(r["sample_ord"])
    own = []
    for name, members in groups.items():
        cells = F.col("f_") if members is None else F.transform(F.array(*(F.lit(i) for i in members)), lambda i: F.get("f_", i))
        has = lambda n: lambda c: c[n]
        fits = lambda n: lambda c: c[n] | ~c["quality_breadth"]
        some = [F.exists(cells, has(n)).alias(f"any_{n}") for n in SAMPLE]
        for n in SAMPLE:
            whole = F.exists(cells, has(n)) & F.forall(cells, fits(n)) if judged and n.startswith("called_") else F.forall(cells, has(n))
            some.append(whole.alias(f"all_{n}"))
        own.append(F.struct(F.lit(name).cast("string").alias("nickname"), *some))
    by = [] if nicknames is None else ["nickname"]
    if not own:
        own = [F.struct(F.lit("").alias("nickname"), *(F.lit(False).alias(f"{k}_{n}") for k in ("any", "all") for n in SAMPLE))]
    each = _flag_arrays(rows, passed).select(F.explode(F.array(*own)).alias("s")).select("s.*").where("true" if groups else "false")
    sums = each.groupBy(*by).agg(*(F.count_if(f"{k}_{n}").alias(f"{k}_{n}") for k in ("any", "all") for n in SAMPLE))
    scopes = F.array(*(F.struct(F.lit(k).alias("scope"), *(F.col(f"{k}_{n}").alias(n) for n in SAMPLE)) for k in ("any", "all")))
    return sums.select(*by, F.explode(scopes).alias("s")).select(*by, "s.*")


def failed_stats(stats: DataFrame) -> DataFrame:
    """Of the called positions how many failed each filter, and their percentage."""
    out = stats.select("sample_ord", "was_called", C.failed_of("was_called", "passed_coverage_filter").alias("failed_coverage"), C.failed_of("was_called", "passed_proportion_filter").alias("failed_proportion"))
    return out.select("*", *(C.percent(c, "was_called").alias(f"{c}_percent") for c in ("failed_coverage", "failed_proportion")))


def analysis_consensus(cells: DataFrame) -> DataFrame:
    """(contig, pos, consensus): the analyses of each nickname agree and all pass, and so for all nicknames.

    cells: contig, pos, nickname, call, passed.
    """
    each = cells.groupBy("contig", "pos", "nickname").agg((F.min("call") == F.max("call")).alias("same"), F.bool_and("passed").alias("good"))
    return each.groupBy("contig", "pos").agg(F.bool_and(F.col("same") & F.col("good")).alias("consensus"))
