"""The derived matrices as filters of the positions, and their wide form with a column for each sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calls as C
from .positions import with_pattern_ids

#: The columns behind the samples' in a matrix file.
SUFFIX = ["#SNPcall", "#Indelcall", "#Refcall", "#CallWasMade", "#PassedDepthFilter", "#PassedProportionFilter", "#A", "#C", "#G", "#T", "#Indel", "#NXdegen", "Contig", "Position", "InDupRegion", "SampleConsensus", "CallWasMade", "PassedDepthFilter", "PassedProportionFilter", "Pattern"]

#: For each kind which positions it has and which calls it prints.
KINDS = {
    "master": ("true", "calls"),
    "master_masked": ("true", "masked"),
    "missingdata": ("any_snp", "masked"),
    "bestsnp": ("best_snp", "calls"),
    "includeref": ("quality", "calls"),
    "allcallable": ("all_called and not in_dup", "calls"),
}


def matrix(rows: DataFrame, kind: str) -> DataFrame:
    """The positions of a kind of matrix; shown is the array of calls that it prints."""
    where, shown = KINDS[kind]
    return rows.where(where).withColumn("shown", F.col(shown))


def with_legacy_pattern(rows: DataFrame) -> DataFrame:
    """`rows` (positions with contig_ord) with the older pattern, quoted, and pattern_id, its number by first appearance."""
    usable = F.zip_with("calls", "passed", lambda c, p: p & c.isin(*C.BASES))
    text = C.legacy_pattern(F.concat(F.array("ref_call"), "calls"), F.concat(F.array("ref_base"), usable))
    return with_pattern_ids(rows.withColumn("pattern", F.concat(F.lit("'"), text, F.lit("'"))), ("contig_ord", "pos"))


#: The columns that the older matrix of all callable positions lacks.
_NOT_CALLABLE = ["CallWasMade", "PassedDepthFilter", "PassedProportionFilter"]


def wide(rows: DataFrame, identifiers: list[str], legacy: str | bool = False) -> DataFrame:
    """The columns of a matrix file, one for each sample between the reference and the counters.

    legacy: the kind of an older matrix, whose last column is the pattern's number.
    """
    n = len(identifiers)
    text = lambda c: F.when(F.col(c), "True").otherwise("False")
    values = ["n_snp", F.lit(0), "n_ref", C.fraction("n_called", F.lit(n)), C.fraction("n_cov", F.lit(n)), C.fraction("n_prop", F.lit(n)), "n_a", "n_c", "n_g", "n_t", F.lit(0), "n_other", "contig", "pos", text("in_dup"), text("consensus"), "call_flags", "cov_flags", "prop_flags", "pattern"]
    tail = [(F.col(v) if isinstance(v, str) else v).alias(name) for name, v in zip(SUFFIX, values) if legacy != "allcallable" or name not in _NOT_CALLABLE]
    tail += [F.col("pattern_id").alias("Pattern#")] if legacy else []
    return rows.select(C.locus_id("contig", "pos").alias("LocusID"), F.col("ref_call").alias("Reference"), *(F.col("shown")[i].alias(x) for i, x in enumerate(identifiers)), *tail)


def samples_of(table: DataFrame) -> list[str]:
    """The samples' columns of a wide matrix: those before the counters."""
    names = table.columns
    return names[2 : names.index("#SNPcall")]


def calls_of(table: DataFrame) -> DataFrame:
    """(contig, pos, ref_call, calls) of a wide matrix."""
    cols = [F.col("`" + c.replace("`", "``") + "`") for c in samples_of(table)]
    return table.select(C.locus_contig("LocusID").alias("contig"), C.locus_pos("LocusID").alias("pos"), F.col("Reference").alias("ref_call"), F.array(*cols).cast("array<string>").alias("calls"))


def long(rows: DataFrame, shown="calls") -> DataFrame:
    """(contig, pos, ref_call, sample_ord, call): a row for each cell."""
    return rows.select("contig", "pos", "ref_call", F.posexplode(shown).alias("sample_ord", "call"))
