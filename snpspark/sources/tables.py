"""Matrix files, and the small lists that accompany them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import MalformedFile
from ..functions import calls as C


def _columns(spark: SparkSession, path) -> list[str]:
    head = spark.read.text(path).first()
    if head is None:
        raise MalformedFile(f"{path} is empty")
    return head[0].rstrip("\r").split("\t")


def matrix(spark: SparkSession, path) -> tuple[DataFrame, list[str]]:
    """(contig, pos, ref_call, calls, n_snp, …, pattern) of a matrix file, and its samples.

    Some columns differ from others in case or a # alone, so they are read by place.
    """
    names = _columns(spark, path)
    if "#SNPcall" not in names:
        raise MalformedFile(f"{path}: no column #SNPcall")
    last = names.index("#SNPcall")
    rows = spark.read.option("sep", "\t").option("header", False).option("quote", "").csv(path, schema=", ".join(f"c{i} string" for i in range(len(names))))
    rows = rows.where(F.col("c0") != names[0])
    at = {n: F.col(f"c{i}") for i, n in enumerate(names) if i >= last}
    counters = {"n_snp": "#SNPcall", "n_ref": "#Refcall", "n_a": "#A", "n_c": "#C", "n_g": "#G", "n_t": "#T", "n_other": "#NXdegen"}
    texts = {"call_flags": "CallWasMade", "cov_flags": "PassedDepthFilter", "prop_flags": "PassedProportionFilter", "pattern": "Pattern"}
    flags = {"in_dup": "InDupRegion", "consensus": "SampleConsensus"}
    out = rows.select(
        C.locus_contig("c0").alias("contig"),
        C.locus_pos("c0").alias("pos"),
        F.col("c1").alias("ref_call"),
        F.array(*(F.col(f"c{i}") for i in range(2, last))).cast("array<string>").alias("calls"),
        *(at[n].cast("long").alias(c) for c, n in counters.items() if n in at),
        *(at[n].alias(c) for c, n in texts.items() if n in at),
        *((at[n] == "True").alias(c) for c, n in flags.items() if n in at),
    )
    return out, names[2:last]


def coordinates(spark: SparkSession, path) -> DataFrame:
    """(contig, pos) of a list of locus names."""
    rows = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> ''")
    return rows.select(C.locus_contig("v").alias("contig"), C.locus_pos("v").alias("pos"))


def names(spark: SparkSession, path) -> list[str]:
    """A list of samples, one in each line; as many as a matrix has columns at most."""
    return [r["v"] for r in spark.read.text(path).select(F.trim("value").alias("v")).where("v <> ''").collect()]


def _pairs(spark: SparkSession, path, first: str, second: str) -> DataFrame:
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.trim("value") != "").select(parts[0].alias(first), F.get(parts, F.lit(1)).alias(second))


def groups(spark: SparkSession, path) -> DataFrame:
    """(identifier, phenotype): 1 unaffected, 2 affected, 0 unknown."""
    return _pairs(spark, path, "identifier", "phenotype").withColumn("phenotype", F.col("phenotype").try_cast("int"))


def contig_names(spark: SparkSession, path) -> DataFrame:
    return _pairs(spark, path, "contig", "other")
