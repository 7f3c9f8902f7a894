"""Inputs found by their names."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calls import sample_identity

_MATE = r"^(.*)_(R?)([12])((?:_001)?\.(?:fastq|fq)(?:\.gz)?)$"


def read_pairs(files: DataFrame) -> DataFrame:
    """(sample, read1, read2) of (path): mates by their names; those without a mate are left out."""
    part = lambda k: F.regexp_extract("path", _MATE, k)
    rows = files.select("path", part(1).alias("sample"), F.concat(part(2), part(4)).alias("kind"), part(3).alias("mate")).where("mate <> ''")
    one = rows.where("mate = '1'").select("sample", "kind", F.col("path").alias("read1"))
    two = rows.where("mate = '2'").select("sample", "kind", F.col("path").alias("read2"))
    return one.join(two, ["sample", "kind"]).select("sample", "read1", "read2")


def lone_reads(files: DataFrame) -> DataFrame:
    pairs = read_pairs(files)
    known = pairs.select(F.col("read1").alias("path")).union(pairs.select(F.col("read2").alias("path")))
    return files.where(F.col("path").rlike(_MATE)).join(known, "path", "left_anti")


def analyses(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, name, aligner, snpcaller, source) of the given files and of one level of the given folders.

    Folders are listed through Spark's file systems, so they may be anywhere that Spark reads.
    """
    found = []
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for status in fs.listStatus(path):
            name = status.getPath().toString()
            if status.isFile() and os.path.splitext(name)[1] in (".frankenfasta", ".vcf"):
                found.append((name,))
    rows = spark.createDataFrame(sorted(set(found)), "path string").select("path", sample_identity("path").alias("i")).select("path", "i.*")
    return rows.withColumn("source", F.when(F.col("path").endswith(".frankenfasta"), "fasta").otherwise("vcf"))
