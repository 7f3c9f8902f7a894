"""Variant files that arrive over time: each is turned into cells once, and the positions are computed from all so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vcf as V


def cells_of(lines: DataFrame) -> DataFrame:
    """(path, contig, pos, call, depth, prop) of the text lines (path, value) of files of one sample; static or streaming."""
    f = F.split(F.regexp_replace("value", r"\r$", ""), "\t")
    rows = lines.where(~F.col("value").startswith("#") & (F.trim("value") != "")).withColumn("f", f)
    names = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "sample"]
    rows = rows.select("path", *(F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)))
    records = rows.withColumnRenamed("path", "line")
    return V.cells(records).withColumnRenamed("line", "path")


def follow(spark: SparkSession, folder: str, out: str, checkpoint: str, pattern="*.vcf"):
    """Appends the cells of files that appear in `folder` to the Parquet table `out`; a file counts once.

    The sink's log makes each batch appear exactly once, however often it is tried. Returns the query; with
    processAllAvailable() it has read all that is there.
    """
    lines = spark.readStream.schema("value string").option("pathGlobFilter", pattern).text(folder).select(F.col("_metadata.file_path").alias("path"), "value")
    return cells_of(lines).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").start()
