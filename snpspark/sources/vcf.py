"""VCF files, of one or several samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import MalformedFile

#: The columns before the samples'.
COLUMNS = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]


def records(spark: SparkSession, paths: list[str], multi_sample=False, missing_header="error") -> DataFrame:
    """path, line, the nine fixed columns, sample_name and sample: a row for each record (and each of its samples).

    line orders a file's records as they stand in it. Only the first sample is read unless `multi_sample` is set.
    missing_header: "error" if a file that isn't empty has no line with the columns' names, or "blank" to leave it out.
    """
    rows = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")).alias("line"), F.col("value"))
    rows = rows.where(F.trim("value") != "")
    heads = rows.where(F.col("value").startswith("#CHROM")).select("path", F.split(F.rtrim("value"), "\t").alias("head"))
    body = rows.where(~F.col("value").startswith("#"))
    if missing_header == "error" and (bad := body.select("path").distinct().join(heads, "path", "left_anti").head()):
        raise MalformedFile(f"{bad[0]}: no header")
    fields = F.split(F.regexp_replace("value", r"\r$", ""), "\t")
    body = body.join(F.broadcast(heads), "path").withColumn("f", fields)  # one header for each file
    names = F.slice("head", 10, F.greatest(F.size("head") - 9, F.lit(0)))
    pairs = F.arrays_zip(names.alias("n"), F.slice("f", 10, F.greatest(F.size("f") - 9, F.lit(0))).alias("v"))
    pairs = pairs if multi_sample else F.slice(pairs, 1, 1)
    body = body.select("path", "line", *(F.get("f", F.lit(i)).alias(c) for i, c in enumerate(COLUMNS)), F.explode(pairs).alias("p"))
    return body.select("path", "line", *COLUMNS, F.col("p.n").alias("sample_name"), F.col("p.v").alias("sample"))


def samples_in(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, sample_name, column): the samples that the files' headers name."""
    heads = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value").where(F.col("value").startswith("#CHROM"))
    names = F.slice(F.split(F.rtrim("value"), "\t"), 10, F.greatest(F.size(F.split(F.rtrim("value"), "\t")) - 9, F.lit(0)))
    return heads.select("path", F.posexplode(names).alias("column", "sample_name"))
