"""FASTA files: one record for each sequence, exploded into positions.

A file is cut at its > signs by the text source, so a sequence is one row before it is exploded and a description must
not hold another >. Names end at the first blank; lines may end in CR LF, the last without any end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import MalformedFile
from ..operators.exports import exploded
from ..operators.positions import mark_duplicates


def sequences(spark: SparkSession, path, franken=False) -> DataFrame:
    """(path, contig_ord, contig, seq); contig_ord is the place in its file. franken: strips franken:: from names."""
    rows = spark.read.option("lineSep", ">").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block_"), F.monotonically_increasing_id().alias("at_"), "value")
    head = F.regexp_extract("value", r"^([^ \t\r\n]*)", 1)
    name = F.regexp_replace(head, "^franken::", "") if franken else head
    body = F.regexp_replace(F.regexp_extract("value", r"(?s)^[^\n]*\n(.*)$", 1), r"[\s]", "")
    rows = rows.where(F.trim("value") != "").select("path", "block_", "at_", name.alias("contig"), body.alias("seq"))
    order = F.row_number().over(Window.partitionBy("path").orderBy("block_", "at_")).cast("int")
    return rows.select("path", order.alias("contig_ord"), "contig", "seq")


def positions(spark: SparkSession, path, franken=False, call="call") -> DataFrame:
    """(contig, pos, call) of the files' sequences, spread over the session's partitions; for a reference contig_ord too."""
    return exploded(sequences(spark, path, franken), call=call, keep=("contig_ord",) if call == "ref_call" else ())


#: Fixed value: the letters that a sequence may have.
ALPHABET = r"^[A-Za-z.\-*]*$"


def check(seqs: DataFrame, alphabet=ALPHABET) -> DataFrame:
    if bad := seqs.where(~F.col("seq").rlike(alphabet)).head():
        raise MalformedFile(f"{bad['path']}: {bad['contig']}")
    return seqs


def reference(spark: SparkSession, path, mask=None) -> DataFrame:
    """contig, contig_ord, pos, ref_call, in_dup; mask: a file of the same contigs with 1 where positions are repeated."""
    ref = positions(spark, path, call="ref_call")
    if mask is None:
        return ref.withColumn("in_dup", F.lit(False))
    marks = exploded(sequences(spark, mask).where(F.col("seq").rlike("^[01-]*$")), call="mask")
    return mark_duplicates(ref, marks)
