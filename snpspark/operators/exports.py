"""Positions as lines of other formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calls as C


def wrapped(seq, width=80) -> Column:
    """A sequence in lines of `width`."""
    return F.regexp_replace(C._col(seq), f"(.{{{width}}})(?=.)", "$1\n")


def packed(rows: DataFrame, call="call", order="pos") -> DataFrame:
    """(contig, seq) of (contig, pos, call): a contig's bases in order, one value by definition of the format."""
    seq = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(call).alias("c")))), lambda x: x["c"]), "")
    return rows.groupBy("contig").agg(seq.alias("seq"))


#: Letters of a sequence that one row holds while it is spread.
PIECE = 1 << 16


def exploded(sequences: DataFrame, name="contig", seq="seq", call="call", keep=()) -> DataFrame:
    """(contig, pos, call) of packed sequences, positions from 1, with the columns `keep`.

    A sequence is cut into pieces, by bytes and so without a walk, and the pieces are spread over the session's
    partitions before their letters become rows.
    """
    whole = F.col(seq).cast("binary")
    last = F.greatest(F.octet_length(seq) - 1, F.lit(0)) / PIECE
    rows = sequences.where(F.length(seq) > 0).select(*keep, F.col(name).alias("contig"), whole.alias("b_"), F.explode(F.sequence(F.lit(0), F.floor(last).cast("int"))).alias("k_"))
    piece = F.substring("b_", F.col("k_") * PIECE + 1, F.lit(PIECE)).cast("string")
    rows = rows.select(*keep, "contig", "k_", piece.alias("s_")).repartition("contig", "k_")
    letters = rows.select(*keep, "contig", "k_", F.posexplode(F.split("s_", "")).alias("i_", call)).where(F.col(call) != "")
    return letters.select(*keep, "contig", (F.col("k_").cast("long") * PIECE + F.col("i_") + 1).alias("pos"), call)


def sample_sequences(rows: DataFrame, identifiers: list[str], shown="calls", order=("contig_ord", "pos")) -> DataFrame:
    """(ord, name, seq): the reference's and each sample's calls at the rows' positions, in order.

    A sequence is one value by definition of the format: as long as there are positions.
    """
    names = F.array(F.lit("Reference"), *(F.lit(x) for x in identifiers))
    cells = rows.select(*order, F.posexplode(F.concat(F.array("ref_call"), F.col(shown))).alias("ord", "call"))
    seq = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "call"))), lambda x: x["call"]), "")
    return cells.groupBy("ord").agg(seq.alias("seq")).select("ord", names[F.col("ord")].alias("name"), "seq")


def vcf_rows(rows: DataFrame, identifiers: list[str]) -> DataFrame:
    """The columns of a VCF. ALT and the genotypes both come from the calls that pass, in order of first appearance."""
    usable = F.zip_with("calls", "passed", lambda c, p: F.when(p & c.isin(*C.BASES), c))
    rows = rows.withColumn("u_", usable)
    alts = C.alternates(F.filter("u_", lambda c: c.isNotNull()), F.col("ref_call"))
    rows = rows.withColumn("alts_", alts)
    index = lambda c: F.when(c.isNull(), ".").when(c == F.col("ref_call"), "0").otherwise(F.array_position("alts_", c).cast("string"))

    def sample(i):
        flag = lambda x: F.substring(F.col(x), i + 1, 1)
        return F.concat_ws(":", index(F.col("u_")[i]), C.failed_text(F.col("calls")[i], flag("cov_flags"), flag("prop_flags")))

    alleles = F.size("alts_") + 1
    info = F.concat(F.lit("AN="), alleles.cast("string"), F.lit(";NS="), (F.col("n_snp") + F.col("n_ref")).cast("string"))
    return rows.select(
        F.col("contig").alias("#CHROM"), F.col("pos").alias("POS"), F.lit(".").alias("ID"), F.col("ref_call").alias("REF"),
        F.when(F.size("alts_") > 0, F.array_join("alts_", ",")).otherwise(".").alias("ALT"), F.lit(".").alias("QUAL"), F.lit("PASS").alias("FILTER"),
        info.alias("INFO"), F.lit("GT:FT").alias("FORMAT"), *(sample(i).alias(x) for i, x in enumerate(identifiers)),
    )


def vcf_header(contigs: list[tuple[str, int]], identifiers: list[str]) -> list[str]:
    # The texts of a VCF's header as other programs expect them.
    lines = ["##fileformat=VCFv4.2", "##source=snpspark"]
    lines += [f'##contig=<ID="{c}",length={n}>' for c, n in contigs]
    lines += [f'##SAMPLE=<ID="{x}",Genomes="{x}",Mixture=1.0>' for x in identifiers]
    return [
        *lines,
        '##INFO=<ID=AN,Number=1,Type=Integer,Description="Total number of alleles in called genotypes">',
        '##INFO=<ID=NS,Number=1,Type=Integer,Description="Number of Samples With Data">',
        '##FILTER=<ID=NoCall,Description="No call for this sample at this position">',
        '##FILTER=<ID=CovFail,Description="Insufficient depth of coverage for this sample at this position">',
        '##FILTER=<ID=PropFail,Description="Insufficient proportion of reads were variant for this sample at this position">',
        '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
        '##FORMAT=<ID=FT,Number=1,Type=String,Description="Filters that the sample failed">',
    ]
