"""Files that the engine writes: matrices, statistics, sequences, variant calls and pedigrees.

Rows are put in order by range partitioning and sorting within partitions; a single file is written only if asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import exports, matrices, stats


def _lines(lines: DataFrame, path: str, header: list[str] = (), single=True) -> None:
    """Writes (ord…, value), in the order of all other columns, as text; the header is the first line of the first file."""
    order = [c for c in lines.columns if c != "value"]
    spark = lines.sparkSession
    if single:
        # One task writes one file by definition of the format; it merges sorted partitions and holds no more than a row.
        lines = lines.orderBy(*order).coalesce(1) if order else lines.coalesce(1)
    elif order:
        lines = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = lines.select("value")
    if header:
        heads = spark.createDataFrame([(i, h) for i, h in enumerate(header)], "i int, value string").coalesce(1).sortWithinPartitions("i").select("value")
        rows = heads.union(rows)
        rows = rows.coalesce(1) if single else rows
    rows.write.mode("overwrite").text(path)


def _tabbed(df: DataFrame, order: list[str] = ()) -> DataFrame:
    text = [F.coalesce(F.col("`" + c.replace("`", "``") + "`").cast("string"), F.lit("")) for c in df.columns if c not in order]
    return df.select(*order, F.concat_ws("\t", *text).alias("value"))


def write_matrix(rows: DataFrame, kind: str, identifiers: list[str], path: str, single=True, legacy=False) -> None:
    """rows: positions with contig_ord; kind: one of matrices.KINDS. legacy: with the older pattern and its number."""
    chosen = matrices.matrix(rows, kind)
    chosen = matrices.with_legacy_pattern(chosen) if legacy else chosen
    wide = matrices.wide(chosen, identifiers, legacy and kind)
    names = wide.columns
    text = [F.coalesce(F.col("`" + c.replace("`", "``") + "`").cast("string"), F.lit("")) for c in names]
    ordered = wide.select(F.concat_ws("\t", *text).alias("value"), F.col("Contig").alias("contig"), F.col("Position").alias("o2"))
    contigs = chosen.select("contig", F.col("contig_ord").alias("o1")).distinct()
    _lines(ordered.join(F.broadcast(contigs), "contig").select("o1", "o2", "value"), path, ["\t".join(names)], single)


def write_table(df: DataFrame, path: str, order: tuple[str, ...] = (), single=True) -> None:
    """Any table as tab-separated lines under its columns' names, in the order of some of them."""
    lines = _tabbed(df.select(*(F.col(c).alias(f"o_{c}") for c in order), "*"), [f"o_{c}" for c in order])
    _lines(lines, path, ["\t".join(df.columns)], single)


def write_stats(rows: DataFrame, samples: list[dict], general: str, by_sample: str, older=False) -> None:
    """Two small tables: contigs (the whole genome first) and samples (any and all first, then by nickname).

    older: what passed counts in duplicated regions too, and the kinds of call hold for all samples that can be judged.
    """
    more = {"passed": True, "judged": True} if older else {}
    spark = rows.sparkSession
    table = stats.with_percents(stats.contig_stats(rows)).withColumnRenamed("contig", "Contig")
    _lines(_tabbed(table.withColumn("o1", F.col("Contig") != stats.WHOLE).withColumn("o2", F.col("Contig")), ["o1", "o2"]), general, ["\t".join(table.columns)])
    names = spark.createDataFrame([(i, s["nickname"], s["identifier"]) for i, s in enumerate(samples)], "sample_ord int, nickname string, identifier string")
    length = rows.count()
    own = stats.sample_stats(rows, older).join(F.broadcast(names), "sample_ord").select("nickname", "identifier", F.lit(2).alias("o"), *stats.SAMPLE)
    scope = lambda df, nick, o: df.select(nick.alias("nickname"), F.concat(F.lit("["), "scope", F.lit("]")).alias("identifier"), F.when(F.col("scope") == "any", 0).otherwise(1).alias("o"), *stats.SAMPLE)
    by_nick = scope(stats.any_all_stats(rows, names.select("sample_ord", "nickname"), **more), F.col("nickname"), 0)
    whole = stats.any_all_stats(rows, **more)
    top = whole.select(F.concat(F.lit("["), "scope", F.lit("]")).alias("nickname"), F.lit("").alias("identifier"), F.when(F.col("scope") == "any", -2).otherwise(-1).alias("o"), *stats.SAMPLE)
    every = own.unionByName(by_nick).unionByName(top).withColumn("length_", F.lit(length).cast("long"))
    out = stats.with_percents(every, "length_").drop("length_")
    out = out.select(F.when(F.col("o") < 0, "").otherwise(F.col("nickname")).alias("o1"), F.col("o").alias("o2"), F.col("identifier").alias("o3"), F.col("nickname").alias("Sample"), F.col("identifier").alias("Sample::Analysis"), *out.columns[3:])
    _lines(_tabbed(out, ["o1", "o2", "o3"]), by_sample, ["\t".join(out.columns[3:])])


def write_fasta(sequences: DataFrame, path: str, prefix="", order=("contig",), width=80) -> None:
    """sequences: contig, seq."""
    text = F.concat(F.lit(">" + prefix), "contig", F.lit("\n"), exports.wrapped("seq", width))
    _lines(sequences.select(*(F.col(c).alias(f"o_{c}") for c in order), text.alias("value")), path)


def write_sample_fasta(rows: DataFrame, identifiers: list[str], path: str, shown="calls") -> None:
    seqs = exports.sample_sequences(rows, identifiers, shown).select(F.col("ord"), F.col("name").alias("contig"), "seq")
    write_fasta(seqs, path, order=("ord",))


def write_vcf(rows: DataFrame, lengths: list[tuple[str, int]], identifiers: list[str], path: str, single=True) -> None:
    """rows: positions with contig_ord; lengths: the reference's contigs in order, with their lengths.

    A position on a contig that isn't among them is an error.
    """
    table = exports.vcf_rows(rows, identifiers)
    text = F.concat_ws("\t", *(F.col("`" + c.replace("`", "``") + "`").cast("string") for c in table.columns))
    ranks = rows.sparkSession.createDataFrame([(c, i) for i, (c, _) in enumerate(lengths)], "`#CHROM` string, o1 int")
    unknown = F.raise_error(F.concat(F.lit("no length is known of the contig "), F.col("#CHROM"))).cast("int")
    lines = table.join(ranks, "#CHROM", "left").select(F.coalesce("o1", unknown).alias("o1"), F.col("POS").alias("o2"), text.alias("value"))
    _lines(lines, path, [*exports.vcf_header(lengths, identifiers), "\t".join(table.columns)], single)


def write_ranges(intervals: DataFrame, path: str) -> None:
    _lines(intervals.select(F.col("contig").alias("o1"), F.col("start_pos").alias("o2"), F.concat_ws("\t", "contig", F.col("start_pos").cast("string"), F.col("end_pos").cast("string")).alias("value")), path)


def write_pedigree(lines: DataFrame, identifiers: list[str], path: str) -> None:
    """lines: sample_ord, phenotype, genotypes."""
    name = F.array(*(F.lit(x) for x in identifiers))[F.col("sample_ord")]
    text = F.concat_ws("\t", name, name, F.lit("0"), F.lit("0"), F.lit("0"), F.col("phenotype").cast("string"), "genotypes")
    _lines(lines.select("sample_ord", text.alias("value")), path)


def write_pedigree_map(places: DataFrame, path: str) -> None:
    """places: number, locus, pos."""
    text = F.concat_ws("\t", F.col("number").cast("string"), "locus", F.lit("0"), F.col("pos").cast("string"))
    _lines(places.select(F.col("number").alias("o1"), F.col("pos").alias("o2"), text.alias("value")), path)


def read_lines(spark: SparkSession, path: str) -> list[str]:
    """A small written file's lines, for looking at it."""
    return [r["value"] for r in spark.read.text(path).collect()]
