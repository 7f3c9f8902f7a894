"""The commands that users run, as plans over sources, operators and sinks."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import sinks
from ..errors import InputError, ReferenceCallMismatch
from ..functions import calls as C
from ..functions import vcf as V
from ..operators import association, exports, filters, franken, intervals, matrices, merge, positions
from ..sources import config, delta, discover, fasta, tables
from ..sources import vcf as vcf_files


def _same(path: str) -> str:
    """A path as it is told here and in Spark's metadata alike."""
    return unquote(re.sub("^file:/+", "/", path))


def _there(spark: SparkSession, path: str) -> str | None:
    """The full path of a file, or null if there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(at).toString() if fs.exists(at) else None


def load_cells(spark: SparkSession, reference: DataFrame, analyses: list[config.Analysis], multi_sample=False, failed_files="error", check_reference=False) -> tuple[DataFrame, list[dict]]:
    """All samples' cells and the samples, in the order of their identifiers.

    All variant files are one scan, and all assemblies another; which sample a row belongs to follows from its file (and
    its column). With several samples in a file each is a sample of its own. failed_files: "error", or "blank" for empty
    columns of files that are missing or can't be read. check_reference: raises ReferenceCallMismatch where a variant
    file has another base than the reference.
    """
    found = [_there(spark, a.path) for a in analyses]
    if failed_files != "blank" and None in found:
        raise InputError(f"{analyses[found.index(None)].path}: not found")
    vcfs = [path for a, path in zip(analyses, found) if path and a.source != "fasta"]
    fastas = [path for a, path in zip(analyses, found) if path and a.source == "fasta"]
    heads: dict[str, list[tuple[int, str]]] = {}
    names: dict[str, str] = {}
    if vcfs:
        for r in vcf_files.samples_in(spark, vcfs).orderBy("path", "column").collect():  # the matrix's columns
            heads.setdefault(_same(r["path"]), []).append((r["column"], r["sample_name"]))
            names[_same(r["path"])] = r["path"]
    bad: set[str] = set()
    seqs = None
    if fastas:
        seqs = fasta.sequences(spark, fastas, franken=True)
        unread = seqs.where(~F.col("seq").rlike(fasta.ALPHABET)).select("path").distinct()
        bad = {_same(r["path"]) for r in unread.collect()} if failed_files == "blank" else bad
        seqs = seqs if failed_files == "blank" else fasta.check(seqs)
        names |= {_same(r["path"]): r["path"] for r in seqs.select("path").distinct().collect()}
    samples = []
    for a, path in zip(analyses, found):
        columns = heads.get(_same(path), []) if path and a.source != "fasta" else []
        several = multi_sample and len(columns) > 1
        for column, name in columns if several else columns[:1] or [(0, "")]:
            identifier = f"{name}::{a.identifier.partition('::')[2]}".rstrip(":") if several else a.identifier
            samples.append({"identifier": identifier, "nickname": (name if several else a.name) or identifier, "source": a.source, "path": a.path, "file": names.get(_same(path or ""), ""), "column": name})
    samples.sort(key=lambda s: (s["identifier"], s["path"]))
    ords = spark.createDataFrame([(s["file"], s["column"], s["source"], i) for i, s in enumerate(samples)], "path string, sample_name string, source string, sample_ord int")
    ords = F.broadcast(ords)  # a row for each column of the matrix
    cells = spark.createDataFrame([], "contig string, pos long, call string, depth double, prop double, sample_ord int, line struct<block:bigint,at:bigint>")
    if vcfs:
        records = vcf_files.records(spark, vcfs, multi_sample, "blank" if failed_files == "blank" else "error")
        records = records.join(ords.where("source <> 'fasta'"), ["path", "sample_name"])
        if check_reference:
            _raise_mismatch(reference, records)
        cells = cells.unionByName(V.cells(records))
    if seqs is not None:
        good = seqs.where(~F.col("seq").rlike(fasta.ALPHABET)).select("path").distinct() if bad else None
        own = seqs.join(F.broadcast(good), "path", "left_anti") if good is not None else seqs
        own = exports.exploded(own.join(ords.where("source = 'fasta'").drop("sample_name"), "path"), keep=("sample_ord",))
        nothing = F.lit(None).cast("double")
        cells = cells.unionByName(own.select("contig", "pos", "call", nothing.alias("depth"), nothing.alias("prop"), "sample_ord", F.struct(F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("at")).alias("line")))
    return cells, [{k: s[k] for k in ("identifier", "nickname", "source", "path")} for s in samples]


def _raise_mismatch(reference: DataFrame, records: DataFrame) -> None:
    """Raises at the first record whose base differs from the reference's, if that is one of the four."""
    told = records.select("path", F.col("CHROM").alias("contig"), F.col("POS").cast("long").alias("pos"), F.substring("REF", 1, 1).alias("ref_call"))
    wrong = positions.check_reference(reference, told).where(F.col("expected").isin(*C.BASES))
    if r := wrong.head():
        raise ReferenceCallMismatch(f"{r['path']}: {r['contig']}:{r['pos']} is {r['ref_call']}, in the reference {r['expected']}")


def matrix(
    spark: SparkSession, settings: config.Settings, *, consensus="cells", missing="pass", multi_sample=False, failed_files="error", check_reference=False, legacy=False, vcf=False, stats="failed", single=True
) -> DataFrame:
    """Matrices and statistics of a run; returns its positions.

    consensus: "cells", or "analyses" if those of one sample must agree. legacy: matrices with the older patterns and
    their numbers. vcf: the bestsnp and missingdata matrices as variant files too. stats: "failed", or "passed" for the
    older counts. The positions are computed once and kept for the outputs.
    """
    ref = fasta.reference(spark, settings.reference, settings.duplicates or None)
    cells, samples = load_cells(spark, ref, settings.analyses, multi_sample, failed_files, check_reference)
    if not samples:
        raise InputError("no samples")
    least = {"min_depth": settings.min_depth or 0, "min_proportion": settings.min_proportion or 0}
    rows = positions.positions(ref, cells, positions.with_unfiltered(samples), **least, missing=missing, extra=("contig_ord",))
    if consensus == "analyses":
        rows = positions.agreed(rows, [s["nickname"] for s in samples])
    rows = rows.persist()
    ids = [s["identifier"] for s in samples]
    kinds = ["master", "missingdata", "bestsnp", *(["includeref"] if settings.include_all else []), *(["master_masked"] if settings.include_masked else []), *(["allcallable"] if legacy else [])]
    if settings.matrix_folder:
        for kind in kinds:
            sinks.write_matrix(rows, kind, ids, f"{settings.matrix_folder}/{kind}.tsv", single, legacy)
        if vcf:
            lengths = [(r["contig"], r["n"]) for r in rows.groupBy("contig_ord", "contig").agg(F.count("*").alias("n")).orderBy("contig_ord").collect()]  # a header line each
            for kind in ("missingdata", "bestsnp"):
                sinks.write_vcf(matrices.matrix(rows, kind), lengths, ids, f"{settings.matrix_folder}/{kind}.vcf", single)
    if settings.stats_folder:
        sinks.write_stats(rows, samples, f"{settings.stats_folder}/general_stats.tsv", f"{settings.stats_folder}/sample_stats.tsv", stats == "passed")
    return rows


def run(spark: SparkSession, configured: config.Run, deltas: dict[str, str] | None = None, **options) -> DataFrame:
    """A configured run, from what other programs have made to its matrices; returns its positions.

    deltas: alignments with the reference by sample ("" for the reference with itself). Assemblies with one become
    sequences at the reference's positions, the reference's own becomes the mask of duplicated regions, and the variant
    files are read as they are; aligners and callers aren't run.
    """
    deltas, top, extra, mask = deltas or {}, configured.output_folder.rstrip("/"), [], ""
    if configured.find_dups and "" in deltas:
        mask = f"{top}/reference/duplicates.txt"
        duplicates(spark, deltas[""], mask, "fasta", configured.reference)
    for sample, path in configured.assemblies:
        if sample in deltas:
            out = f"{top}/external/{sample}.frankenfasta"
            frankenfasta(spark, deltas[sample], path, configured.reference, out)
            extra.append(config.Analysis(out, sample, "nucmer", "", "fasta"))
    known = [r["path"] for kind, folder in configured.folders if kind == "vcfs" for r in discover.analyses(spark, [folder]).where("source = 'vcf'").collect()]
    extra += [config.Analysis(p, p.rsplit("/", 1)[-1].rsplit(".", 1)[0], "pre-aligned", "pre-called") for p in known]
    settings = config.settings_of(configured, mask, extra)
    return matrix(spark, config.merged(settings, config.Settings(), []), **options)


def _read(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """A matrix file as positions, with what can be told from it."""
    rows, ids = tables.matrix(spark, path)
    order = rows.select("contig").distinct().orderBy("contig")
    order = order.withColumn("contig_ord", F.row_number().over(Window.orderBy("contig")))
    flag = lambda c: F.transform("calls", lambda _, i: F.substring(F.col(c), i + 1, F.lit(1)).isin("Y", "-"))
    good = F.zip_with(flag("cov_flags"), flag("prop_flags"), lambda a, b: a & b)
    return rows.join(F.broadcast(order), "contig").withColumn("passed", good).withColumn("ref_base", F.col("ref_call").isin("A", "C", "G", "T")), ids


def export(spark: SparkSession, path: str, kind: str, out: str, lengths: list[tuple[str, int]] | None = None) -> None:
    """A matrix file as FASTA or VCF; contig lengths are the numbers of its rows if none are given."""
    rows, ids = _read(spark, path)
    if kind == "fasta":
        sinks.write_sample_fasta(rows, ids, out)
    elif kind == "vcf":
        known = lengths or [(r["contig"], r["n"]) for r in rows.groupBy("contig").agg(F.count("*").alias("n")).orderBy("contig").collect()]
        sinks.write_vcf(rows, known, ids, out)
    else:
        raise InputError(kind)


def frankenfasta(spark: SparkSession, delta_path: str, assembly: str, reference: str, out: str, deletion="X") -> None:
    """An assembly's bases at the reference's positions, as a FASTA file."""
    ref = fasta.reference(spark, reference)
    calls = franken.aligned(delta.alignments(spark, delta_path), fasta.positions(spark, assembly), deletion)
    sinks.write_fasta(exports.packed(franken.on_reference(ref, calls)), out, prefix="franken::")


def duplicates(spark: SparkSession, delta_path: str, out: str, kind="fasta", reference: str = "") -> None:
    """The reference's repeated regions, as a mask or as ranges, from its alignment with itself."""
    found = intervals.duplicated(delta.alignments(spark, delta_path))
    if kind == "range":
        sinks.write_ranges(intervals.merged(found), out)
    else:
        ref = fasta.reference(spark, reference)
        sinks.write_fasta(exports.packed(intervals.mask(ref, found), call="mask"), out)


def format_fasta(spark: SparkSession, path: str, out: str) -> None:
    sinks.write_fasta(fasta.check(fasta.sequences(spark, path)), out, order=("contig_ord",))


def matrix_to_fasta(spark: SparkSession, path: str, prefix: str, share=0.9) -> dict[str, int]:
    """Three FASTA files (all, complete enough, of these the informative) and how many positions each has."""
    rows, ids = _read(spark, path)
    rows = filters.without_indels(rows)
    kept = filters.dashed(filters.complete(rows, share))
    found = {"raw": rows, "filtered": kept, "filtered_PI_snps_only": filters.informative(kept)}
    for name, part in found.items():
        sinks.write_sample_fasta(part, ids, f"{prefix}.{name}.fasta")
    return {name: part.count() for name, part in found.items()}


def _rewritten(rows: DataFrame, ids: list[str], out: str) -> None:
    n = len(ids)
    for c, flags in (("n_called", "call_flags"), ("n_cov", "cov_flags"), ("n_prop", "prop_flags")):
        rows = rows.withColumn(c, F.lit(n).cast("long") - F.length(F.regexp_replace(flags, "[Y-]", ""))) if c not in rows.columns else rows
    sinks.write_matrix(rows, "master", ids, out)


def filter_by_coordinates(spark: SparkSession, path: str, coords: str, action: str, out: str) -> dict[str, int]:
    rows, ids = _read(spark, path)
    places = tables.coordinates(spark, coords)
    kept = (filters.keep_coordinates if action == "keep" else filters.remove_coordinates)(rows, places)
    _rewritten(kept, ids, out)
    whole = filters.without_missing(kept)
    return {"matching": filters.keep_coordinates(rows, places).count(), "without_missing": whole.count(), "informative": filters.informative(whole).count()}


def filter_by_distance(spark: SparkSession, path: str, reference: str, distance: int, prefix: str) -> int:
    rows, ids = _read(spark, path)
    lengths = fasta.sequences(spark, reference).select("contig", F.length("seq").alias("length"))
    kept = filters.thinned(rows, lengths, distance)
    _rewritten(kept, ids, f"{prefix}_distance_filtered.matrix")
    sinks.write_sample_fasta(kept, ids, f"{prefix}_distance_filtered.fasta")
    return kept.count()


def filter_by_genome(spark: SparkSession, path: str, genomes: str, action: str, out: str) -> list[str]:
    rows, ids = _read(spark, path)
    rows, kept = filters.choose_samples(rows, ids, tables.names(spark, genomes), action)
    _rewritten(rows, kept, out)
    return kept


def merge_matrices(spark: SparkSession, paths: list[str], out: str) -> list[str]:
    parts, every = [], []
    for path in paths:
        rows, ids = _read(spark, path)
        n = len(ids)
        for c, flags in (("n_called", "call_flags"), ("n_cov", "cov_flags"), ("n_prop", "prop_flags")):
            rows = rows.withColumn(c, F.lit(n).cast("long") - F.length(F.regexp_replace(flags, "[Y-]", "")))
        usable = F.zip_with("calls", "passed", lambda c, p: F.when(~c.isin("X", "N") & ~(p & c.isin("A", "C", "G", "T")), "N").otherwise(c))
        degen = F.size(F.filter(F.zip_with("calls", "passed", lambda c, p: p & ~c.isin("A", "C", "G", "T", "X", "N")), lambda x: x)).cast("long")
        rows = rows.withColumns({"masked": usable, "n_degen": degen, **{f"all_{a}": F.col(f"n_{b}") == n for a, b in (("called", "called"), ("cov", "cov"), ("prop", "prop"))}})
        parts.append(rows)
        every.append(ids)
    ids = merge.check_samples(*every)
    _rewritten(merge.merged(*parts), ids, out)
    return ids


def single_states(spark: SparkSession, path: str, sample: str, out: str) -> int:
    """Positions at which one sample alone has a base."""
    rows, ids = _read(spark, path)
    found = filters.singles(rows).where(F.col("sample_ord") == ids.index(sample))
    sinks._lines(found.select(F.col("contig").alias("o1"), F.col("pos").alias("o2"), F.concat_ws("\t", F.concat_ws("::", "contig", F.col("pos").cast("string")), "ref_call" if "ref_call" in found.columns else "call", "call").alias("value")), out)
    return found.count()


def annotate(spark: SparkSession, path: str, annotations: DataFrame, names: str = "") -> DataFrame:
    """A matrix's positions with what annotations (contig, pos, info) say; names: a file of other names for contigs."""
    rows, _ = _read(spark, path)
    if names:
        rows = filters.renamed(rows, tables.contig_names(spark, names))
        back = rows.select("contig", "other").distinct()
        annotations = annotations.withColumnRenamed("contig", "other").join(F.broadcast(back), "other").drop("other")
    return filters.annotated(rows, annotations)


def association_test(spark: SparkSession, path: str, groups: str, prefix: str, alpha=0.05, times=99) -> DataFrame:
    """Pedigree files, and how many positions go with the groups compared with groups dealt at random."""
    rows, ids = _read(spark, path)
    ords = spark.createDataFrame([(x, i) for i, x in enumerate(ids)], "identifier string, sample_ord int")
    known = tables.groups(spark, groups).join(F.broadcast(ords), "identifier").select("sample_ord", "phenotype")
    sinks.write_pedigree(association.pedigree(rows, known), ids, f"{prefix}.ped")
    sinks.write_pedigree_map(association.pedigree_map(rows, filters.contig_numbers(rows)), f"{prefix}.map")
    return association.permutation_test(rows, known, alpha, times)
