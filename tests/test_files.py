import itertools

import pytest
from pyspark.sql import functions as F

from snpspark import cli, sinks
from snpspark.errors import DuplicateSample, InputError, InvalidContigName, MalformedFile, ReferenceCallMismatch
from snpspark.functions import calls as C
from snpspark.operators import association, merge, positions
from snpspark.plans import commands
from snpspark.sources import config, delta, discover, fasta, tables
from snpspark.sources import vcf as vcf_files
from snpspark.streaming import arrivals

REF = ">chr1 first\nACGTACGTAC\nGTAC\n>chr2\nTTTTGGGG"
HEAD = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\n"


def line(contig, pos, ref, alt, gt, dp, ad):
    return f"{contig}\t{pos}\t.\t{ref}\t{alt}\t.\t.\tDP={dp}\tGT:AD:DP\t{gt}:{ad}:{dp}\n"


@pytest.fixture
def run(tmp_path):
    """A reference, a mask, an assembly and two variant files."""
    (tmp_path / "ref.fasta").write_text(REF)
    (tmp_path / "dups.fasta").write_text(">chr1\n00000000000011\n")
    (tmp_path / "asm.frankenfasta").write_text(">franken::chr1\nACGAACGTACGTAC\n>franken::chr2\nTTTTGGGX")
    ref = {"chr1": "ACGTACGTACGTAC", "chr2": "TTTTGGGG"}
    for name, snps in (("one", {("chr1", 4): "A"}), ("two", {("chr1", 4): "A", ("chr1", 13): "T", ("chr2", 2): "C"})):
        text = HEAD
        for contig, seq in ref.items():
            for i, base in enumerate(seq, 1):
                snp = snps.get((contig, i))
                text += line(contig, i, base, snp or ".", 1 if snp else 0, 3 if (name, contig, i) == ("one", "chr1", 2) else 20, "0,20" if snp else "20")
        text += line("chr1", 4, "T", "G", 1, 50, "0,50")  # a repeated position: the first counts
        (tmp_path / f"{name}-bowtie2-gatk.vcf").write_text(text)
    return tmp_path


def settings(run, **more):
    files = [config.Analysis(f"{run}/asm.frankenfasta", "asm", "nucmer", "", "fasta"), config.Analysis(f"{run}/one-bowtie2-gatk.vcf", "one", "Bowtie2", "GATK"), config.Analysis(f"{run}/two-bowtie2-gatk.vcf", "two", "Bowtie2", "GATK")]
    return config.Settings(f"{run}/ref.fasta", f"{run}/dups.fasta", f"{run}/matrices", f"{run}/stats", 10, 0.9, True, True, files, **more)


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fasta").write_bytes(b">ContigA more\nGATC\nABCD\r\nefgh\n>ContigB\nCTAGDCBA")
    got = fasta.sequences(spark, str(tmp_path / "a.fasta")).orderBy("contig_ord").collect()
    assert [(r["contig"], r["seq"]) for r in got] == [("ContigA", "GATCABCDefgh"), ("ContigB", "CTAGDCBA")]
    sinks.write_fasta(fasta.sequences(spark, str(tmp_path / "a.fasta")), str(tmp_path / "out"), width=5)
    assert sinks.read_lines(spark, str(tmp_path / "out")) == [">ContigA", "GATCA", "BCDef", "gh", ">ContigB", "CTAGD", "CBA"]
    with pytest.raises(MalformedFile):
        (tmp_path / "b.fasta").write_text(">x\nAC!GT\n")
        fasta.check(fasta.sequences(spark, str(tmp_path / "b.fasta")))


def test_matrix_run(spark, run):
    rows = commands.matrix(spark, settings(run))
    got = {(r["contig"], r["pos"]): r for r in rows.collect()}
    assert len(got) == 22
    snp = got["chr1", 4]
    assert snp["calls"] == ["A", "A", "A"] and snp["pattern"] == "1222" and snp["best_snp"] and snp["cov_flags"] == "-YY"
    assert got["chr1", 2]["cov_flags"] == "-NY" and not got["chr1", 2]["consensus"] and got["chr1", 2]["masked"] == ["C", "N", "C"]
    assert got["chr1", 13]["in_dup"] and not got["chr1", 13]["any_snp"] and got["chr1", 13]["n_snp"] == 1
    assert got["chr2", 8]["calls"][0] == "X" and got["chr2", 8]["cov_flags"][0] == "-" and not got["chr2", 8]["quality"]
    for r in got.values():
        assert r["n_a"] + r["n_c"] + r["n_g"] + r["n_t"] + r["n_other"] == 3 and len(r["pattern"]) == 4 and (r["any_snp"] or not r["best_snp"])
    best = sinks.read_lines(spark, f"{run}/matrices/bestsnp.tsv")
    head, first = best[0].split("\t"), best[1].split("\t")
    assert head[:6] == ["LocusID", "Reference", "asm", "one::Bowtie2,GATK", "two::Bowtie2,GATK", "#SNPcall"] and head[-1] == "Pattern"
    assert first[:6] == ["chr1::4", "T", "A", "A", "A", "3"] and first[-1] == "1222" and len(best) == 3
    order = [x.split("\t")[0] for x in sinks.read_lines(spark, f"{run}/matrices/master.tsv")[1:]]
    assert order == [f"chr1::{i}" for i in range(1, 15)] + [f"chr2::{i}" for i in range(1, 9)]
    general = [x.split("\t") for x in sinks.read_lines(spark, f"{run}/stats/general_stats.tsv")]
    assert general[1][:4] == ["Whole Genome", "22", "20", "90.91%"] and [x[0] for x in general[2:]] == ["chr1", "chr2"]
    samples = [x.split("\t") for x in sinks.read_lines(spark, f"{run}/stats/sample_stats.tsv")]
    assert [x[:2] for x in samples[1:6]] == [["[any]", ""], ["[all]", ""], ["asm", "[any]"], ["asm", "[all]"], ["asm", "asm"]]


def test_two_forms_agree(spark, run):
    ref = fasta.reference(spark, f"{run}/ref.fasta", f"{run}/dups.fasta")
    cells, samples = commands.load_cells(spark, ref, settings(run).analyses)
    dense = positions.dense_cells(ref, cells, 3).select("contig", "pos", F.posexplode("cells").alias("s", "c")).select("contig", "pos", "s", "c.call")
    plain = ref.select("contig", "pos").join(spark.range(3).select(F.col("id").cast("int").alias("s")))
    plain = plain.join(positions.first_cells(cells).withColumnRenamed("sample_ord", "s"), ["contig", "pos", "s"], "left").select("contig", "pos", "s", F.coalesce(F.upper("call"), F.lit("X")).alias("call"))
    assert dense.exceptAll(plain).count() == 0 and plain.exceptAll(dense).count() == 0


def test_exports_and_filters(spark, run):
    commands.matrix(spark, settings(run))
    src = f"{run}/matrices/missingdata.tsv"
    commands.export(spark, src, "fasta", f"{run}/x.fasta")
    assert sinks.read_lines(spark, f"{run}/x.fasta") == [">Reference", "TT", ">asm", "AT", ">one::Bowtie2,GATK", "AT", ">two::Bowtie2,GATK", "AC"]
    commands.export(spark, src, "vcf", f"{run}/x.vcf")
    vcf = [x.split("\t") for x in sinks.read_lines(spark, f"{run}/x.vcf") if not x.startswith("##")]
    assert vcf[0][:9] == ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]
    assert vcf[1][:5] == ["chr1", "4", ".", "T", "A"] and vcf[1][7:] == ["AN=2;NS=3", "GT:FT", "1:PASS", "1:PASS", "1:PASS"]
    assert commands.matrix_to_fasta(spark, src, f"{run}/m") == {"raw": 2, "filtered": 2, "filtered_PI_snps_only": 0}
    (run / "coords.txt").write_text("chr1::4\n")
    assert commands.filter_by_coordinates(spark, src, f"{run}/coords.txt", "remove", f"{run}/c.tsv")["matching"] == 1
    assert [x.split("\t")[0] for x in sinks.read_lines(spark, f"{run}/c.tsv")] == ["LocusID", "chr2::2"]
    (run / "genomes.txt").write_text("asm\n")
    assert commands.filter_by_genome(spark, src, f"{run}/genomes.txt", "remove", f"{run}/g.tsv") == ["one::Bowtie2,GATK", "two::Bowtie2,GATK"]
    assert commands.single_states(spark, src, "two::Bowtie2,GATK", f"{run}/s.txt") == 1
    assert commands.filter_by_distance(spark, src, f"{run}/ref.fasta", 4, f"{run}/d") == 2
    (run / "groups.txt").write_text("asm 1\none::Bowtie2,GATK 1\ntwo::Bowtie2,GATK 2\nReference 0\n")
    result = commands.association_test(spark, src, f"{run}/groups.txt", f"{run}/p", alpha=0.05, times=5).first()
    assert result["hits"] == 1 and 0 <= result["p_value"] <= 1
    assert [x.split("\t")[5] for x in sinks.read_lines(spark, f"{run}/p.ped")] == ["1", "1", "2"]
    notes = spark.createDataFrame([("c1", 4, "x|syn|y|g|p")], "contig string, pos long, info string")
    (run / "names.txt").write_text("chr1 c1\n")
    assert {r["pos"]: r["kind"] for r in commands.annotate(spark, src, notes, f"{run}/names.txt").collect()} == {4: "syn", 2: "N/A"}


def test_merge_equals_one_run(spark, run):
    every = settings(run)
    whole = commands.matrix(spark, every).select("contig", "pos", F.array_join("calls", "").alias("calls"), "pattern", "n_snp")
    paths = []
    for k, part in enumerate((every.analyses[:1], every.analyses[1:])):
        one = config.Settings(every.reference, every.duplicates, f"{run}/part{k}", "", 10, 0.9, analyses=part)
        commands.matrix(spark, one)
        paths.append(f"{run}/part{k}/master.tsv")
    assert commands.merge_matrices(spark, paths, f"{run}/merged.tsv") == ["asm", "one::Bowtie2,GATK", "two::Bowtie2,GATK"]
    got = tables.matrix(spark, f"{run}/merged.tsv")[0].select("contig", "pos", F.array_join("calls", "").alias("calls"), "pattern", "n_snp")
    assert got.exceptAll(whole).count() == 0 and whole.count() == got.count()
    with pytest.raises(DuplicateSample):
        merge.check_samples(["a"], ["b", "a"])


def test_vcf_reader(spark, tmp_path):
    (tmp_path / "m.vcf").write_text(HEAD.replace("S1", "S1\tS2") + "c\t1\t.\tA\tC\t.\t.\tDP=9\tGT:DP\t1:5\t0\n")
    rows = vcf_files.records(spark, [str(tmp_path / "m.vcf")], multi_sample=True)
    assert sorted((r["sample_name"], r["sample"]) for r in rows.collect()) == [("S1", "1:5"), ("S2", "0")]
    assert vcf_files.records(spark, [str(tmp_path / "m.vcf")]).count() == 1
    (tmp_path / "bad.vcf").write_text("c\t1\t.\tA\tC\n")
    with pytest.raises(MalformedFile):
        vcf_files.records(spark, [str(tmp_path / "bad.vcf")])
    (tmp_path / "empty.vcf").write_text("")
    assert vcf_files.records(spark, [str(tmp_path / "empty.vcf")]).count() == 0


def test_assembly_and_duplicates(spark, run):
    (run / "a.delta").write_text("a b\nNUCMER\n>chr1 q 14 9\n3 8 1 6 0 0 0\n2\n-2\n0\n")
    (run / "q.fasta").write_text(">q\nGAACGTCCC\n")
    row = delta.alignments(spark, f"{run}/a.delta").first()
    assert row["distances"] == [2, -2, 0] and row["ref_name"] == "chr1" and row["query_len"] == 9
    commands.frankenfasta(spark, f"{run}/a.delta", f"{run}/q.fasta", f"{run}/ref.fasta", f"{run}/f.fasta")
    # Copied G, a position lacking in q, copied A, one base of q skipped, then three copied.
    assert sinks.read_lines(spark, f"{run}/f.fasta") == [">franken::chr1", "XXGXACGTXXXXXX", ">franken::chr2", "XXXXXXXX"]
    (run / "bad.fasta").write_text(">other\nGAT\n")
    with pytest.raises(InvalidContigName):
        commands.frankenfasta(spark, f"{run}/a.delta", f"{run}/bad.fasta", f"{run}/ref.fasta", f"{run}/g.fasta")
    (run / "self.delta").write_text("a a\nNUCMER\n>chr1 chr1 14 14\n1 14 1 14 0 0 0\n0\n1 3 7 5 0 0 0\n0\n")
    commands.duplicates(spark, f"{run}/self.delta", f"{run}/r.txt", "range")
    assert sinks.read_lines(spark, f"{run}/r.txt") == ["chr1\t1\t3", "chr1\t5\t7"]
    commands.duplicates(spark, f"{run}/self.delta", f"{run}/m.fasta", "fasta", f"{run}/ref.fasta")
    assert sinks.read_lines(spark, f"{run}/m.fasta")[:2] == [">chr1", "11101110000000"]
    with pytest.raises(MalformedFile):
        list(delta.parse("a b\nPROMER\n"))


def test_settings(tmp_path):
    plain = config.Settings("r.fasta", "d.txt", "m", "s", 10, 0.9, analyses=[config.Analysis("e.frankenfasta", "e", "nucmer", "", "fasta"), config.Analysis("e.vcf", "e1", "Bowtie2", "GATK")])
    assert config.read(config.write(plain)) == plain
    # What the caller gives wins, also where it equals some default.
    said = config.Settings("r.fasta", min_depth=15, min_proportion=0.95, include_all=True)
    assert [getattr(config.merged(said, config.Settings(min_depth=10, min_proportion=0.9, include_all=False), []), k) for k in ("min_depth", "min_proportion", "include_all")] == [10, 0.9, False]
    assert config.merged(said, config.Settings(), []).min_proportion == 0.95
    given = config.Settings(min_depth=5)
    out = config.merged(plain, given, [config.Analysis("e.vcf", "other")])
    assert out.min_depth == 5 and out.min_proportion == 0.9 and [a.name for a in out.analyses] == ["e", "other"]
    assert [a.identifier for a in plain.analyses] == ["e", "e1::Bowtie2,GATK"]
    (tmp_path / "s.xml").write_text(config.write(plain))
    args = cli.parser().parse_args(["matrix", "--settings", str(tmp_path / "s.xml"), "--min-depth", "7", "x.vcf"])
    assert cli.settings_of(args).min_depth == 7 and len(cli.settings_of(args).analyses) == 3


def test_discovery(spark, run):
    found = {r["name"]: (r["aligner"], r["source"]) for r in discover.analyses(spark, [str(run)]).collect()}
    assert found == {"asm": ("nucmer", "fasta"), "one-bowtie2-gatk": ("Bowtie2", "vcf"), "two-bowtie2-gatk": ("Bowtie2", "vcf")}
    files = spark.createDataFrame([("s_R1_001.fastq.gz",), ("s_R2_001.fastq.gz",), ("t_1.fastq",), ("u_1.fq",), ("u_2.fq",)], "path string")
    assert sorted(r["sample"] for r in discover.read_pairs(files).collect()) == ["s", "u"]
    assert [r["path"] for r in discover.lone_reads(files).collect()] == ["t_1.fastq"]


def test_streamed_cells_equal_static_ones(spark, run, tmp_path):
    query = arrivals.follow(spark, str(run), str(tmp_path / "cells"), str(tmp_path / "log"))
    query.processAllAvailable()
    query.stop()
    static = arrivals.cells_of(spark.read.text([f"{run}/one-bowtie2-gatk.vcf", f"{run}/two-bowtie2-gatk.vcf"]).select(F.col("_metadata.file_path").alias("path"), "value"))
    got = spark.read.parquet(str(tmp_path / "cells"))
    assert got.count() == static.count() == 46 and got.select("contig", "pos", "call").exceptAll(static.select("contig", "pos", "call")).count() == 0


def test_options(spark, run):
    ref = fasta.reference(spark, f"{run}/ref.fasta")
    cells = spark.createDataFrame([("chr1", 1, 0, "A", None, None)], "contig string, pos long, sample_ord int, call string, depth double, prop double")
    flags = lambda **o: positions.positions(ref, cells, [False], **o).where("contig = 'chr1' and pos = 1").first()["cov_flags"]
    assert flags() == "-" and flags(missing="fail") == "?"
    rows = commands.matrix(spark, settings(run), consensus="analyses")
    assert rows.where("best_snp").count() == 2
    wrong = spark.createDataFrame([("chr1", 1, "C")], "contig string, pos long, ref_call string")
    assert positions.check_reference(ref, wrong).count() == 1
    text = spark.range(1).select(C.legacy_pattern(F.split(F.lit("CGGC"), ""), F.array(*map(F.lit, (True, True, False, True)))).alias("p")).first()[0]
    assert text == "12N1"


def test_permutations_equal_a_loop(spark):
    rows = spark.createDataFrame([("c", i, "A", list(x)) for i, x in enumerate(itertools.product("AC", repeat=4))], "contig string, pos long, ref_call string, calls array<string>")
    groups = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, 2)], "sample_ord int, phenotype int")
    dealt = association.shuffled_groups(groups, 20)
    want = []
    for k in range(1, 21):
        want.append(association.significant(rows, dealt.where(F.col("round") == k).drop("round"), 0.05))
    got = association.permutation_test(rows, groups, 0.05, 20).first()
    assert got["hits"] == association.significant(rows, groups, 0.05) and got["mean_random"] == pytest.approx(sum(want) / 20)
    assert got["better"] == sum(x >= got["hits"] for x in want)


def test_files_that_cannot_be_read(spark, run):
    (run / "bare.vcf").write_text("chr1\t1\t.\tA\t.\t.\t.\t.\tGT\t0\n")
    (run / "odd.frankenfasta").write_text(">chr1\nAC!GT\n")
    ref = fasta.reference(spark, f"{run}/ref.fasta")
    for name, source, error in (("bare.vcf", "vcf", MalformedFile), ("odd.frankenfasta", "fasta", MalformedFile), ("none.vcf", "vcf", InputError)):
        files = [*settings(run).analyses, config.Analysis(f"{run}/{name}", "zz", source=source)]
        with pytest.raises(error):
            commands.load_cells(spark, ref, files)
        cells, samples = commands.load_cells(spark, ref, files, failed_files="blank")
        assert [s["identifier"] for s in samples] == ["asm", "one::Bowtie2,GATK", "two::Bowtie2,GATK", "zz"]
        assert sorted(r["sample_ord"] for r in cells.select("sample_ord").distinct().collect()) == [0, 1, 2]


def test_reference_is_checked(spark, run):
    ref = fasta.reference(spark, f"{run}/ref.fasta")
    commands.load_cells(spark, ref, settings(run).analyses, check_reference=True)
    text = (run / "one-bowtie2-gatk.vcf").read_text().replace("chr1\t2\t.\tC", "chr1\t2\t.\tG")
    (run / "one-bowtie2-gatk.vcf").write_text(text)
    commands.load_cells(spark, ref, settings(run).analyses)
    with pytest.raises(ReferenceCallMismatch, match="chr1:2"):
        commands.load_cells(spark, ref, settings(run).analyses, check_reference=True)


def test_several_samples_in_a_file(spark, run):
    head = HEAD.rstrip("\n") + "\tS2\n"
    rows = "".join(line("chr1", i, base, ".", 0, 20, "20").rstrip("\n") + "\t0:20:20\n" for i, base in enumerate("ACGT", 1))
    (run / "both.vcf").write_text(head + rows)
    ref = fasta.reference(spark, f"{run}/ref.fasta")
    files = [config.Analysis(f"{run}/both.vcf", "both", "Bowtie2", "GATK")]
    cells, samples = commands.load_cells(spark, ref, files, multi_sample=True)
    assert [s["identifier"] for s in samples] == ["S1::Bowtie2,GATK", "S2::Bowtie2,GATK"] and cells.count() == 8
    cells, samples = commands.load_cells(spark, ref, files)
    assert len(samples) == 1 and cells.count() == 4


def test_legacy_outputs(spark, run):
    rows = commands.matrix(spark, settings(run), legacy=True, vcf=True, stats="passed")
    best = [x.split("\t") for x in sinks.read_lines(spark, f"{run}/matrices/bestsnp.tsv")]
    assert best[0][-2:] == ["Pattern", "Pattern#"] and best[1][-2:] == ["'1222'", "1"]
    whole = sinks.read_lines(spark, f"{run}/matrices/allcallable.tsv")[0].split("\t")
    assert "CallWasMade" not in whole and whole[-1] == "Pattern#"
    vcf = [x.split("\t") for x in sinks.read_lines(spark, f"{run}/matrices/bestsnp.vcf") if not x.startswith("##")]
    assert vcf[1][:5] == ["chr1", "4", ".", "T", "A"]
    samples = {x.split("\t")[1]: x.split("\t") for x in sinks.read_lines(spark, f"{run}/stats/sample_stats.tsv")[1:]}
    assert samples["two::Bowtie2,GATK"][2] == "22"
    with pytest.raises(Exception, match="no length"):
        sinks.write_vcf(rows, [("chr1", 14)], ["a", "b", "c"], f"{run}/x.vcf")


def test_configured_run(spark, run):
    text = f"""<NaspInputData><Options><RunName>r</RunName><OutputFolder>{run}/out</OutputFolder>
    <Reference name="ref" path="{run}/ref.fasta"><FindDups>True</FindDups></Reference>
    <Filters><CoverageFilter>10</CoverageFilter><ProportionFilter>0.9</ProportionFilter></Filters><JobSubmitter>NONE</JobSubmitter></Options>
    <Files><VCFFolder path="{run}"><VCFFile sample="one">one-bowtie2-gatk.vcf</VCFFile></VCFFolder>
    <ReadFolder path="/r"><ReadPair sample="p"><Read1Filename>a_1.fastq</Read1Filename><Read2Filename>a_2.fastq</Read2Filename></ReadPair></ReadFolder><AssemblyFolder path="/none"/></Files>
    <ExternalApplications><Index/><Aligner name="BWA-mem" path="/usr/bin/bwa"><AdditionalArguments>-k 9</AdditionalArguments><JobParameters name="a"><NumCPUs>4</NumCPUs></JobParameters></Aligner></ExternalApplications></NaspInputData>"""
    got = config.read_run(text)
    assert (got.name, got.reference_name, got.find_dups, got.min_depth, got.submitter) == ("r", "ref", True, 10, "NONE")
    assert got.reads == [("p", "/r/a_1.fastq", "/r/a_2.fastq")] and got.folders == [("assemblies", "/none")]
    assert got.tools["Aligner"][0].arguments == "-k 9" and got.tools["Aligner"][0].job["cpus"] == "4"
    rows = commands.run(spark, got)
    assert rows.count() == 22 and rows.where("n_snp = 1").count() == 1
    assert sinks.read_lines(spark, f"{run}/out/matrices/bestsnp.tsv")[0].split("\t")[2] == "one::pre-aligned,pre-called"


def test_command_line(spark, run, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    (run / "coords.txt").write_text("chr1::4\n")
    (run / "names.txt").write_text("asm\n")
    (run / "in").mkdir()
    (run / "in" / "asm.frankenfasta").write_text((run / "asm.frankenfasta").read_text())
    m = f"{run}/m2/missingdata.tsv"
    lines = [
        "matrix --reference R/ref.fasta --matrix-folder R/m2 --folder R/in --min-depth 3", "export --type fasta M R/o1", "format-fasta R/ref.fasta R/o2", "matrix-to-fasta M R/o3", "filter-coordinates M R/coords.txt R/o4 --action remove",
        "filter-distance M R/ref.fasta R/o5 --distance 2", "filter-genome M R/names.txt R/o6", "single M asm R/o7", "annotate M R/one-bowtie2-gatk.vcf R/o8",
    ]
    for k, argv in enumerate(lines):
        assert cli.main(argv.replace(" M", f" {m}").replace("R/", f"{run}/").split()) == 0
        assert list(run.glob(f"o{k}*")) or list(run.glob("m2"))


def test_random_groups_that_are_the_true_one(spark):
    groups = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, 2)], "sample_ord int, phenotype int")
    got = association.still_affected(groups, 12).collect()
    assert len(got) == 12 and all(set(r["both"]) == set(r["affected"]) & {2, 3} and set(r["others"]) == set(r["affected"]) - {2, 3} for r in got)


def test_a_given_master_holds(monkeypatch):
    from snpspark import session as module

    monkeypatch.setattr(module.SparkSession, "getActiveSession", classmethod(lambda cls: None))
    for name in ("SPARK_REMOTE", "PYSPARK_GATEWAY_PORT", "MASTER", "SPARK_MASTER", "PYSPARK_SUBMIT_ARGS"):
        monkeypatch.delenv(name, raising=False)
    assert not module._placed()
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", "--master yarn pyspark-shell")
    assert module._placed()
