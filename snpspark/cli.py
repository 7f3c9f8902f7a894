"""Commands: python -m snpspark.cli matrix --settings run.xml, and the like."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import sinks
from .plans import commands
from .session import session
from .sources import config, discover


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="snpspark")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, help_: str, *places: str, **several: str) -> argparse.ArgumentParser:
        out = sub.add_parser(name, help=help_)
        for place in places:
            out.add_argument(place)
        for place, n in several.items():
            out.add_argument(place, nargs=n)
        return out

    def options(p: argparse.ArgumentParser) -> None:
        p.add_argument("--consensus", choices=["cells", "analyses"], default="cells")
        p.add_argument("--missing", choices=["pass", "fail"], default="pass", help="whether unknown depths and proportions pass")
        p.add_argument("--failed-files", choices=["error", "blank"], default="error")
        p.add_argument("--stats", choices=["failed", "passed"], default="failed")
        for flag, help_ in (("multi-sample", "every column of a variant file is a sample"), ("check-reference", "variant files must have the reference's bases"), ("legacy", "older patterns, with their numbers"), ("vcf", "variant files beside the matrices"), ("parts", "matrices in as many files as there are partitions")):
            p.add_argument(f"--{flag}", action="store_true", help=help_)

    m = command("matrix", "matrices and statistics of a run", files="*")
    m.add_argument("--settings", help="an XML file; options win over it")
    for name in ("reference", "duplicates", "matrix-folder", "stats-folder"):
        m.add_argument(f"--{name}", default="")
    m.add_argument("--folder", action="append", default=[], help="a folder whose variant files and assemblies take part")
    m.add_argument("--min-depth", type=float)
    m.add_argument("--min-proportion", type=float)
    m.add_argument("--include-all", action=argparse.BooleanOptionalAction)
    m.add_argument("--include-masked", action=argparse.BooleanOptionalAction)
    options(m)
    r = command("run", "a configured run, from the files of other programs", "config")
    r.add_argument("--delta", action="append", default=[], metavar="SAMPLE=FILE", help="an assembly's alignment; =FILE for the reference with itself")
    options(r)
    e = command("export", "a matrix as FASTA or VCF", "matrix", "out")
    e.add_argument("--type", choices=["fasta", "vcf"], required=True)
    command("frankenfasta", "an assembly at the reference's positions", "delta", "assembly", "reference", "out").add_argument("--deletion", default="X")
    d = command("duplicates", "the reference's repeated regions", "delta", "out")
    d.add_argument("--type", choices=["fasta", "range"], default="fasta")
    d.add_argument("--reference", default="")
    command("merge", "matrices of different samples as one", "out", matrices="+")
    command("format-fasta", "sequences in lines of one length", "fasta", "out")
    command("matrix-to-fasta", "a matrix's samples as FASTA: all, complete and informative positions", "matrix", "prefix").add_argument("--share", type=float, default=0.9)
    c = command("filter-coordinates", "positions that a list has, or lacks", "matrix", "coordinates", "out")
    c.add_argument("--action", choices=["keep", "remove"], default="keep")
    command("filter-distance", "positions at least so far apart", "matrix", "reference", "prefix").add_argument("--distance", type=int, default=5000)
    g = command("filter-genome", "samples that a list has, or lacks", "matrix", "genomes", "out")
    g.add_argument("--action", choices=["keep", "remove"], default="keep")
    command("single", "positions at which one sample alone has a base", "matrix", "sample", "out")
    command("annotate", "a matrix's positions with the effects that an annotated variant file has", "matrix", "annotations", "out").add_argument("--names", default="")
    a = command("associate", "pedigree files, and how positions go with groups", "matrix", "groups", "prefix")
    a.add_argument("--alpha", type=float, default=0.05)
    a.add_argument("--times", type=int, default=99)
    return top


def settings_of(args: argparse.Namespace, spark: SparkSession | None = None) -> config.Settings:
    base = config.read(open(args.settings, encoding="utf-8").read()) if args.settings else config.Settings()
    given = config.Settings(args.reference, args.duplicates, args.matrix_folder, args.stats_folder, args.min_depth, args.min_proportion, args.include_all, args.include_masked)
    files = [config.Analysis(p, name=p.rsplit("/", 1)[-1].rsplit(".", 1)[0], source="fasta" if p.endswith(".frankenfasta") else "vcf") for p in args.files]
    if args.folder:
        found = discover.analyses(spark or session(), args.folder).collect()
        files += [config.Analysis(r["path"], r["name"], r["aligner"] or "", r["snpcaller"] or "", r["source"]) for r in found]
    return config.merged(base, given, files)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session()
    if args.command in ("matrix", "run"):
        chosen = {k: getattr(args, k) for k in ("consensus", "missing", "failed_files", "stats", "multi_sample", "check_reference", "legacy", "vcf")} | {"single": not args.parts}
    if args.command == "matrix":
        commands.matrix(spark, settings_of(args, spark), **chosen)
    elif args.command == "run":
        deltas = dict(x.split("=", 1) for x in args.delta)
        commands.run(spark, config.read_run(open(args.config, encoding="utf-8").read()), deltas, **chosen)
    elif args.command == "export":
        commands.export(spark, args.matrix, args.type, args.out)
    elif args.command == "frankenfasta":
        commands.frankenfasta(spark, args.delta, args.assembly, args.reference, args.out, args.deletion)
    elif args.command == "duplicates":
        commands.duplicates(spark, args.delta, args.out, args.type, args.reference)
    elif args.command == "merge":
        commands.merge_matrices(spark, args.matrices, args.out)
    elif args.command == "format-fasta":
        commands.format_fasta(spark, args.fasta, args.out)
    elif args.command == "matrix-to-fasta":
        print(commands.matrix_to_fasta(spark, args.matrix, args.prefix, args.share))
    elif args.command == "filter-coordinates":
        print(commands.filter_by_coordinates(spark, args.matrix, args.coordinates, args.action, args.out))
    elif args.command == "filter-distance":
        print(commands.filter_by_distance(spark, args.matrix, args.reference, args.distance, args.prefix))
    elif args.command == "filter-genome":
        print(*commands.filter_by_genome(spark, args.matrix, args.genomes, args.action, args.out))
    elif args.command == "single":
        print(commands.single_states(spark, args.matrix, args.sample, args.out))
    elif args.command == "annotate":
        fields = F.split(F.col("value"), "\t")
        known = spark.read.text(args.annotations).where(~F.col("value").startswith("#") & (F.size(fields) > 7))
        known = known.select(fields[0].alias("contig"), fields[1].cast("long").alias("pos"), fields[7].alias("info"))
        found = commands.annotate(spark, args.matrix, known, args.names)
        plain = [c for c, kind in found.dtypes if not kind.startswith(("array", "boolean"))]
        sinks.write_table(found.select(plain), args.out, ("contig_ord", "pos"))
    else:
        commands.association_test(spark, args.matrix, args.groups, args.prefix, args.alpha, args.times).show()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
