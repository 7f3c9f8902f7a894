"""A run's settings, from XML and from the caller; what the caller gives wins. None (or an empty text) is not given."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from dataclasses import dataclass, field, fields, replace

from ..errors import InputError


@dataclass
class Analysis:
    path: str
    name: str = ""
    aligner: str = ""
    snpcaller: str = ""
    source: str = "vcf"

    @property
    def identifier(self) -> str:
        made = ",".join(x for x in (self.aligner, self.snpcaller) if x)
        return f"{self.name}::{made}" if made and self.source == "vcf" else self.name


@dataclass
class Settings:
    reference: str = ""
    duplicates: str = ""
    matrix_folder: str = ""
    stats_folder: str = ""
    min_depth: float | None = None
    min_proportion: float | None = None
    include_all: bool | None = None
    include_masked: bool | None = None
    analyses: list[Analysis] = field(default_factory=list)


#: Where the settings stand in the XML.
_TAGS = {"reference": "reference-fasta", "duplicates": "reference-dups", "matrix_folder": "matrix-folder", "stats_folder": "stats-folder", "min_depth": "minimum-coverage", "min_proportion": "minimum-proportion"}


def read(text: str) -> Settings:
    root = ET.fromstring(text.strip())
    out = Settings()
    for name, tag in _TAGS.items():
        found = root.findtext(f"parameters/{tag}")
        if found is not None and found.strip():
            setattr(out, name, float(found) if name.startswith("min_") else found.strip())
    if (found := root.findtext("parameters/filter-matrix-format")) is not None:
        out.include_all = "include_allref_pos" in found
    for item in root.findall("files/*"):
        source = "fasta" if item.tag == "frankenfasta" else "vcf"
        out.analyses.append(Analysis((item.text or "").strip(), item.get("name", ""), item.get("aligner", ""), item.get("snpcaller", ""), source))
    return out


def write(settings: Settings) -> str:
    root = ET.Element("matrix_data")
    params, files = ET.SubElement(root, "parameters"), ET.SubElement(root, "files")
    for name, tag in _TAGS.items():
        if (value := getattr(settings, name)) not in ("", None):
            ET.SubElement(params, tag).text = f"{value:g}" if isinstance(value, (int, float)) else value
    if settings.include_all:
        ET.SubElement(params, "filter-matrix-format").text = "include_allref_pos"
    for a in settings.analyses:
        more = {"snpcaller": a.snpcaller} if a.snpcaller else {}
        ET.SubElement(files, "frankenfasta" if a.source == "fasta" else "vcf", {"name": a.name, "aligner": a.aligner, **more}).text = a.path
    ET.indent(root)
    return ET.tostring(root, encoding="unicode")


def merged(base: Settings, given: Settings, analyses: list[Analysis]) -> Settings:
    """`base` with all that `given` says; of files named twice the given ones count."""
    changed = {f.name: value for f in fields(Settings) if f.name != "analyses" and (value := getattr(given, f.name)) not in (None, "")}
    every = {a.path: a for a in [*base.analyses, *given.analyses, *analyses]}
    out = replace(base, **changed, analyses=sorted(every.values(), key=lambda a: (a.identifier, a.path)))
    if not out.reference:
        raise InputError("a reference is needed")
    return out


@dataclass
class Tool:
    """A program that a run's configuration names; programs aren't run here, their files are the inputs."""

    name: str = ""
    path: str = ""
    arguments: str = ""
    job: dict[str, str] = field(default_factory=dict)


@dataclass
class Run:
    """A run's configuration: options, the files of each kind, and the tools it names."""

    name: str = ""
    output_folder: str = ""
    reference_name: str = ""
    reference: str = ""
    find_dups: bool = False
    min_depth: float | None = None
    min_proportion: float | None = None
    submitter: str = ""
    matrix_format: str = ""
    trim_reads: bool = False
    reads: list[tuple[str, ...]] = field(default_factory=list)
    assemblies: list[tuple[str, str]] = field(default_factory=list)
    alignments: list[tuple[str, str]] = field(default_factory=list)
    vcfs: list[tuple[str, str]] = field(default_factory=list)
    #: Folders that name no files of their own, by kind: whatever lies in them belongs to the run.
    folders: list[tuple[str, str]] = field(default_factory=list)
    tools: dict[str, list[Tool]] = field(default_factory=dict)


#: Where a configuration's options and files stand in the XML.
_OPTIONS = {"name": "RunName", "output_folder": "OutputFolder", "submitter": "JobSubmitter", "matrix_format": "FilterMatrixFormat"}
_FOLDERS = {"ReadFolder": ("reads", "Read"), "AssemblyFolder": ("assemblies", "Assembly"), "AlignmentFolder": ("alignments", "Alignment"), "VCFFolder": ("vcfs", "VCFFile")}
_JOB = {"MemRequested": "memory", "NumCPUs": "cpus", "Walltime": "walltime", "Queue": "queue", "JobSubmitterArgs": "arguments"}


def read_run(text: str) -> Run:
    """A run's configuration from its XML."""
    root = ET.fromstring(text.strip())
    options, out = root.find("Options"), Run()
    if options is None or options.find("Reference") is None:
        raise InputError("a configuration needs options and a reference")
    said = lambda node, tag: (node.findtext(tag) or "").strip()
    for name, tag in _OPTIONS.items():
        setattr(out, name, said(options, tag))
    reference = options.find("Reference")
    out.reference_name, out.reference, out.find_dups = reference.get("name", ""), reference.get("path", ""), said(reference, "FindDups").lower() == "true"
    out.trim_reads = said(options, "TrimReads").lower() == "true"
    for name, tag in (("min_depth", "Filters/CoverageFilter"), ("min_proportion", "Filters/ProportionFilter")):
        setattr(out, name, float(said(options, tag)) if said(options, tag) else None)
    for folder in root.findall("Files/*"):
        if folder.tag not in _FOLDERS:
            continue
        kind, tag = _FOLDERS[folder.tag]
        at = lambda name, top=folder.get("path", ""): f"{top.rstrip('/')}/{name.strip()}"
        found = [(x.get("sample", ""), at(x.text or "")) for x in folder.findall(tag)]
        found += [(x.get("sample", ""), at(said(x, "Read1Filename")), at(said(x, "Read2Filename"))) for x in folder.findall("ReadPair")]
        getattr(out, kind).extend(found)
        if not found:
            out.folders.append((kind, folder.get("path", "")))
    for tool in root.findall("ExternalApplications/*"):
        job = tool.find("JobParameters")
        asked = {} if job is None else {"name": job.get("name", "")} | {ours: said(job, tag) for tag, ours in _JOB.items()}
        out.tools.setdefault(tool.tag, []).append(Tool(tool.get("name") or tool.tag, tool.get("path", ""), said(tool, "AdditionalArguments"), asked))
    return out


def settings_of(run: Run, duplicates: str = "", extra: list[Analysis] = ()) -> Settings:
    """The matrix settings of a run: its variant files as analyses, its folders below the output folder."""
    files = [Analysis(path, sample, snpcaller="pre-called", aligner="pre-aligned") for sample, path in run.vcfs]
    top = run.output_folder.rstrip("/")
    include = "include_allref_pos" in run.matrix_format
    return Settings(run.reference, duplicates, f"{top}/matrices", f"{top}/statistics", run.min_depth, run.min_proportion, include, None, [*files, *extra])
