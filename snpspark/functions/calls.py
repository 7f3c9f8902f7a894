"""Column expressions over base calls, flags and locus names. All run inside Spark's generated code; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The bases, and the complement of each nucleotide code (K, by custom, stays K).
BASES = ("A", "C", "G", "T")
CODES, COMPLEMENTS = "ABCDGHMNRSTUVWXY", "TVGHCDKNYSAABWXR"


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_base(call) -> Column:
    return _col(call).isin(*BASES)


def was_called(call) -> Column:
    """A degenerate letter or a deletion counts as called; X (nothing there) and N don't."""
    return ~_col(call).isin("X", "N")


def is_degenerate(call) -> Column:
    return ~is_base(call)


def simple_call(text, allow_x=False, allow_deletion=False) -> Column:
    """First letter in upper case, U as T; anything but a base is N (or X or a dot where these are allowed)."""
    first = F.translate(F.upper(F.substring(_col(text), 1, 1)), "U", "T")
    allowed = [*BASES, *(["X"] if allow_x else []), *(["."] if allow_deletion else [])]
    return F.when(first.isin(*allowed), first).otherwise("N")


def reverse_complement(text) -> Column:
    return F.reverse(F.translate(F.upper(_col(text)), CODES, COMPLEMENTS))


def filter_flag(call, value, least, unfiltered) -> Column:
    """Y passes, N fails, ? can't be checked (no call), - doesn't apply (no filters in this kind of input, or no value)."""
    value = _col(value)
    return F.when(unfiltered, "-").when(_col(call) == "X", "?").when(value.isNull(), "-").when(value >= least, "Y").otherwise("N")


def passes(flag) -> Column:
    return _col(flag).isin("Y", "-")


def masked_call(call, passed) -> Column:
    """The call itself if there is none to hide, or if it passed and is a base; else N."""
    return F.when(~was_called(call) | (passed & is_base(call)), _col(call)).otherwise("N")


def failed_text(call, depth_flag, proportion_flag) -> Column:
    """What a VCF says about a sample's filters, the first that applies."""
    return F.when(~was_called(call), "NoCall").when(~passes(depth_flag), "CovFail").when(~passes(proportion_flag), "PropFail").otherwise("PASS")


def genotype(digit) -> Column:
    """The genotype that a pattern's digit stands for: one less, a dot for 0."""
    return F.when(_col(digit) == "0", ".").otherwise((_col(digit).cast("int") - 1).cast("string"))


def differs(call, reference) -> Column:
    return F.when(_col(call) == _col(reference), 0).otherwise(1)


def pedigree_genotype(call, reference) -> Column:
    """Two alleles: A for the reference's base, 0 where nothing is known, C otherwise."""
    call = _col(call)
    return F.when(call == _col(reference), "A\tA").when(call.isin("X", "N", "-"), "0\t0").otherwise("C\tC")


def dash_if_missing(call) -> Column:
    return F.when(is_base(call), _col(call)).otherwise("-")


def locus_id(contig, pos) -> Column:
    return F.concat_ws("::", _col(contig), _col(pos).cast("string"))


def locus_contig(locus) -> Column:
    """All before the last separator: contig names may hold nearly anything."""
    return F.regexp_extract(_col(locus), r"^(.*)::", 1)


def locus_pos(locus) -> Column:
    return F.regexp_extract(_col(locus), r"::(\d+)$", 1).try_cast("long")


def fraction(k, n) -> Column:
    return F.concat(_col(k).cast("string"), F.lit("/"), _col(n).cast("string"))


def percent(part, whole) -> Column:
    """Two digits and a percent sign; 0.00% of nothing."""
    return F.format_string("%.2f%%", F.coalesce(F.try_divide(_col(part) * 100.0, _col(whole)), F.lit(0.0)))


def failed_of(called, passed) -> Column:
    return F.greatest(_col(called) - _col(passed), F.lit(0).cast("long"))


def nickname(path) -> Column:
    """The file's name without folder and kind; of nameless files a hash of the path."""
    name = F.regexp_extract(_col(path), r"([^/]*?)(\.frankenfasta|\.vcf|\.fasta|\.fa)?$", 1)
    return F.when(name != "", name).otherwise(F.concat(F.lit("file_"), F.lpad(F.hex(F.xxhash64(_col(path))), 16, "0")))


def identifier(name, *generators) -> Column:
    """The name, and behind it what made the calls."""
    made = F.concat_ws(",", *(F.nullif(_col(g), F.lit("")) for g in generators))
    return F.when(made == "", _col(name)).otherwise(F.concat_ws("::", _col(name), made))


#: Endings of file names, and the tools that they tell.
ALIGNERS = {"novo": "Novoalign", "bowtie2": "Bowtie2", "bwamem": "BWA-mem", "bwa": "BWA", "snap": "SNAP"}
CALLERS = {"gatk": "GATK", "varscan": "VarScan", "samtools": "SAMtools", "solsnp": "SolSNP"}


def sample_identity(path) -> Column:
    """struct(name, aligner, snpcaller) told by a path's endings."""
    path = _col(path)
    name = F.regexp_extract(path, r"([^/]*?)(\.frankenfasta|\.vcf)?$", 1)

    def told(tools, otherwise):
        out = F.lit(otherwise)
        for ending, tool in reversed(tools.items()):
            out = F.when(F.lower(name).rlike(rf"-{ending}(-|$)"), tool).otherwise(out)
        return out

    none = F.lit("")
    franken, vcf = path.endswith(".frankenfasta"), path.endswith(".vcf")
    aligner = F.when(franken, "nucmer").when(vcf, told(ALIGNERS, "pre-aligned")).otherwise(none)
    caller = F.when(vcf, told(CALLERS, "pre-called")).otherwise(none)
    return F.struct(F.when(franken | vcf, name).otherwise(none).alias("name"), aligner.alias("aligner"), caller.alias("snpcaller"))


def is_self_hit(ref, query, ref_start, ref_end, query_start, query_end) -> Column:
    """An alignment of a place with itself."""
    return (_col(ref) == _col(query)) & ((_col(ref_start) == _col(query_start)) | (_col(ref_end) == _col(query_end)))


def effect_fields(info) -> Column:
    """struct(kind, locus, protein): the second, fourth and fifth field of an annotation, N/A where they are absent."""
    parts = F.split(_col(info), r"\|")
    field = lambda i: F.coalesce(F.nullif(F.get(parts, F.lit(i)), F.lit("")), F.lit("N/A"))
    return F.struct(field(1).alias("kind"), field(3).alias("locus"), field(4).alias("protein"))


def pattern(calls, usable) -> Column:
    """For each element the rank at which its base first appears among the usable ones, 0 if it isn't usable.

    calls, usable: arrays of the reference and all samples, in order.
    """
    pairs = F.arrays_zip(_col(calls).alias("c"), _col(usable).alias("u"))
    states = F.array_distinct(F.transform(F.filter(pairs, lambda p: p["u"]), lambda p: p["c"]))
    return F.array_join(F.transform(pairs, lambda p: F.when(p["u"], F.array_position(states, p["c"]).cast("string")).otherwise("0")), "")


def legacy_pattern(calls, usable) -> Column:
    """As pattern(), but 1 always belongs to the reference, and what isn't usable is N."""
    pairs = F.arrays_zip(_col(calls).alias("c"), _col(usable).alias("u"))
    rest = F.array_except(F.array_distinct(F.transform(F.filter(pairs, lambda p: p["u"]), lambda p: p["c"])), F.array(pairs[0]["c"]))
    digit = lambda p: F.when(p["c"] == pairs[0]["c"], "1").otherwise((F.array_position(rest, p["c"]) + 1).cast("string"))
    return F.array_join(F.transform(pairs, lambda p, i: F.when((i > 0) & ~p["u"], "N").when(i == 0, "1").otherwise(digit(p))), "")


def alternates(calls, reference) -> Column:
    """Bases other than the reference's, in the order in which they first appear."""
    return F.array_distinct(F.filter(_col(calls), lambda c: is_base(c) & (c != _col(reference))))


def is_complete(calls, share) -> Column:
    """At least `share` of the calls are bases."""
    return F.size(F.filter(_col(calls), is_base)) >= share * F.size(_col(calls))


def has_missing(calls) -> Column:
    return F.exists(_col(calls), lambda c: c.isin("X", "N", "-"))


def has_indel(calls) -> Column:
    return F.exists(_col(calls), lambda c: F.length(c) > 1)


def is_informative(calls) -> Column:
    """Two states at least have two calls each."""
    states = F.filter(F.array_distinct(_col(calls)), is_base)
    twice = F.filter(states, lambda s: F.size(F.filter(_col(calls), lambda c: c == s)) > 1)
    return F.size(twice) > 1


def is_single(calls, call) -> Column:
    """No other sample and not the reference has this base."""
    return is_base(call) & (F.size(F.filter(_col(calls), lambda c: c == _col(call))) == 1)
