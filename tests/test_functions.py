import random

import pytest
from pyspark.sql import functions as F

from snpspark.functions import calls as C
from snpspark.functions import vcf as V
from snpspark.operators import filters, franken, intervals


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'long' if isinstance(v, int) else 'double'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize(
    ("format_", "sample", "info", "depth"),
    [
        ("", "", "", None), ("GT:DP", "0:42", "", 42), ("DP", "42", "", 42), ("FOO:DP", "24:42", "", 42), ("FOO", "24:", "", None), ("XDP:DP", "24:42", "", 42), ("FOO:XDP", "24:42", "", None),
        ("", "", "DP=42", 42), ("", "", "ADP=42", 42), ("", "", "FOO;DP=42", 42), ("", "", "FOO;ADP=42", 42), ("", "", "FOO", None), ("", "", "XDP=24;DP=42", 42), ("", "", "XADP=24;ADP=42", 42),
        ("", "", "FOO=24;XDP=42", None), ("", "", "FOO=24;XADP=42", None), ("GT:DP", "1:14", "DP=15", 14),
    ],
)
def test_depth(spark, format_, sample, info, depth):
    assert one(spark, V.depth(V.info_map("i"), V.sample_map("f", "s")), i=info, f=format_, s=sample) == depth


@pytest.mark.parametrize(
    ("ref", "alt", "gt", "call"),
    [("GA", "G", "1", "G"), ("GTT", "TT", "1/1", "G"), ("A", ".", "0", "A"), ("A", "C", "./.", "X"), ("A", "C", "0/1", "A"), ("A", "C,T", "2", "T"), ("a", "c", "1|0", "C"), ("A", "C", "7", "X")],
)
def test_call(spark, ref, alt, gt, call):
    assert one(spark, V.call("r", "a", "g"), r=ref, a=alt, g=gt) == call


def test_proportions(spark):
    info = lambda i, f, s: one(spark, V.proportion(V.info_map("i"), V.sample_map("f", "s"), V.depth(V.info_map("i"), V.sample_map("f", "s")), F.lit(True)), i=i, f=f, s=s)
    assert info("DP4=2,2,12589,13869;DP=26462", "GT", "1") == pytest.approx(26458 / 26462)
    assert info("DP=2", "GT:AD", "1:0,84") == 42
    assert info("DP=2", "GT:AD", "0:42,84") == 21
    assert info("DP=2", "GT:DP", "0:3") is None
    assert info("", "GT:AD:RD:DP", "1/1:15645:650:16608") == pytest.approx(0.9420, abs=1e-4)
    assert info("AR=0.25", "GT", "1") == 0.25
    assert info("DP=0", "GT:AD", "1:0,84") is None


def test_scalars(spark):
    assert one(spark, C.reverse_complement("x"), x="ACGTNRY") == "RYNACGT"
    assert [one(spark, C.simple_call("x"), x=v) for v in ("u", "acg", "X", "r", "")] == ["T", "A", "N", "N", "N"]
    assert one(spark, C.locus_contig("x"), x="gi|1.2::x::5") == "gi|1.2::x" and one(spark, C.locus_pos("x"), x="a::5") == 5
    assert one(spark, C.percent("a", "b"), a=3974, b=3977) == "99.92%" and one(spark, C.percent("a", "b"), a=0, b=0) == "0.00%"
    assert one(spark, C.failed_of("a", "b"), a=2, b=5) == 0
    assert one(spark, C.genotype("x"), x="0") == "." and one(spark, C.genotype("x"), x="2") == "1"
    assert tuple(one(spark, C.effect_fields("x"), x="a|syn|c|g1|p1")) == ("syn", "g1", "p1") and tuple(one(spark, C.effect_fields("x"), x="a")) == ("N/A",) * 3
    assert tuple(one(spark, C.sample_identity("x"), x="/d/e1-bowtie2-gatk.vcf")) == ("e1-bowtie2-gatk", "Bowtie2", "GATK")
    assert tuple(one(spark, C.sample_identity("x"), x="e1.vcf")) == ("e1", "pre-aligned", "pre-called") and tuple(one(spark, C.sample_identity("x"), x="e1.frankenfasta")) == ("e1", "nucmer", "")
    assert tuple(one(spark, C.sample_identity("x"), x="")) == ("", "", "")


@pytest.mark.parametrize(("calls", "usable", "pattern"), [("CGG", "111", "122"), ("AAGTA", "11101", "11201"), ("NAAC", "0111", "0112"), ("A", "1", "1")])
def test_pattern(spark, calls, usable, pattern):
    col = C.pattern(F.split("c", ""), F.transform(F.split("u", ""), lambda x: x == "1"))
    assert one(spark, col, c=calls, u=usable) == pattern


def test_informative(spark):
    df = spark.createDataFrame([("AACC",), ("AAAC",), ("ACGT",), ("AACCG",), ("",)], "c string").select("c", C.is_informative(F.split("c", "")).alias("x"))
    assert {r["c"]: r["x"] for r in df.collect()} == {"AACC": True, "AAAC": False, "ACGT": False, "AACCG": True, "": False}


def test_thinning(spark):
    rows = spark.createDataFrame([("a", p) for p in (2500, 3000, 7600, 9000, 12800)] + [("b", p) for p in (2499, 2500, 7500, 7501)], "contig string, pos long")
    lengths = spark.createDataFrame([("a", 100_000), ("b", 10_000)], "contig string, length long")
    assert sorted(map(tuple, filters.thinned(rows, lengths, 5000).collect())) == [("a", 2500), ("a", 7600), ("a", 12800), ("b", 2500), ("b", 7500)]


def test_intervals(spark):
    found = spark.createDataFrame([("a", 5, 2), ("a", 4, 9), ("a", 20, 21), ("b", 1, 1)], "contig string, start_pos long, end_pos long")
    assert sorted(map(tuple, intervals.merged(found).collect())) == [("a", 2, 9), ("a", 20, 21), ("b", 1, 1)]
    ref = spark.createDataFrame([("a", p) for p in range(1, 31)], "contig string, pos long")
    assert sorted(r["pos"] for r in intervals.marked(ref, found, cell=4).where("marked").collect()) == [*range(2, 10), 20, 21]


def _walk(row, query):
    """The alignment base by base, for comparison."""
    step = 1 if row["query_end"] >= row["query_start"] else -1
    flip = {"A": "T", "C": "G", "G": "C", "T": "A"}
    r, q, out = row["ref_start"], row["query_start"], {}

    def copy(n):
        nonlocal r, q
        for _ in range(n):
            out[r] = query[q - 1] if step == 1 else flip[query[q - 1]]
            r, q = r + 1, q + step

    for d in row["distances"]:
        if d == 0:
            break
        copy(abs(d) - 1)
        if d > 0:
            out[r] = "X"
            r += 1
        else:
            q += step
    copy(row["ref_end"] - r + 1)
    return out


def test_alignments_equal_a_walk(spark):
    rng = random.Random(3)
    names, rows, want = [], [], {}
    for k in range(40):
        query = "".join(rng.choice("ACGT") for _ in range(60))
        ds = [rng.choice((1, -1)) * rng.randint(1, 6) for _ in range(rng.randint(0, 4))]
        ends = (1, 60) if rng.random() < 0.5 else (60, 1)
        row = {"record_ord": k, "alignment_ord": 0, "ref_name": f"r{k}", "query_name": f"q{k}", "ref_start": 5, "ref_end": 5 + 30, "query_start": ends[0], "query_end": ends[1], "distances": [*ds, 0]}
        rows.append(row)
        names += [(f"q{k}", i + 1, c) for i, c in enumerate(query)]
        want |= {(f"r{k}", p): c for p, c in _walk(row, query).items()}
    df = spark.createDataFrame(rows, "record_ord long, alignment_ord int, ref_name string, query_name string, ref_start long, ref_end long, query_start long, query_end long, distances array<long>")
    got = franken.aligned(df, spark.createDataFrame(names, "contig string, pos long, call string"))
    assert {(r["contig"], r["pos"]): r["call"] for r in got.collect()} == want


def test_overlap(spark):
    rows = [("c", i + 1, b) for seq in ("XAC", "GAT") for i, b in enumerate(seq)]
    got = franken.overlapped(spark.createDataFrame(rows, "contig string, pos long, call string")).orderBy("pos").collect()
    assert "".join(r["call"] for r in got) == "GAN"
