"""All queries over the bridge's inputs, by name, each with the SQL that it is compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bridge
from .functions import calls as C
from .functions import vcf as V
from .operators import association, exports, filters, franken, intervals, matrices, merge, positions, stats
from .sources import discover, samples

_QUERIES: dict = {}
_SQL: dict = {}
IDS = [x[0] for x in bridge.SAMPLES]
NICKS = [x[1] for x in bridge.SAMPLES]


def query(sql: str | None = None, gaps: float = 0, plain=False):
    """Registers a query under q_ and the function's name; its SQL may use the bridge's CTEs."""

    def add(f):
        name = f"q_{f.__name__.strip('_')}"
        _QUERIES[name] = f
        if sql:
            # Further CTEs come first and end with the last select.
            _SQL[name] = sql if plain else "with recursive" + bridge.ctes(gaps) + (sql if sql.lstrip().startswith(",") else "\n" + sql)
        return f

    return add


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _positions(spark, sf_dir, gaps=0, **options) -> DataFrame:
    cells = bridge.cells(spark, sf_dir, gaps)
    return positions.positions(bridge.reference(spark, sf_dir), cells, [x[2] for x in bridge.SAMPLES], extra=("contig_ord",), **options)


def _cells(rows: DataFrame) -> DataFrame:
    """A row for each cell with its flags and its masked call."""
    z = F.arrays_zip("calls", "masked", "passed")
    rows = rows.select("contig", "pos", "ref_call", "in_dup", "cov_flags", "prop_flags", F.posexplode(z).alias("sample_ord", "z"))
    char = lambda c: F.substring(F.col(c), F.col("sample_ord") + 1, F.lit(1))
    return rows.select("contig", "pos", "ref_call", "in_dup", "sample_ord", F.col("z.calls").alias("call"), F.col("z.masked").alias("masked"), F.col("z.passed").alias("passed"), char("cov_flags").alias("cov"), char("prop_flags").alias("pf"))


def _matrix(rows: DataFrame, kind: str) -> DataFrame:
    return matrices.matrix(rows, kind).select("contig", "pos", "ref_call", F.array_join("shown", "").alias("calls"), "n_snp", "n_ref", "pattern")


_COUNTS = "n_snp, n_ref, n_degen, n_called, n_cov, n_prop, n_a, n_c, n_g, n_t, n_other"


# --- cells and positions


@query("select contig, pos, sample_ord, call, depth, prop from dense", gaps=0.935)
def cells_dense(spark, sf_dir):
    rows = positions.dense_cells(bridge.reference(spark, sf_dir), bridge.cells(spark, sf_dir, 0.935), bridge.N)
    return rows.select("contig", "pos", F.posexplode("cells").alias("sample_ord", "c")).select("contig", "pos", "sample_ord", "c.*")


@query("select contig, pos, sample_ord, cov from cell", gaps=0.935)
def cov_flag(spark, sf_dir):
    return _cells(_positions(spark, sf_dir, 0.935)).select("contig", "pos", "sample_ord", "cov")


@query("select contig, pos, sample_ord, pf from cell", gaps=0.935)
def prop_flag(spark, sf_dir):
    return _cells(_positions(spark, sf_dir, 0.935)).select("contig", "pos", "sample_ord", "pf")


@query("select contig, pos, sample_ord, call, masked, passed from shown", gaps=0.935)
def mask(spark, sf_dir):
    return _cells(_positions(spark, sf_dir, 0.935)).select("contig", "pos", "sample_ord", "call", "masked", "passed")


@query(f"select contig, pos, ref_call, in_dup, {_COUNTS}, consensus, all_called, all_cov, all_prop, quality, any_snp, best_snp from judged")
def position_summary(spark, sf_dir):
    return _positions(spark, sf_dir).select("contig", "pos", "ref_call", "in_dup", *_COUNTS.split(", "), "consensus", "all_called", "all_cov", "all_prop", "quality", "any_snp", "best_snp")


@query(f"select contig, pos, {_COUNTS}, pattern, quality, any_snp, best_snp from judged", gaps=0.935)
def position_summary_gaps(spark, sf_dir):
    return _positions(spark, sf_dir, 0.935).select("contig", "pos", *_COUNTS.split(", "), "pattern", "quality", "any_snp", "best_snp")


@query("select contig, pos, n_a, n_c, n_g, n_t, n_other from position")
def base_histogram(spark, sf_dir):
    return _positions(spark, sf_dir).select("contig", "pos", "n_a", "n_c", "n_g", "n_t", "n_other")


@query("select contig, pos, call_flags, cov_flags, prop_flags from position", gaps=0.935)
def flag_strings(spark, sf_dir):
    return _positions(spark, sf_dir, 0.935).select("contig", "pos", "call_flags", "cov_flags", "prop_flags")


@query("select contig, pos, pattern from position")
def pattern(spark, sf_dir):
    return _positions(spark, sf_dir).select("contig", "pos", "pattern")


@query("""
, lranked as (select contig, pos, k, call, usable, first_value(call) over (partition by contig, pos order by k) as ref from element),
lnum as (select *, min(case when usable and call <> ref then k end) over (partition by contig, pos, call) as fk2 from lranked),
ldig as (select *, dense_rank() over (partition by contig, pos order by case when usable and call <> ref then fk2 end nulls last) + 1 as d from lnum)
select contig, pos, string_agg(case when k = 0 then '1' when not usable then 'N' when call = ref then '1' else cast(d as varchar) end, '' order by k) as pattern from ldig group by contig, pos
""")
def legacy_pattern(spark, sf_dir):
    rows = _positions(spark, sf_dir)
    usable = F.zip_with("calls", "passed", lambda c, p: p & c.isin(*C.BASES))
    return rows.select("contig", "pos", C.legacy_pattern(F.concat(F.array("ref_call"), F.col("calls")), F.concat(F.array("ref_base"), usable)).alias("pattern"))


def _matrix_sql(kind: str) -> str:
    where, shown = matrices.KINDS[kind]
    return f"select contig, pos, ref_call, {shown} as calls, n_snp, n_ref, pattern from judged where {where}"


def _add_matrix(kind):
    def run(spark, sf_dir):
        return _matrix(_positions(spark, sf_dir), kind)

    run.__name__ = kind
    query(_matrix_sql(kind))(run)


for _kind in matrices.KINDS:
    _add_matrix(_kind)


@query("""
select contig || '::' || cast(pos as varchar) as LocusID, ref_call as Reference, substr(calls, 1, 1) as s0, substr(calls, 2, 1) as s1, substr(calls, 3, 1) as s2, substr(calls, 4, 1) as s3,
  n_snp as "#SNPcall", cast(0 as int) as "#Indelcall", n_ref as "#Refcall", cast(n_called as varchar) || '/4' as "#CallWasMade", cast(n_cov as varchar) || '/4' as "#PassedDepthFilter",
  cast(n_prop as varchar) || '/4' as "#PassedProportionFilter", n_a as "#A", n_c as "#C", n_g as "#G", n_t as "#T", cast(0 as int) as "#Indel", n_other as "#NXdegen", contig as "Contig", pos as "Position",
  case when in_dup then 'True' else 'False' end as "InDupRegion", case when consensus then 'True' else 'False' end as "SampleConsensus", call_flags as "CallWasMade_", cov_flags as "PassedDepthFilter_", prop_flags as "PassedProportionFilter_", pattern as "Pattern"
from judged where best_snp
""")
def matrix_wide(spark, sf_dir):
    out = matrices.wide(matrices.matrix(_positions(spark, sf_dir), "bestsnp"), IDS)
    # Apart from case and a number sign these names are others'; the comparison tells them apart by an underscore.
    return out.withColumnsRenamed({c: c + "_" for c in ("CallWasMade", "PassedDepthFilter", "PassedProportionFilter")})


# --- statistics

_CONTIG_SQL = "count(*) as reference_length, " + ", ".join(f"count(*) filter ({c}) as {n}" for n, c in stats.CONTIG.items())
_FLAGS_SQL = """
, f as (select contig, pos, sample_ord, nickname, called as was_called, cov in ('Y', '-') as passed_coverage_filter, pf in ('Y', '-') as passed_proportion_filter, sure as quality_breadth,
        sure and call = ref_call as called_reference, sure and base and call <> ref_call as called_snp, sure and not base as called_degen from shown where not in_dup)
"""
_SUMS = ", ".join(f"count(*) filter ({n}) as {n}" for n in stats.SAMPLE)


@query(f"select contig, {_CONTIG_SQL} from judged group by contig")
def contig_stats(spark, sf_dir):
    return stats.contig_stats(_positions(spark, sf_dir), total=False)


@query(f"select case when grouping(contig) = 1 then 'Whole Genome' else contig end as contig, {_CONTIG_SQL} from judged group by rollup (contig)")
def contig_rollup(spark, sf_dir):
    return stats.contig_stats(_positions(spark, sf_dir))


@query(f"""
, s as (select case when grouping(contig) = 1 then 'Whole Genome' else contig end as contig, {_CONTIG_SQL} from judged group by rollup (contig))
select contig, reference_length, quality_breadth, printf('%.2f%%', quality_breadth * 100.0 / reference_length) as "quality_breadth (%)", best_snps, printf('%.2f%%', best_snps * 100.0 / reference_length) as "best_snps (%)" from s
""")
def contig_percents(spark, sf_dir):
    out = stats.with_percents(stats.contig_stats(_positions(spark, sf_dir)))
    return out.select("contig", "reference_length", "quality_breadth", "quality_breadth (%)", "best_snps", "best_snps (%)")


@query(f"{_FLAGS_SQL} select sample_ord, {_SUMS} from f group by sample_ord")
def sample_stats(spark, sf_dir):
    return stats.sample_stats(_positions(spark, sf_dir))


def _scopes(by: str) -> str:
    each = ", ".join(f"bool_{k}({n}) as {s}_{n}" for n in stats.SAMPLE for k, s in (("or", "any"), ("and", "all")))
    sums = lambda s: ", ".join(f"count(*) filter ({s}_{n}) as {n}" for n in stats.SAMPLE)
    group = f"group by {by.rstrip(', ')}" if by else ""
    return f"{_FLAGS_SQL}, e as (select contig, pos, {by} {each} from f group by {by} contig, pos) select {by} 'any' as scope, {sums('any')} from e {group} union all select {by} 'all' as scope, {sums('all')} from e {group}"


@query(_scopes(""))
def sample_any_all(spark, sf_dir):
    return stats.any_all_stats(_positions(spark, sf_dir))


_PASSED_SQL = """, f as (select contig, pos, sample_ord, nickname, called as was_called, cov in ('Y', '-') as passed_coverage_filter, pf in ('Y', '-') as passed_proportion_filter,
  sure and not in_dup as quality_breadth, sure and call = ref_call and not in_dup as called_reference, sure and base and call <> ref_call and not in_dup as called_snp,
  sure and not base and not in_dup as called_degen from shown)"""


@query(f"{_PASSED_SQL} select sample_ord, {_SUMS} from f group by sample_ord")
def stats_passed(spark, sf_dir):
    return stats.sample_stats(_positions(spark, sf_dir), passed=True)


def _judged() -> str:
    whole = lambda n: f"bool_or({n}) and bool_and({n} or not quality_breadth)" if n.startswith("called_") else f"bool_and({n})"
    each = ", ".join(f"bool_or({n}) as any_{n}, {whole(n)} as all_{n}" for n in stats.SAMPLE)
    sums = lambda s: ", ".join(f"count(*) filter ({s}_{n}) as {n}" for n in stats.SAMPLE)
    return f"{_PASSED_SQL}, e as (select contig, pos, nickname, {each} from f group by nickname, contig, pos) select nickname, 'any' as scope, {sums('any')} from e group by nickname union all select nickname, 'all' as scope, {sums('all')} from e group by nickname"


@query(_judged())
def stats_judged(spark, sf_dir):
    nicks = spark.createDataFrame(list(enumerate(NICKS)), "sample_ord int, nickname string")
    return stats.any_all_stats(_positions(spark, sf_dir), nicks, passed=True, judged=True)


@query(_scopes("nickname, "))
def nickname_any_all(spark, sf_dir):
    nicks = spark.createDataFrame(list(enumerate(NICKS)), "sample_ord int, nickname string")
    return stats.any_all_stats(_positions(spark, sf_dir), nicks)


@query(f"""{_FLAGS_SQL}, s as (select sample_ord, {_SUMS} from f group by sample_ord),
t as (select sample_ord, was_called, greatest(was_called - passed_coverage_filter, 0) as failed_coverage, greatest(was_called - passed_proportion_filter, 0) as failed_proportion from s)
select *, printf('%.2f%%', case when was_called = 0 then 0.0 else failed_coverage * 100.0 / was_called end) as failed_coverage_percent, printf('%.2f%%', case when was_called = 0 then 0.0 else failed_proportion * 100.0 / was_called end) as failed_proportion_percent from t
""")
def failed_pct(spark, sf_dir):
    return stats.failed_stats(stats.sample_stats(_positions(spark, sf_dir)))


@query("""
, n as (select contig, pos, nickname, min(call) = max(call) and bool_and(passed) as ok from cell group by contig, pos, nickname)
select contig, pos, bool_and(ok) as consensus from n group by contig, pos
""")
def consensus_analyses(spark, sf_dir):
    nicks = spark.createDataFrame(list(enumerate(NICKS)), "sample_ord int, nickname string")
    return stats.analysis_consensus(_cells(_positions(spark, sf_dir)).join(F.broadcast(nicks), "sample_ord"))


@query("select contig, pos, count(*) filter (call in ('X')) as n_absent, bool_or(cov = '?') as unchecked from cell group by contig, pos", gaps=0.935)
def absent_cells(spark, sf_dir):
    rows = _cells(_positions(spark, sf_dir, 0.935))
    return rows.groupBy("contig", "pos").agg(F.count_if(F.col("call") == "X").alias("n_absent"), F.bool_or(F.col("cov") == "?").alias("unchecked"))


# --- repeated lines, reference checks, duplicated regions

_ORDER = "l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_shipdate, depth, prop"


def _keep(spark, sf_dir, keep):
    rows = bridge.lines(spark, sf_dir).withColumn("line", F.struct(*_ORDER.split(", ")))
    return positions.first_cells(rows, keep)


def _keep_sql(way: str) -> str:
    order = ", ".join(f"{c} {way}" for c in _ORDER.split(", "))
    return f"select r.contig, x.pos, sample_ord, sample_call as call, depth, prop from (select *, row_number() over (partition by pos, sample_ord order by {order}) as rn from lines) x join reference r on r.pos = x.pos where rn = 1"


@query(_keep_sql("asc"))
def keep_first(spark, sf_dir):
    return _keep(spark, sf_dir, "first")


@query(_keep_sql("desc"))
def keep_last(spark, sf_dir):
    return _keep(spark, sf_dir, "last")


@query("select r.contig, c.pos, c.sample_ord, c.sample_call as ref_call, r.ref_call as expected from cells c join reference r on r.pos = c.pos where sample_call <> r.ref_call")
def ref_mismatch(spark, sf_dir):
    rows = bridge.cells(spark, sf_dir).select("contig", "pos", "sample_ord", F.col("call").alias("ref_call"))
    return positions.check_reference(bridge.reference(spark, sf_dir), rows).select("contig", "pos", "sample_ord", "ref_call", "expected")


@query(f", i as ({bridge.INTERVALS.format(part='part where p_size <= 5')}) select r.contig, r.pos, exists (select 1 from i where i.contig = r.contig and r.pos between i.start_pos and i.end_pos) as marked from reference r")
def dup_mark(spark, sf_dir):
    part = _t(spark, sf_dir, "part").where("p_size <= 5")
    return intervals.marked(bridge.reference(spark, sf_dir), spark.sql(bridge.INTERVALS, part=part)).select("contig", "pos", "marked")


@query(f"""
, i as ({bridge.INTERVALS.format(part="part")}),
p as (select *, max(end_pos) over (partition by contig order by start_pos, end_pos rows between unbounded preceding and 1 preceding) as pe from i),
g as (select *, sum(case when pe is null or start_pos > pe then 1 else 0 end) over (partition by contig order by start_pos, end_pos rows between unbounded preceding and current row) as island from p)
select contig, min(start_pos) as start_pos, max(end_pos) as end_pos from g group by contig, island
""")
def range_merge(spark, sf_dir):
    return intervals.merged(bridge.intervals(spark, sf_dir))


_HITS = """select p_brand as ref_name, case when p_size % 3 = 0 then p_brand else 'Brand#1' end as query_name, p_partkey + 1 as ref_start, p_partkey + p_size as ref_end,
 case when p_size % 2 = 0 then p_partkey + 1 else p_partkey + 7 end as query_start, p_partkey + p_size + 3 as query_end from {part}"""


@query(f", h as ({_HITS.format(part='part')}) select ref_name, query_name, ref_start, ref_end, query_start, query_end from h where not (ref_name = query_name and (ref_start = query_start or ref_end = query_end))")
def self_hit_filter(spark, sf_dir):
    hits = spark.sql(_HITS, part=_t(spark, sf_dir, "part"))
    return hits.where(~C.is_self_hit("ref_name", "query_name", "ref_start", "ref_end", "query_start", "query_end"))


@query(f"""
, h as ({_HITS.format(part="part")}), k as (select * from h where not (ref_name = query_name and (ref_start = query_start or ref_end = query_end))),
i as (select ref_name as contig, ref_start as s, ref_end as e from k union all select query_name, query_start, query_end from k),
o as (select contig, least(s, e) as start_pos, greatest(s, e) as end_pos from i)
select r.contig, r.pos, case when exists (select 1 from o where o.contig = r.contig and r.pos between start_pos and end_pos) then '1' else '0' end as mask from reference r
""")
def duplicate_mask(spark, sf_dir):
    hits = spark.sql(_HITS, part=_t(spark, sf_dir, "part"))
    return intervals.mask(bridge.reference(spark, sf_dir), intervals.duplicated(hits))


@query(f"""
, i as ({bridge.INTERVALS.format(part="part where p_size <= 5")}),
m as (select r.contig, r.pos, exists (select 1 from i where i.contig = r.contig and r.pos between start_pos and end_pos) as d from reference r where ref_call <> 'G')
select r.contig, r.pos, coalesce(m.d, false) as in_dup from reference r left join m on m.contig = r.contig and m.pos = r.pos
""")
def reference_mask(spark, sf_dir):
    ref = bridge.reference(spark, sf_dir)
    part = _t(spark, sf_dir, "part").where("p_size <= 5")
    mask_ = intervals.mask(ref, spark.sql(bridge.INTERVALS, part=part)).join(ref.where("ref_call <> 'G'").select("contig", "pos"), ["contig", "pos"])
    return positions.mark_duplicates(ref, mask_).select("contig", "pos", "in_dup")


# --- scalar functions

_LETTERS = "upper(regexp_replace({x}, '[^A-Za-z]', '', 'g'))"


@query("select p_partkey, reverse(translate(upper(p_type), 'ABCDGHMNRSTUVWXY', 'TVGHCDKNYSAABWXR')) as rc from part", plain=True)
def revcomp(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", C.reverse_complement("p_type").alias("rc"))


@query("""
select p_partkey, case when b in ('A', 'C', 'G', 'T') then b else 'N' end as plain, case when b in ('A', 'C', 'G', 'T', 'X') then b else 'N' end as with_x
from (select p_partkey, replace(upper(substr(p_name, 2, 1)), 'U', 'T') as b from part)
""", plain=True)  # fmt: skip
def simple_call(spark, sf_dir):
    second = F.substring("p_name", 2, 5)
    return _t(spark, sf_dir, "part").select("p_partkey", C.simple_call(second).alias("plain"), C.simple_call(second, allow_x=True).alias("with_x"))


@query("""
, s as (select contig || '::' || cast(pos as varchar) as locus, ref_call from reference)
select locus, split_part(locus, '::', 1) as contig, cast(split_part(locus, '::', 2) as bigint) as pos from s
""")
def locus_split(spark, sf_dir):
    rows = bridge.reference(spark, sf_dir).select(C.locus_id("contig", "pos").alias("locus"))
    return rows.select("locus", C.locus_contig("locus").alias("contig"), C.locus_pos("locus").alias("pos"))


_RECORDS = """
select p_partkey as pos, case when p_size % 7 = 0 then 'GTT' else substr('ACGT', cast(p_partkey % 4 as int) + 1, 1) end as ref,
  case when p_size % 5 = 0 then '.' when p_size % 7 = 0 then 'TT' when p_size % 3 = 0 then substr('CATG', cast(p_partkey % 4 as int) + 1, 1) || ',' || substr('TGAC', cast(p_partkey % 4 as int) + 1, 1)
       else substr('CATG', cast(p_partkey % 4 as int) + 1, 1) end as alt,
  case p_size % 6 when 0 then './.' when 1 then '0/1' when 2 then '1/1' when 3 then '2' when 4 then '1|0' else '0' end as gt, p_size as dp, p_partkey % 50 as a0, p_partkey % 31 as a1, p_partkey % 13 as a2, p_size % 4 as kind
from {part}
"""
# Records as lines: kind 0 has AD as a list, 1 a single AD with RD, 2 DP4 in INFO, 3 AR.
_LINE = """
select 'c' as "CHROM", pos as "POS", ref as "REF", alt as "ALT",
  case kind when 0 then 'AN=1;DP=' || cast(dp as varchar(20)) || ';FOO' when 1 then 'ADP=' || cast(dp as varchar(20)) when 2 then 'DP4=' || cast(a0 as varchar(20)) || ',1,' || cast(a1 as varchar(20)) || ',2;DP=' || cast(dp as varchar(20)) else 'AR=0.25;XDP=3' end as "INFO",
  case kind when 0 then 'GT:AD:DP' when 1 then 'GT:AD:RD' when 2 then 'GT' else 'GT:GQ:DP' end as "FORMAT",
  case kind when 0 then gt || ':' || cast(a0 as varchar(20)) || ',' || cast(a1 as varchar(20)) || ',' || cast(a2 as varchar(20)) || ':' || cast(dp + 1 as varchar(20))
            when 1 then gt || ':' || cast(a1 as varchar(20)) || ':' || cast(a0 as varchar(20)) when 2 then gt else gt end as sample
from {r}
"""
_PARSED = f"""with r as ({_RECORDS.format(part="part")}),
g as (select *, case when gt like '.%' then null else cast(substr(gt, 1, 1) as int) end as k, substr(ref, 1, 1) as r0,
             case kind when 0 then dp + 1 when 1 then dp when 2 then dp else null end as depth from r),
c as (select *, case when alt = '.' then r0 when k is null then 'X' when k = 0 then r0 when length(ref) > 1 and substr(ref, 2) = split_part(alt, ',', k) then r0
                     when split_part(alt, ',', k) = '' then 'X' else substr(split_part(alt, ',', k), 1, 1) end as call from g),
s as (select *, call in ('A', 'C', 'G', 'T') and call <> r0 as snp from c)
"""


def _records(spark, sf_dir):
    return spark.sql(_LINE.replace('"CHROM"', "CHROM").replace('"POS"', "POS").replace('"REF"', "REF").replace('"ALT"', "ALT").replace('"INFO"', "INFO").replace('"FORMAT"', "FORMAT"), r=spark.sql(_RECORDS, part=_t(spark, sf_dir, "part")))


@query(_PARSED + "select pos, call from s", plain=True)
def vcf_call(spark, sf_dir):
    return V.cells(_records(spark, sf_dir)).select("pos", "call")


@query(_PARSED + "select pos, cast(depth as double) as depth from s", plain=True)
def vcf_depth(spark, sf_dir):
    return V.cells(_records(spark, sf_dir)).select("pos", "depth")


@query(_PARSED + """select pos, round(case kind
  when 0 then case coalesce(k, 0) when 0 then a0 when 1 then a1 else a2 end / cast(nullif(depth, 0) as double)
  when 1 then case when snp then a1 else a0 end / cast(nullif(depth, 0) as double)
  when 2 then case when snp then a1 + 2 else a0 + 1 end / cast(nullif(depth, 0) as double)
  else case when snp then 0.25 else 0.75 end end, 9) as prop from s""", plain=True)  # fmt: skip
def vcf_proportion(spark, sf_dir):
    return V.cells(_records(spark, sf_dir)).select("pos", F.round("prop", 9).alias("prop"))


def _one_kind(kind: int, sql: str):
    def run(spark, sf_dir):
        rows = _records(spark, sf_dir).withColumn("i_", V.info_map("INFO")).withColumn("s_", V.sample_map("FORMAT", "sample"))
        call = V.call("REF", "ALT", F.coalesce(F.col("s_")["GT"], F.lit("0")))
        rows = rows.withColumn("d_", V.depth(F.col("i_"), F.col("s_"))).withColumn("snp_", call.isin(*C.BASES) & (call != F.substring("REF", 1, 1)))
        i, s, snp = F.col("i_"), F.col("s_"), F.col("snp_")
        value = {0: V.proportion_by_alleles(s, "d_", snp), 2: V.proportion_by_strands(i, "d_", snp), 3: V.proportion_by_ratio(i, s, snp)}[kind]
        return rows.select("POS", F.round(value, 9).alias("prop")).withColumnRenamed("POS", "pos")

    run.__name__ = {0: "vcf_prop_ad", 2: "vcf_prop_dp4", 3: "vcf_prop_ar"}[kind]
    query(_PARSED + f"select pos, round({sql}, 9) as prop from s", plain=True)(run)


_one_kind(0, "case kind when 0 then case coalesce(k, 0) when 0 then a0 when 1 then a1 else a2 end / cast(nullif(depth, 0) as double) when 1 then case when snp then a1 else a0 end / cast(nullif(depth, 0) as double) end")
_one_kind(2, "case kind when 2 then case when snp then a1 + 2 else a0 + 1 end / cast(nullif(depth, 0) as double) end")
_one_kind(3, "case kind when 3 then case when snp then 0.25 else 0.75 end end")

# --- exports

_ALTS = """
, firsts as (select c.contig, c.pos, call, min(sample_ord) as k from cell c where passed and base and call <> ref_call group by c.contig, c.pos, call),
numbered as (select *, row_number() over (partition by contig, pos order by k) as n from firsts),
alts as (select contig, pos, string_agg(call, ',' order by k) as alt, count(*) as n_alt from firsts group by contig, pos)
"""


@query(f"{_ALTS} select j.contig, j.pos, coalesce(alt, '.') as alt from judged j left join alts a on a.contig = j.contig and a.pos = j.pos where any_snp")
def alt_list(spark, sf_dir):
    return exports.vcf_rows(_positions(spark, sf_dir).where("any_snp"), IDS).select(F.col("#CHROM").alias("contig"), F.col("POS").alias("pos"), F.col("ALT").alias("alt"))


@query(f"""{_ALTS}, field as (
  select c.contig, c.pos, sample_ord, case when not (passed and base) then '.' when c.call = ref_call then '0' else cast(n as varchar) end || ':' ||
         case when not called then 'NoCall' when cov not in ('Y', '-') then 'CovFail' when pf not in ('Y', '-') then 'PropFail' else 'PASS' end as v
  from cell c left join numbered x on x.contig = c.contig and x.pos = c.pos and x.call = c.call),
w as (select contig, pos, max(case when sample_ord = 0 then v end) as s0, max(case when sample_ord = 1 then v end) as s1, max(case when sample_ord = 2 then v end) as s2, max(case when sample_ord = 3 then v end) as s3 from field group by contig, pos)
select j.contig as "#CHROM", j.pos as "POS", '.' as "ID", ref_call as "REF", coalesce(alt, '.') as "ALT", '.' as "QUAL", 'PASS' as "FILTER",
  'AN=' || cast(coalesce(n_alt, 0) + 1 as varchar) || ';NS=' || cast(n_snp + n_ref as varchar) as "INFO", 'GT:FT' as "FORMAT", s0, s1, s2, s3
from judged j join w on w.contig = j.contig and w.pos = j.pos left join alts a on a.contig = j.contig and a.pos = j.pos where any_snp
""")
def vcf_rows(spark, sf_dir):
    return exports.vcf_rows(_positions(spark, sf_dir).where("any_snp"), IDS)


@query("""
, e as (select k, j.contig_ord, j.pos, case when k = 0 then j.ref_call else substr(j.calls, k, 1) end as c from judged j cross join (select unnest(range(0, 5)) as k) where best_snp)
select cast(k as int) as ord, case k when 0 then 'Reference' else 's' || cast(k - 1 as varchar) end as name, string_agg(c, '' order by contig_ord, pos) as seq from e group by k
""")
def fasta_rows(spark, sf_dir):
    return exports.sample_sequences(_positions(spark, sf_dir).where("best_snp"), IDS)


@query(f"""
, d as (select doc_id, {_LETTERS.format(x="text")} as seq from documents)
select doc_id, cast(i as bigint) as pos, substr(seq, i, 1) as call from (select doc_id, seq, unnest(range(1, length(seq) + 1)) as i from d)
""")
def fasta_explode(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select("doc_id", F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("seq"))
    return exports.exploded(rows, name="doc_id").withColumnRenamed("contig", "doc_id")


@query("""
, c as (select contig, string_agg(ref_call, '' order by pos) as seq from reference group by contig),
l as (select contig, i, substr(seq, i * 80 + 1, 80) as line from (select contig, seq, unnest(range(0, (length(seq) + 79) // 80)) as i from c))
select contig, string_agg(line, chr(10) order by i) as seq from l group by contig
""")
def fasta_wrap(spark, sf_dir):
    rows = exports.packed(bridge.reference(spark, sf_dir), call="ref_call")
    return rows.select("contig", exports.wrapped("seq").alias("seq"))


@query("select contig, count(*) as length from reference group by contig")
def contig_lengths(spark, sf_dir):
    return bridge.reference(spark, sf_dir).groupBy("contig").agg(F.count("*").alias("length"))


# --- aligned assemblies

_ALIGN = """
select p_partkey as record_ord, cast(0 as int) as alignment_ord, 'r' as ref_name, 'q' as query_name, p_partkey * 100 + 1 as ref_start, p_partkey * 100 + 10 + (p_size % 5) as ref_end,
  case when p_size % 2 = 0 then cast(1 as bigint) else cast(60 as bigint) end as query_start, case when p_size % 2 = 0 then cast(60 as bigint) else cast(1 as bigint) end as query_end,
  cast(p_size % 4 + 1 as bigint) as d1, cast(-(p_size % 3 + 1) as bigint) as d2 from {part}
"""


@query(f"""with a as ({_ALIGN.format(part="part")}),
t as (select *, 0 as k, d1 as d from a union all select *, 1, d2 from a union all select *, 2, 0 from a),
s as (select *, case when d = 0 then 0 else abs(d) - 1 end as c, case when query_end >= query_start then 1 else -1 end as step from t),
w as (select *, ref_start + coalesce(sum(c + case when d > 0 then 1 else 0 end) over p, 0) as ref_from, query_start + step * coalesce(sum(c + case when d < 0 then 1 else 0 end) over p, 0) as query_from
      from s window p as (partition by record_ord order by k rows between unbounded preceding and 1 preceding))
select record_ord, cast(ref_from as bigint) as ref_from, cast(query_from as bigint) as query_from, cast(step as int) as step, cast(case when d = 0 then ref_end - ref_from + 1 else c end as bigint) as length, d > 0 as deleted from w
""", plain=True)  # fmt: skip
def delta_walk(spark, sf_dir):
    rows = spark.sql(_ALIGN, part=_t(spark, sf_dir, "part")).withColumn("distances", F.array("d1", "d2", F.lit(0).cast("long")))
    out = franken.segments(rows)
    return out.select("record_ord", "ref_from", "query_from", "step", "length", "deleted")


@query("""
, s as (select pos, sample_call as call from cells), c as (select pos, min(case when call <> 'X' then call end) as a, max(case when call <> 'X' then call end) as b from s group by pos)
select r.contig, r.pos, case when a is null then 'X' when a = b then a else 'N' end as call from reference r join c on c.pos = r.pos
""")
def overlap_merge(spark, sf_dir):
    return franken.overlapped(bridge.cells(spark, sf_dir).select("contig", "pos", "call"))


# --- filters over matrices


def _all_calls(spark, sf_dir):
    return _positions(spark, sf_dir).select("contig", "contig_ord", "pos", "ref_call", "calls", "any_snp", "best_snp")


def _coords(spark, sf_dir):
    return _t(spark, sf_dir, "part").where("p_size <= 5").select(F.col("p_brand").alias("contig"), F.col("p_partkey").alias("pos"))


_SHOW = lambda df: df.select("contig", "pos", F.array_join("calls", "").alias("calls"))


@query("select contig, pos, calls from judged where any_snp and pos in (select p_partkey from part where p_size <= 5)")
def coord_keep(spark, sf_dir):
    return _SHOW(filters.keep_coordinates(_all_calls(spark, sf_dir).where("any_snp"), _coords(spark, sf_dir)))


@query("select contig, pos, calls from judged where any_snp and pos not in (select p_partkey from part where p_size <= 5)")
def coord_remove(spark, sf_dir):
    return _SHOW(filters.remove_coordinates(_all_calls(spark, sf_dir).where("any_snp"), _coords(spark, sf_dir)))


@query("select contig, pos, substr(calls, 1, 1) || substr(calls, 3, 2) as calls from judged where any_snp")
def genome_drop(spark, sf_dir):
    return _SHOW(filters.choose_samples(_all_calls(spark, sf_dir).where("any_snp"), IDS, ["s1"], "remove")[0])


@query("select contig, pos, calls from judged where length(regexp_replace(ref_call || calls, '[^ACGT]', '', 'g')) >= 0.9 * 5")
def complete_filter(spark, sf_dir):
    return _SHOW(filters.complete(_all_calls(spark, sf_dir), 0.9))


@query("select contig, pos, calls from judged where not regexp_matches(ref_call || calls, '[XN-]')", gaps=0.935)
def no_missing(spark, sf_dir):
    return _SHOW(filters.without_missing(_positions(spark, sf_dir, 0.935).select("contig", "pos", "ref_call", "calls")))


_STATES = ", st as (select contig, pos, call, count(*) as n from element where call in ('A', 'C', 'G', 'T') group by contig, pos, call)"


@query(f"{_STATES} select j.contig, j.pos, calls from judged j join (select contig, pos from st where n > 1 group by contig, pos having count(*) > 1) x on x.contig = j.contig and x.pos = j.pos")
def parsimony(spark, sf_dir):
    return _SHOW(filters.informative(_all_calls(spark, sf_dir)))


@query(f"{_STATES} select e.contig, e.pos, cast(k - 1 as int) as sample_ord, e.call from element e join st on st.contig = e.contig and st.pos = e.pos and st.call = e.call and n = 1 where k > 0")
def singleton(spark, sf_dir):
    return filters.singles(_all_calls(spark, sf_dir))


@query("select contig, pos, call, count(*) as n from cell group by contig, pos, call")
def state_counts(spark, sf_dir):
    return filters.states(_all_calls(spark, sf_dir))


@query("select contig, pos, regexp_replace(calls, '[^ACGT]', '-', 'g') as calls from judged where any_snp", gaps=0.935)
def dash_missing(spark, sf_dir):
    return _SHOW(filters.dashed(_positions(spark, sf_dir, 0.935).where("any_snp").select("contig", "pos", "ref_call", "calls")))


@query("""
, len as (select contig, max(pos) as length from reference group by contig),
c as (select p.contig, p.pos from (select contig, pos from judged where any_snp) p join len on len.contig = p.contig where pos >= 50 and pos <= length - 50),
walk as (select contig, min(pos) as pos from c group by contig union all
         select w.contig, (select min(c.pos) from c where c.contig = w.contig and c.pos >= w.pos + 100) as pos from walk w where w.pos is not null)
select contig, pos from walk where pos is not null
""")
def thin_distance(spark, sf_dir):
    rows = _all_calls(spark, sf_dir).where("any_snp")
    lengths = bridge.reference(spark, sf_dir).groupBy("contig").agg(F.max("pos").alias("length"))
    return filters.thinned(rows, lengths, 100).select("contig", "pos")


@query("select contig, pos, calls, pattern, n_snp, n_ref, n_called, call_flags, cov_flags, prop_flags, consensus and substr(calls, 1, 1) = substr(calls, 3, 1) as consensus from judged")
def merge_matrices(spark, sf_dir):
    cells, ref = bridge.cells(spark, sf_dir), bridge.reference(spark, sf_dir)
    half = lambda a: positions.positions(ref, cells.where(F.col("sample_ord").between(a, a + 1)).withColumn("sample_ord", F.col("sample_ord") - a), [False, False])
    out = merge.merged(half(0), half(2))
    return out.select("contig", "pos", F.array_join("calls", "").alias("calls"), "pattern", "n_snp", "n_ref", "n_called", "call_flags", "cov_flags", "prop_flags", "consensus")


@query("""
, f as (select pattern, min(cast(contig_ord as bigint) * 1000000000 + pos) as k from judged where any_snp group by pattern), n as (select pattern, row_number() over (order by k) as pattern_id from f)
select contig, pos, pattern, pattern_id from judged join n using (pattern) where any_snp
""")
def pattern_id(spark, sf_dir):
    return positions.with_pattern_ids(_positions(spark, sf_dir).where("any_snp"), ("contig_ord", "pos")).select("contig", "pos", "pattern", "pattern_id")


@query("select contig, pos, sample_ord, call from cell where exists (select 1 from judged j where j.contig = cell.contig and j.pos = cell.pos and best_snp)")
def transpose(spark, sf_dir):
    return matrices.long(_positions(spark, sf_dir).where("best_snp")).select("contig", "pos", "sample_ord", "call")


def _groups(spark):
    return spark.createDataFrame([(0, 1), (1, 2), (2, 1), (3, 2)], "sample_ord int, phenotype int")


@query("""
select sample_ord, cast(case when sample_ord % 2 = 0 then 1 else 2 end as int) as phenotype,
  string_agg(case when call = c.ref_call then 'A' || chr(9) || 'A' when call in ('X', 'N', '-') then '0' || chr(9) || '0' else 'C' || chr(9) || 'C' end, chr(9) order by c.contig_ord, c.pos) as genotypes
from cell c join judged j on j.contig = c.contig and j.pos = c.pos and best_snp group by sample_ord
""")
def ped(spark, sf_dir):
    return association.pedigree(_positions(spark, sf_dir).where("best_snp"), _groups(spark))


@query(", n as (select contig, cast(row_number() over (order by min(contig_ord)) as int) as number from judged where best_snp group by contig) select number, j.contig || '::' || cast(pos as varchar) as locus, pos from judged j join n on n.contig = j.contig where best_snp")
def map(spark, sf_dir):  # noqa: A001
    rows = _positions(spark, sf_dir).where("best_snp")
    return association.pedigree_map(rows, filters.contig_numbers(rows))


@query("""
, g as (select c.contig, c.pos, count(*) filter (sample_ord % 2 = 1 and call <> ref_call) as a1, count(*) filter (sample_ord % 2 = 1 and call = ref_call) as u1,
        count(*) filter (sample_ord % 2 = 0 and call <> ref_call) as a2, count(*) filter (sample_ord % 2 = 0 and call = ref_call) as u2 from cell c where call not in ('X', 'N', '-') group by c.contig, c.pos)
select contig, pos, a1, u1, a2, u2, round((a1 + u1 + a2 + u2) * 2.0 * power(4.0 * a1 * u2 - 4.0 * u1 * a2, 2) / nullif(16.0 * (a1 + u1) * (a2 + u2) * (a1 + a2) * (u1 + u2), 0), 6) as chi2 from g
""")
def assoc(spark, sf_dir):
    out = association.chi_squared(association.allele_counts(_all_calls(spark, sf_dir), _groups(spark)))
    return out.withColumn("chi2", F.round("chi2", 6))


@query()
def assoc_permutations(spark, sf_dir):
    """The rounds are dealt by Spark's hash, which the other engine lacks; tested against a loop."""
    return association.permutation_test(_all_calls(spark, sf_dir).where("any_snp"), _groups(spark), alpha=0.1)


@query("""
, a as (select contig, pos, case when pos % 2 = 0 then 'x|missense|y|g' || cast(pos as varchar) || '|p' else 'x|syn' end as info from reference where ref_call <> 'T')
select j.contig, j.pos, coalesce(nullif(split_part(info, '|', 2), ''), 'N/A') as kind, coalesce(nullif(split_part(info, '|', 4), ''), 'N/A') as locus, coalesce(nullif(split_part(info, '|', 5), ''), 'N/A') as protein
from judged j left join a on a.contig = j.contig and a.pos = j.pos where any_snp
""")
def annotate_join(spark, sf_dir):
    info = F.when(F.col("pos") % 2 == 0, F.concat(F.lit("x|missense|y|g"), F.col("pos").cast("string"), F.lit("|p"))).otherwise("x|syn")
    notes = bridge.reference(spark, sf_dir).where("ref_call <> 'T'").select("contig", "pos", info.alias("info"))
    return filters.annotated(_all_calls(spark, sf_dir).where("any_snp"), notes).select("contig", "pos", "kind", "locus", "protein")


@query("select r.contig, pos, n_name as other from reference r left join nation on n_nationkey = contig_ord")
def contig_rename(spark, sf_dir):
    names = _t(spark, sf_dir, "nation").select(F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("contig"), F.col("n_name").alias("other"))
    return filters.renamed(bridge.reference(spark, sf_dir), names).select("contig", "pos", "other")


_FILES = "select '/data/' || s_name || '.vcf' as path, s_name as name, cast(1 as int) as priority from supplier where s_nationkey < 12 union all select '/data/' || s_name || '.vcf', 'given ' || s_name, cast(0 as int) from supplier where s_nationkey > 8"


@query(f"with f as ({_FILES}) select path, name, priority from (select *, row_number() over (partition by path order by priority) as k from f) x where k = 1", plain=True)
def union_dedup(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier").withColumn("path", F.concat(F.lit("/data/"), "s_name", F.lit(".vcf")))
    one = s.where("s_nationkey < 12").select("path", F.col("s_name").alias("name"), F.lit(1).alias("priority"))
    two = s.where("s_nationkey > 8").select("path", F.concat(F.lit("given "), "s_name").alias("name"), F.lit(0).alias("priority"))
    return merge.merged_files(one.union(two))


@query("select 'Customer ' || c_mktsegment as identifier, count(*) as n from customer group by all having count(*) > 1", plain=True)
def dup_samples(spark, sf_dir):
    return merge.repeated_samples(_t(spark, sf_dir, "customer").select(F.concat(F.lit("Customer "), "c_mktsegment").alias("identifier")))


_READS = "select s_name || '_R1_001.fastq.gz' as path from {supplier} where s_acctbal > 0 union all select s_name || '_R2_001.fastq.gz' from {supplier} where s_nationkey <> 3"


@query(f"with f as ({_READS.format(supplier='supplier')}) select split_part(a.path, '_R1_', 1) as sample, a.path as read1, b.path as read2 from f a join f b on b.path = replace(a.path, '_R1_', '_R2_') where contains(a.path, '_R1_')", plain=True)
def read_pairs(spark, sf_dir):
    return discover.read_pairs(spark.sql(_READS, supplier=_t(spark, sf_dir, "supplier")))


_PATHS = "select '/x/' || replace(p_name, ' ', '_') || case p_size % 5 when 0 then '-bowtie2-gatk.vcf' when 1 then '-bwamem-varscan.vcf' when 2 then '.vcf' when 3 then '.frankenfasta' else '.txt' end as path, p_size % 5 as k, replace(p_name, ' ', '_') as n, p_partkey from {part}"


@query(f"""with p as ({_PATHS.format(part="part")})
select p_partkey, case k when 0 then n || '-bowtie2-gatk' when 1 then n || '-bwamem-varscan' when 2 then n when 3 then n else '' end as name,
  case k when 0 then 'Bowtie2' when 1 then 'BWA-mem' when 2 then 'pre-aligned' when 3 then 'nucmer' else '' end as aligner, case k when 0 then 'GATK' when 1 then 'VarScan' when 2 then 'pre-called' else '' end as snpcaller from p
""", plain=True)  # fmt: skip
def sample_identity(spark, sf_dir):
    return spark.sql(_PATHS, part=_t(spark, sf_dir, "part")).select("p_partkey", C.sample_identity("path").alias("i")).select("p_partkey", "i.*")


@query("select row_number() over (order by n_name) - 1 as sample_ord, n_name as identifier from nation", plain=True)
def sample_order(spark, sf_dir):
    return samples.ordered(_t(spark, sf_dir, "nation").select(F.col("n_name").alias("identifier"))).select("sample_ord", "identifier")


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict:
    return dict(_SQL)
