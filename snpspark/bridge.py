"""The operators' inputs, derived from the general tables of the driver by SQL that two engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Samples of the bridge: identifier, nickname and whether it is an assembly.
SAMPLES = [("s0", "a", False), ("s1", "a", False), ("s2", "b", False), ("s3", "b", False)]
N = len(SAMPLES)

REFERENCE = """
select p_brand as contig, cast(substr(p_brand, 7) as int) as contig_ord, p_partkey as pos,
       substr('ACGTACGTACGTACGTACGN', cast(p_partkey % 20 as int) + 1, 1) as ref_call, (p_size % 10 = 0) as in_dup
from {part}
"""

# All lines, in file order, before the first of repeated positions is chosen.
LINES = """
select l_partkey as pos, cast(l_suppkey % 4 as int) as sample_ord, l_quantity as depth, 1 - l_discount as prop,
       case when k < 80 then substr('ACGTACGTACGTACGTACGN', cast(l_partkey % 20 as int) + 1, 1)
            when k < 96 then substr('ACGT', cast(k % 4 as int) + 1, 1) when k < 98 then 'R' else 'N' end as sample_call,
       l_orderkey, l_linenumber, l_extendedprice, l_suppkey, l_shipdate
from (select *, (l_orderkey * 7 + l_linenumber * 13 + l_suppkey) % 100 as k from {lineitem}) q
"""

CELLS = """
select pos, sample_ord, sample_call, depth, prop
from (select *, row_number() over (partition by pos, sample_ord
             order by depth desc, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_shipdate) as rn from ({lines}) x) y
where rn = 1
"""

INTERVALS = "select p_brand as contig, p_partkey as start_pos, p_partkey + p_size as end_pos from {part}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REFERENCE, part=_table(spark, sf_dir, "part"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """contig, pos, sample_ord, call, depth, prop and the order of the lines."""
    rows = spark.sql(LINES, lineitem=_table(spark, sf_dir, "lineitem"))
    return rows.join(reference(spark, sf_dir).select("contig", "pos"), "pos").withColumnRenamed("sample_call", "call")


def cells(spark: SparkSession, sf_dir: str, least: float = 0) -> DataFrame:
    """contig, pos, sample_ord, call, depth, prop; without cells of a proportion below `least`, to leave gaps."""
    rows = spark.sql(LINES, lineitem=_table(spark, sf_dir, "lineitem"))
    rows = spark.sql(CELLS.replace("({lines}) x", "{lines}"), lines=rows)
    rows = rows.where(F.col("prop") >= least) if least else rows
    return rows.join(reference(spark, sf_dir).select("contig", "pos"), "pos").withColumnRenamed("sample_call", "call")


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(INTERVALS, part=_table(spark, sf_dir, "part"))


def ctes(least: float = 0) -> str:
    """The same inputs for the comparison: CTEs reference, lines, cells, dense (all cells), flagged and position.

    They follow the definition cell by cell: positions x samples, a row for each, and window functions over them.
    """
    gap = f"where prop >= {least}" if least else ""
    return f"""
reference as ({REFERENCE.format(part="part")}),
lines as ({LINES.format(lineitem="lineitem")}),
cells as (select * from ({CELLS.format(lines="select * from lines")}) c {gap}),
sample as (select * from (values (0, 's0', 'a'), (1, 's1', 'a'), (2, 's2', 'b'), (3, 's3', 'b')) s(sample_ord, identifier, nickname)),
dense as (select r.contig, r.contig_ord, r.pos, r.ref_call, r.in_dup, s.sample_ord, s.nickname, coalesce(c.sample_call, 'X') as call, c.depth, c.prop
          from reference r cross join sample s left join cells c on c.pos = r.pos and c.sample_ord = s.sample_ord),
flagged as (select *, case when call = 'X' then '?' when depth is null then '-' when depth >= 10 then 'Y' else 'N' end as cov,
                   case when call = 'X' then '?' when prop is null then '-' when prop >= 0.915 then 'Y' else 'N' end as pf,
                   ref_call in ('A', 'C', 'G', 'T') as ref_base, call in ('A', 'C', 'G', 'T') as base, call not in ('X', 'N') as called from dense),
cell as (select *, cov in ('Y', '-') and pf in ('Y', '-') as passed from flagged),
shown as (select *, case when not called or (passed and base) then call else 'N' end as masked, called and passed and ref_base as sure from cell),
element as (select contig, pos, sample_ord + 1 as k, call, passed and base as usable from cell
            union all select contig, pos, 0, ref_call, ref_call in ('A', 'C', 'G', 'T') from reference),
seen as (select *, min(case when usable then k end) over (partition by contig, pos, call, usable) as fk from element),
ranked as (select *, case when usable then dense_rank() over (partition by contig, pos order by case when usable then fk end nulls last) else 0 end as digit from seen),
patterned as (select contig, pos, string_agg(cast(digit as varchar), '' order by k) as pattern from ranked group by contig, pos),
position as (
  select c.contig, c.contig_ord, c.pos, c.ref_call, c.in_dup, any_value(pattern) as pattern, bool_and(ref_base) as ref_base,
         string_agg(call, '' order by sample_ord) as calls, string_agg(masked, '' order by sample_ord) as masked,
         string_agg(case when called then 'Y' else 'N' end, '' order by sample_ord) as call_flags,
         string_agg(cov, '' order by sample_ord) as cov_flags, string_agg(pf, '' order by sample_ord) as prop_flags,
         count(*) filter (sure and base and call <> c.ref_call) as n_snp, count(*) filter (sure and call = c.ref_call) as n_ref, count(*) filter (sure and not base) as n_degen,
         count(*) filter (called) as n_called, count(*) filter (cov in ('Y', '-')) as n_cov, count(*) filter (pf in ('Y', '-')) as n_prop,
         count(*) filter (call = 'A') as n_a, count(*) filter (call = 'C') as n_c, count(*) filter (call = 'G') as n_g, count(*) filter (call = 'T') as n_t, count(*) filter (not base) as n_other,
         bool_and(passed and base) as consensus
  from shown c join patterned p on p.contig = c.contig and p.pos = c.pos group by c.contig, c.contig_ord, c.pos, c.ref_call, c.in_dup),
judged as (select *, n_called = 4 as all_called, n_cov = 4 as all_cov, n_prop = 4 as all_prop, consensus and ref_base and not in_dup as quality,
                  n_snp > 0 and not in_dup as any_snp, consensus and ref_base and not in_dup and n_snp > 0 as best_snp from position)
"""
