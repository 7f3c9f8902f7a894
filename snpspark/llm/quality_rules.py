"""Rule failures of each document, and verdicts on whole hosts from shrunken failure rates.

Each document is measured by itself (numpy over Arrow batches) and fails if it is too short or too repetitive. The
failures are summed by host; the hosts' rates give a beta prior by the method of moments, towards which each host's
rate is shrunk (a host with few documents says little about itself), and a host whose shrunken rate is above
`max_host_rate` is rejected with all its documents.

Edge cases: a null or empty text has no words, so it fails. Null hosts form one host. Each input row gives one output
row, repeated rows too. Columns other than the three named ones are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import stored, table

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
MAX_BROADCAST_HOSTS = 100_000
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _measured(batches, window: int):
    symbol = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))
    newline = np.zeros(256, bool)
    newline[10] = True
    for batch in batches:
        for lo, hi, data, offs in K.slices(batch):
            starts, ends, first = K.words(data, offs)
            counts = np.diff(first)

            def by_row(flags):
                return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offs])

            heads = ((data & 0xC0) != 0x80) & ~K.SPACE[data]
            # Lines are words of another kind: runs between newlines. Lines of no word can't be repeated lines.
            at, end, line = K.words(data, offs, newline)
            inked = np.concatenate([[0], np.cumsum(~K.SPACE[data])])
            with_word = inked[end] > inked[at]
            row = K.row_of(line)[with_word]
            key = K.mix(K.span_hashes(data, at[with_word], end[with_word]) + row.astype(np.uint64) * K.U(0x9E3779B97F4A7C15))
            _, kept = np.unique(key, return_index=True)
            dup_lines = np.bincount(row, minlength=hi - lo) - np.bincount(row[kept], minlength=hi - lo)
            h = K.window_hashes(K.span_hashes(data, starts, ends), window)
            ok = K.whole_windows(first, window)[: len(h)]
            at = np.flatnonzero(ok)
            rows = K.row_of(first)
            twice = at[K.repeated(rows[at], h[at])]
            repeat = np.bincount(rows[K.covered(twice, window, len(starts))], minlength=hi - lo)
            out = [counts, by_row(heads), by_row(symbol[data]), dup_lines, repeat]
            keep = [batch.column(i).slice(lo, hi - lo) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*keep, *(pa.array(x, pa.int64()) for x in out)], names=["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])


def rule_failures(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source", *, window=5, min_words=10, max_repeat_percent=20) -> DataFrame:
    """doc_id, host, the five measures and base_failed, a row for each row of `docs`."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(lambda b: _measured(b, window), f"doc_id {kind}, host string, {MEASURES}")
    return out.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))


def host_verdicts(failures: DataFrame, *, max_host_rate=0.5, max_strength=1e6) -> tuple[DataFrame, int]:
    """host, host_docs, host_failed, host_rate (shrunken) and host_rejected, and the number of hosts.

    The prior's mean is the share of failed documents; its strength comes from how much the hosts' own rates vary
    beyond what their sizes explain. Where they don't vary, all hosts get the common rate.
    """
    hosts = failures.groupBy("host").agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    # One row of sums is all that reaches the driver.
    s = hosts.agg(F.count("*").alias("hosts"), F.sum("host_docs").alias("docs"), F.sum("host_failed").alias("failed"), F.sum(F.col("host_docs") * rate * rate).alias("squares"), F.sum(1 / F.col("host_docs")).alias("inverse")).first()
    if not s["docs"]:
        return hosts.withColumns({"host_rate": F.lit(0.0), "host_rejected": F.lit(False)}), 0
    mean = s["failed"] / s["docs"]
    spread = s["squares"] / s["docs"] - mean * mean - mean * (1 - mean) * s["hosts"] / s["docs"]
    strength = min(max(mean * (1 - mean) / spread - 1, 1.0), max_strength) if spread > 0 else max_strength
    shrunk = (F.col("host_failed") + mean * strength) / (F.col("host_docs") + strength)
    return hosts.withColumn("host_rate", shrunk).withColumn("host_rejected", F.col("host_rate") > max_host_rate), s["hosts"]


def quality_rules(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source", *, max_host_rate=0.5, **rules) -> DataFrame:
    """The measures of each document, base_failed, its host's counts and rate, and kept."""
    failures = stored(rule_failures(docs, id_col, text_col, host_col, **rules))
    hosts, n = host_verdicts(failures, max_host_rate=max_host_rate)
    hosts = hosts.withColumnRenamed("host", "host_")
    # Beyond the bound Spark joins by shuffle and splits the partitions of hot hosts.
    hosts = F.broadcast(hosts) if n <= MAX_BROADCAST_HOSTS else hosts
    return failures.join(hosts, F.col("host").eqNullSafe(F.col("host_")), "left").drop("host_").withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_docs", "host_failed")


SQL = r"""
with d as (select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
word as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from d),
line as (select doc_id, unnest(string_split(text, chr(10))) as line from d),
dup as (select doc_id, count(*) - count(distinct line) as n from line where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
wins as (select doc_id, pos, array_to_string(list(word) over (partition by doc_id order by pos rows between current row and 4 following), ' ') as passage,
               count(*) over (partition by doc_id order by pos rows between current row and 4 following) as k from word),
twice as (select doc_id, pos from (select doc_id, pos, count(*) over (partition by doc_id, passage) as c from wins where k = 5) where c > 1),
rep as (select doc_id, count(*) as n from (select distinct doc_id, unnest(range(pos, pos + 5)) as pos from twice) group by doc_id),
m as (select d.doc_id, source, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
             cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
             cast(coalesce(dup.n, 0) as bigint) as n_dup_lines, cast(coalesce(rep.n, 0) as bigint) as n_repeat_words
      from d left join dup using (doc_id) left join rep using (doc_id)),
f as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m),
h as (select source, count(*) as host_docs, count(*) filter (base_failed) as host_failed from f group by source),
s as (select sum(host_failed) / sum(host_docs) as mean, count(*) / sum(host_docs) as hosts, sum(host_failed * host_failed / host_docs) / sum(host_docs) as squares from h),
t as (select mean, squares - mean * mean - mean * (1 - mean) * hosts as spread from s),
p as (select mean, case when spread > 0 then least(greatest(mean * (1 - mean) / spread - 1, 1), 1e6) else 1e6 end as strength from t)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not ((host_failed + mean * strength) / (host_docs + strength) > 0.5) as kept,
       cast(host_docs as bigint) as host_docs, cast(host_failed as bigint) as host_failed
from f join h on f.source is not distinct from h.source cross join p
"""
