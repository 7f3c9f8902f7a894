"""Exact search of benchmark passages in documents, as a prefix-filtered join of shingles of words.

A benchmark item's windows are its runs of `size` words (an item of fewer words is one window). A document holds a
window only if it holds all shingles of `shingle` words in it (a shorter window is one shingle), so of a window's
shingles, ordered by how rare they are in the documents, the join needs the first alone: that is the prefix which full
containment leaves. A document's shingles meet the prefixes by their hash. A meeting gives the only place where the
window can lie; it must lie within the document (the bounds by length and position), and then the words there are
compared with the window's, all of them.

The hashes of the prefixes are the broadcast side, at most `block` of them at once; a larger benchmark is searched in
several passes. A document is shuffled only as the words around such meetings, and one mark that carries its number of
words; the windows themselves are broadcast while they are at most `most_windows`, and else joined by shuffle, where
Spark splits the rows of a passage that many documents have.

Edge cases: null and empty texts have no words; an item without words has no window. Every input row gives a row,
repeated rows too; rows of one id but different texts are judged separately. Other columns are ignored, whatever their
names. Empty tables give no rows, or no hits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, fresh, stored, table

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Fixed value: what separates words once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def windows_of(items: DataFrame, id_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(window_id, words) of the distinct windows, and (window_id, item_id)."""
    rows = items.select(F.col(id_col).cast("string").alias("item_id"), words_of(F.col(text_col)).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    all_ = rows.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("words"))
    ids = all_.select(F.sha2(F.array_join("words", " ").cast("binary"), 256).alias("window_id"), "words", "item_id")
    ids = stored(ids)
    return ids.select("window_id", "words").dropDuplicates(["window_id"]), ids.select("window_id", "item_id").distinct()


def _hash(words: Column, at: Column, length: int) -> Column:
    """The hash of the shingle of so many words at a place of the array, counted from 0."""
    return F.xxhash64(F.lit(length), *(F.get(words, at + k) for k in range(length)))


def _shingles(rows: DataFrame, lengths: list[int], mark: bool) -> DataFrame:
    """(doc_id, body, w, pos, h): the shingles of each length at each place of the words w; with a mark at the end, of hash 0."""
    places = F.posexplode(F.concat("w", F.array(F.lit(""))) if mark else F.col("w")).alias("pos", "word")
    rows = rows.select("doc_id", "body", "w", places)
    hashes = [_hash(F.col("w"), F.col("pos"), n) for n in lengths] or [F.lit(1).cast("long")]
    h = hashes[0] if len(hashes) == 1 else F.explode(F.array(*hashes))
    if not mark:
        return rows.select("doc_id", "body", "w", "pos", h.alias("h"))
    if len(hashes) > 1:
        h = F.explode(F.when(F.col("word") == "", F.array(F.lit(0).cast("long"))).otherwise(F.array(*hashes)))
    else:
        h = F.when(F.col("word") == "", F.lit(0).cast("long")).otherwise(h)
    return rows.select("doc_id", "body", "w", "pos", h.alias("h"))


def _prefixes(docs: DataFrame, windows: DataFrame, lengths: list[int], shingle: int) -> DataFrame:
    """(window_id, words, at, h): the windows with the shingle that is rarest in the documents, and its place."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - shingle, F.lit(0)))
    own = F.lit(None).cast("long")
    placed = windows.select("window_id", "words", F.explode(starts).alias("at"))
    for n in lengths:
        own = F.when(F.least(F.size("words"), F.lit(shingle)) == n, _hash(F.col("words"), F.col("at"), n)).otherwise(own)
    placed = stored(placed.withColumn("h", own))
    vocabulary = bounded(placed.select("h").distinct())
    counts = _shingles(docs, lengths, False).select("h").join(vocabulary, "h", "left_semi").groupBy("h").agg(F.count("*").alias("n"))
    rarest = F.min_by(F.struct("at", "h"), F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at"))
    return placed.join(counts, "h", "left").groupBy("window_id").agg(F.any_value("words").alias("words"), rarest.alias("p")).select("window_id", "words", "p.at", "p.h")


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text", *, size=10, shingle=3, block=1 << 21, most_windows=50_000
) -> DataFrame:
    """doc_id, body (its text's xxhash64), n_words, n_hit, items (sorted texts of ids) and contaminated, a row for each row of `docs`."""
    windows, owners = windows_of(benchmark, item_col, item_text_col, size)
    # At most `shingle` numbers reach the driver.
    lengths = sorted(r[0] for r in windows.select(F.least(F.size("words"), F.lit(shingle))).distinct().collect())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("body"), words_of(F.col(text_col)).alias("w"))
    # Each row has one empty word at its end, whose hash is 0 and which meets a window of no words: the mark of the row.
    mark = docs.sparkSession.sql("select string(null) as window_id, array() as words, 0 as at, 0L as h")
    prefixes = stored(_prefixes(rows, windows, lengths, shingle).union(mark))
    count = prefixes.count()
    told, found, blocks = _shingles(rows, lengths, True), None, max(1, math.ceil(count / block))
    begin = F.greatest(F.col("pos") - (size - 1), F.lit(0))
    for k in range(blocks):
        part = prefixes.select("h").where(F.pmod("h", F.lit(blocks)) == k).distinct()
        met = told.join(F.broadcast(part), "h", "left_semi")  # `block` hashes on average
        met = met.select("doc_id", "body", "h", "pos", F.size("w").alias("n"), begin.alias("begin"), F.slice("w", begin + 1, 2 * size - 1).alias("near"))
        found = met if found is None else found.union(met)
    window = prefixes.select("window_id", F.col("words").alias("words_"), "at", "h")
    found = found.join(F.broadcast(window) if count <= most_windows else window, "h")
    start, length = F.col("pos") - F.col("at"), F.size("words_")
    inside = (start >= 0) & (start + length <= F.col("n"))
    equal = F.when(F.col("window_id").isNull(), F.lit(True)).when(inside, F.slice("near", start - F.col("begin") + 1, length) == F.col("words_")).otherwise(False)
    found = found.where(equal).select("doc_id", "body", "n", "window_id", start.alias("start"), length.alias("length"))
    span = F.when(F.col("window_id").isNotNull(), F.struct("start", (F.col("start") + F.col("length")).alias("end")))
    by_row = stored(
        found.groupBy("doc_id", "body").agg(
            F.max("n").cast("long").alias("n_words"),
            F.count_if(F.col("window_id").isNull()).alias("rows"),
            F.array_sort(F.collect_set(span)).alias("spans"),
            F.collect_set("window_id").alias("windows"),
        )
    )
    nothing = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc, s):
        more = F.greatest(s["end"] - F.greatest(s["start"], acc["end"]), F.lit(0))
        return F.struct(F.greatest(acc["end"], s["end"]).alias("end"), (acc["n"] + more).alias("n"))

    n_hit = F.aggregate("spans", nothing, step, lambda acc: acc["n"])
    items = by_row.select("doc_id", "body", F.explode("windows").alias("window_id")).join(owners, "window_id").groupBy("doc_id", "body").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    items = items.withColumnsRenamed({"doc_id": "d", "body": "b"})
    out = by_row.join(items, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("body").eqNullSafe(F.col("b")), "left")
    out = out.select("doc_id", "body", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("copy_"))
    return out.drop("copy_").withColumn("contaminated", F.col("n_hit") > 0)


def uncontaminated(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", **limits) -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no window of the benchmark."""
    one, body = fresh(docs, "hit_id", "hit_body")
    hit = benchmark_hits(docs, benchmark, id_col, text_col, **limits).where("contaminated").select(F.col("doc_id").alias(one), F.col("body").alias(body)).distinct()
    return docs.join(bounded(hit), F.col(id_col).eqNullSafe(F.col(one)) & (F.xxhash64(text_col) == F.col(body)), "left_anti")


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    out = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    sha = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), sha.alias("items_sha256"), "contaminated")


SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (select distinct item_id, array_to_string(w[i:i + 9], ' ') as passage, least(len(w), 10) as k from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
ks as (select distinct k from bw),
dw as (select doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') as passage from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d cross join ks where len(w) >= k)),
hit as (select doc_id, i, dw.k, item_id from dw join bw on dw.passage = bw.passage and dw.k = bw.k),
n as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(i, i + k)) as pos from hit) group by doc_id),
it as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items from (select distinct doc_id, cast(item_id as varchar) as item_id from hit) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (doc_id) left join it using (doc_id)
"""
