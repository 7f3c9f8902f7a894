"""Removal of passages that an earlier document already has, found level by level with windows of doubling length.

A window of `size` words counts as repeated if its words also start in a document of a smaller id. Windows are not
compared at full length at once: at the first level each is represented by the least hash among the short spans in it
(so that equal windows are represented by equal spans, and far fewer spans than words are shuffled). Only the windows
around spans that occur in two documents go on to the next level, with spans of twice the length, until the span is the
window itself; there 128 bits of hash of every surviving window are compared. Where nothing survives, the later levels
have no rows. Documents of exactly the same words have the same windows, so only the earliest of them takes part; by
definition the others lose all their words.

At each level the documents of each span are counted (partial sums before the shuffle, so that a passage that many
share is one row of each task). Spans that make up at least one in `broadcast_rows` of all places of repeated spans, which
are no more than `broadcast_rows` whatever the input, are broadcast to where the documents' spans are, and so a common
passage is never brought together in one task; all others are joined by shuffle, in small inputs as in large ones, and
a bit map of fixed size spares the shuffle of most spans that don't repeat, until repeated spans fill it. Texts are
shuffled only of documents that have a hit.

Edge cases: a null or empty text has no words and loses none. A null id counts as larger than all others. Rows with the
same id don't remove each other's words; repeated rows each give a row. Texts of any length are worked off whole.
Columns other than the two named ones are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import bounded, columns, fresh, marks, stored, table

LAST = (1 << 63) - 1


def levels(size: int, shortest: int = 10) -> list[int]:
    """Lengths of the spans: each is twice the one before (one less where halving leaves a rest), the last is `size`."""
    out = [size]
    while (half := -(-out[0] // 2)) >= shortest:
        out.insert(0, half)
    return out


def _slide(x: np.ndarray, k: int, f) -> np.ndarray:
    """f (minimum or maximum) over each run of k items."""
    at = 1
    while at * 2 <= k:
        x, at = f(x[:-at], x[at:]), at * 2
    return f(x[: len(x) - (k - at)], x[k - at :]) if at < k else x


def _representatives(h: np.ndarray, window: np.ndarray, k: int) -> np.ndarray:
    """Places of spans with the least hash of the k spans in some window; `window` marks where windows start."""
    if not window.any():
        return np.zeros(0, np.int64)
    least = np.where(window, _slide(h, k, np.minimum)[: len(window)], 0)
    pad = np.zeros(k - 1, np.uint64)
    return np.flatnonzero(_slide(np.concatenate([pad, least, pad]), k, np.maximum)[: len(h)] == h)


def _lists(at: np.ndarray, first: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    """List arrays by row of what was found at the places `at`, with each place's offset in its row first."""
    offs = pa.array(np.searchsorted(at, first), pa.int32())
    own = (at - np.repeat(first[:-1], np.diff(np.searchsorted(at, first)))).astype(np.int32)
    return [pa.ListArray.from_arrays(offs, pa.array(x)) for x in (own, *values)]


def _windows_at(batch, lo: int, hi: int, first: np.ndarray, words: np.ndarray, span: int, size: int) -> np.ndarray:
    """True where a window starts whose representative span of the last level occurs in two documents."""
    out = K.whole_windows(first, size)
    if span == 0 or not out.any():
        return out
    at = batch.column(batch.schema.get_field_index("at")).slice(lo, hi - lo)
    place = at.flatten().to_numpy().astype(np.int64) + np.repeat(first[:-1], np.diff(at.offsets.to_numpy()))
    h, k = K.window_hashes(words, span), size - span + 1
    live = np.full(len(h), ~K.U(0))
    live[place] = h[place]
    fits = _slide(live, k, np.minimum) == _slide(h, k, np.minimum)
    out[: len(fits)] &= fits
    out[len(fits) :] = False
    return out


def _spans(batches, span: int, length: int, size: int):
    """Spans of `length` words that represent the surviving windows, for the first level with each text's digest.

    Later levels get along with the packed texts of the documents that still matter.
    """
    for batch in batches:
        for lo, hi, data, offs in K.slices(batch):
            starts, ends, first = K.words(data, offs)
            words = K.span_hashes(data, starts, ends, 1)
            window = _windows_at(batch, lo, hi, first, words, span, size)
            h = K.window_hashes(words, length)
            if length < size:
                at = _representatives(h, window[: max(0, len(starts) - size + 1)], size - length + 1)
                cols = _lists(at, first, h[at].view(np.int64))
            else:
                at = np.flatnonzero(window)
                g = K.window_hashes(K.span_hashes(data, starts, ends, 2), length)
                cols = _lists(at, first, h[at].view(np.int64), g[at].view(np.int64))
            names = ["at", "h", "g"][: len(cols)]
            if span == 0:
                texts = (data[a:b].tobytes() for a, b in zip(offs[:-1], offs[1:]))
                cols += [pa.array(np.diff(first), pa.int64()), pa.array([hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts])]
                names += ["n_words", "whole"]
            yield pa.RecordBatch.from_arrays([batch.column(i).slice(lo, hi - lo) for i in (0, 1)] + cols, names=["doc", "body", *names])


def _packed(batches, live: np.ndarray):
    """The texts of rows whose key the bit map has, compressed, for the shuffle."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for lo, hi, data, offs in K.slices(batch):
            key = batch.column(batch.schema.get_field_index("key")).slice(lo, hi - lo).to_numpy().view(np.uint64)
            at = np.flatnonzero(K.marked(live, key))
            packed = pa.array([pack(data[offs[i] : offs[i + 1]].tobytes()) for i in at], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo).take(pa.array(at)) for i in (0, 1)), packed], names=["doc", "body", "packed"])


def _unpacked(batches):
    """The batches with their texts unpacked, a few rows at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            at = part.schema.get_field_index("packed")
            yield part.set_column(at, "text", pa.array([unpack(x) for x in part.column(at).to_pylist()], pa.binary()).cast(pa.large_string()))


def _kept(batches, size: int, with_text: bool):
    """The text without the words that windows at the places `at` cover."""
    for batch in batches:
        for lo, hi, data, offs in K.slices(batch):
            starts, ends, first = K.words(data, offs)
            at = batch.column(batch.schema.get_field_index("at")).slice(lo, hi - lo)
            lens = np.diff(at.offsets.to_numpy()).astype(np.int64)
            gone = K.covered(at.flatten().to_numpy().astype(np.int64) + np.repeat(first[:-1], lens), size, len(starts))
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
            shas, texts = [], []
            for i in range(hi - lo):
                word = data[offs[i] : offs[i + 1]].tobytes().split()
                kept = b" ".join([w for w, g in zip(word, gone[first[i] : first[i + 1]].tolist()) if not g])
                shas.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode("utf-8", "replace") if with_text else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in (0, 1)), pa.array(removed, pa.int64()), pa.array(shas), pa.array(texts, pa.string())], names=["doc", "body", "n_removed", "kept_sha256", "kept_text"])


class Repeats:
    """The repeated spans that are broadcast, and a bit map of the others."""

    def __init__(self, near: list[np.ndarray], others: np.ndarray | None):
        h, self.g, self.least = near[0].view(np.uint64), near[1] if len(near) > 2 else None, near[-1]
        self.spans, self.others = K.Lookup(K.mix(h.copy())), others  # mixed, since least hashes are small

    def sort_out(self, doc: np.ndarray, h: np.ndarray, g: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """True where a span is a hit for sure, and where it has to be joined."""
        h = h.view(np.uint64)
        at = self.spans.find(K.mix(h.copy()))
        sure = at >= 0
        if g is not None:
            sure &= self.g[at] == g if len(self.least) else False
            known = sure.copy()
            sure &= doc > self.least[at] if len(self.least) else False
        else:
            known = sure
        rest = ~known & K.marked(self.others, h << K.U(32)) if self.others is not None else np.zeros(len(h), bool)
        return sure, rest


def _sorted_out(batches, held, names: list[str]):
    """doc, body, sure (places that are hits), and the spans that have to be joined."""
    for batch in batches:
        at = batch.column(batch.schema.get_field_index("at"))
        n = np.diff(at.offsets.to_numpy()).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(n)])
        doc = np.repeat(batch.column(0).to_numpy(), n)
        values = [batch.column(batch.schema.get_field_index(c)).flatten().to_numpy() for c in names]
        place = at.flatten().to_numpy()
        sure, rest = held.value.sort_out(doc, values[0], values[1] if len(values) > 1 else None)
        lists = lambda keep, x: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(keep)])[first], pa.int32()), pa.array(x[keep]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists(sure, place), lists(rest, place), *(lists(rest, x) for x in values)], names=["doc", "body", "sure", "at", *names])


def _hits(found: DataFrame, last: bool, broadcast_rows: int) -> DataFrame:
    """(doc, body, at): places of spans that start in two documents; at the last level, in an earlier one.

    The earliest document of a window has to be compared at the next level too, but loses nothing at the last.
    """
    names = ["h", "g"][: 1 + last]
    exploded = lambda df: df.select("doc", "body", F.explode(F.arrays_zip("at", *names)).alias("s")).select("doc", "body", "s.*")
    every = exploded(found).groupBy(*names).agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("n"))
    twice = stored(every.where("least < most").drop("most"))
    places = twice.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cut = places / broadcast_rows if broadcast_rows else LAST
    others = twice.where(F.col("n") < cut)
    near = columns(twice.where(F.col("n") >= cut).select(*names, "least"))
    held = found.sparkSession.sparkContext.broadcast(Repeats(near, marks(others, F.shiftleft("h", 32)) if cut > 2 else None))
    kind = "doc long, body long, sure array<int>, at array<int>" + "".join(f", {c} array<long>" for c in names)
    split = found.select("doc", "body", "at", *names).mapInArrow(lambda b: _sorted_out(b, held, names), kind)
    hits = split.where("size(sure) > 0").select("doc", "body", "sure")
    if cut > 2:  # a repeated span has two places at least
        joined = exploded(split).join(others.drop("n"), names).where("doc > least" if last else "true")
        hits = hits.union(joined.select("doc", "body", F.array("at")))
    return hits.groupBy("doc", "body").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("sure")))).alias("at"))


def repeated_passages(docs: DataFrame, id_col="doc_id", text_col="text", *, size=50, shortest=10, with_text=False, broadcast_rows=1 << 16) -> DataFrame:
    """doc_id, body (its text's xxhash64), n_words, n_removed, kept_sha256 and kept_text, a row for each row of `docs`.

    kept_text is the kept words joined by a space; it is null where no word is removed, and everywhere unless
    `with_text` is set. Ids are integers.
    """
    # A row is known by its id and its text's hash; a null id stands as the largest.
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text_col).alias("body"), F.col(text_col).alias("text"))
    key, steps = ["doc", "body"], levels(size, shortest)
    keyed = rows.withColumn("key", F.xxhash64("doc", "body"))
    schema = lambda length: "doc long, body long, at array<int>, h array<long>" + ", g array<long>" * (length == size)
    found = stored(rows.mapInArrow(lambda b: _spans(b, 0, steps[0], size), schema(steps[0]) + ", n_words long, whole string"))
    # A document with exactly the words of an earlier one loses them all; only the earliest is compared.
    copied = found.where(F.col("n_words") >= size).groupBy("whole").agg(F.min("doc").alias("first"), F.count("*").alias("n"))
    judged = found.join(bounded(copied.where("n > 1").drop("n")), "whole", "left").withColumn("copy", F.coalesce(F.col("doc") > F.col("first"), F.lit(False)))
    digests = judged.select(*key, "n_words", "whole", "copy")
    spans = stored(judged.where(~F.col("copy")).select(*key, "at", "h", *["g"] * (steps[0] == size)))

    def texts(hits: DataFrame) -> DataFrame:
        live = docs.sparkSession.sparkContext.broadcast(marks(hits, F.xxhash64("doc", "body")))
        return keyed.mapInArrow(lambda b: _packed(b, live.value), "doc long, body long, packed binary").join(hits, key)

    for k, length in enumerate(steps):
        hits = stored(_hits(spans, length == size, broadcast_rows))
        if length < size:
            spans = stored(texts(hits).mapInArrow(lambda b, s=length, n=steps[k + 1]: _spans(_unpacked(b), s, n, size), schema(steps[k + 1])))
    cut = texts(hits).mapInArrow(lambda b: _kept(_unpacked(b), size, with_text), "doc long, body long, n_removed long, kept_sha256 string, kept_text string").dropDuplicates(key)
    doc_id = F.when(F.col("doc") != LAST, F.col("doc")).cast(docs.schema[id_col].dataType)
    one = lambda copied, else_, kept: F.when(F.col("copy"), copied).otherwise(F.coalesce(kept, else_))
    return digests.join(cut, key, "left").select(
        doc_id.alias("doc_id"),
        "body",
        "n_words",
        one(F.col("n_words"), F.lit(0).cast("long"), "n_removed").alias("n_removed"),
        one(F.lit(hashlib.sha256().hexdigest()), F.col("whole"), "kept_sha256").alias("kept_sha256"),
        one(F.lit("") if with_text else F.lit(None).cast("string"), F.lit(None).cast("string"), "kept_text").alias("kept_text"),
    )


def without_passages(docs: DataFrame, id_col="doc_id", text_col="text", **sizes) -> DataFrame:
    """The rows of `docs`, with all their columns, their texts without the repeated passages.

    A text that loses words is left as its kept words, joined by a space; a row that loses all its words goes. Only the
    texts that change are shuffled, unless these are more rows than a broadcast may have.
    """
    one, body, kept = fresh(docs, "cut_id", "cut_body", "cut_text")
    cut = stored(repeated_passages(docs, id_col, text_col, with_text=True, **sizes).where("n_removed > 0"))
    cut = cut.select(F.col("doc_id").alias(one), F.col("body").alias(body), F.col("kept_text").alias(kept)).dropDuplicates([one, body])
    rows = docs.withColumn(body + "_", F.xxhash64(text_col))
    same = F.col(id_col).eqNullSafe(F.col(one)) & (F.col(body + "_") == F.col(body))
    whole = rows.join(bounded(cut.select(one, body)), same, "left_anti").select(docs.columns)
    changed = rows.drop(text_col).join(cut.where(F.col(kept) != ""), same)
    return whole.unionByName(changed.withColumnRenamed(kept, text_col).select(docs.columns))


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
word as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from d),
wins as (select doc_id, unnest(range(1, len(w) - 48)) as pos, unnest(list_transform(range(1, len(w) - 48), lambda i: sha256(array_to_string(w[i:i + 49], ' ')))) as h from d where len(w) >= 50),
hit as (select doc_id, pos from (select doc_id, pos, min(doc_id) over (partition by h) as least from wins) where least < doc_id),
gone as (select distinct doc_id, unnest(range(pos, pos + 50)) as pos from hit),
kept as (select word.doc_id, string_agg(word, ' ' order by word.pos) as kept from word left join gone on gone.doc_id = word.doc_id and gone.pos = word.pos where gone.pos is null group by word.doc_id),
n as (select doc_id, count(*) as n_removed from gone group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join n using (doc_id) left join kept using (doc_id)
"""
