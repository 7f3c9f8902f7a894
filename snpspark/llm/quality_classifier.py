"""Document quality by pairwise ranking after Bradley and Terry.

Of each pair of a good and a bad document the good one is preferred; the chance of that is the logistic function of the
difference of their scores, and a score is a weighted sum of the text's features (shares of kinds of characters, words
and repetitions, whatever the language). The weights minimise the logistic loss over random pairs of a bounded sample
of `most` labelled rows, in a fixed number of steps, on the driver. A document is accepted if its score reaches the
quantile of the sample's scores that separates the labels best; scores are mapped to 0 to 1 so that it lies at `cut`.

Edge cases: null and empty texts have features of zero and are scored. With labels of one kind only or none, every
score is that label, 1 without labels (nothing is rejected without evidence). Each input row gives a row, repeated rows
too; other columns are ignored, and labels that are null or have no document are left out. Of an id's several labels the
better counts; of its several documents the one with the least hash is learnt from, so that the model doesn't depend on
order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import table

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "bang": b"!?",
    "stop": b".,;:",
    "pipe": b"|",
    "symbol": b"#*$%&<>@^~_=+\\{}[]`",
    "quote": b"\"'()-/",
    "line": b"\n",
}
_KIND = np.full(256, len(_KINDS) + 1, np.uint8)
for _i, _set in enumerate(_KINDS.values()):
    _KIND[list(_set)] = _i
_KIND[32] = len(_KINDS)
_KIND[128:] = len(_KINDS) + 2
CHARS = len(_KINDS) + 3
FEATURES = 2 * CHARS + 11


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows x FEATURES, each about 0 to 1."""
    rows = len(offs) - 1
    size = np.diff(offs)
    chars = np.zeros(rows * CHARS)
    for k in range(0, len(data), K.SLICE_BYTES):  # a long text is a slice of its own
        part = data[k : k + K.SLICE_BYTES]
        row = np.searchsorted(offs, np.arange(k, k + len(part)), side="right") - 1 if rows > 1 else 0
        chars += np.bincount(row * CHARS + _KIND[part].astype(np.int64), minlength=rows * CHARS)
    chars = chars.reshape(rows, CHARS) / np.maximum(1, size)[:, None]
    starts, ends, first = K.words(data, offs)
    n = np.diff(first)
    of = K.row_of(first)
    per = lambda flags: np.bincount(of, weights=flags, minlength=rows) / np.maximum(1, n)
    lens = (ends - starts).astype(float)
    h = K.span_hashes(K.LOWER[data], starts, ends)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    _, at = np.unique(K.mix(h + of.astype(np.uint64) * K.U(0x9E3779B97F4A7C15)), return_index=True)
    distinct = np.bincount(of[at], minlength=rows)
    head, tail = (data[starts], data[ends - 1]) if len(starts) else (data[:0], data[:0])
    mean = per(lens)
    spread = np.sqrt(np.maximum(0, per(lens**2) - mean**2))
    triple = K.window_hashes(h, 3)
    ok = np.flatnonzero(K.whole_windows(first, 3)[: len(triple)])
    again = np.bincount(of[ok[K.repeated(of[ok], triple[ok])]], minlength=rows) / np.maximum(1, n)
    heads, tails = _KIND[head], _KIND[tail]
    more = [
        per(same),
        np.sqrt(per(same)),
        distinct / np.maximum(1, n) ** 0.8,
        np.log1p(n) / 10,
        mean / 10,
        spread / 10,
        per(lens <= 3),
        per(heads == 0),
        per(tails == 4),
        per((tails == 3) | (tails == 5) | (tails == 6)),
        again,
    ]
    return np.concatenate([chars, np.sqrt(chars), np.stack(more, 1)], 1)


class Model:
    """Weights on standardised features, and the map of raw scores to 0 to 1."""

    def __init__(self):
        self.mean, self.scale, self.weights = np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES)
        self.at, self.slope, self.cut, self.constant = 0.0, 1.0, 0.7, None

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -4, 4) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        odds = np.log(self.cut / (1 - self.cut)) + self.slope * (self.raw(x) - self.at)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def fit(self, x: np.ndarray, good: np.ndarray, *, cut=0.7, steps=400, pairs=2048, rate=0.05, decay=1e-3, seed=5):
        self.cut = cut
        if len(set(good.tolist())) < 2:
            self.constant = float(good.min(initial=1))
            return self
        self.mean, self.scale = x.mean(0), x.std(0) + 0.01
        z = np.clip((x - self.mean) / self.scale, -4, 4)
        rng, up, down = np.random.default_rng(seed), np.flatnonzero(good == 1), np.flatnonzero(good == 0)
        w, m, v = np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(FEATURES)
        for step in range(1, steps + 1):
            d = z[rng.choice(up, pairs)] - z[rng.choice(down, pairs)]
            g = -(d / (1 + np.exp(np.clip(d @ w, -500, 500)))[:, None]).mean(0) + decay * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.weights = w
        s = self.raw(x)
        q = np.linspace(0.001, 0.999, 999)
        at = np.quantile(s, q)
        right = np.array([((s >= t) == (good == 1)).mean() for t in at])
        self.at = float(np.median(at[right >= right.max() - 1e-12]))
        base = np.log(cut / (1 - cut))
        slopes = np.geomspace(0.05, 20, 60) / (s.std() + 1e-9)
        sign = np.where(good == 1, -1, 1)
        self.slope = float(min(slopes, key=lambda k: np.logaddexp(0, sign * (base + k * (s - self.at))).sum()))
        return self


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", *, most=20_000, cut=0.7) -> Model:
    """A model of the labelled rows. labels: id and 0/1, the rows to learn from; `most` of them at most are used."""
    labels = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and doc_id is not null")
    sample = labels.orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(most).groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = _rows(docs, id_col, text_col).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y")  # the sample's size is bounded
    rows = rows.withColumn("body", F.xxhash64("text"))

    def fetch(batches):
        for batch in batches:
            for lo, hi, data, offs in K.slices(batch):
                x = pa.FixedSizeListArray.from_arrays(pa.array(features(data, offs).ravel()), FEATURES).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([x, *(batch.column(i).slice(lo, hi - lo) for i in (0, 2, 3))], names=["x", "doc_id", "y", "body"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    one = rows.mapInArrow(fetch, f"x array<double>, doc_id {kind}, y int, body long").groupBy("doc_id").agg(F.min_by(F.struct("x", "y"), "body").alias("t"))
    got = one.select("doc_id", "t.*").toArrow().sort_by("doc_id")
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, FEATURES) if len(got) else np.zeros((0, FEATURES))
    return Model().fit(x, got["y"].to_numpy(), cut=cut)


def quality_scores(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id and score, for each row."""
    rows = _rows(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            for lo, hi, data, offs in K.slices(batch):
                s = pa.array(held.value.scores(features(data, offs)), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), s], names=["doc_id", "score"])

    return rows.mapInArrow(score, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def accepted(docs: DataFrame, model: Model, text_col="text") -> DataFrame:
    """The rows of `docs`, with all their columns, whose score reaches the model's cut."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        for batch in batches:
            for lo, hi, data, offs in K.slices(batch, text_col):
                yield batch.slice(lo, hi - lo).filter(pa.array(held.value.scores(features(data, offs)) >= held.value.cut))

    return docs.mapInArrow(keep, docs.schema)


def held_out(id_col="doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(~held_out()))
    return quality_scores(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= model.cut).cast("int").alias("predicted"))
