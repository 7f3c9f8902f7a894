"""A small convolutional text classifier for toxicity, trained in numpy.

Words (runs of ASCII letters and digits and of all bytes beyond ASCII, A-Z lower-cased) are hashed several times: whole,
and by their first bytes, so that inflected forms share what their stems mean. A word's vector is the sum of these
hashed embeddings; filters of several widths slide over the vectors, each keeps its maximum over the whole
text, and a logistic layer weighs the maxima.

Training takes in the whole text of every labelled row. The rows are dealt, by a hash of the id, into parts of about
`most_bytes` of text, one to a task, of which only hashed words are held. In each of `rounds` rounds every part takes the
model as it is through all its rows (and so often that a small corpus gets `steps` steps in all), by batches that are
half toxic; the model then moves by the mean of what the parts have learnt, weighed by their rows, embeddings by that of
the parts that changed them.
Sums over parts are of whole numbers, so the model doesn't depend on the order. In the end all labelled rows are scored:
the bias is set so that a logistic regression of their labels on the model's logits has even odds at a score of one half,
and each language with 20 rows of either kind gets its own threshold in the same way; language is no input of the score.

Edge cases: null and empty texts are scored (all maxima are those of padding). With labels of one kind only or none,
every score is the share of toxic labels, 0 without labels. Each input row gives a row, repeated rows too; columns other
than those named are ignored, and labels that are null or have no document are left out. Of an id's several labels any
one counts; of its several documents the one with the least hash is learnt from, so that the model doesn't depend on order.
"""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import bounded, columns, stored, table

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 15, 8, 8, (1, 2, 3)
STEMS = (1 << 62, 4, 5, 7)  # bytes of a word that are hashed
PAD = len(STEMS) * BUCKETS
DENSE = ("filters", "bias", "weights", "base")
PART = 1 << 17  # words of a text that are convolved at once
BATCH = 48
FIXED = float(1 << 30)  # what is learnt is averaged in units of its inverse
LOGITS = np.linspace(-20, 20, 1281)  # to which logits are rounded when thresholds are sought
_OTHER = np.ones(256, bool)
_OTHER[48:58] = _OTHER[65:91] = _OTHER[97:123] = _OTHER[128:] = False


def hashed(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The embedding rows of each word (words x stems), and the first word of each row."""
    starts, ends, first = K.words(data, offs, _OTHER)
    data = K.LOWER[data]
    out = np.empty((len(starts), len(STEMS)), np.int32)
    for k, most in enumerate(STEMS):
        out[:, k] = K.span_hashes(data, starts, np.minimum(ends, starts + most), k) >> K.U(49)
        out[:, k] += k * BUCKETS
    return out, first


def padded(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all rows with padding behind each row, and where each row's windows start and end."""
    gap = max(WIDTHS)
    start = first[:-1] + gap * np.arange(len(first) - 1)
    out = np.full((first[-1] + gap * (len(first) - 1), len(STEMS)), PAD, np.int32)
    out[np.arange(first[-1]) + gap * K.row_of(first)] = ids
    return out, start, start + np.maximum(np.diff(first), 1)


class Model:
    def __init__(self, seed=7):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.02, (PAD + 1, DIM)).astype(np.float32)
        self.table[PAD] = 0
        self.filters = rng.normal(0, 0.3, (DIM, sum(WIDTHS) * FILTERS)).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.weights = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.base = np.float32(0)
        self.constant = None

    def _convolved(self, vectors: np.ndarray) -> np.ndarray:
        part = vectors @ self.filters
        out = np.empty((len(vectors), len(WIDTHS) * FILTERS), np.float32)
        at = 0
        for i, w in enumerate(WIDTHS):
            z = part[:, at : at + FILTERS].copy()
            for k in range(1, w):
                z[:-k] += part[k:, at + k * FILTERS : at + (k + 1) * FILTERS]
            out[:, i * FILTERS : (i + 1) * FILTERS] = z
            at += w * FILTERS
        return out + self.bias

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        out = self.table[ids[:, 0]]
        for k in range(1, len(STEMS)):
            out += self.table[ids[:, k]]
        return out

    def maxima(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The filters' maxima over each row. A long row is worked off in parts that overlap by a filter's width."""
        if len(first) == 2 and len(ids) > 2 * PART:
            reach = max(WIDTHS) - 1
            parts = [self.maxima(part, np.array([0, len(part)])) for k in range(0, len(ids), PART) for part in [ids[k : k + PART + reach]]]
            return np.max(parts, axis=0)
        ids, start, end = padded(ids, first)
        cut = np.stack([start, end], 1).ravel()
        return np.maximum.reduceat(self._convolved(self.vectors(ids)), cut, axis=0)[::2]

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.maximum(self.maxima(ids, first), 0) @ self.weights + self.base

    def scores(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        return 1 / (1 + np.exp(-self.logits(ids, first).astype(np.float64)))

    def _start(self, seen: np.ndarray, n: np.ndarray):
        """The first dimension starts as how surely a hash is commoner in toxic texts, which a text's own chance words
        can't claim; the filters start by looking at it. seen: for clean and toxic texts, how many have each hash; n: how many there are."""
        share = (seen[0] + seen[1] + 1) / (n[0] + n[1] + 2)
        z = (seen[1] / n[1] - seen[0] / n[0]) / np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
        z[np.abs(z) < 3] = 0
        self.table[:, 0] = np.clip(z / 4, -1, 3)
        self.table[PAD] = 0
        self.filters[0] = np.abs(self.filters[0]) + 0.3
        self.weights = np.abs(self.weights)

    def fit(self, texts: list[np.ndarray], toxic: np.ndarray, *, steps=300, **more):
        self._start(*seen(texts, toxic))
        self.descend(texts, toxic, steps, self.sums(), **more)
        return self

    def sums(self) -> dict:
        """Adagrad's sums of squares before the first step."""
        return {k: np.full_like(getattr(self, k), 1e-3) for k in DENSE} | {"table": np.full_like(self.table, 1e-8)}

    def _tops(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's maximum over each text, and the hashes of the words at it and behind (texts x filters x width x stems)."""
        reach = max(WIDTHS)
        tops, at = [], []
        for t in texts:
            best = None
            for k in range(0, max(1, len(t)), PART):
                ids = np.full((min(PART, max(1, len(t) - k)) + reach - 1, len(STEMS)), PAD, np.int32)
                own = t[k : k + len(ids)]
                ids[: len(own)] = own
                z = self._convolved(self.vectors(ids))[: len(ids) - reach + 1]
                place = z.argmax(0)
                top = z[place, np.arange(z.shape[1])]
                near = ids[place[:, None] + np.arange(reach)]
                if best is None:
                    best = top, near
                else:
                    better = top > best[0]
                    best = np.where(better, top, best[0]), np.where(better[:, None, None], near, best[1])
            tops.append(best[0])
            at.append(best[1])
        return np.stack(tops), np.stack(at)

    def descend(self, texts: list[np.ndarray], toxic: np.ndarray, steps: int, sums: dict, *, start=0.0, end=1.0, size=BATCH, rate=0.15, decay=1e-4, slow=0.05, seed=11):
        """Adagrad on batches of which half are toxic, each kind's texts in turn; sparse for the embeddings. The rate falls
        from 1 - start to 1 - end of `rate`. Gives the embeddings' rows that were changed."""
        rng = np.random.default_rng(seed)
        kinds = [k for k in (np.flatnonzero(toxic == k) for k in (0, 1)) if len(k)]
        turns = [np.concatenate([rng.permutation(k) for _ in range(1 + steps * (size // 2) // len(k))]) for k in kinds]
        changed = np.zeros(PAD + 1, bool)
        for step in range(steps):
            pick = np.concatenate([t[step * (size // 2) : (step + 1) * (size // 2)] for t in turns])
            top, near = self._tops([texts[i] for i in pick])
            p = 1 / (1 + np.exp(-(np.maximum(top, 0) @ self.weights + self.base)))
            g = ((p - toxic[pick]) / size).astype(np.float32)
            back = g[:, None] * self.weights * (top > 0)
            grads = {"weights": np.maximum(top, 0).T @ g + decay * self.weights, "base": g.sum(), "bias": back.sum(0), "filters": decay * self.filters}
            rows, values, col = [], [], 0
            for i, w in enumerate(WIDTHS):
                own = slice(i * FILTERS, (i + 1) * FILTERS)
                live = back[:, own] != 0
                for k in range(w):
                    ids = near[:, own, k]
                    cols = slice(col, col + FILTERS)
                    grads["filters"][:, cols] += np.einsum("nf,nfd->df", back[:, own], self.vectors(ids.reshape(-1, len(STEMS))).reshape(*ids.shape[:2], DIM))
                    spread = (back[:, own, None] * self.filters[:, cols].T[None])[live]
                    for j in range(len(STEMS)):
                        rows.append(ids[live, j])
                        values.append(spread)
                    col += FILTERS
            scale = np.float32(rate * (1 - start - (end - start) * step / steps))
            for k in DENSE:
                sums[k] += grads[k] ** 2
                setattr(self, k, getattr(self, k) - scale * grads[k] / np.sqrt(sums[k]))
            rows, at = np.unique(np.concatenate(rows), return_inverse=True)
            grad = np.zeros((len(rows), DIM), np.float32)
            np.add.at(grad, at, np.concatenate(values))
            grad[rows == PAD] = 0
            sums["table"][rows] += grad**2
            self.table[rows] -= slow * scale * grad / np.sqrt(sums["table"][rows])
            changed[rows] = True
        changed[PAD] = False
        return np.flatnonzero(changed)


def seen(texts: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In how many clean and toxic texts each hash is (2 x PAD + 1), and how many such texts there are."""
    out = np.zeros((2, PAD + 1), np.int64)
    for t, y in zip(texts, toxic):
        out[y, np.unique(t)] += 1
    return out, np.bincount(toxic, minlength=2)


def _packed(model: Model, sums: dict) -> tuple[np.ndarray, np.ndarray]:
    """All that is learnt, and Adagrad's sums for it, as rows of DIM numbers: the embeddings, then the rest."""

    def rows(of):
        dense = np.concatenate([np.ravel(of(k)) for k in DENSE])
        return np.concatenate([of("table"), np.pad(dense, (0, -len(dense) % DIM)).reshape(-1, DIM)])

    return rows(lambda k: getattr(model, k)), rows(sums.get)


def _unpacked(model: Model, sums: dict, packed: tuple[np.ndarray, np.ndarray]):
    for rows, put in zip(packed, (lambda k, x: setattr(model, k, x), sums.__setitem__)):
        rows = rows.astype(np.float32)
        put("table", rows[: PAD + 1])
        dense, at = rows[PAD + 1 :].ravel(), 0
        for k in DENSE:
            like = np.asarray(getattr(model, k))
            put(k, dense[at : at + like.size].reshape(like.shape)[()])
            at += like.size


def _learnt_from(part: pa.Table) -> tuple[list[np.ndarray], np.ndarray, list]:
    """Hashed words, label and language of each id of a part, in the order of the ids' hashes."""
    part = part.sort_by([(c, "ascending") for c in ("u", "doc_id", "body")])
    ids = part["doc_id"].to_pylist()
    part = part.filter(pa.array([i == 0 or ids[i - 1] != x for i, x in enumerate(ids)]))
    texts = []
    for batch in part.to_batches():
        for _, _, data, offs in K.slices(batch):
            h, first = hashed(data, offs)
            texts += [h[a:b] for a, b in zip(first[:-1], first[1:])]
    return texts, part["y"].to_numpy().astype(np.int64), part["lang"].to_pylist()


def _each(parts: DataFrame, emitted, schema: str) -> DataFrame:
    """The rows (columns by name) that `emitted` gives for each part, of which partitions hold whole ones, one after another."""

    def of(batches):
        held: list = []
        for batch in batches:
            part = batch.column(batch.schema.get_field_index("part")).to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for lo, hi in zip(cut[:-1], cut[1:]):
                if held and held[0][0] != part[lo]:
                    yield from done(held)
                if hi > lo:
                    held.append((part[lo], batch.slice(lo, hi - lo)))
        if held:
            yield from done(held)

    def done(held):
        got = emitted(*_learnt_from(pa.Table.from_batches([x for _, x in held])))
        held.clear()
        yield from pa.table(got).to_batches()
        K.release()

    return parts.mapInArrow(of, schema)


def _sums(parts: DataFrame, emitted, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Place and numbers, added over all parts, of what `emitted` gives for each: (places, numbers), whole ones, so that
    their sums don't depend on the order."""

    def of(*part):
        at, numbers = emitted(*part)
        return {k: pa.array(x.astype(np.int64)) for k, x in zip(["at", *names], (at, *numbers.T))}

    got = _each(parts, of, ", ".join(f"{c} long" for c in ["at", *names]))
    got = columns(got.groupBy("at").agg(*(F.sum(c).alias(c) for c in names)))
    return got[0], np.stack(got[1:], 1)


def _even(counts: np.ndarray) -> float:
    """The logit at which a logistic regression of the label on the model's logit has even odds. counts: of clean and of
    toxic texts, by LOGITS. The slope is drawn to one a little, so that separable texts have an answer."""
    n, at = counts.sum(0), np.array([1.0, 0.0])
    x = np.stack([LOGITS, np.ones(len(LOGITS))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -500, 500)))
        slope = x @ (n * p - counts[1]) + at - [1, 0]
        step = np.linalg.solve((n * p * (1 - p) * x) @ x.T + np.eye(2), slope)
        at = at - step / max(1, np.abs(step).max())
    return float(np.clip(-at[1] / max(at[0], 0.1), LOGITS[0], LOGITS[-1]))


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", label_col="toxic", *, most_bytes=24_000_000, steps=300, rounds=3) -> tuple[Model, dict]:
    """The model and its thresholds by language (None: all others). labels: id and 0/1, the rows to learn from."""
    labels = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and doc_id is not null")
    labels = bounded(labels.groupBy("doc_id").agg(F.max("y").alias("y")))
    counts = {r["y"]: r["n"] for r in labels.groupBy("y").agg(F.count("*").alias("n")).collect()}
    model = Model()
    if len(counts) < 2:
        model.constant = float(counts.get(1, 0) > 0)
        return model, {None: 0.5}
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("body"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.join(labels, "doc_id")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(1, round(size / most_bytes))
    u = F.xxhash64("doc_id", F.lit(1))
    parts = stored(rows.withColumn("u", u).withColumn("part", F.pmod("u", F.lit(n_parts)).cast("int")).repartitionById(n_parts, "part").sortWithinPartitions("part"))

    def start(texts, toxic, _):
        got, n = seen(texts, toxic)
        at = np.flatnonzero(got.any(0))
        return np.append(at, PAD + 1), np.concatenate([got[:, at].T, n[None]])

    at, got = _sums(parts, start, ["n0", "n1"])
    all_seen = np.zeros((PAD + 2, 2), np.int64)
    all_seen[at] = got
    n = all_seen[PAD + 1]
    if not n.all():
        model.constant = float(n[1] > 0)
        return model, {None: 0.5}
    model._start(all_seen[: PAD + 1].T, n)
    sums = model.sums()
    sc = docs.sparkSession.sparkContext
    for k in range(rounds):
        held = sc.broadcast((model, sums))

        def learn(texts, toxic, _, held=held, k=k):
            own, squares = copy.deepcopy(held.value)
            before = _packed(own, squares)
            least = -(-int(np.bincount(toxic).max()) // (BATCH // 2))
            changed = own.descend(texts, toxic, max(least, -(-steps // rounds)), squares, start=k / rounds, end=(k + 1) / rounds, seed=11 + k)
            at = np.concatenate([changed, np.arange(PAD + 1, len(before[0]))])
            moved = [(x[at] - y[at]).astype(np.float64) for x, y in zip(_packed(own, squares), before)]
            return at, np.concatenate([np.full((len(at), 1), len(texts)), np.rint(np.concatenate(moved, 1) * len(texts) * FIXED)], 1)

        at, got = _sums(parts, learn, ["n", *(f"x{i}" for i in range(2 * DIM))])
        mean = got[:, 1:] / FIXED / got[:, :1]
        packed = [x.astype(np.float64) for x in _packed(model, sums)]
        for x, d in zip(packed, (mean[:, :DIM], mean[:, DIM:])):
            x[at] += d
        _unpacked(model, sums, packed)
        held.unpersist()
    held = sc.broadcast(model)

    def judge(texts, toxic, langs):
        logits = np.concatenate([held.value.logits(t, np.array([0, len(t)])) for t in texts])
        return {"lang": pa.array(langs, pa.string()), "y": toxic, "k": np.rint(np.interp(logits, LOGITS, np.arange(len(LOGITS)))).astype(np.int64)}

    judged = _each(parts, judge, "lang string, y long, k long")
    found: dict = {}
    for r in judged.groupBy(F.coalesce("lang", F.lit("")).alias("lang"), "y", "k").count().collect():
        found.setdefault(r["lang"], np.zeros((2, len(LOGITS)), np.int64))[r["y"], r["k"]] += r["count"]
    even = _even(sum(found.values()))
    model.base = np.float32(model.base - even)
    own = {lang: _even(x) - even for lang, x in sorted(found.items()) if x.sum(1).min() >= 20}
    return model, {None: 0.5} | {lang: float(1 / (1 + np.exp(-x))) for lang, x in own.items()}


def toxicity_scores(docs: DataFrame, model: Model, thresholds: dict, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """doc_id, score, threshold (of the row's language) and flagged (score at least that)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)  # 3 MB, whatever the data

    def score(batches):
        for batch in batches:
            for lo, hi, data, offs in K.slices(batch, most=1 << 19):
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in (0, 1)), pa.array(held.value.scores(*hashed(data, offs)), pa.float64())], names=["doc_id", "lang", "score"])

    scored = rows.mapInArrow(score, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang string, score double")
    cut = F.lit(float(thresholds[None]))
    for lang, t in thresholds.items():
        if lang is not None:
            cut = F.when(F.coalesce("lang", F.lit("")) == lang, t).otherwise(cut)
    return scored.withColumn("threshold", cut).withColumn("flagged", F.col("score") >= F.col("threshold"))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    part = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    model, thresholds = train(docs, labels.where(~part))
    out = toxicity_scores(docs, model, thresholds)
    return out.select("doc_id", part.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "flagged")
