"""Scoring of texts by a probabilistic suffix tree over words.

Tokens are words, A-Z lower-cased, and one end for each text. The tree's symbols are the words that occur `symbol_count`
times in training, and for all others their last three bytes (where those occur as often; one symbol for the rest). A
symbol's own words share its probability by their counts, and it reserves as much for unseen words as its words that
occur once suggest; so the scores are those of one distribution over known and unseen tokens.

The tree is grown level by level: for contexts of one symbol, then of two, up to `depth`, the next symbols are counted
over the whole corpus; a symbol that is too rare behind a context's suffix is not counted behind the context. Contexts
that occur `context_count` times are extended, and next symbols that occur `entry_count` times behind them are kept. The
counts are absolute, so that symbols, contexts and entries grow with the corpus; where a share of all tokens
(`symbol_share`, `context_share`, `entry_share`) is less, as in a small corpus, that share holds. A context is retained
if its next symbols diverge from those of its suffix by at least `divergence` nats a token. Its kept entries are smoothed
by an absolute discount; what is left is shared as in the suffix. A token is scored in the state of the longest retained
suffix of what precedes it.

A token's logarithm is that of its symbol, plus for each retained context what the context adds to all symbols, plus for
each kept entry what the entry adds to that. So contexts and entries are rows of a hash and a number, to be summed over
a text. The most frequent, at most `broadcast_rows` of each level, are broadcast; all others, whose number has no bound,
stay a distributed table and are joined by hash. Bit maps of fixed size spare the shuffle of most hashes that aren't in it; they never decide.

Only the symbols must be known to every task: words are looked up in a broadcast table of those with a share of at least
`table_share` (at most a million) and of all symbols; the counts of all rarer words are joined by shuffle, so that every
count is exact.

Edge cases: null and empty texts consist of their end. Without training texts all scores are those of a model that has
seen nothing. Each input row gives a row, repeated rows too; a null id is a training row. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import kernels as K
from .common import columns, marks, most_frequent, stored, table

DISCOUNT = 0.5
SLICE = 1 << 19  # bytes of text whose arrays a worker holds at once
GATHERED = 8 << 20  # bytes of counts whose contexts a worker merges at once
HELD, EMITTED = 400_000, 1_000_000  # rows that a worker holds unmerged, and merged before it emits them
BEGIN, END, RARE = 0, 1, 2  # symbols; the shapes and the frequent words follow
_G = K.U(0x9E3779B97F4A7C15)


def _tokens(data: np.ndarray, offs: np.ndarray):
    """Hash and shape (a hash of the last three bytes) of each word, and each row's first word."""
    data = K.LOWER[data]
    starts, ends, first = K.words(data, offs)
    return K.span_hashes(data, starts, ends, 3), _shapes(data, starts, ends), first


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What K.span_hashes gives for the last three bytes with the seed 4, without a number for each byte."""
    size = np.minimum(ends - starts, 3)
    at = ends - size
    out = K._PLACES[data[at]]
    for k in (1, 2):
        own = np.flatnonzero(size > k)
        out[own] += K._PLACES[256 * k + data[at[own] + k].astype(np.int64)]
    return K.mix(out + size.astype(np.uint64) * K._GOLD + K.U(4))


def _equal(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal hashes come together, and where each begins there."""
    order = np.argsort(h)
    u = h[order]
    return order, np.flatnonzero(np.append(True, u[1:] != u[:-1])) if len(u) else order


def _counted(batches):
    """(h, shape, n) of a partition's words."""
    held: list[tuple] = []
    fresh = 0

    def merged():
        h, s, n = (np.concatenate(x) for x in zip(*held))
        order, start = _equal(h)
        at = order[start]
        return h[at], s[at], np.add.reduceat(n[order], start) if len(at) else n

    for batch in batches:
        for _, _, data, offs in K.slices(batch, most=SLICE):
            h, s, _ = _tokens(data, offs)
            order, start = _equal(h)
            at = order[start]
            held.append((h[at], s[at], np.diff(np.append(start, len(h)))))
            fresh += len(at)
            if fresh > max(HELD, len(held[0][0])):
                held, fresh = [merged()], 0
                if len(held[0][0]) > EMITTED:
                    yield from _emit(held.pop())
    if held:
        yield from _emit(merged())
    held.clear()
    K.release()


def _emit(columns, names=("h", "shape", "n")):
    for k in range(0, len(columns[0]), 200_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[k : k + 200_000].view(np.int64)) for x in columns], names=list(names))


class Model:
    def __init__(self, total: int, distinct: int, ends: int, words, shapes, rest, least: float):
        """words: columns (h, n) of the table; shapes: (shape, n, distinct, once) of the words that are no symbols, for
        the shapes that are; rest: (n, distinct, once) of all others; least: tokens that make a symbol."""
        self.total, self.distinct, self.bottom = total, distinct, total + 0.5 * (distinct + 1)
        self.ends = ends
        self.words, self.counts = K.Lookup(words[0]), words[1]
        frequent = np.flatnonzero(words[1] >= least)
        big = len(shapes[0])
        self.shapes = K.Lookup(shapes[0])
        tokens, kinds, once = (np.concatenate([[r], c]).astype(float) for r, c in zip(rest, shapes[1:]))
        self.symbols = 3 + big + len(frequent)
        self.symbol_of = np.full(len(words[0]) + 1, -1, np.int32)  # the last for words that aren't in the table
        self.symbol_of[frequent] = 3 + big + np.arange(len(frequent))
        # For each shape (0: the rest) what its known words share, and what an unseen word gets.
        unseen = (once + 0.5) / (tokens + 1)
        self.known = np.log10((1 - unseen) / np.maximum(tokens + 0.5 * kinds, 0.5))
        self.unseen = np.log10(unseen)
        root = np.zeros(self.symbols)
        root[END] = (ends + 0.5) / self.bottom if ends else 0
        root[RARE] = (tokens[0] + 0.5 * kinds[0] + 0.5) / self.bottom
        root[3 : 3 + big] = (tokens[1:] + 0.5 * kinds[1:]) / self.bottom
        root[3 + big :] = (words[1][frequent] + 0.5) / self.bottom
        with np.errstate(divide="ignore"):
            self.root = np.log(root)
        if not ends:
            self.root[END] = np.log(0.5 / self.bottom)
        #: How often each symbol precedes another.
        self.preceding = np.concatenate([[ends, 0, rest[0]], shapes[1], words[1][frequent]]).astype(np.int64)
        self.levels: list[dict] = []
        #: The rows (key, value) that aren't in the levels, where there are any, and bit maps of their contexts and entries.
        self.tail: DataFrame | None = None
        self.marks: tuple | None = None

    def __getstate__(self):
        return self.__dict__ | {"tail": None}

    def symbolise(self, h: np.ndarray, shape: np.ndarray):
        """For each word its place in the table (or -1), its shape's number and its symbol."""
        at = self.words.find(h)
        kind = self.shapes.find(shape) + 1
        symbol = self.symbol_of[at]
        return at, kind, np.where(symbol >= 0, symbol, kind + RARE)

    def sequence(self, symbol: np.ndarray, first: np.ndarray):
        """Symbols of all rows, each with its begin and its end; and where each row's first word stands."""
        rows = len(first) - 1
        start = first[:-1] + 2 * np.arange(rows) + 1
        out = np.empty(first[-1] + 2 * rows, np.int64)
        out[start - 1] = BEGIN
        out[start + np.diff(first)] = END
        out[np.arange(first[-1]) + 2 * K.row_of(first) + 1] = symbol
        return out, start

    @staticmethod
    def contexts(s: np.ndarray, k: int) -> list[np.ndarray]:
        """For 1 to k: the hash of so many symbols before each place; 0 where a row's begin would have to be crossed."""
        out = []
        for j in range(k):
            # A context is that of one symbol less before its last symbol, and that symbol.
            shorter = out[-1][:-1] if j else np.zeros(len(s) - 1, np.uint64)
            key = np.zeros(len(s), np.uint64)
            key[1:] = _longer(shorter, s[:-1])
            key[1:][(s[1:] == BEGIN) | (shorter == 0 if j else False)] = 0
            out.append(key)
        return out

    def logs(self, keys: list[np.ndarray], x: np.ndarray, far: list | None = None) -> np.ndarray:
        """Natural logarithms of the probabilities of x; keys[k - 1]: hashes of the contexts of k symbols.

        far: takes (places, hashes) of what may be in the tail and has to be added.
        """
        out = self.root[x]
        for level, key in zip(self.levels, keys):
            state = level["contexts"].find(key)
            near = state >= 0
            out[near] += level["back"][state[near]]
            if far is not None and self.marks:
                away = np.flatnonzero(~near & (key != 0) & K.marked(self.marks[0], key))
                far.append((away, key[away]))
                near[away] = True
            # Contexts that the bit map lets through by mistake have no entries.
            own = np.flatnonzero(near)
            hashes = _entry(key[own], x[own])
            entry = level["entries"].find(hashes)
            hit = entry >= 0
            out[own[hit]] += level["log"][entry[hit]]
            if far is not None and self.marks:
                miss = np.flatnonzero(~hit)
                miss = miss[K.marked(self.marks[1], hashes[miss])]
                far.append((own[miss], hashes[miss]))
        return out

    def add(self, contexts, entries):
        """Adds a level: columns (key, back) of contexts, (key, x, log) of entries, of which log adds to back."""
        key, x, log = entries
        self.levels.append({"contexts": K.Lookup(contexts[0].view(np.uint64)), "back": contexts[1], "entries": K.Lookup(_entry(key.view(np.uint64), x)), "log": log})


def _longer(key: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The hash of the context that has x behind the symbols of `key` (0: none)."""
    return K.mix(key * _G + x.astype(np.uint64) + K.U(1))


def _grown(batches):
    """(key, x, s1, ..., total): the context of which x comes `total` times behind `key`, and its own suffixes."""
    for batch in batches:
        values = dict(zip(batch.schema.names, (c.to_numpy(zero_copy_only=False) for c in batch.columns)))
        x, total = values.pop("x"), values.pop("total")
        shorter = [np.zeros(len(x), np.uint64), *(values[f"s{j}"].view(np.uint64) for j in range(1, len(values))), values["key"].view(np.uint64)]
        *suffixes, key = (_longer(c, x) for c in shorter)
        yield from _emit([key, *suffixes, total], ["key", *(f"s{j}" for j in range(1, len(suffixes) + 1)), "total"])


def _entry(key: np.ndarray, x: np.ndarray) -> np.ndarray:
    return ~K.mix(key * _G + x.astype(np.uint64))  # inverted, since contexts are hashed alike


def _entries(batches):
    """(key, value) of entries (key, x, log)."""
    for batch in batches:
        key, x, log = (batch.column(batch.schema.get_field_index(c)) for c in ("key", "x", "log"))
        hashes = _entry(key.to_numpy(zero_copy_only=False).view(np.uint64), x.to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), log], names=["key", "value"])


def _merged(parts: list[tuple]) -> tuple:
    """Rows (key, x, n) with the n of equal (key, x) added."""
    key, x, n = (np.concatenate(c) for c in zip(*parts))
    order, start = _equal(_pair(key, x))
    at = order[start]
    return key[at], x[at], np.add.reduceat(n[order], start) if len(at) else n


def _pair(key: np.ndarray, x: np.ndarray) -> np.ndarray:
    return K.mix(key * _G + x.astype(np.uint64))


def _varints(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits each, of which the last of a number is below 128; and where each number starts (one more)."""
    size = np.ones(len(v), np.int64)
    for k in range(7, int(v.max(initial=K.U(0))).bit_length(), 7):
        size += v >> K.U(k) > 0
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(at[-1], np.uint8)
    for k in range(int(size.max(initial=0))):
        own = np.flatnonzero(size > k)
        out[at[own] + k] = (v[own] >> K.U(7 * k)).astype(np.uint8) & 127 | ((size[own] > k + 1) << 7).astype(np.uint8)
    return out, at


def _numbers(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1])[: len(last)]
    size = last - first
    out = (data[first] & 127).astype(np.uint64)
    for k in range(1, int(size.max(initial=0)) + 1):
        own = np.flatnonzero(size >= k)
        out[own] |= (data[first[own] + k] & 127).astype(np.uint64) << K.U(7 * k)
    return out


def _ordered(key: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The order by key and then by x, which isn't negative; faster than np.lexsort where a key's number and x fit into 63 bits."""
    order, start = _equal(key)
    bits = int(x.max(initial=0)).bit_length()
    if bits + len(start).bit_length() > 63:
        return np.lexsort((x, key))
    number = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(key))))
    return order[np.argsort(number << bits | x[order])]


def _packed(key: np.ndarray, x: np.ndarray, n: np.ndarray):
    """(key, pairs) of rows (key, x, n): a row for each context, with its x in order, each as the distance from the one before, and their n."""
    order = _ordered(key, x)
    for k in range(0, len(order), 200_000):
        own = order[k : k + 200_000]
        u, y = key[own], x[own].astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
        step = np.diff(y, prepend=0)
        step[start] = y[start]
        data, at = _varints(np.stack([step, n[own]], 1).astype(np.uint64).ravel())
        offs = pa.array(np.append(at[2 * start], len(data)), pa.int32())
        pairs = pa.Array.from_buffers(pa.binary(), len(start), [None, offs.buffers()[1], pa.py_buffer(data)])
        yield pa.RecordBatch.from_arrays([pa.array(u[start].view(np.int64)), pairs], names=["key", "pairs"])


def _unpacked(pairs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, x and n of what `_packed` gave."""
    offs = np.frombuffer(pairs.buffers()[1], np.int32)[pairs.offset : pairs.offset + len(pairs) + 1].astype(np.int64)
    data = np.frombuffer(pairs.buffers()[2], np.uint8)[offs[0] : offs[-1]] if pairs.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = np.concatenate([[0], np.cumsum(data < 128)])[offs - offs[0]] // 2
    step, n = _numbers(data).astype(np.int64).reshape(-1, 2).T
    row = K.row_of(first)
    x = np.cumsum(step)
    return row, x - np.concatenate([[0], x])[first[row]], n


def _next_symbols(batches, model: Model, k: int, wanted: np.ndarray | None, shorter: np.ndarray | None):
    """(key, pairs): counts of the symbols behind the contexts of k symbols that are wanted (None: any), as `_packed` gives
    them. A symbol that is too rare behind the context's own suffix (whose pairs are in the bit map `shorter`) is too rare here."""
    parts, fresh = [], 0
    for batch in batches:
        for _, _, data, offs in K.slices(batch, most=SLICE):
            h, shape, first = _tokens(data, offs)
            s, _ = model.sequence(model.symbolise(h, shape)[2], first)
            keys = model.contexts(s, k)
            own = np.flatnonzero(keys[-1])
            if wanted is not None:
                own = own[K.marked(wanted, keys[-1][own])]
                own = own[K.marked(shorter, _pair(keys[-2][own], s[own]))]
            parts.append((keys[-1][own], s[own], np.ones(len(own), np.int64)))
            fresh += len(own)
            if fresh > max(HELD, len(parts[0][0])):
                parts, fresh = [_merged(parts)], 0
                if len(parts[0][0]) > EMITTED:
                    yield from _packed(*parts.pop())
    if parts:
        yield from _packed(*_merged(parts))
    parts.clear()
    K.release()


def _lists(values, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values))


def _gathered(batches, kept: float, root: np.ndarray | None):
    """(key, total, s1, ..., x, n, value): the next symbols that occur `kept` times behind each context that has a total;
    rows of counts and the row of the total come together, sorted by key. root: the values, null if None."""
    held: list = []

    def done(part):
        names = part.schema.names
        key = part["key"].to_numpy()
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        row, x, n = _unpacked(part["pairs"].combine_chunks().fill_null(b""))
        group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(key))))
        g, x, n = _merged([(group[row].astype(np.uint64), x, n)])
        there = part["total"].is_valid().to_numpy()
        known = np.full(len(start), -1)
        known[group[there]] = np.flatnonzero(there)
        ok = (n >= kept) & (known[g.astype(np.int64)] >= 0)
        g, x, n = g[ok].astype(np.int64), x[ok], n[ok]
        order = np.lexsort((x, g))
        g, x, n = g[order], x[order], n[order]
        own, first = np.unique(g, return_index=True)
        for k in range(0, len(own), 1000):
            cut = np.append(first, len(g))[k : k + 1001]
            at = slice(cut[0], cut[-1])
            fixed = part.select([c for c in names if c != "pairs"]).take(pa.array(known[own[k : k + 1000]])).combine_chunks()
            out = [fixed[c].combine_chunks() for c in fixed.schema.names] + [_lists(x[at].astype(np.int32), cut - cut[0]), _lists(n[at], cut - cut[0])]
            out.append(_lists(root[x[at]], cut - cut[0]) if root is not None else pa.nulls(len(cut) - 1, pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(out, names=[*fixed.schema.names, "x", "n", "value"])

    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > GATHERED:
            part = pa.Table.from_batches(held)
            key = part["key"].to_numpy()
            whole = int(np.searchsorted(key, key[-1]))  # the last context may go on
            if whole:
                yield from done(part.slice(0, whole))
            held = part.slice(whole).to_batches()
            size = sum(x.nbytes for x in held)
    if held and sum(len(x) for x in held):
        yield from done(pa.Table.from_batches(held))
    held.clear()
    K.release()


def _flat(batch: pa.RecordBatch, *names: str):
    """The row's number and the entries of each list of a batch."""
    lists = [batch.column(batch.schema.get_field_index(c)) for c in names]
    sizes = lists[0].value_lengths().to_numpy()
    return np.repeat(np.arange(len(sizes)), sizes), *(x.flatten().to_numpy(zero_copy_only=False) for x in lists)


def _judged(batches, divergence: float):
    """The rows with `back`, null where the context isn't retained."""
    for batch in batches:
        row, n, value = _flat(batch, "n", "value")
        total = batch.column(batch.schema.get_field_index("total")).to_numpy()
        p = (n - DISCOUNT) / total[row]
        sums = lambda x, row=row, rows=len(total): np.bincount(row, weights=x, minlength=rows)
        left = lambda x: np.log(np.maximum(1 - x, 1e-12))
        part = sums(p)
        back = left(part) - left(sums(np.exp(value)))
        gain = sums(p * (np.log(p) - value)) + (1 - part) * back
        yield batch.append_column("back", pa.array(back, mask=gain < divergence))


def _hashes(batches, by: str):
    """The pairs (by, x) as hashes."""
    for batch in batches:
        row, x = _flat(batch, "x")
        key = batch.column(batch.schema.get_field_index(by)).to_numpy().view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(_pair(key[row], x).view(np.int64))], names=["h"])


def _values(batches, needed: np.ndarray):
    """(key, x, value): what each pair that may be needed is worth to the longer contexts."""
    for batch in batches:
        row, x, n, value = _flat(batch, "x", "n", "value")
        key, total = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("key", "total"))
        retained = batch.column(batch.schema.get_field_index("back")).is_valid().to_numpy(zero_copy_only=False)
        own = np.flatnonzero(K.marked(needed, _pair(key.view(np.uint64)[row], x)))
        row, x, n, value = (c[own] for c in (row, x, n, value))
        value = np.where(retained[row], np.log((n - DISCOUNT) / total[row]), value)
        yield pa.RecordBatch.from_arrays([pa.array(key[row]), pa.array(x), pa.array(value)], names=["key", "x", "value"])


def _level(counted: DataFrame, totals: DataFrame, model: Model, lower: DataFrame | None, k: int, kept: float, divergence: float) -> DataFrame:
    """A row for each context of k symbols with kept entries: (key, total, s1, ..., x, n, value, back). x, n: lists of the
    next symbols; value: their logarithms in the suffix; back: null where the context isn't retained.

    counted: (key, pairs); totals: (key, total, s1, ...): how often a context occurs, and its suffixes; lower: what this
    function gave for the contexts of one symbol less. A pair is kept only if that of the suffix is, so all have their value there.
    """
    fixed = ["key", "total", *(f"s{j}" for j in range(1, k))]
    root = model.root if lower is None else None
    none = F.lit(None).cast("long")
    both = counted.select(*(F.col(c) if c == "key" else none.alias(c) for c in fixed), "pairs").union(totals.select(*fixed, F.lit(None).cast("binary").alias("pairs")))
    schema = ", ".join(f"{c} long" for c in fixed) + ", x array<int>, n array<long>, value array<double>"
    rows = both.repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: _gathered(b, kept, root), schema)
    needed = None
    if lower is not None:
        rows = stored(rows)
        s = f"s{k - 1}"
        needed = counted.sparkSession.sparkContext.broadcast(marks(rows.mapInArrow(lambda b: _hashes(b, s), "h long"), F.col("h")))
        values = lower.mapInArrow(lambda b, held=needed: _values(b, held.value), "key long, x int, value double").withColumnRenamed("key", s)
        one = rows.select(*fixed, F.explode(F.arrays_zip("x", "n")).alias("t")).select(*fixed, "t.x", "t.n").join(values, [s, "x"])
        rows = one.groupBy("key").agg(*(F.any_value(c).alias(c) for c in fixed[1:]), F.collect_list(F.struct("x", "n", "value")).alias("t"))
        rows = rows.select(*fixed, "t.x", "t.n", "t.value")
    out = stored(rows.mapInArrow(lambda b: _judged(b, divergence), schema + ", back double"))
    if needed:
        needed.destroy()
    return out


def train(
    docs: DataFrame, text_col="text", *, depth=4, symbol_share=1e-4, context_share=1e-4, entry_share=1e-6, table_share=1e-6, divergence=0.02, symbol_count=1000, context_count=1000, entry_count=10, broadcast_rows=1 << 20
) -> tuple[Model, DataFrame]:
    """The model of the texts, and (h, n): the counts of all words."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(F.col(text_col).alias("text"))
    counts = rows.mapInArrow(_counted, "h long, shape long, n long").groupBy("h").agg(F.any_value("shape").alias("shape"), F.sum("n").alias("n"))
    counts = stored(counts)
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = rows.count()
    total, distinct = sums["n"] + ends, sums["v"] + (ends > 0)
    # Of the tables that come to the driver only the symbols' grows: a word for `symbol_count` tokens at most.
    least = max(1.0, min(symbol_count, symbol_share * total))
    words = columns(counts.where(F.col("n") >= min(least, max(1, table_share * total))).select("h", "n").orderBy("h"))
    below = counts.where(F.col("n") < least).groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.count_if(F.col("n") == 1).alias("once"))
    shapes = columns(below.where(F.col("n") >= least).orderBy("shape"))
    every = below.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "v", "once"))).first()
    rest = [x - int(c.sum()) for x, c in zip(every, shapes[1:])]
    model = Model(total, distinct, ends, (words[0].view(np.uint64), words[1]), (shapes[0].view(np.uint64), *shapes[1:]), rest, least)
    if not ends:
        return model, counts.select("h", "n")
    often, kept = (max(2, min(c, share * total)) for c, share in ((context_count, context_share), (entry_count, entry_share)))
    there = np.flatnonzero(model.preceding >= often)
    totals = spark.createDataFrame(pa.table({"key": K.mix(there.astype(np.uint64) + K.U(1)).view(np.int64), "total": model.preceding[there]}), "key long, total long")
    wanted, shorter, level, far = None, None, None, []
    for k in range(1, depth + 1):
        held = sc.broadcast((model, wanted, shorter))
        counted = rows.mapInArrow(lambda b, h=held, k=k: _next_symbols(b, h.value[0], k, *h.value[1:]), "key long, pairs binary")
        level = _level(counted, totals, model, level, k, kept, divergence)
        held.destroy()  # the level is stored, and each executor would keep a copy on its disk
        contexts = level.where("back is not null").select("key", "total", "back")
        pairs = level.select("key", "total", "back", *(f"s{j}" for j in range(1, k)), F.explode(F.arrays_zip("x", "n", "value")).alias("t"))
        entries = pairs.where("back is not null").select("key", "t.x", "t.n", (F.log((F.col("t.n") - DISCOUNT) / F.col("total")) - F.col("t.value") - F.col("back")).alias("log"))
        near, close = most_frequent(contexts, "total", broadcast_rows), most_frequent(entries, "n", broadcast_rows)
        model.add(
            columns(contexts.where(F.col("total") >= near).select("key", "back").orderBy("key")),
            columns(entries.where(F.col("n") >= close).select("key", "x", "log").orderBy("key", "x")),
        )
        if near or close:
            away = contexts.where(F.col("total") < near).select("key", F.col("back").alias("value"))
            far.append((away, entries.where(F.col("n") < close).mapInArrow(_entries, "key long, value double")))
        if k < depth:
            # A context is as often followed by something as it occurs, so the pairs have the longer ones' totals.
            more = pairs.where((F.col("t.n") >= often) & (F.col("t.x") != END)).select("key", "t.x", *(f"s{j}" for j in range(1, k)), F.col("t.n").alias("total"))
            totals = stored(more.mapInArrow(_grown, ", ".join(f"{c} long" for c in ["key", *(f"s{j}" for j in range(1, k + 1)), "total"])))
            wanted = marks(totals, F.col("key"))
            if not wanted.any():
                break
            shorter = marks(level.mapInArrow(lambda b: _hashes(b, "key"), "h long"), F.col("h"))
    if far:
        away, rare = (reduce(DataFrame.union, part) for part in zip(*far))
        model.marks = marks(away, F.col("key")), marks(rare, F.col("key"))
        model.tail = away.union(rare)
    return model, counts.select("h", "n")


#: What the rows that are dealt by hash are, in the order in which a part takes them.
WORDS, TAIL, ASKED, ASKED_TAIL, DOCUMENT = range(5)


def _binary(data: np.ndarray, offs: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offs) - 1, [None, pa.array(offs, pa.int32()).buffers()[1], pa.py_buffer(data)])


def _some(schema: pa.Schema, rows: int, **values) -> pa.RecordBatch:
    """A batch of the schema; columns that aren't given are null, and a number stands for all rows."""
    full = (values.get(f.name) for f in schema)
    made = (pa.nulls(rows, f.type) if v is None else pa.array(np.full(rows, v), f.type) if np.isscalar(v) else v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, f.type) for f, v in zip(schema, full))
    return pa.RecordBatch.from_arrays(list(made), schema=schema)


def _cut(u: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Of hashes in order: the parts, by leading bits, that have some; and where each starts (one more)."""
    part = (u >> K.U(64 - parts.bit_length() + 1)).astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(u) else np.zeros(0, np.int64)
    return part[start], np.append(start, len(u))


def _known(batches, parts: int, schema: pa.Schema, role: int):
    """The rows (key, n) or (key, value) of a table, packed by parts."""
    held: list[tuple] = []
    fresh = 0

    def packed():
        u, n = (np.concatenate(c) for c in zip(*held))
        held.clear()
        order = np.argsort(u)
        part, cut = _cut(u[order], parts)
        more, at = _varints(n[order].astype(np.uint64)) if role == WORDS else (n[order].view(np.uint8), 8 * np.arange(len(n) + 1))
        return _some(schema, len(part), part=part, role=role, a=_binary(u[order].view(np.uint8), 8 * cut), b=_binary(more, at[cut]))

    for batch in batches:
        held.append((batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()))
        fresh += len(batch)
        if fresh > HELD:
            fresh = 0
            yield packed()
    if fresh:
        yield packed()


def _asked(u: np.ndarray, row: np.ndarray, kind: np.ndarray, parts: int, schema: pa.Schema, **values) -> pa.RecordBatch:
    """What a group of texts asks for, packed by parts. a: each hash; b: how often each is asked for and its kind, then the text of each time."""
    order = np.argsort(u)
    u, row = u[order], row[order]
    start = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
    part, cut = _cut(u[start], parts)
    ends = np.append(start, len(u))
    own, at = _varints(np.stack([np.diff(ends), kind[order[start]]], 1).astype(np.uint64).ravel())
    texts, to = _varints(row.astype(np.uint64))
    at, to = at[2 * cut], to[ends[cut]]
    both = np.concatenate([x for k in range(len(part)) for x in (own[at[k] : at[k + 1]], texts[to[k] : to[k + 1]])])
    return _some(schema, len(part), part=part, a=_binary(u[start].view(np.uint8), 8 * cut), b=_binary(both, at + to), **values)


def _told(a: bytes, b: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The hashes and kinds of a row that `_asked` gave, and for each time one is asked for its place among them and the text."""
    u, numbers = np.frombuffer(a, np.uint64), _numbers(np.frombuffer(b, np.uint8)).astype(np.int64)
    often, kind = numbers[: 2 * len(u)].reshape(-1, 2).T
    return u, kind.astype(np.uint64), np.repeat(np.arange(len(u)), often), numbers[2 * len(u) :]


def _scored(batches, model: Model, parts: int, schema: pa.Schema):
    """For groups of texts: a row for each text with its sums over what is at hand, and what the group asks of each part:
    the counts of its other words, and the values of contexts and entries that may be in the tail."""
    ln10 = np.log(10)
    texts, words, keys, size, number = [], [], [], [0, 0], 0
    task = TaskContext.get()
    place = task.partitionId() if task else 0

    def done():
        nonlocal number
        one = pa.Table.from_batches(texts).combine_chunks().to_batches()[0]
        # The same texts in another order, as a repeated task may read them, are another group.
        seen = K.mix(np.cumsum(K.mix(one.column("body").to_numpy().view(np.uint64) + np.arange(len(one), dtype=np.uint64)))).sum()
        group = int(K.mix(np.array([seen], np.uint64) + K.mix(np.array([place << 32 | number], np.uint64) * _G)).view(np.int64)[0])
        number += 1
        values = {c: one.column(c) for c in one.schema.names if c != "body"}
        yield _some(schema, len(one), part=(group + np.arange(len(one))) % parts, role=DOCUMENT, g=group, row=np.arange(len(one)), **values)
        for role, asked in ((ASKED, words), (ASKED_TAIL, keys)):
            if asked and sum(len(x[0]) for x in asked):
                yield _asked(*(np.concatenate(x) for x in zip(*asked)), parts, schema, role=role, g=group)
            asked.clear()
        texts.clear()
        size[:] = 0, 0

    for batch in batches:
        for lo, hi, data, offs in K.slices(batch, most=SLICE):
            h, shape, first = _tokens(data, offs)
            at, kind, symbol = model.symbolise(h, shape)
            row, rows = K.row_of(first), hi - lo
            there = at >= 0
            log = np.zeros(len(h))
            log[there] = np.log10(model.counts[at[there]] + 0.5)
            n_tokens = np.diff(first) + 1
            total = lambda x: np.bincount(row, weights=x, minlength=rows)
            base = total(log) + np.log10(model.ends + 0.5) - n_tokens * np.log10(model.bottom)
            inner = np.where(symbol == kind + RARE, log + model.known[kind], 0)
            s, start = model.sequence(symbol, first)
            more: list[tuple] = []
            score = model.logs(model.contexts(s, max(1, len(model.levels))), s, more) / ln10
            score[s == BEGIN] = 0
            at, far_keys = (np.concatenate(x) for x in zip(*more)) if more else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
            score = np.add.reduceat(score, start - 1) + total(inner)
            far = np.flatnonzero(~there)
            tails = np.searchsorted(start - 1, at, side="right") - 1
            words.append((h[far], (row[far] + size[0]).astype(np.int32), kind[far].astype(np.int32)))
            keys.append((far_keys, (tails + size[0]).astype(np.int32), np.zeros(len(at), np.int32)))
            asked = np.bincount(row[far], minlength=rows) + np.bincount(tails, minlength=rows)
            known = (total(there) + (model.ends > 0)).astype(np.int64)
            out = [batch.column(i).slice(lo, rows) for i in (0, 1)] + [pa.array(n_tokens, pa.int64()), pa.array(known), pa.array(base), pa.array(score), pa.array(asked, pa.int64())]
            texts.append(pa.RecordBatch.from_arrays(out, names=["doc_id", "body", "n_tokens", "n_known", "base_score", "score", "asked"]))
            size[:] = size[0] + rows, size[1] + len(far) + len(at)
            if size[1] > HELD or size[0] > 65536:
                yield from done()
    if texts:
        yield from done()
    K.release()


def _answers(batches, schema: pa.Schema):
    """The texts' rows as they are, and what each group is told by each part (row). WORDS, a: for each time a word is asked
    for the text and twice the word's count, or twice its kind and one if it doesn't occur; TAIL, a: the texts, b: the sum
    of each. asked: how much was asked for.

    The rows of a part come together, those of its tables first.
    """
    part, table, found = None, {}, {}
    for batch in batches:
        roles = batch.column("role").to_numpy()
        out = batch.filter(pa.array(roles == DOCUMENT))
        if len(out):
            yield out.select(schema.names)
        parts, groups, a, b = (batch.column(c) for c in ("part", "g", "a", "b"))
        for i in np.flatnonzero(roles != DOCUMENT):
            if parts[i].as_py() != part:
                part, table, found = parts[i].as_py(), {WORDS: [], TAIL: []}, {}
            x, y, role = a[i].as_py(), b[i].as_py(), int(roles[i])
            if role in table:
                values = _numbers(np.frombuffer(y, np.uint8)) if role == WORDS else np.frombuffer(y, np.float64)
                table[role].append((np.frombuffer(x, np.uint64), values))
                continue
            kept = WORDS if role == ASKED else TAIL
            if kept not in found:
                u, v = (np.concatenate(c) for c in zip(*table[kept])) if table[kept] else (np.zeros(0, np.uint64), np.zeros(0, np.uint64 if kept == WORDS else float))
                found[kept] = K.Lookup(u), np.append(v, v.dtype.type(0))
            lookup, values = found[kept]
            u, kind, at, text = _told(x, y)
            value = values[lookup.find(u)]
            if kept == WORDS:
                code = np.where(value > 0, value * K.U(2), kind * K.U(2) + K.U(1))[at]
                x, y = _varints(np.stack([text.astype(np.uint64), code], 1).ravel())[0], None
            else:
                sums = np.bincount(text, weights=value[at])
                own = np.flatnonzero(sums)
                x, y = _varints(own.astype(np.uint64))[0], [sums[own].tobytes()]
            yield _some(schema, 1, role=kept, g=groups[i].as_py(), row=part, a=[x.tobytes()], b=y, asked=len(text))


def _added(batches, cost: np.ndarray, schema: pa.Schema):
    """The rows of texts with what their groups were told added; a group's rows come together. cost: of an unseen word, by kind."""
    held: list[pa.RecordBatch] = []

    def done(part: pa.Table):
        part = part.sort_by([("role", "ascending"), ("row", "ascending")])
        roles, told = part["role"].to_numpy(), part["asked"].to_numpy()
        texts = part.filter(pa.array(roles == DOCUMENT)).combine_chunks()
        if told[roles == DOCUMENT].sum() != told[roles != DOCUMENT].sum():
            raise RuntimeError("texts came in another order when a task was repeated; store them before they are scored")
        known, base, more = (np.zeros(len(texts)) for _ in range(3))
        for i in np.flatnonzero(roles != DOCUMENT):
            numbers = _numbers(np.frombuffer(part["a"][i].as_py(), np.uint8))
            if roles[i] == TAIL:
                more[numbers.astype(np.int64)] += np.frombuffer(part["b"][i].as_py(), np.float64) / np.log(10)
                continue
            text, code = numbers.astype(np.int64).reshape(-1, 2).T
            unseen, n = code & 1 > 0, code >> 1
            log = np.log10(np.where(unseen, 0, n) + 0.5)
            for sums, value in ((known, ~unseen), (base, log), (more, np.where(unseen, cost[np.where(unseen, n, 0)], log))):
                sums += np.bincount(text, weights=value, minlength=len(texts))
        plus = {"n_known": known.astype(np.int64), "base_score": base, "score": more}
        values = {c: (texts[c].to_numpy() + plus[c]) if c in plus else texts[c].combine_chunks() for c in schema.names}
        yield _some(schema, len(texts), **values)

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        if held[0].column("g")[0] == batch.column("g")[-1]:
            continue
        part = pa.Table.from_batches(held)
        cuts = np.flatnonzero(np.diff(part["g"].to_numpy())) + 1
        for lo, hi in zip([0, *cuts[:-1]], cuts):
            yield from done(part.slice(lo, hi - lo))
        held = part.slice(cuts[-1]).combine_chunks().to_batches()  # the last group may go on
    if held:
        yield from done(pa.Table.from_batches(held))
    held.clear()
    K.release()


def scores(docs: DataFrame, model: Model, counts: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (both log10) for each row of `docs`.

    Texts are scored in groups. What a group needs of the distributed tables it asks of parts of them, by leading bits of
    the hashes, and is told for each text; hashes, counts and texts travel packed, and a text's own row is known by its
    group and its place there.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("body"), F.col(text_col).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["doc_id"].dataType.simpleString()
    parts = 64
    while parts * 65536 < model.distinct:
        parts *= 2
    own = f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double"
    told = f"role int, g long, a binary, b binary, row int, asked long, {own}"
    dealt, told_, own_ = (to_arrow_schema(StructType.fromDDL(x)) for x in (f"part int, {told}", told, own))
    packed = lambda df, role: df.mapInArrow(lambda b: _known(b, parts, dealt, role), f"part int, {told}")
    both = rows.mapInArrow(lambda b: _scored(b, held.value, parts, dealt), f"part int, {told}").union(packed(counts.select("h", "n"), WORDS))
    if model.tail is not None:
        both = both.union(packed(model.tail.select("key", "value"), TAIL))
    answers = both.repartition("part").sortWithinPartitions("part", "role").mapInArrow(lambda b: _answers(b, told_), told)
    cost = model.unseen - model.known
    out = answers.repartition("g").sortWithinPartitions("g").mapInArrow(lambda b: _added(b, cost, own_), own)
    return out.select("doc_id", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def op7_suffix_tree(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))
    model, counts = train(docs.where(~held_out))
    out = scores(docs, model, counts)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
