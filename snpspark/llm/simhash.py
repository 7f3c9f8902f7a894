"""SimHash fingerprints and near-duplicate groups by tiled comparison.

A fingerprint's bit is set where more than half of the hashes of a text's word shingles have it set. Equal fingerprints
are merged first; the distinct ones are dealt into tiles, and a compared pair of tiles is one exclusive-or and bit
count of all rows against all columns. A task reports a forest that connects what its links connect, so a large group
gives links in proportion to its members.

`near_duplicates` finds every link within a small radius. Its tiles are made by the population counts of the
fingerprint's parts (four of 16 bits): two fingerprints differ in at least as many bits as the sum of the differences
of these counts, so a pair of tiles is compared only if that sum is within the radius; all other pairs of tiles are
skipped unseen. Tiles hold TILE fingerprints on average at most: a crowded combination of counts is split into several.

`similar_documents` groups by the similarity (Jaccard) of whole sets of shingles, for which the radius of a fingerprint
is too wide to skip much. So only fingerprints that agree in one of several bands of bits meet in a tile; comparison
there gives candidates, and the sets of all texts that hang together as candidates are intersected exactly.

Edge cases: null and empty texts have the fingerprint zero, and an empty set; they link like any other. Null ids are
larger than all others and never a component's id unless all its ids are null. Each input row gives a row, repeated rows
too. Other columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import bounded, fresh, marks, stored, table
from .components import components, forest

TILE = 1024
LAST = (1 << 63) - 1  # stands for a null id
CHUNK = 1 << 18  # shingles of one text that are hashed at once
PARTS = 4
_GOLD = K.U(0x9E3779B97F4A7C15)
# Each bit of a byte as a byte of its own: sums of up to 255 such words don't overflow a place.
_SPREAD = np.packbits(np.zeros((1, 64), np.uint8), axis=1).view(np.uint64).repeat(256)
for _b in range(256):
    _SPREAD[_b] = sum(1 << (8 * k) for k in range(8) if _b >> k & 1)


def _bits(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each row, none of them empty, how many of its hashes have each of the 64 bits."""
    runs = [np.arange(a, b, 255) for a, b in zip(first[:-1], first[1:])]
    cut = np.concatenate(runs)
    part = np.add.reduceat(_SPREAD[h.view(np.uint8).reshape(-1, 8)], cut, axis=0)
    heads = np.concatenate([[0], np.cumsum([len(r) for r in runs])[:-1]])
    return np.add.reduceat(np.ascontiguousarray(part).view(np.uint8).reshape(len(cut), 64).astype(np.int64), heads, axis=0)


def _majority(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each row the bits that over half of its hashes have."""
    n = np.diff(first)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        bits = _bits(h, np.concatenate([first[full], first[-1:]])) * 2 > n[full][:, None]
        out[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _hashes(text: bytes, end: np.ndarray, shingle: int, lo: int, hi: int) -> np.ndarray:
    """XXH64 of shingles lo to hi of a text of words that end at `end`, one space apart; a shorter text is one shingle."""
    import xxhash

    digest = partial(xxhash.xxh64_intdigest, seed=42)
    last = min(shingle, len(end)) - 1
    start = np.concatenate([[0], end[:-1] + 1])[lo:hi].tolist()
    return np.fromiter((digest(text[x:y]) for x, y in zip(start, end[lo + last : hi + last].tolist())), np.uint64, hi - lo)


def _fingerprinted(batches, shingle: int):
    for batch in batches:
        for lo, hi, data, offs in K.slices(batch):
            data = K.LOWER[data]
            hashes, first, long = [], [0], {}
            for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
                word = data[a:b].tobytes().split()
                n = 0
                if word:
                    text = b" ".join(word)
                    end = np.cumsum(np.fromiter(map(len, word), np.int64, len(word)) + 1) - 1
                    n = max(1, len(word) - shingle + 1)
                    if n <= CHUNK:
                        hashes.append(_hashes(text, end, shingle, 0, n))
                    else:  # bit counts of parts add up
                        counts = sum(_bits(h, np.array([0, len(h)]))[0] for k in range(0, n, CHUNK) for h in [_hashes(text, end, shingle, k, min(n, k + CHUNK))])
                        long[i], n = np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0], 0
                first.append(first[-1] + n)
            fp = _majority(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.array(first))
            for i, bits in long.items():
                fp[i] = bits
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", *, shingle=3) -> DataFrame:
    """doc_id and fp, a long with the fingerprint's bits, for each row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda b: _fingerprinted(b, shingle), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _shingled(data: np.ndarray, offs: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each row in ascending order, and each row's first; a shorter text is one shingle."""
    data = K.LOWER[data]
    starts, ends, first = K.words(data, offs)
    h = K.span_hashes(data, starts, ends, 5)
    n = np.diff(first)
    w = K.window_hashes(h, shingle)
    at = np.flatnonzero(K.whole_windows(first, shingle)[: len(w)])
    short = np.flatnonzero((n > 0) & (n < shingle))
    own = np.array([K.window_hashes(h[first[i] : first[i + 1]], int(n[i]))[0] for i in short], np.uint64)
    of, w = np.concatenate([K.row_of(first)[at], short]), np.concatenate([w[at], own])
    order = np.lexsort((w, of))
    of, w = of[order], w[order]
    fresh_ = np.ones(len(w), bool)
    fresh_[1:] = (w[1:] != w[:-1]) | (of[1:] != of[:-1])
    of, w = of[fresh_], w[fresh_]
    return w, np.searchsorted(of, np.arange(len(offs)))


def _signed(batches, shingle: int, words: int):
    """node (a digest of the text's set of shingles), n (its size) and `words` longs of majority bits over it."""
    for batch in batches:
        for lo, hi, data, offs in K.slices(batch):
            w, cut = _shingled(data, offs, shingle)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(K.mix(w + _GOLD), dtype=np.uint64)])[cut]
            n = np.diff(cut)
            node = K.mix(np.diff(sums) + n.astype(np.uint64) * _GOLD)
            sig = np.stack([_majority(K.mix(w + K.U((k + 1) * int(_GOLD) % 2**64)), cut) for k in range(words)], 1)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(sig.view(np.int64).ravel()), words).cast(pa.list_(pa.int64()))
            own = [batch.column(i).slice(lo, hi - lo) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(node.view(np.int64)), pa.array(n, pa.int64()), lists], names=["doc", "body", "node", "n", "sig"])


def _sets(batches, shingle: int, wanted: np.ndarray):
    """The sets of shingles of rows whose key the bit map has."""
    for batch in batches:
        for lo, hi, data, offs in K.slices(batch):
            key = batch.column(batch.schema.get_field_index("key")).slice(lo, hi - lo).to_numpy().view(np.uint64)
            keep = pa.array(K.marked(wanted, key))
            w, cut = _shingled(data, offs, shingle)
            lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(w.view(np.int64)))
            own = [batch.column(i).slice(lo, hi - lo) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([x.filter(keep) for x in (*own, lists)], names=["doc", "body", "set"])


def _lists(batch, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of arrays of (node, a list): rows' first items, nodes, and the lists' offsets and values."""
    col = batch.column(batch.schema.get_field_index(name))
    at, items = col.offsets.to_numpy(), col.values
    inner = items.field(1)
    return at, items.field(0).to_numpy(), inner.offsets.to_numpy(), inner.values.to_numpy().view(np.uint64)


def _banded(batches, picks: np.ndarray):
    """(key, node, sig): a row for each band of a signature, the key made of the band's number and its bits."""
    weight = np.uint64(1) << np.arange(picks.shape[1], dtype=np.uint64)
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            sig = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
            bits = np.unpackbits(np.ascontiguousarray(sig).view(np.uint8), axis=1, bitorder="little")
            for j, pick in enumerate(picks):
                key = K.mix((bits[:, pick].astype(np.uint64) @ weight) * _GOLD + K.U(j + 1))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), part.column(0), part.column(1)], names=["key", "node", "sig"])


def _forests(found, most=2_000_000):
    """Batches (u, v) of a forest over pairs of arrays u, v, which are merged whenever there are `most`."""
    us, vs, held = [], [], 0
    for x, y in found:
        us.append(x)
        vs.append(y)
        held += len(x)
        if held > most:
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            us, vs, held = [u], [v], len(u)
    if held:
        u, v = forest(np.concatenate(us), np.concatenate(vs))
        for k in range(0, len(u), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(u[k : k + 100_000]), pa.array(v[k : k + 100_000])], names=["u", "v"])


def _candidates(batches, most: int):
    """Pairs of a tile and another (or itself) whose signatures differ in `most` bits at most."""

    def found():
        for batch in batches:
            (ao, an, _, av), (bo, bn, _, bv) = _lists(batch, "a"), _lists(batch, "b")
            width = max(1, len(av) // max(1, len(an)))
            av, bv = av.reshape(-1, width), bv.reshape(-1, width)
            for i in range(batch.num_rows):
                x, own = av[ao[i] : ao[i + 1]], batch.column(2)[i].as_py()
                y, nodes = (x, an[ao[i] :]) if own else (bv[bo[i] : bo[i + 1]], bn[bo[i] :])
                px, py = (np.bitwise_count(z).sum(1, dtype=np.int64) for z in (x, y))
                if px.min() - py.max() > most or py.min() - px.max() > most:
                    continue
                step = max(1, (1 << 18) // len(y))
                for k in range(0, len(x), step):
                    apart = sum(np.bitwise_count(x[k : k + step, j : j + 1] ^ y[None, :, j]).astype(np.uint16) for j in range(width))
                    p, q = np.nonzero(apart <= most)
                    p += k
                    if own:
                        p, q = p[p < q], q[p < q]
                    if len(p):
                        yield an[ao[i] + p], nodes[q]

    return _forests(found())


def _overlaps(x: list[np.ndarray], y: list[np.ndarray], step=8192) -> np.ndarray:
    """Sizes of the intersections of the sets in x with those in y."""
    values = np.concatenate([*x, *y])
    row = np.repeat(np.arange(len(x) + len(y)), [len(s) for s in (*x, *y)])
    _, at, n = np.unique(values, return_inverse=True, return_counts=True)
    shared = n[at] > 1
    _, at = np.unique(at[shared], return_inverse=True)
    row = row[shared]
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    out = np.zeros((len(x), len(y)), np.float32)
    for lo in range(0, int(at[-1]) + 1 if len(at) else 0, step):
        own = slice(*np.searchsorted(at, [lo, lo + step]))
        there = np.zeros((len(x) + len(y), min(step, int(at[-1]) + 1 - lo)), np.float32)
        there[row[own], at[own] - lo] = 1
        out += there[: len(x)] @ there[len(x) :].T
    return out


def _verified(batches, similarity: float):
    """Pairs of texts of a tile and another (or itself) whose sets are as similar as asked for."""

    def found():
        for batch in batches:
            (ao, an, ai, av), (bo, bn, bi, bv) = _lists(batch, "a"), _lists(batch, "b")
            for i in range(batch.num_rows):
                x = [av[ai[k] : ai[k + 1]] for k in range(ao[i], ao[i + 1])]
                own = batch.column(2)[i].as_py()
                y = x if own else [bv[bi[k] : bi[k + 1]] for k in range(bo[i], bo[i + 1])]
                both = _overlaps(x, y)
                sizes = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y])[None, :]
                p, q = np.nonzero(both * (1 + similarity) >= similarity * sizes - 1e-3)
                if own:
                    p, q = p[p < q], q[p < q]
                    yield an[ao[i] + p], an[ao[i] + q]
                else:
                    yield an[ao[i] + p], bn[bo[i] + q]

    return _forests(found())


def _near(x: np.ndarray, y: np.ndarray, own: bool, radius: int):
    """Pairs of rows that differ in at most `radius` bits, in blocks."""
    step = max(1, (1 << 20) // max(1, len(y)))
    for i in range(0, len(x), step):
        near = np.bitwise_count(x[i : i + step, None] ^ y[None, :]) <= radius
        if own:
            near &= np.arange(i, i + len(near))[:, None] < np.arange(len(y))[None, :]
        p, q = np.nonzero(near)
        if len(p):
            yield p + i, q


def _linked(batches, radius: int):
    """Links within and between tiles, as a forest over all pairs of tiles of a partition."""

    def found():
        for batch in batches:
            (ao, an, _, av), (bo, bn, _, bv) = _lists(batch, "a"), _lists(batch, "b")
            for i, own in enumerate(batch.column(batch.schema.get_field_index("own")).to_pylist()):
                x, y = an[ao[i] : ao[i + 1]], bn[bo[i] : bo[i + 1]]
                for p, q in _near(av[ao[i] : ao[i + 1]], bv[bo[i] : bo[i + 1]], own, radius):
                    yield x[p], y[q]

    return _forests(found())


def links(distinct: DataFrame, *, radius=3, parts=PARTS, tile=TILE) -> DataFrame:
    """Links (u, v) that connect the nodes whose fingerprints differ in at most `radius` bits.

    distinct: node (a long) and sig (an array of one long) of different fingerprints. Tiles are made by the population
    counts of `parts` parts.
    """
    bits = 64 // parts
    base = bits + 1
    first = F.col("sig")[0]
    count = lambda k: F.bit_count(F.shiftrightunsigned(first, bits * k).bitwiseAND((1 << bits) - 1) if parts > 1 else first)
    place = sum((count(k).cast("int") * base**k for k in range(parts)), F.lit(0))
    placed = distinct.select("node", "sig", place.alias("place"))
    # At most (bits + 1) ** parts places, 83,521 for four, whatever the number of fingerprints.
    crowd = stored(placed.groupBy("place").agg(F.count("*").alias("n")).select("place", F.ceil(F.col("n") / tile).alias("splits")))
    split = F.pmod(F.xxhash64("node"), "splits").alias("split")
    tiles = stored(placed.join(F.broadcast(crowd), "place").groupBy("place", split).agg(F.collect_list(F.struct("node", "sig")).alias("tile")))
    steps = [d for d in itertools.product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius and d >= (0,) * parts]
    moves = F.array(*(F.struct(*(F.lit(x).alias(f"d{k}") for k, x in enumerate(d))) for d in steps))
    # Which tiles meet follows from the counts alone: a row for each tile and place near it that has tiles, then one
    # for each of those tiles. So the pairs, not the places, are what is dealt out.
    left = tiles.select("place", F.col("split").alias("split_a"), F.col("tile").alias("a"), F.explode(moves).alias("d"))
    left = left.where(" and ".join(f"(floor(place / {base**k}) % {base}) + d.d{k} between 0 and {bits}" for k in range(parts)))
    moved = sum((F.col(f"d.d{k}") * base**k for k in range(parts)), F.col("place"))
    left = left.select("split_a", "a", F.col("place").alias("from"), moved.cast("int").alias("place"))
    other = F.sequence(F.when(F.col("place") == F.col("from"), F.col("split_a")).otherwise(F.lit(0)).cast("long"), F.col("splits") - 1)
    left = left.join(F.broadcast(crowd), "place").select("split_a", "a", "from", "place", F.explode(other).alias("split_b"))
    right = tiles.select("place", F.col("split").alias("split_b"), F.col("tile").alias("b"))
    pairs = left.join(right, ["place", "split_b"])
    return pairs.select("a", "b", F.expr("place = from and split_a = split_b").alias("own")).mapInArrow(lambda x: _linked(x, radius), "u long, v long")


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", *, shingle=3, radius=3, tile=TILE) -> DataFrame:
    """doc_id, fp and component_id (the smallest id that links reach) for each row of `docs`."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle=shingle))
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct.select(F.col("fp").alias("node"), F.array("fp").alias("sig")), radius=radius, tile=tile))
    least = _least(roots, distinct.select(F.col("fp").alias("node"), "least"))
    by = distinct.join(least.select(F.col("node").alias("fp"), "first"), "fp", "left").select("fp", F.coalesce("first", "least").alias("component_id"))
    return prints.join(by, "fp").select("doc_id", "fp", "component_id")


def _least(roots: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, first): for each node that links name, the least `least` of its component. nodes: (node, least)."""
    roots = stored(roots.union(roots.select("v", "v").distinct()).select(F.col("u").alias("node"), F.col("v").alias("root")).join(nodes, "node"))
    # A large component is one row of each task before the shuffle, and its members are met by a broadcast or split.
    first = bounded(roots.groupBy("root").agg(F.min("least").alias("first")))
    return roots.select("node", "root").join(first, "root").select("node", "first")


def _dealt(rows: DataFrame, group: str, item, size, tile: int) -> DataFrame:
    """(a, b, own): tiles of each group's items, and the pairs of tiles that have to be compared.

    rows: the column `group`; item: a struct of node and a list; size: what an item counts for. A group of more than
    `tile` is split into several tiles by a hash of the node, and each pair of them is a row: no task holds a group.
    """
    crowd = bounded(rows.groupBy(group).agg(F.sum(size).alias("n")).where(F.col("n") > tile).select(group, F.ceil(F.col("n") / tile).alias("splits")))
    placed = rows.join(crowd, group, "left").withColumn("split", F.when(F.col("splits").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("node"), "splits")).cast("long"))
    tiles = lambda df: df.groupBy(group, "split").agg(F.collect_list(item).alias("tile"), F.max("splits").alias("splits"))
    out = tiles(placed).select(F.col("tile").alias("a"), F.slice("tile", 1, 0).alias("b"), F.lit(True).alias("own"))
    if crowd.isEmpty():
        return out
    large = stored(tiles(placed.where("splits is not null")))
    left = large.where("split + 1 < splits").select(group, F.col("tile").alias("a"), F.explode(F.expr("sequence(split + 1, splits - 1)")).alias("split"))
    return out.union(left.join(large.select(group, "split", F.col("tile").alias("b")), [group, "split"]).select("a", "b", F.lit(False)))


def similar_documents(
    docs: DataFrame, id_col="doc_id", text_col="text", *, shingle=5, similarity=0.8, words=4, recall=0.995, tile=4096, set_tile=1 << 18
) -> DataFrame:
    """doc_id, body (its text's xxhash64), component_id, and first (the component's id and body) for each row of `docs`.

    Documents link whose sets of word shingles have a similarity (Jaccard) of at least `similarity`; texts shorter than
    a shingle are one shingle. Equal sets are one node. Signatures of 64 x `words` bits estimate the angle between sets:
    at a similarity s each bit differs with chance acos(2s / (1 + s)) / pi. Signatures that agree in all bits of one of
    so many bands that a pair at the threshold does with chance `recall` are compared in tiles, and those that differ by
    no more than what is expected there and 3.3 standard deviations are candidates. A band has so many bits that chance
    brings together a few hundred signatures, whatever their number. The sets of candidates that hang together are then
    intersected exactly, in tiles of `set_tile` shingles: every link is verified.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    size = 64 * words
    most = math.floor(size * p + 3.3 * math.sqrt(size * p * (1 - p)))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text_col).alias("body"), F.col(text_col).alias("text"))
    signed = stored(rows.mapInArrow(lambda b: _signed(b, shingle, words), "doc long, body long, node long, n long, sig array<long>"))
    distinct = stored(signed.groupBy("node").agg(F.min(F.struct("doc", "body")).alias("least"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig")))
    wide = max(8, math.ceil(math.log2(max(2, distinct.count()))) - 9)
    bands = math.ceil(math.log(1 - recall) / math.log1p(-((1 - p) ** wide)))
    picks = np.random.default_rng(3).permuted(np.tile(np.arange(size), (bands, 1)), axis=1)[:, :wide]
    banded = distinct.select("node", "sig").mapInArrow(lambda b: _banded(b, picks), "key long, node long, sig array<long>")
    pairs = _dealt(banded, "key", F.struct("node", "sig"), F.lit(1), tile)
    clusters = components(pairs.mapInArrow(lambda b: _candidates(b, most), "u long, v long"))
    members = clusters.union(clusters.select("v", "v").distinct()).select(F.col("u").alias("node"), F.col("v").alias("cluster"))
    members = stored(members.join(distinct.select("node", "least.*"), "node"))
    wanted = docs.sparkSession.sparkContext.broadcast(marks(members, F.xxhash64("doc", "body")))
    sets = rows.withColumn("key", F.xxhash64("doc", "body")).mapInArrow(lambda b: _sets(b, shingle, wanted.value), "doc long, body long, set array<long>")
    sets = stored(sets.dropDuplicates(["doc", "body"]).join(members, ["doc", "body"]).select("cluster", "node", "set"))
    same = _dealt(sets, "cluster", F.struct("node", "set"), F.size("set"), set_tile)
    roots = components(same.mapInArrow(lambda b: _verified(b, similarity), "u long, v long"))
    by = distinct.select("node", "least").join(_least(roots, distinct.select("node", "least")), "node", "left").select("node", F.coalesce("first", "least").alias("first"))
    out = signed.select("doc", "body", "node").join(by, "node")
    real = lambda c: F.when(F.col(c) != LAST, F.col(c)).cast(docs.schema[id_col].dataType)
    return out.select(real("doc").alias("doc_id"), "body", real("first.doc").alias("component_id"), "first")


def without_similar(docs: DataFrame, id_col="doc_id", text_col="text", **limits) -> DataFrame:
    """One document of each group of similar ones, chains included, with all its columns: the one of the smallest id.

    A document is known by its id and its text: of rows with one id and different texts each is judged for itself (of
    two in a group with the same least id, the one of the smaller hash stays), and of rows that repeat both, any one
    stays. A null id is larger than all others. Texts are shuffled only if more rows go than a broadcast may have, or if
    rows are repeated.
    """
    groups = stored(similar_documents(docs, id_col, text_col, **limits).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), "body", "first"))
    one, body, id_ = fresh(docs, "gone_id", "gone_body", "own_id")
    gone = bounded(groups.where("doc <> first.doc or body <> first.body").select(F.col("doc").alias(one), F.col("body").alias(body)).distinct())
    rows = docs.withColumn(id_, F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))).withColumn(body + "_", F.xxhash64(text_col))
    out = rows.join(gone, (F.col(id_) == F.col(one)) & (F.col(body + "_") == F.col(body)), "left_anti")
    repeated = groups.groupBy("doc", "body").count().where("count > 1")
    return (out if repeated.isEmpty() else out.dropDuplicates([id_, body + "_"])).select(docs.columns)


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
