import collections
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from snpspark.llm import kernels as K
from snpspark.llm import suffix_tree

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\r\x0b\x0cabABé|ñ\u2028\xa0", max_size=30)), min_size=1, max_size=6)


def batch_of(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])


@settings(deadline=None)
@given(TEXTS)
def test_words_are_the_pattern(texts):
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    got = []
    for lo, hi, data, offs in K.slices(batch_of(texts), most=16):
        starts, ends, first = K.words(data, offs)
        got += [[bytes(data[starts[j] : ends[j]]).decode() for j in range(first[i], first[i + 1])] for i in range(hi - lo)]
    assert got == want


@settings(deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=4), min_size=1, max_size=40), st.integers(1, 9))
def test_equal_windows_have_equal_hashes_and_others_not(words, size):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, first = K.words(data, np.array([0, len(data)]))
    h = K.window_hashes(K.span_hashes(data, starts, ends), size)
    at = np.flatnonzero(K.whole_windows(first, size)[: len(h)])
    windows = [tuple(words[i : i + size]) for i in at]
    assert len(set(windows)) == len(set(h[at].tolist())) and dict(zip(windows, h[at].tolist())) == {w: x for w, x in zip(windows, h[at].tolist())}


def test_long_words_differ_by_order():
    a, b = "x" * 300 + "yz" + "x" * 300, "x" * 300 + "zy" + "x" * 300
    data = np.frombuffer((a + " " + b + " " + a[1:] + a[0]).encode(), np.uint8)
    starts, ends, _ = K.words(data, np.array([0, len(data)]))
    assert len(set(K.span_hashes(data, starts, ends).tolist())) == 3


def test_sliced_and_large_arrays():
    for kind in (pa.string(), pa.large_string()):
        col = pa.array(["a", None, "bc", ""], kind)[1:]
        data, offs = K.column(pa.RecordBatch.from_arrays([col], names=["text"]))
        assert bytes(data) == b"bc" and offs.tolist() == [0, 0, 2, 2]


def test_lookup_finds_first_places_of_any_keys():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 900):
        keys = rng.integers(0, 2**64, n, np.uint64)
        if n > 2:
            keys[[5, 9]], keys[0], keys[1] = keys[7], 2**64 - 1, 0
        asked = np.concatenate([keys, rng.integers(0, 2**64, 500, np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        place = {}
        for i, k in enumerate(keys.tolist()):
            place.setdefault(k, i)
        assert K.Lookup(keys).find(asked).tolist() == [place.get(k, -1) for k in asked.tolist()]


def test_packed_orders_and_merges_equal_plain_ones():
    rng = np.random.default_rng(5)
    for n, top in ((0, 5), (1, 5), (3000, 40), (3000, 1 << 62)):
        key, x = rng.integers(0, 2**64, 60, np.uint64)[rng.integers(0, 60, n)], rng.integers(0, top, n)
        own, plain = suffix_tree._ordered(key, x), np.lexsort((x, key))
        assert (key[own] == key[plain]).all() and (x[own] == x[plain]).all()
        u, y, m = suffix_tree._merged([(key, x, np.ones(n, np.int64))])
        assert dict(zip(zip(u.tolist(), y.tolist()), m.tolist())) == collections.Counter(zip(key.tolist(), x.tolist())) and len(u) == len(set(zip(u.tolist(), y.tolist())))
    for v in ([], [0], [127, 128, 0, 1 << 40, 2**64 - 1, 5]):
        assert suffix_tree._numbers(suffix_tree._varints(np.array(v, np.uint64))[0]).tolist() == v
