"""Each operator against its SQL or a brute-force version, and on awkward inputs."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from snpspark.llm import chat_format, components, decontamination, packing, quality_classifier, quality_rules, queries, simhash, substring_dedup, suffix_tree, toxicity, url_filters
from snpspark.llm.common import table

SQL = queries.oracle_sql()
N_LONG = 230_000  # words; more than a slice of text
LONG = " ".join(f"w{i % 977}" for i in range(N_LONG))
#: Nulls, empty and very long texts, ties and repeated rows; further columns with names that the operators use.
ODD = [(1, "a b c", "s", "en"), (1, "a b c", "s", "en"), (2, None, None, None), (3, "", "s", "en"), (None, "x y z", "t", None), (4, LONG, "s", "en"), (5, LONG, "s", "de"), (6, " \n ", "s", "en"), (7, "A|b! é", "s", "en")]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, source string, lang string")
    return df.select("*", *(F.lit(7).alias(c) for c in ("n_words", "score", "body", "h", "fp", "cell", "word", "kept", "doc", "host", "bucket", "rows", "cut_id", "CUT_BODY", "cut_text", "hit_id", "hit_body", "gone_id", "gone_body", "own_id", "node", "set", "key", "pos")))


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.where("false")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(name, agrees):
    agrees(queries.queries()[name], SQL[name])


def test_many_hosts_are_joined_by_shuffle(odd, monkeypatch):
    want = sorted(map(str, quality_rules.quality_rules(odd).collect()))
    monkeypatch.setattr(quality_rules, "MAX_BROADCAST_HOSTS", 0)
    assert sorted(map(str, quality_rules.quality_rules(odd).collect())) == want


def test_odd_rows_of_rules(odd, nothing):
    got = quality_rules.quality_rules(odd).collect()
    assert len(got) == len(ODD) and {r["doc_id"]: r["n_words"] for r in got}[4] == N_LONG and not any(r["kept"] for r in got if r["n_words"] < 10)
    assert quality_rules.quality_rules(nothing).count() == 0


def test_hosts_are_shrunk(spark):
    rows = [("good", False)] * 95 + [("good", True)] * 5 + [("bad", True)] * 90 + [("bad", False)] * 10 + [("new", True)]
    failures = spark.createDataFrame(rows, "host string, base_failed boolean")
    hosts, n = quality_rules.host_verdicts(failures)
    got = {r["host"]: r for r in hosts.collect()}
    assert n == 3 and got["bad"]["host_rejected"] and not got["good"]["host_rejected"]
    assert got["new"]["host_rate"] < 0.95 and got["good"]["host_rate"] > 0.05


def test_urls(spark, monkeypatch):
    urls = ["http://A.example.net/en/x", "http://b.net", "http://b.net/", "ftp://www.spam.org/a/?utm_source=1&b=2&a=1#x", "http://spam.org:80/a?a=1&b=2", "no scheme", None, "", "http://example.net/e", "x://notnet/", "http://c.org/fr/?q"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("canon", F.lit(1))
    listed = spark.createDataFrame([("https://spam.org/a/?a=1&b=2",), (None,)], "url string")
    want = {0: ("example.net/en/", "allow"), 1: (None, "allow"), 2: ("net/", "block"), 3: (None, "block"), 4: (None, "block"), 5: (None, "allow"), 6: (None, "allow"), 7: (None, "allow"), 8: ("net/", "block"), 9: (None, "allow"), 10: ("org/fr/", "allow")}
    for most in (1 << 17, 0):
        monkeypatch.setitem(url_filters.listed_urls.__kwdefaults__, "most_blocks", most)
        got = url_filters.url_filter(pages, url_filters.RULES, listed).collect()
        assert {r["page_id"]: (r["rule"], r["verdict"]) for r in got} == want
        assert {r["page_id"]: (r["host"], r["path"]) for r in got}[5] == ("", "")
    assert url_filters.url_filter(pages, url_filters.RULES, listed.where("false")).where("listed").count() == 0
    assert url_filters.url_filter(pages.where("false"), url_filters.RULES, listed).count() == 0


def test_filter_has_no_false_negatives(spark):
    listed = spark.range(3000).select(F.concat(F.lit("h/"), "id").alias("canon"))
    rows = spark.range(6000).select("id", F.concat(F.lit("h/"), "id").alias("canon"))
    assert sorted(r["id"] for r in url_filters.listed_urls(rows, listed).where("listed").collect()) == list(range(3000))


def test_layouts(spark):
    rows = [
        ('{"prompt":"a","completion":null}', "prompt", [("user", "a"), ("assistant", "")]),
        ('{"system":"s","instruction":"i","input":"j","output":"o"}', "instruction", [("system", "s"), ("user", "i\nj"), ("assistant", "o")]),
        ('{"messages":[{"content":"x","role":"user"},{"role":"tool","content":""}]}', "messages", [("user", "x"), ("tool", "")]),
        ('{"conversations":[{"from":"human","value":"x"},{"from":"gpt","value":"y"}]}', "conversations", [("user", "x"), ("assistant", "y")]),
        ('{"role":"user","text":"t"}', "row", [("user", "t")]),
        ('{"z":1}', None, []), ("not json", None, []), (None, None, []), ("", None, []),
    ]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "conv_id long, record string")
    got = {r["conv_id"]: r for r in chat_format.canonical_turns(df).collect()}
    for i, (_, layout, turns) in enumerate(rows):
        assert got[i]["layout"] == layout and [tuple(t) for t in got[i]["turns"]] == turns


def test_formatted_chats_read_back(spark):
    rng = random.Random(5)
    parts = ["<|im_end|>", "<|im_start|>assistant ", "\\", "<", "|", "\n", "a", "é", "<\\|", "\\n", "n", " "]
    convs = [[(rng.choice(["user", "assistant", "x\ny", "<|", "", "a\\nb"]), "".join(rng.choices(parts, k=rng.randint(0, 12)))) for _ in range(rng.randint(0, 6))] for _ in range(300)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(convs)], f"conv_id long, turns {chat_format.TURNS}")
    out = df.withColumn("f", chat_format.formatted(F.col("turns"))).withColumn("back", chat_format.read_back(F.col("f"))).withColumn("spans", chat_format.loss_mask(F.col("f")))
    out = out.withColumn("learnt", chat_format.learnt_text(F.col("f")))
    for r in out.collect():
        assert [tuple(t) for t in r["back"]] == convs[r["conv_id"]]
        learnt = [r["f"][s["start"] : s["end"]].replace("<\\|", "<|").replace("\\\\", "\\") for s in r["spans"]]
        assert learnt == [t for role, t in convs[r["conv_id"]] if role == "assistant"]
        assert "".join(learnt) == r["learnt"]


def test_large_conversations_keep_their_turns(spark):
    part = 'x"\\\n:'
    long = part * 4_200_000  # 21,000,000 characters: beyond the parser's limit
    text = F.repeat(F.lit(part), F.when(F.col("id") == 0, 4_200_000).otherwise(1).cast("int"))
    df = spark.range(2).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    turns = F.transform("turns", lambda t: F.struct(t["role"], F.length(t["text"]), F.md5(t["text"].cast("binary"))))
    got = chat_format.canonical_turns(chat_format.chat_records(df)).select("layout", turns.alias("t")).first()
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    assert got["layout"] == "instruction" and [tuple(t) for t in got["t"]] == [("user", len(long), md5(long)), ("assistant", 5, md5(part))]


def test_shapes_without_strings(spark, monkeypatch):
    rows = ['{"prompt":"a","completion":null}', '{"system" : "s\\"", "messages": [{"content":":","role":""},{"role":"\\\\","content":"x"}]}', '{"z":1,"y":["a",{"b":"c"}]}', "not json", '{"role":"\\q","text":"t"}', '{"role":"a","text":"t', None, ""]
    df = spark.createDataFrame([(r,) for r in rows], "record string")
    want = [r[0] for r in df.select(chat_format.shape(F.col("record"))).collect()]
    monkeypatch.setattr(chat_format, "LARGE", -1)
    assert [r[0] for r in df.select(chat_format.shape(F.col("record"))).collect()] == want and want[1]


def test_odd_turns(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (None, None, "assistant", "y"), (2, None, "user", "b"), (2, None, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat_format.canonical_turns(chat_format.chat_records(df)).collect()}
    assert got == {1: [("user", ""), ("", "x"), ("", "x")], None: [("assistant", "y")], 2: [("user", "a"), ("user", "b")]}
    assert chat_format.format_chats(chat_format.chat_records(df.where("false"))).count() == 0


@pytest.mark.parametrize(("module", "column", "cut"), [(toxicity, "toxic", 0.95), (quality_classifier, "quality", 0.97)])
def test_held_out_precision_and_recall(spark, module, column, cut):
    query = {toxicity: toxicity.op1_toxicity, quality_classifier: quality_classifier.op5_quality_classifier}[module]
    sf = "/root/testdata/sf0.1"
    got = query(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out")
    n = {(r[0], r[1]): r[2] for r in got.groupBy("predicted", column).count().collect()}
    caught, wrong, missed = n.get((1, 1), 0), n.get((1, 0), 0), n.get((0, 1), 0)
    assert caught / (caught + wrong) > cut and caught / (caught + missed) > cut
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_classifiers_on_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 0, 1), (99, 1, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.where("doc_id = 1"), labels.where("false")):
        model = quality_classifier.train(odd, some)
        assert quality_classifier.quality_scores(odd, model).where("score between 0 and 1").count() == len(ODD)
        assert quality_classifier.accepted(odd, model).columns == odd.columns and quality_classifier.quality_scores(nothing, model).count() == 0
        net, cuts = toxicity.train(odd, some, steps=5)
        assert toxicity.toxicity_scores(odd, net, cuts).where("score between 0 and 1").count() == len(ODD)
        assert toxicity.toxicity_scores(nothing, net, cuts).count() == 0


def test_gradients_lower_the_loss():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 500, (rng.integers(0, 30), len(toxicity.STEMS))).astype(np.int32) for _ in range(200)]
    toxic = np.array([int(len(t) and (t[:, 0] < 20).any()) for t in texts])
    model = toxicity.Model().fit(texts, toxic, steps=150)
    scores = np.concatenate([model.scores(t, np.array([0, len(t)])) for t in texts])
    assert ((scores >= 0.5) == toxic).mean() > 0.9
    together = model.scores(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    assert np.allclose(together, scores, atol=1e-5)


def test_training_and_wide_filters_matter(monkeypatch):
    """Toxic is what has word 1 right before word 2; single words say nothing, so neither widths of one nor the start do."""
    rng = np.random.default_rng(1)

    def text(toxic):
        words = rng.integers(10, 60, 24)
        at = rng.choice(np.arange(0, 24, 3), 2, replace=False)
        words[at[0]], words[at[0] + 1], words[at[1]] = (1, 2, 3) if toxic else (1, 3, 2)
        return np.stack([words + k * toxicity.BUCKETS for k in range(len(toxicity.STEMS))], 1).astype(np.int32)

    toxic = rng.integers(0, 2, 1200)
    texts = [text(y) for y in toxic]

    def right(steps):
        model = toxicity.Model().fit(texts[:900], toxic[:900], steps=steps)
        return np.mean([(model.scores(t, np.array([0, len(t)]))[0] >= 0.5) == y for t, y in zip(texts[900:], toxic[900:])])

    trained, started = right(600), right(0)
    monkeypatch.setattr(toxicity, "WIDTHS", (1, 1, 1))
    single = right(600)
    assert trained > 0.75 and started < 0.6 and single < 0.6


def test_parts_of_a_long_text(monkeypatch):
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 500, (1000, len(toxicity.STEMS))).astype(np.int32)
    model, first = toxicity.Model(), np.array([0, 1000])
    want = model.logits(ids, first)
    for part in (7, 64, 499):
        monkeypatch.setattr(toxicity, "PART", part)
        assert np.allclose(model.logits(ids, first), want, atol=1e-6)


def test_training_sample_is_bounded_and_ordered(spark):
    rows = [(i % 40, f"text {i} bad" if i % 3 else f"word {i}", "en") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    models = []
    for order in (1, -1):
        df = spark.createDataFrame(rows[::order], "doc_id long, text string, lang string").repartition(3 if order > 0 else 5)
        models.append([toxicity.train(df, labels, steps=3, most_bytes=b)[0] for b in (10**6, 60)])
    assert all((a.table == b.table).all() for a, b in zip(*models))
    assert (models[0][0].table != models[0][1].table).any()


def test_every_labelled_row_is_learnt_from(spark):
    """Each text is one word of its own, so what the model has of it shows whether it was learnt from."""
    words = [f"{i:03}word" for i in range(90)]
    docs = spark.createDataFrame([(i, w, "en") for i, w in enumerate(words)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id long, toxic int")
    start = toxicity.Model().table
    for most in (70, 10**6):
        model, _ = toxicity.train(docs, labels, steps=3, most_bytes=most)
        for w in words:
            own = toxicity.hashed(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0][0, 0]
            assert (model.table[own] != start[own]).any()


def test_learning_from_parts_of_a_long_text(monkeypatch):
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 200, (n, len(toxicity.STEMS))).astype(np.int32) for n in (0, 1, 2, 300, 41, 90)]
    toxic = np.array([0, 1, 0, 1, 0, 1])
    want = toxicity.Model().fit(texts, toxic, steps=20)
    for part in (1, 7, 64):
        monkeypatch.setattr(toxicity, "PART", part)
        got = toxicity.Model().fit(texts, toxic, steps=20)
        assert np.allclose(got.table, want.table, atol=1e-4) and np.allclose(got.filters, want.filters, atol=1e-4)


def test_odd_rows_of_decontamination(spark, odd, nothing):
    items = spark.createDataFrame([(1, "A b C"), (2, None), (3, ""), (4, LONG[:4000]), (5, "a b c")], "item_id long, text string").withColumn("doc_id", F.lit(1))
    for limits in ({}, {"block": 100}, {"most_windows": 0}):
        got = decontamination.benchmark_hits(odd, items, **limits).collect()
        assert len(got) == len(ODD)
        by = {r["doc_id"]: r for r in got}
        assert by[1]["n_hit"] == 3 and by[1]["items"] == ["1", "5"] and by[4]["contaminated"] and by[4]["items"] == ["4"] and by[2]["n_words"] == 0 and not by[7]["contaminated"]
    assert decontamination.benchmark_hits(nothing, items).count() == 0
    assert decontamination.benchmark_hits(odd, items.where("false")).where("contaminated").count() == 0
    assert sorted(str(r["doc_id"]) for r in decontamination.uncontaminated(odd, items).collect()) == ["2", "3", "6", "7", "None"]


def _tokens(text):
    low = (text or "").encode().translate(bytes(c + 32 if 65 <= c < 91 else c for c in range(256)))
    return [*low.split(), None]


def test_base_scores_equal_counting(spark, sf):
    got = {r["doc_id"]: r for r in suffix_tree.op7_suffix_tree(spark, sf).collect()}
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    counts = collections.Counter(t for i, x in docs.items() if not out(i) for t in _tokens(x))
    total, bottom = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    for i, x in docs.items():
        t = _tokens(x)
        assert got[i]["held_out"] == out(i) and got[i]["n_tokens"] == len(t) and got[i]["n_known"] == sum(counts[w] > 0 for w in t) and got[i]["train_tokens"] == total
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / bottom) for w in t), abs=1e-6)
    for side in (True, False):
        rows = [r for r in got.values() if r["held_out"] == side]
        assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def _tree(texts, depth, symbol, often, kept, divergence):
    """A function of a text for its score, by plain counting."""
    train = [_tokens(x) for x in texts]
    counts = collections.Counter(w for t in train for w in t if w is not None)
    ends, total = len(train), sum(counts.values()) + len(train)
    bottom = total + 0.5 * (len(counts) + 2)
    rare = {w: n for w, n in counts.items() if n < symbol}
    shapes = collections.Counter()
    for w, n in rare.items():
        shapes[w[-3:]] += n
    kind = lambda w: w[-3:] if shapes[w[-3:]] >= symbol else None
    symbol_of = lambda w: ("end",) if w is None else ("word", w) if counts[w] >= symbol else ("shape", kind(w))
    groups = collections.defaultdict(list)
    for w, n in rare.items():
        groups[kind(w)].append(n)
    groups[None]  # the rest is there even if it is empty
    root = {("end",): (ends + 0.5) / bottom}
    for w, n in counts.items():
        if n >= symbol:
            root["word", w] = (n + 0.5) / bottom
    for k, ns in groups.items():
        root["shape", k] = (sum(ns) + 0.5 * len(ns) + (0.5 if k is None else 0)) / bottom
    share = {k: (sum(ns), len(ns), (sum(n == 1 for n in ns) + 0.5) / (sum(ns) + 1)) for k, ns in groups.items()}
    seqs = [["begin", *map(symbol_of, t)] for t in train]
    states = {}

    def value(context, x):
        """The probability of x behind the context: of its suffixes that are retained, from short to long."""
        log = math.log(root[x])
        for k in range(1, len(context) + 1):
            if (state := states.get(context[-k:])) is not None:
                log += state[0] + state[1].get(x, 0)
        return log

    live = None
    for k in range(1, depth + 1):
        pairs = collections.Counter()
        for s in seqs:
            for i in range(1, len(s)):
                c = tuple(s[max(0, i - k) : i])
                # A text's begin counts as the outermost symbol of a context.
                if len(c) == k and (live is None or c in live):
                    pairs[c, s[i]] += 1
        totals = collections.Counter()
        if live is None:
            for (c, _), n in pairs.items():
                totals[c] += n
        else:
            totals = live
        pairs = {p: n for p, n in pairs.items() if n >= kept}
        new = {}
        for c in {c for c, _ in pairs if totals[c] >= often}:
            next_ = {x: n for (d, x), n in pairs.items() if d == c}
            p = {x: (n - 0.5) / totals[c] for x, n in next_.items()}
            v = {x: value(c[1:], x) for x in p}
            left = lambda y: max(1 - y, 1e-12)
            back = math.log(left(sum(p.values()))) - math.log(left(sum(math.exp(y) for y in v.values())))
            if sum(p[x] * (math.log(p[x]) - v[x]) for x in p) + (1 - sum(p.values())) * back >= divergence:
                new[c] = (back, {x: math.log(p[x]) - v[x] - back for x in p})
        states |= new
        live = collections.Counter()
        for (c, x), n in pairs.items():
            if n >= often and x != ("end",):
                live[(*c, x)] += n

    def score(text):
        t = _tokens(text)
        s = ["begin", *map(symbol_of, t)]
        out = 0
        for i in range(1, len(s)):
            out += value(tuple(s[max(0, i - depth) : i]), s[i]) / math.log(10)
            if s[i][0] == "shape":
                n, kinds, unseen = share[s[i][1]]
                c = counts[t[i - 1]]
                out += math.log10((c + 0.5) * (1 - unseen) / max(n + 0.5 * kinds, 0.5)) if c else math.log10(unseen)
        return out

    return score, states


def test_scores_equal_a_plain_tree(spark):
    rng = random.Random(8)
    grammar = {"": "ab", "a": "bbbc", "b": "cad", "c": "aaad", "d": "ab", "bc": "d", "cd": "a", "ad": "c", "abc": "b", "dab": "d"}

    def text():
        out = ""
        for _ in range(rng.randint(0, 30)):
            context = next(out[len(out) - k :] for k in (3, 2, 1, 0) if out[len(out) - k :] in grammar and (k <= len(out)))
            out += rng.choice(grammar[context])
        return " ".join(f"w{x}" if rng.random() < 0.97 else f"w{x}{rng.randint(0, 40)}ing" for x in out)

    texts = [text() for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    limits = dict(symbol_share=1.0, context_share=1.0, entry_share=1.0)
    model = suffix_tree.train(docs, depth=4, symbol_count=20, context_count=12, entry_count=3, divergence=0.02, **limits)
    score, states = _tree(texts, 4, 20, 12, 3, 0.02)
    assert [len(x["back"]) for x in model[0].levels] == [sum(len(c) == k for c in states) for k in (1, 2, 3, 4)]
    assert sum(len(c) == 3 for c in states) > 3 and sum(len(c) == 4 for c in states) > 0
    asked = [*texts[:200], "wa wb wc zzz", "", "wb qing wa"]
    got = suffix_tree.scores(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), *model).collect()
    assert {r["doc_id"]: r["score"] for r in got} == pytest.approx({i: score(x) for i, x in enumerate(asked)}, abs=1e-6)


def test_counts_of_next_symbols_are_packed_and_pruned(spark, sf):
    rng = np.random.default_rng(3)
    key = rng.integers(0, 2**64, 50, np.uint64)[rng.integers(0, 50, 3000)]
    x, n = rng.integers(0, 1 << 40, 3000), rng.integers(1, 1 << 50, 3000)
    got = []
    for batch in suffix_tree._packed(key, x, n):
        row, y, m = suffix_tree._unpacked(batch.column(1))
        got += zip(batch.column(0).to_numpy().view(np.uint64)[row].tolist(), y.tolist(), m.tolist())
    assert sorted(got) == sorted(zip(key.tolist(), x.tolist(), n.tolist()))
    # Bit maps with nothing in them let nothing through, so a pair whose suffix has none isn't shuffled.
    rows = table(spark, sf, "documents").select("text")
    model, _ = suffix_tree.train(rows, depth=1, symbol_count=30)
    batch = rows.toArrow().to_batches()
    every, none = np.full(1 << 20, 2**64 - 1, np.uint64), np.zeros(1 << 20, np.uint64)
    assert sum(len(b) for b in suffix_tree._next_symbols(batch, model, 2, every, every)) > 100
    assert sum(len(b) for b in suffix_tree._next_symbols(batch, model, 2, every, none)) == 0


def test_shapes_are_hashes_of_three_bytes():
    data = np.frombuffer("a bb ccc dddd été x".encode(), np.uint8)
    starts, ends, _ = suffix_tree.K.words(data, np.array([0, len(data)]))
    assert (suffix_tree._shapes(data, starts, ends) == suffix_tree.K.span_hashes(data, np.maximum(starts, ends - 3), ends, 4)).all()


def test_next_symbols_sum_to_one(spark, sf):
    docs = table(spark, sf, "documents")
    model, _ = suffix_tree.train(docs, symbol_share=1e-3, context_share=1e-3, entry_share=1e-4)
    assert 2 <= len(model.levels) <= 4 and len(model.levels[0]["log"]) and np.exp(model.root).sum() == pytest.approx(1, abs=1e-9)
    every = np.arange(model.symbols)
    for a, b in ((5, 6), (0, 10), (model.symbols - 1, model.symbols - 2), (2, 2)):
        seq = np.array([suffix_tree.BEGIN, a, b, 1]) if a else np.array([0, b, 1])
        keys = [np.full(model.symbols, k[-1]) for k in model.contexts(seq, len(model.levels))]
        assert np.exp(model.logs(keys, every)).sum() == pytest.approx(1, abs=1e-6)


def test_tree_grows_beyond_what_is_broadcast(spark, sf):
    docs = table(spark, sf, "documents")
    low = dict(symbol_share=1.0, context_share=1.0, entry_share=1.0, symbol_count=30, context_count=20, entry_count=3)
    # The same tree, once with all rows broadcast, and with none or some.
    near, far, some = (suffix_tree.train(docs, **low, broadcast_rows=n) for n in (10**6, 0, 100))
    assert near[0].tail is None and not len(far[0].levels[0]["log"])
    assert all(len(x["log"]) <= 100 for x in some[0].levels) and len(some[0].levels[0]["log"])
    assert far[0].tail.count() == sum(len(x["log"]) + len(x["back"]) for x in near[0].levels) > 1000
    a, b, c = ({r["doc_id"]: r["score"] for r in suffix_tree.scores(docs, *m).collect()} for m in (near, far, some))
    assert a == pytest.approx(b, abs=1e-6) and a == pytest.approx(c, abs=1e-6)


def test_what_is_kept_of_the_tree_does_not_depend_on_shares(spark):
    # "red" is always followed by "fox", 40 times, in a corpus where that is far below any share.
    texts = ["red fox"] * 40 + [f"a{i % 50} b{i % 47} c{i % 43}" for i in range(4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = suffix_tree.train(docs, symbol_share=0.01, context_share=0.05, entry_share=0.05, symbol_count=30, context_count=30, entry_count=5)
    got = suffix_tree.scores(spark.createDataFrame([(1, "red fox"), (2, "fox red")], "doc_id long, text string"), *model).collect()
    score = {r["doc_id"]: r["score"] - r["base_score"] for r in got}
    assert score[1] > 2 and score[2] < score[1] - 2


def test_scoring_asks_and_is_told_in_few_bytes(spark, sf, monkeypatch):
    made = []
    broadcast = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, x: made.append(broadcast(self, x)) or made[-1])
    texts = [r["text"] for r in table(spark, sf, "documents").select("text").orderBy("doc_id").collect()]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts) if i % 4], "doc_id long, text string")
    model, counts = suffix_tree.train(docs, symbol_share=1.0, context_share=1.0, entry_share=1.0, symbol_count=30, context_count=20, entry_count=3, table_share=1.0, broadcast_rows=50)
    # The models and bit maps of the levels are no longer kept on the executors' disks.
    assert len(made) == 7 and not any(b._jbroadcast.isValid() for b in made)
    asked = [*texts, "never never seenbefore never", "", None, texts[5], texts[5]]
    rows = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    want = {r["doc_id"]: r for r in suffix_tree.scores(rows, model, counts).collect()}
    # The same by hand, in many groups and few parts.
    monkeypatch.setattr(suffix_tree, "HELD", 5000)
    monkeypatch.setattr(suffix_tree, "SLICE", 10_000)
    own = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    told = f"role int, g long, a binary, b binary, row int, asked long, {own}"
    dealt, told, own = (suffix_tree.to_arrow_schema(suffix_tree.StructType.fromDDL(x)) for x in (f"part int, {told}", told, own))

    source = rows.select("doc_id", F.xxhash64("text").alias("body"), "text").coalesce(1).orderBy("doc_id")
    sent = list(suffix_tree._scored(source.toArrow().to_batches(), model, 4, dealt))
    tables = [b for df, role in ((counts, suffix_tree.WORDS), (model.tail, suffix_tree.TAIL)) for b in suffix_tree._known(df.toArrow().to_batches(), 4, dealt, role)]
    everything = suffix_tree.pa.Table.from_batches([*sent, *tables]).sort_by([("part", "ascending"), ("role", "ascending")])
    answers = suffix_tree.pa.Table.from_batches(list(suffix_tree._answers(everything.to_batches(100), told))).sort_by("g")
    got = suffix_tree.pa.Table.from_batches(list(suffix_tree._added(answers.to_batches(7), model.unseen - model.known, own))).to_pylist()
    assert len(got) == len(asked) == len(want) and len(set(answers["g"].to_pylist())) > 10
    for r in got:
        w = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"]) == (w["n_tokens"], w["n_known"]) and (r["base_score"], r["score"]) == pytest.approx((w["base_score"], w["score"]), abs=1e-6)
    never = want[len(texts)]
    assert never["n_tokens"] == 5 and never["n_known"] == 1
    # A row a word, with its hash, its cost and the text's id and digest, was 28 bytes.
    one = suffix_tree.pa.Table.from_batches(sent)
    one = one.filter(suffix_tree.pa.array(one["role"].to_numpy() != suffix_tree.DOCUMENT))
    times = sum(len(suffix_tree._told(a.as_py(), b.as_py())[3]) for a, b in zip(one["a"], one["b"]))
    size = sum(len(x.as_py()) for c in "ab" for x in one[c])
    assert times > 30_000 and size < 14 * times
    # What is told must belong to the texts as they were when it was asked for.
    again = list(suffix_tree._scored(source.orderBy(F.desc("doc_id")).toArrow().to_batches(), model, 4, dealt))
    texts_of = lambda x, keep: x.filter(suffix_tree.pa.array((x["role"].to_numpy() == suffix_tree.DOCUMENT) == keep))
    mixed = suffix_tree.pa.concat_tables([texts_of(suffix_tree.pa.Table.from_batches(again).select(told.names), True), texts_of(answers, False)]).sort_by("g")
    with pytest.raises(RuntimeError, match="another order"):
        list(suffix_tree._added(mixed.to_batches(), model.unseen - model.known, own))


def test_odd_rows_of_scoring(odd, nothing):
    for part in (odd, nothing, odd.where("doc_id = 3")):
        model, counts = suffix_tree.train(part)
        got = suffix_tree.scores(odd, model, counts).collect()
        assert len(got) == len(ODD) and all(r["score"] <= 1e-9 and math.isfinite(r["score"]) for r in got)
        same = [tuple(r) for r in got if r["doc_id"] == 1]
        assert same[0] == same[1]
    assert suffix_tree.scores(nothing, model, counts).count() == 0


def test_boundaries_are_the_best():
    rng = random.Random(1)

    def padding(x, c, bounds):
        return sum(k * (min(b for b in bounds if b >= v) - v) for v, k in zip(x, c))

    for _ in range(200):
        x = sorted(rng.sample(range(40), rng.randint(1, 8)))
        c, k = [rng.randint(1, 9) for _ in x], rng.randint(1, 5)
        got = packing.boundaries(np.array(x), np.array(c), np.array(x) * np.array(c), k)
        best = min(padding(x, c, [*cut, x[-1]]) for m in range(k) for cut in itertools.combinations(x[:-1], min(m, len(x) - 1)))
        assert len(got) <= k and padding(x, c, got) == best


def test_batches(spark, sf, odd, nothing):
    docs = table(spark, sf, "documents")
    for group in (200_000, 3):
        got = packing.pack(docs, budget=2000, group=group).toPandas()
        assert len(got) == docs.count() and (got.n_tokens <= got.bucket_tokens).all()
        each = got.groupby("batch")
        assert ((each.bucket_tokens.sum() <= 2000) | (each.size() == 1)).all() and (each.bucket.nunique() == 1).all() and not got.duplicated(["batch", "slot"]).any()
        by = got.groupby("bucket").agg(n=("n_tokens", "size"), batches=("batch", "nunique"), tokens=("bucket_tokens", "max"))
        assert (by.batches == np.ceil(by.n / np.maximum(1, 2000 // by.tokens))).all()
    assert packing.pack(odd).count() == len(ODD) and packing.pack(nothing).count() == 0


def test_packing_of_long_texts_is_the_best(spark):
    rng = random.Random(6)
    lengths = rng.sample(range(2049, 60_000), 9)
    rows = [(rng.choice([None, 1, 2]), n) for n in lengths for _ in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rows, "doc_id long, n long")
    waste = lambda bounds: sum(min(b for b in bounds if b >= n) - n for _, n in rows)
    for buckets in (2, 3, 4):
        got = packing.pack(df, length=F.col("n"), buckets=buckets, group=3).toPandas()
        best = min(waste([*cut, max(lengths)]) for cut in itertools.combinations(sorted(lengths)[:-1], buckets - 1))
        assert (got.bucket_tokens - got.n_tokens).sum() == best and not got.duplicated(["batch", "slot"]).any()


def test_bounds_are_the_longest_members(spark):
    lengths = [3, 5001, 5002, 70_001, 70_003, 1_000_001]
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n long")
    for buckets in (1, 2, 3, 16):
        got = packing.pack(df, length=F.col("n"), buckets=buckets).toPandas()
        assert len(got) == len(lengths) and (got.groupby("bucket").n_tokens.max() == got.groupby("bucket").bucket_tokens.max()).all()
        assert got.groupby("bucket").bucket_tokens.nunique().eq(1).all()


def _passages(docs, size):
    """Kept words of each row, window by window."""
    words = [(i if i is not None else 1 << 63, (t or "").encode().split()) for i, t in docs]
    first = {}
    for i, w in words:
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = {j for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < i for j in range(k, k + size)}
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("size", "shortest", "broadcast_rows"), [(6, 2, 1 << 20), (5, 9, 0), (8, 2, 0), (8, 3, 5)])
def test_passages_equal_brute_force(spark, nothing, size, shortest, broadcast_rows):
    rng = random.Random(size)
    docs = [(rng.choice([*range(40), None]), " ".join(rng.choice("ab") for _ in range(rng.randint(0, 14)))) for _ in range(60)] + [(3, None), (9, "a b a b a b a b\n a"), (9, "a b a b a b a b\n a")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("at", F.lit(1))
    got = substring_dedup.repeated_passages(df, size=size, shortest=shortest, with_text=True, broadcast_rows=broadcast_rows).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else 1 << 63, r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == _passages(docs, size)
    for r in got:
        assert r["kept_text"] is None or hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]
    assert substring_dedup.repeated_passages(nothing).count() == 0


def test_long_copy_goes(odd):
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.repeated_passages(odd).collect()}
    assert got[5] == N_LONG and got[4] == 0 and got[1] == 0
    kept = substring_dedup.without_passages(odd)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "2", "3", "4", "6", "7", "None"]


def _fingerprint(text, shingle=3):
    import xxhash

    w = _tokens(text)[:-1]
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + shingle]), seed=42) for i in range(max(1, len(w) - shingle + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_equals_brute_force(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    prints = {i: _fingerprint(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(docs), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r for r in simhash.op10_simhash_near_dedup(spark, sf).collect()}
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{prints[i]:016x}", find(i)) for i in docs}


def test_tiles_find_every_link(spark):
    rng = random.Random(2)
    nodes = [rng.getrandbits(64) for _ in range(60)]
    nodes += [x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for x in nodes for _ in range(3)]
    nodes = sorted({x - (1 << 64) if x >> 63 else x for x in nodes})
    df = spark.createDataFrame([(x, [x]) for x in nodes], "node long, sig array<long>")
    want = components.forest(*map(np.array, zip(*[(a, b) for a, b in itertools.combinations(nodes, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3])))
    for tile, parts in ((1024, 4), (3, 4), (5, 1)):
        got = components.components(simhash.links(df, radius=3, tile=tile, parts=parts)).collect()
        assert sorted(map(tuple, got)) == sorted(zip(*(x.tolist() for x in want)))


def test_similar_documents(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(5000)]
    docs = []
    for k in range(40):
        text = rng.choices(words, k=200)
        near = text[:]
        near[100] = "other"
        docs += [(3 * k, " ".join(text)), (3 * k + 1, " ".join(near)), (3 * k + 2, " ".join(text[:100] + rng.choices(words, k=100)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(df).collect()}
    assert got == {i: i - 1 if i % 3 == 1 else i for i, _ in docs}
    assert simhash.without_similar(df).count() == 80


def _similar(rows, least=0.8, size=5):
    """Least id by row of its group, of (id, text), by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = _tokens(text)[:-1]
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = 0
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] == sets[b] or both and both >= least * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
            links += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(rows))], links


def test_similar_documents_equal_brute_force(spark):
    """Texts whose similarity lies around the threshold, in tiles of all sizes."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    docs = []
    for _ in range(30):
        text = rng.choices(words, k=rng.choice([3, 30, 120, 400]))
        for _ in range(rng.randint(1, 9)):
            near = [w if rng.random() > 0.018 else rng.choice(words) for w in text]
            docs.append((len(docs), " ".join(near)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want, links = _similar(docs)
    assert links > 50
    for tiles in ({}, {"tile": 4, "set_tile": 300}):
        got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(df, **tiles).collect()}
        missed = sum(got[i] != k for i, k in enumerate(want))
        assert missed <= 0.02 * len(docs)  # candidates have a recall; what links is exact
        assert all(want[i] == want[k] for i, k in got.items())


def test_rows_that_stay(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "a"), (5, "a"), (5, "b"), (None, "a"), (None, "c"), (7, "d"), (7, "d"), (8, long), (9, long + " x"), (None, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("gone_id", F.lit(1))
    got = simhash.without_similar(df)
    assert got.columns == df.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in got.collect()) == [("1", "a"), ("3", ""), ("5", "b"), ("7", "d"), ("8", long), ("None", "c")]


def test_odd_rows_of_simhash(odd, nothing):
    got = simhash.near_duplicates(odd).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(ODD) and by[5]["component_id"] == 4 and by[2]["fp"] == 0 and {by[i]["component_id"] for i in (2, 3, 6)} == {2}
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.similar_documents(odd).count() == len(ODD) and simhash.similar_documents(nothing).count() == 0


def test_components_of_chains(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = components.components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert {r["u"]: r["v"] for r in got} == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)}
