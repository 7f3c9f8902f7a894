import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from snpspark.llm import quality_classifier
from snpspark.llm.common import table

from .test_operators import LONG, _passages, _similar


def _words(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _windows(words, size=10):
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def test_stages_equal_brute_force(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = table(spark, sf, "labels").where(~quality_classifier.held_out())
    good = {r["doc_id"] for r in quality_classifier.quality_scores(docs, quality_classifier.train(docs, labels)).where("score >= 0.7").collect()}
    windows = [_windows(_words(r["text"])) for r in table(spark, sf, "benchmark").collect()]

    def near(rows):
        rows = sorted(rows.items())
        return {rows[i][0]: rows[i][1] for i, root in enumerate(_similar(rows)[0]) if root == i}

    def cut(rows):
        gone = {i: (n, k) for i, n, k, _ in _passages(sorted(rows.items()), 50)}
        return {i: gone[i][1] for i in rows if gone[i][1] < gone[i][0] or not gone[i][0]}

    def clean(rows):
        def held(text):
            w = _words(text)
            have = {n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for n in range(1, 11)}
            return any(x in have[len(x)] for item in windows for x in item)

        return {i: t for i, t in rows.items() if not held(t)}

    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        got = {r["doc_id"]: r["text"] if "text" in docs.columns else None for r in docs.collect()}
        assert len(got) == docs.count() > 0
        if name == "quality":
            assert set(got) == good & set(before)
        elif name == "near_dedup":
            assert got == near(before) and len(got) < len(before)
        elif name == "substring_dedup":
            want = cut(before)
            assert set(got) == set(want)
            assert all(len((got[i] or "").split()) == len((before[i] or "").split()) - want[i] and (want[i] or got[i] == before[i]) for i in want)
        elif name == "decontamination":
            assert got == clean(before) and len(got) < len(before)
        else:
            assert set(got) == set(before) and "batch" in docs.columns
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        before = got
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()} == set(before)


def test_bad_documents_go(spark, sf):
    kept = corpus_pipeline.quality(spark, table(spark, sf, "documents"), sf).join(table(spark, sf, "labels"), "doc_id")
    assert kept.where("quality = 1").count() >= 0.95 * table(spark, sf, "labels").where("quality = 1").count()


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_go_through(spark, tmp_path, empty):
    rows = [(1, "a b c"), (1, "a b c"), (1, "d e f"), (2, None), (3, ""), (None, "x y z"), (None, "x y z"), (4, LONG), (5, LONG), (6, "ten words of a benchmark item that nobody should train on")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long"), "cut_id": F.lit(1), "hit_body": F.lit("x"), "n_tokens": F.lit(2)})
    folder = str(tmp_path)
    (docs.where("false") if empty else docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([] if empty else [(9, "of a benchmark item that nobody should train on words ten")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    got = sorted(str(r["doc_id"]) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == ([] if empty else ["1", "1", "2", "4", "6", "None"])
