"""From raw documents to packed training batches, stage by stage.

1. quality: documents that the pairwise quality classifier rejects go.
2. near_dedup: of each group of documents whose sets of five-word shingles have a similarity of 0.8 or more, chains of
   such links included, the one with the smallest id stays. SimHash signatures find the candidates, whole sets decide.
3. substring_dedup: passages of 50 words that a document of a smaller id has are cut out; who loses all words goes.
4. decontamination: documents that hold a ten-word window of a benchmark item go.
5. packing: the documents left are packed into batches by length; its rows are the pipeline's result.

Edge cases: a document is known by its id and its text. Null ids are larger than all others; rows that repeat an id and a
text are one document and one of them stays, rows of one id with different texts are judged one by one. Null, empty and
wordless texts are scored like others; near_dedup keeps one document without words. Further columns are carried along up
to packing, whatever their names. Empty tables give empty results; without labels nothing is rejected, without benchmark
items nothing is contaminated.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snpspark.llm import decontamination, packing, quality_classifier, simhash, substring_dedup
from snpspark.llm.common import shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return quality_classifier.accepted(docs, quality_classifier.train(docs, labels.where(~quality_classifier.held_out())))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.without_similar(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = substring_dedup.without_passages(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("substring_dedup", substrings), ("decontamination", decontaminate), ("packing", pack)]

#: SQL can express neither the trained classifier nor the best boundaries; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; what each keeps is written as Parquet in the shared checkpoint folder.

    The last stage's rows come from what the stage before it wrote; the folders before that one are deleted on the way.
    """
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
            if k:
                _delete(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
