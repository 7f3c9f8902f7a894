"""Alignment files of the delta format: two paths, a line NUCMER, then records of alignments with signed distances.

What a line means depends on those before it, so a file is read as one value by one task; files are read in parallel.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import MalformedFile

SCHEMA = "path string, record_ord long, alignment_ord int, ref_name string, query_name string, ref_len long, query_len long, ref_start long, ref_end long, query_start long, query_end long, distances array<long>"
_HEAD = re.compile(r">(\S+) (\S+) (\d+) (\d+)$")


def parse(text: str, path: str = ""):
    """Rows of SCHEMA, as dictionaries."""
    lines = text.split("\n")
    if len(lines) < 2 or lines[1].strip() != "NUCMER":
        raise MalformedFile(f"{path}: no alignment by NUCMER")
    record, alignment, head, row = -1, 0, None, None
    for line in lines[2:]:
        line = line.strip()
        if not line:
            continue
        if line.startswith(">"):
            if not (m := _HEAD.match(line)):
                raise MalformedFile(f"{path}: {line[:80]}")
            record, alignment, row = record + 1, 0, None
            head = {"ref_name": m[1], "query_name": m[2], "ref_len": int(m[3]), "query_len": int(m[4])}
        elif row is None:
            numbers = line.split()
            if head is None or len(numbers) != 7:
                raise MalformedFile(f"{path}: {line[:80]}")
            a, b, c, d = map(int, numbers[:4])
            row = {"path": path, "record_ord": record, "alignment_ord": alignment, **head, "ref_start": a, "ref_end": b, "query_start": c, "query_end": d, "distances": []}
        else:
            row["distances"].append(int(line))
            if line == "0":
                yield row
                row, alignment = None, alignment + 1


def alignments(spark: SparkSession, paths) -> DataFrame:
    """Every alignment of the files; record_ord and alignment_ord are their places in the file."""
    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")

    def read(batches):
        for batch in batches:
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = list(parse(text, path))
                for k in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_pylist(rows[k : k + 10_000], schema=_ARROW)

    return files.mapInArrow(read, SCHEMA)


_ARROW = pa.schema(
    [("path", pa.string()), ("record_ord", pa.int64()), ("alignment_ord", pa.int32()), ("ref_name", pa.string()), ("query_name", pa.string())]
    + [(c, pa.int64()) for c in ("ref_len", "query_len", "ref_start", "ref_end", "query_start", "query_end")]
    + [("distances", pa.list_(pa.int64()))]
)
