"""Packing of documents into batches by length, with as little padding as possible.

The global histogram of lengths is counted; dynamic programming over it chooses the bucket boundaries for which padding
every document to its bucket's boundary wastes the fewest tokens. Inside a bucket documents are numbered by length, and
as many as the token budget holds at the boundary's length form a batch; a document longer than the budget is a batch
of its own.

The histogram reaches the driver: a cell for each length up to 65,536 tokens, so that for documents up to that length
the boundaries are the best there are. Greater lengths are counted in cells of sixteen leading bits (at most some
32,000 cells for each doubling), with exact sums and the greatest length in a cell as its bound; a bucket's bound is the
length of its longest member. The numbering is distributed: documents are numbered within their cells, of which those
with more than `group` documents are split by a hash, and each cell starts where the counts of those before it end.

Edge cases: null and empty texts have length 0 and lie in the first bucket. Each input row gives a row, repeated rows
too; which of two rows of the same length and id comes first is open, and repeated or null ids are split like others.
Other columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, stored, table, words_of

_EXACT = 16


def boundaries(lengths: np.ndarray, counts: np.ndarray, sums: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` buckets with the least padding.

    lengths: ascending distinct bounds; counts, sums: documents and tokens of each. Padding of one bucket is its bound
    times its documents less their tokens; as the documents before it count only through their number, the best split
    is the least of lines in the bound, taken from a convex hull: buckets x lengths steps.
    """
    n = len(lengths)
    if not n:
        return []
    c, s = np.concatenate([[0], np.cumsum(counts)]).tolist(), np.concatenate([[0], np.cumsum(sums)]).tolist()
    x = [int(v) for v in lengths]
    best = [x[j] * c[j + 1] - s[j + 1] for j in range(n)]  # one bucket for lengths 0 to j
    cuts: list[list[int]] = []
    for _ in range(1, min(buckets, n)):
        hull: list[tuple[int, int, int]] = []  # slope, height, place: padding before less what starts at the place
        at, new, cut = 0, best[:], [-1] * n
        for j in range(1, n):
            slope, height = -c[j], best[j - 1] + s[j]
            while len(hull) > 1:
                (a, p, _), (b, q, _) = hull[-2], hull[-1]
                if (height - p) * (a - b) <= (q - p) * (a - slope):
                    hull.pop()
                else:
                    break
            hull.append((slope, height, j))
            at = min(at, len(hull) - 1)
            while at + 1 < len(hull) and hull[at + 1][0] * x[j] + hull[at + 1][1] <= hull[at][0] * x[j] + hull[at][1]:
                at += 1
            value = hull[at][0] * x[j] + hull[at][1] + x[j] * c[j + 1] - s[j + 1]
            if value < best[j]:
                new[j], cut[j] = value, hull[at][2]
        cuts.append(cut)
        best = new
    out, j = [], n - 1
    for cut in [*reversed(cuts), [-1] * n]:
        if cut[j] >= 0:
            out.append(x[j])
            j = cut[j] - 1
    out.append(x[j])
    return out[::-1]


def cell(n: Column) -> Column:
    """n, rounded up to its sixteen leading bits."""
    bits = F.greatest(F.length(F.bin(F.greatest(n, F.lit(1)) - 1)) - _EXACT, F.lit(0))
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), bits.cast("int"))
    return (F.ceil(n / unit) * unit).cast("long")


def pack(docs: DataFrame, id_col="doc_id", length: Column | None = None, text_col="text", *, buckets=16, budget=32_768, group=20_000) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_tokens (its bound), batch (numbers unique over all buckets) and slot."""
    length = F.size(words_of(F.col(text_col))) if length is None else length
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), length.cast("long").alias("n_tokens")))
    rows = rows.withColumn("cell", cell(F.col("n_tokens")))
    histogram = rows.groupBy("cell").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("tokens"), F.max("n_tokens").alias("most"))
    bounds = boundaries(*columns(histogram.orderBy("cell").select("most", "n", "tokens")), buckets)
    bucket, bound = F.lit(len(bounds) - 1), F.lit(bounds[-1] if bounds else 0).cast("long")
    for k in range(len(bounds) - 2, -1, -1):
        inside = F.col("n_tokens") <= bounds[k]
        bucket, bound = F.when(inside, k).otherwise(bucket), F.when(inside, F.lit(bounds[k]).cast("long")).otherwise(bound)
    # The histogram is small (see above) and says into how many groups a cell is split. Rows are stored, so that each
    # has its partition for good; with its number repeated ids are split too.
    splits = histogram.select("cell", F.ceil(F.col("n") / group).alias("splits"))
    rows = rows.join(F.broadcast(splits), "cell").withColumn("split", F.when(F.col("splits") > 1, F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), "splits")).otherwise(0))
    rows = rows.withColumn("bucket", bucket).withColumn("bucket_tokens", bound)
    own = Window.partitionBy("cell", "split").orderBy("n_tokens", "doc_id")
    groups = rows.groupBy("bucket", "cell", "split").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("cell", "split").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("cell", "split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    out = rows.withColumn("own", F.row_number().over(own) - 1).join(starts, ["cell", "split"]).withColumn("place", F.col("start") + F.col("own"))
    holds = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket_tokens", F.lit(1))), F.lit(1)).cast("long")
    # Of two numbers, the bucket's comes last, so that numbers of batches stay small.
    batch = F.floor(F.col("place") / holds) * max(1, len(bounds)) + F.col("bucket")
    return out.select("doc_id", "n_tokens", "bucket", "bucket_tokens", batch.cast("long").alias("batch"), F.pmod("place", holds).alias("slot"))


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
