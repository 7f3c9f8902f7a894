"""What the operators share on the driver's side."""

from __future__ import annotations

import tempfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space that separates words, as a Java regular expression class.
SPACES = r"[\x20\x09-\x0D]+"
#: Leading bits of a hash that number its place in a bit map.
MARKS = 26
#: Rows of a few numbers each that are counted before they are broadcast; more than that are joined by shuffle.
BROADCAST_ROWS = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only on one machine may it be unset; then a
    temporary folder is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not (sc.master or "").startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the folder that all executors share.

    Spark deletes the files when nothing refers to the result any more.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def words_of(text):
    """Array of the words of a text column; empty for null."""
    return F.coalesce(F.array_remove(F.split(text, SPACES), ""), F.array().cast("array<string>"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as no column of `df` has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def bounded(df: DataFrame) -> DataFrame:
    """`df`, stored, and marked to be broadcast if it is counted to have at most BROADCAST_ROWS rows."""
    df = stored(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def columns(df: DataFrame) -> list[np.ndarray]:
    got = df.toArrow()
    return [got[c].combine_chunks().to_numpy(zero_copy_only=False) for c in got.column_names]


def most_frequent(df: DataFrame, col: str, most: int) -> int:
    """The least power of two (0 for all rows) that at most `most` rows of the column reach."""
    sizes = sorted(df.groupBy(F.length(F.bin(col)).alias("bits")).count().collect(), reverse=True)
    held = 0
    for bits, n in sizes:
        held += n
        if held > most:
            return 1 << bits
    return 0


def marks(keys: DataFrame, key: Column) -> np.ndarray:
    """A bit map, of fixed size (2 to the MARKS bits), of hashes; kernels.marked asks it. It spares work, and decides nothing."""
    keys = keys.select(key.alias("key"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned("key", 64 - MARKS).bitwiseAND(63).cast("int"))
    word, bits = columns(keys.groupBy(F.shiftrightunsigned("key", 64 - MARKS + 6).alias("word")).agg(F.bit_or(bit).alias("bits")))
    out = np.zeros(1 << MARKS - 6, np.uint64)
    out[word] = bits.view(np.uint64)
    return out
