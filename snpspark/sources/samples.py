"""The samples of a run, in their order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordered(samples: DataFrame) -> DataFrame:
    """samples with sample_ord, from 0, by identifier (and path, where there is one)."""
    by = [c for c in ("identifier", "path") if c in samples.columns]
    return samples.withColumn("sample_ord", F.row_number().over(Window.orderBy(*by)) - 1)
