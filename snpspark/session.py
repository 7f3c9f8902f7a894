"""The session that the command line and the tests use; any other session with these settings serves as well."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.caseSensitive": "true",  # sample names may differ in case alone
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def _placed() -> bool:
    """Whether the caller has said where to run: by spark-submit, the environment or a running session."""
    said = "SPARK_REMOTE", "PYSPARK_GATEWAY_PORT", "MASTER", "SPARK_MASTER"
    return any(x in os.environ for x in said) or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "") or SparkSession.getActiveSession() is not None


def session(cores: int | None = None, **more: str) -> SparkSession:
    """A session with these settings. The master and the number of shuffle partitions are set only on one machine; where
    spark-submit, the environment or `more` names a master, that holds, and so do its settings."""
    builder = SparkSession.builder.appName("snpspark").config(map=SETTINGS | more)
    if not _placed() and "spark.master" not in more:
        cores = cores or os.cpu_count() or 1
        builder = builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", more.get("spark.sql.shuffle.partitions", str(cores)))
    return builder.getOrCreate()
