"""Session settings the toolkit is tuned for; any Spark 4 session works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A UTC, ANSI, adaptive session.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: spark-submit
    names the master, and adaptive execution merges the shuffle partitions it
    starts with. Tests pass ``local[*]`` and a small number.
    """
    builder = SparkSession.builder.appName("barlake")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
