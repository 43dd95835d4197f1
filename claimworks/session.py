"""Session factory.  Library functions never change the caller's session."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What the operators count on: adaptive execution picks join strategies from
# measured sizes, merges small shuffle partitions and splits skewed ones.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def spark_session(
    app_name: str = "claimworks", master: str | None = None, **conf: str
) -> SparkSession:
    """The active session as it is, or else a new one.

    ``master`` is left to spark-submit when unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
