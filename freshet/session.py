"""A session with the settings the library is tested with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Python workers are reached over socket files, not local ports.
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(master: str | None = None, parallelism: int | None = None, **settings: str) -> SparkSession:
    """Create or reuse a session.

    ``parallelism`` sets the number of shuffle partitions, the job-wide
    parallelism; a single step is changed with ``repartition`` / ``coalesce``.
    Leave ``master`` unset on a cluster, where the submit command names it.
    """
    builder = SparkSession.builder.appName("freshet")
    if master:
        builder = builder.master(master)
    if parallelism:
        builder = builder.config("spark.sql.shuffle.partitions", str(parallelism))
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
