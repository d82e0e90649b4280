"""Session builder with the settings the jobs rely on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "tallybook",
    *,
    time_zone: str = "UTC",
    master: str | None = None,
    initial_partitions: int = 4096,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session.

    Business days are cut in ``time_zone``. AQE sizes the shuffles: each starts with
    ``initial_partitions`` and is coalesced. It never splits what an aggregate reads, so on a
    large cluster that is the most tasks it can have; small local sessions want fewer.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": time_zone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # What is shuffled per account expands to many payout rows, so even small shuffle
        # partitions are worth a task of their own.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial_partitions),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        **(extra or {}),
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
