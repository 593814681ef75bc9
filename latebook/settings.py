"""Session settings the jobs are designed for; the caller's session keeps the last word."""

from __future__ import annotations

PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Enough shuffle partitions for about 128 MiB each, at least two per core.

    Adaptive execution merges the ones that turn out small.
    """
    return max(2 * cores, -(-shuffled_bytes // PARTITION_BYTES))


def session_conf(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """For ``SparkSession.builder.config(map=...)``."""
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions(shuffled_bytes, cores)),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }
