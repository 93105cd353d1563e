"""Session settings by size of the input."""

from __future__ import annotations

MIB = 1024 * 1024


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings under which partitions fit into an executor core's memory.

    Scan tasks read 256 MiB. A shuffle starts with one partition per 512 MiB, at
    least two per core; AQE merges small ones and splits skewed ones.
    """
    partitions = max(input_bytes // (512 * MIB), 2 * cores)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB),
        "spark.sql.files.maxPartitionBytes": str(256 * MIB),
        "spark.sql.shuffle.partitions": str(partitions),
    }
