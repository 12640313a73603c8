"""Session settings for a load of a given size."""

from __future__ import annotations

import math

MEGABYTE = 1 << 20
SHUFFLE_BYTES = 256 * MEGABYTE
TASKS_PER_CORE = 3


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Spark settings under which a shuffle of the whole input fits its tasks into memory.

    A range partitioning (surrogate keys, slices of hot keys) is never split
    afterwards, only joined by AQE, so the number of partitions is set for the
    largest shuffle and left to AQE to lower for all others.
    """
    partitions = max(cores * TASKS_PER_CORE, math.ceil(input_bytes / SHUFFLE_BYTES))
    scan = 512 * MEGABYTE if input_bytes / cores > 4096 * MEGABYTE else 128 * MEGABYTE
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
