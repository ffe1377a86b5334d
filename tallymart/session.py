"""Session settings for a given size of work. The library itself sets none."""

PARTITION_BYTES = 128 << 20


def settings(cores: int, shuffle_bytes: int, broadcast_bytes: int = 10 << 20) -> dict[str, str]:
    """Settings for ``cores`` in total and the largest expected shuffle.

    Shuffles start with partitions of about 128 MB, at least two per core, and
    adaptive execution merges small ones and splits skewed ones while the query
    runs. Broadcasts stay behind Spark's own size check, ``broadcast_bytes`` by file
    statistics; raise it when executors have memory for larger dimensions, as
    each one that fits saves a shuffle of the facts.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # hashing and drawing cost more per byte than plain rows: keep small shuffles on all cores
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "65536",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }
