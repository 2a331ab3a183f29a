"""Session settings for a given input size and cluster."""

from __future__ import annotations

MIB = 1024 * 1024

#: what a reducer should get; also the unit that small partitions are merged to
REDUCE_BYTES = 128 * MIB
#: what a scan task reads
SCAN_BYTES = 256 * MIB


def session_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a session that loads ``input_bytes`` on ``cores`` cores.

    Shuffles start with enough partitions for the whole input and adaptive
    execution merges the small ones, so narrow steps do not pay for it. Skewed
    sort-merge joins are split at run time in addition to the explicit salt.
    Lookups by key tuples build a Bloom filter from the keys of a load when the
    stored side is large; the filter itself has a fixed greatest size. Steps of
    many columns whose generated method is above 8000 bytes, which the JVM would
    only interpret, are generated in smaller methods.
    """
    partitions = max(3 * cores, -(-input_bytes // REDUCE_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(REDUCE_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(SCAN_BYTES),
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": str(1024 * MIB),
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(1024 * MIB),
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.session.timeZone": "UTC",
    }
