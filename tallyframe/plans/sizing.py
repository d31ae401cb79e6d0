"""Task sizes from the size of the source, for the duration of one publication."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

MB = 1024 * 1024
SCAN = "spark.sql.files.maxPartitionBytes"
SHUFFLE = "spark.sql.shuffle.partitions"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# One shuffle partition per 256 MB of source, whatever its size: 100 TB have 400,000.
# Beyond a TB a scan task reads 512 MB, which it streams, so that there are as many
# shuffle blocks as need be and no more.
PARTITION_BYTES = 256 * MB
SCAN_BYTES = 128 * MB
LARGE_SCAN_BYTES = 512 * MB
LARGE = 1024 * 1024 * MB


def source_bytes(spark: SparkSession, path: str) -> int:
    """Total file size, from the listing alone; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def settings_for(size: int) -> tuple[int, int]:
    """(shuffle partitions, bytes per scan task) for a source of ``size`` bytes."""
    return ceil(size / PARTITION_BYTES), LARGE_SCAN_BYTES if size > LARGE else SCAN_BYTES


@contextmanager
def sized_for(spark: SparkSession, size: int) -> Iterator[None]:
    """Raise the session's task sizes where the source asks for it, then restore them.

    Adaptive execution still merges partitions that turn out small.
    """
    partitions, scan = settings_for(size)
    wanted = {}
    current = spark.conf.get(INITIAL, None) or spark.conf.get(SHUFFLE)
    if partitions > int(current):
        wanted |= {SHUFFLE: str(partitions), INITIAL: str(partitions)}
    if scan > SCAN_BYTES:
        wanted[SCAN] = str(scan)
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
