"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import contextlib
import math
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Runtime settings. Timestamps are UTC throughout (a month key and a year taken
# from the same instant must agree), casts at the sinks must fail on overflow,
# and a partition replacement must leave the other partitions alone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # The JVM does not compile methods above 8000 bytes of code; the cleaning of
    # forty columns in one generated method would be interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# One shuffle partition per 256 MB of input; adaptive execution merges what
# turns out small and splits what turns out large.
BYTES_PER_PARTITION = 256 << 20
PARTITIONS = "spark.sql.shuffle.partitions"


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the shuffle partitions to suit the input; never lowers them."""
    wanted = math.ceil(input_bytes / BYTES_PER_PARTITION)
    chosen = max(int(spark.conf.get(PARTITIONS)), wanted)
    spark.conf.set(PARTITIONS, chosen)
    return chosen


@contextlib.contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """:func:`size_shuffles` for the jobs inside; the session's own number comes back."""
    previous = spark.conf.get(PARTITIONS)
    try:
        yield size_shuffles(spark, input_bytes)
    finally:
        spark.conf.set(PARTITIONS, previous)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder of the cluster.

    The shared folder is ``spark.checkpoint.dir``. Only a local session may
    fall back to the machine's own temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="lamina-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
