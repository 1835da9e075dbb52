"""Where intermediate tables go, and whether a lookup table is small."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup whose measured text is at most this large may be broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``, as it is configured.

    A ``file:`` folder may be a mount that every executor has, so only a missing setting is
    refused: a local session then gets a folder of its own; on a cluster a machine-local
    folder would not survive a lost executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="clinflat-")
    return _local_dirs[context.applicationId]


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files when they end.

    Otherwise the files stay until the driver happens to collect its garbage.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as parquet in the shared folder and read it back.

    Several consumers then read columns of a table instead of repeating the JSON
    parsing, and a lost executor costs nothing but the running tasks.
    """
    spark = df.sparkSession
    path = table_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame) -> int:
    """Exact size of a frame's columns as text, measured by one distributed pass."""
    width = F.lit(16)
    for field in df.schema.fields:
        width = width + F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0))
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("n")).first()["n"]


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return text_bytes(df) <= limit
