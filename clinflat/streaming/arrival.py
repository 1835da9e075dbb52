"""Resources that arrive in steps: files of JSON lines into the lake, each file once.

A micro-batch writes its own folder ``batch=<number>`` of the lake and, if asked, its own part
of the states. Both replace what a broken attempt at the same batch left, and the stream's
checkpoint gives a restarted batch the same files, so every file is in the lake exactly once.
A batch that is being written is seen in parts by readers of the lake; read between batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clinflat.operators.states import resource_states, write_states
from clinflat.session import shuffles_dropped
from clinflat.sources.resources import from_json_lines, read_lake, with_promoted, write_lake


def arriving(spark: SparkSession, path: str, files_a_batch: int = 1000) -> DataFrame:
    """Stream of the resources in the text files of a folder, oldest files first."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_a_batch)
    return from_json_lines(lines.load(path))


def add_batch(lake: str, states: str | None = None) -> Callable[[DataFrame, int], None]:
    """What to do with a batch: its rows into the lake, its numbers into the states."""

    def add(batch: DataFrame, number: int) -> None:
        folder = f"{lake}/batch={number}"
        with shuffles_dropped(batch.sparkSession):  # a stream has many batches
            write_lake(batch, folder)
        if states is not None:
            stored = read_lake(batch.sparkSession, folder)
            write_states(resource_states(stored, F.lit(f"batch-{number}")), states)

    return add


def write_arrivals(
    resources: DataFrame, lake: str, checkpoint: str, states: str | None = None
) -> StreamingQuery:
    """Take everything that has arrived, in batches, and stop; started again, go on from there."""
    return (
        resources.writeStream.foreachBatch(add_batch(lake, states))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_arrivals(spark: SparkSession, lake: str) -> DataFrame:
    """The lake of all batches, with the columns of one that was written at once."""
    columns = with_promoted(
        spark.createDataFrame([], "resource_type string, id string, json string")
    ).columns
    return read_lake(spark, lake).select(*columns)
