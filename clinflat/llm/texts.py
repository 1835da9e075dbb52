"""Words of a text and the small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8, A-Z lower-cased; none for a null text.

    On bytes, ``lower`` changes A-Z only and ``split`` cuts at just these six characters.
    """
    return [] if text is None else text.encode().lower().split()


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(text, UPPER, LOWER)


def row_key(id_: Column, text: Column) -> list[Column]:
    """Two hashes, together 128 bits, that tell documents apart even without an id."""
    return [F.xxhash64(id_, text), F.xxhash64(F.lit(1), text, id_)]


def shingle_hashes(tokens: Column, width: int) -> Column:
    """Hash of the ``width`` words from each place on; an empty array if there are fewer."""
    last = F.size(tokens) - width
    hashed = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(width)]),
    )
    return F.when(last >= 0, hashed).otherwise(F.array().cast("array<long>"))


def map_rows(
    df: DataFrame, per_row: Callable[..., tuple], schema: str | StructType
) -> DataFrame:
    """One output row for each input row, made by ``per_row(*columns)`` in Arrow batches."""
    arrow = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(per_row(*row) for row in zip(*(c.to_pylist() for c in batch.columns)))))
            columns = rows if rows else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

    # by position, so that any column names will do
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]).mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
