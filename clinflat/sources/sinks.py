"""Sinks: long tables as CSV or parquet, entries and triples as text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat.operators.bundle import envelope


def write_table(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> None:
    """Overwrite ``path``. CSV has a header; one single file only when asked for,
    since that puts the whole table through one task."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        # Quotes inside a value are doubled, as other CSV readers expect.
        writer.option("header", True).option("escape", '"').csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def write_entries(entries: DataFrame, path: str, timestamp: Column | None = None) -> None:
    """Transaction entries, one per line, in ``path/entries``, a folder ``rank=<n>`` for each
    type in bundle order; the bundle's own fields in ``path/envelope``.

    Within a type the order does not matter, so nothing is sorted or moved.
    """
    lines = entries.select("rank", "entry").write.mode("overwrite").partitionBy("rank")
    lines.text(f"{path}/entries")
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    head = entries.sparkSession.range(1).select(
        envelope(now if timestamp is None else timestamp).alias("value")
    )
    head.write.mode("overwrite").text(f"{path}/envelope")


def _escape(c: Column) -> Column:
    for plain, escaped in (
        ("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"),
    ):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


# Characters that N-Triples does not allow in an address.
IRI_ESCAPED = ["\\", *map(chr, range(0x21)), *'<>"{}|^`']


def _address(c: Column) -> Column:
    """An address with the characters that are not allowed written as ``\\uXXXX``."""
    escaped = c
    for x in IRI_ESCAPED:
        escaped = F.replace(escaped, F.lit(x), F.lit(f"\\u{ord(x):04X}"))
    return F.when(c.rlike(r"[\x00-\x20<>\"{}|^`\\]"), escaped).otherwise(c)


def ntriples(triples: DataFrame) -> DataFrame:
    """One N-Triples line per triple, in column ``value``."""

    def node(c: Column) -> Column:
        return F.when(F.startswith(c, F.lit("_:")), c).otherwise(
            F.concat(F.lit("<"), _address(c), F.lit(">"))
        )

    quoted = F.concat(F.lit('"'), _escape(F.col("o")), F.lit('"'))
    suffix = F.coalesce(
        F.concat(F.lit("@"), "lang"), F.concat(F.lit("^^<"), "datatype", F.lit(">")), F.lit("")
    )
    obj = F.when(F.col("o_kind") == "literal", F.concat(quoted, suffix)).otherwise(
        node(F.col("o"))
    )
    return triples.select(
        F.concat(node(F.col("s")), F.lit(" <"), _address(F.col("p")), F.lit("> "), obj, F.lit(" .")).alias("value")
    )


def write_ntriples(triples: DataFrame, path: str) -> None:
    ntriples(triples).write.mode("overwrite").text(path)
