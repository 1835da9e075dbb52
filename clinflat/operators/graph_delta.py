"""What changes from one publication of a graph to the next, as triples to drop and to add.

Ids and blank nodes are hashes of their keys, so an unchanged record gives the same triples
each time, and the difference of two graphs is that of two sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat.operators.triples import TRIPLE_COLUMNS
from clinflat.session import stage

ADD, DROP = "add", "drop"


def triple_digest() -> Column:
    """SHA-256 of a triple, 32 bytes. The JSON names the parts, so a missing one shifts nothing."""
    return F.unhex(F.sha2(F.to_json(F.struct(*TRIPLE_COLUMNS)), 256))


def graph_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """``op, s, p, o, o_kind, datatype, lang``: the triples that only one graph has.

    ``op`` is ``drop`` for triples of ``old`` alone, ``add`` for those of ``new`` alone;
    repeated triples count once. Only digests are shuffled, reduced in each task first;
    the digests that differ are written down, and the triples are fetched by a semi join with
    them, which is a broadcast where Spark finds their table small.
    """
    sides = [
        graph.select(triple_digest().alias("digest"), F.lit(op).alias("op"))
        for graph, op in ((old, DROP), (new, ADD))
    ]
    changed = stage(
        sides[0].unionByName(sides[1])
        .groupBy("digest")
        .agg(F.min("op").alias("op"), F.max("op").alias("other"))
        .where(F.col("op") == F.col("other"))
        .drop("other"),
        "graph_changes",
    )
    parts = [
        graph.withColumn("digest", triple_digest())
        .join(changed.where(F.col("op") == op), "digest", "left_semi")
        .dropDuplicates(["digest"])
        .select(F.lit(op).alias("op"), *TRIPLE_COLUMNS)
        for graph, op in ((old, DROP), (new, ADD))
    ]
    return parts[0].unionByName(parts[1])


def apply_delta(old: DataFrame, delta: DataFrame) -> DataFrame:
    """The new graph: ``old`` without the dropped triples and with the added ones.

    Applying a delta twice changes nothing.
    """
    dropped = delta.where(F.col("op") == DROP).select(triple_digest().alias("digest"))
    added = delta.where(F.col("op") == ADD).select(*TRIPLE_COLUMNS)
    known = added.select(triple_digest().alias("digest"))
    kept = (
        old.select(*TRIPLE_COLUMNS)
        .withColumn("digest", triple_digest())
        .join(dropped.unionByName(known), "digest", "left_anti")
        .drop("digest")
    )
    return kept.unionByName(added)
