"""Reproducible sharding by a Feistel permutation of global row numbers.

Rows are numbered 0..n-1 in the order of their ids. The permutation works on pairs
(l, r) with l < a and r < b, where a * b is the smallest such product of near-equal
factors that is at least n: rounds add a keyed hash of one half to the other, modulo its
range. A result of n or more is permuted again until it falls below n (cycle walking).
The permuted number p gives shard p mod k and slot p div k, so shard sizes differ by at
most one row, slots have no gaps, and a row's place follows from its number alone.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflat.session import stage

SHARDS = 40
SEED = "shards"
ROUNDS = 6
WALKS = 64  # fewer than a numbers lie outside 0..n-1, so a longer walk is all but impossible
OVERHEAD = 16
ROW_BITS = 33  # monotonically_increasing_id keeps the place within a partition here


def domain(n: int) -> tuple[int, int]:
    """Factors a, b with a * b >= n and a * b - n < a."""
    a = max(1, isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _keyed(seed: str, k: Column, half: Column) -> Column:
    text = F.concat_ws(":", F.lit(seed), k.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def _permute(x: Column, a: int, b: int, seed: str, rounds: int) -> Column:
    def step(s: Column, k: Column) -> Column:
        left, right = s["l"], s["r"]
        even = F.struct(
            ((left + _keyed(seed, k, right)) % a).alias("l"), right.alias("r")
        )
        odd = F.struct(left.alias("l"), ((right + _keyed(seed, k, left)) % b).alias("r"))
        return F.when(k % 2 == 0, even).otherwise(odd)

    # x % b first: the quotient is then exact in whole numbers
    right = x % b
    start = F.struct(((x - right) / b).cast("long").alias("l"), right.alias("r"))
    ended = F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, step)
    return ended["l"] * b + ended["r"]


def permuted(number: Column, n: int, seed: str = SEED, rounds: int = ROUNDS) -> Column:
    """Where row ``number`` of 0..n-1 goes; a permutation of 0..n-1."""
    a, b = domain(n)
    again = lambda x: _permute(x, a, b, seed, rounds)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(min(a, WALKS))),
        again(number),
        lambda x, _: F.when(x < n, x).otherwise(again(x)),
    )
    return F.when(walked < n, walked).otherwise(
        F.raise_error(F.lit("cycle walk too long: choose another seed")).cast("long")
    )


def row_numbers(df: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """The rows with ``number`` 0..n-1 in the given order (nulls last), and n.

    Rows are dealt out by ranges and sorted there; what is numbered in one place is one
    row for each partition.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    placed = stage(ranged.withColumn("mid", F.monotonically_increasing_id()), "sorted-rows")
    part = F.shiftright("mid", ROW_BITS)
    sizes = placed.groupBy(part.alias("part")).count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rows_before = F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
    first, n = sizes.select("part", rows_before), placed.count()
    within = F.col("mid").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    numbered = placed.withColumn("part", part).join(F.broadcast(first), "part")
    return numbered.withColumn("number", F.col("first") + within).drop("part", "first", "mid"), n


def assign(
    docs: DataFrame, shards: int = SHARDS, seed: str = SEED, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, number`` for each row.

    The law is ``rows``: shard sizes differ by at most one. ``size`` is the text's UTF-8
    bytes plus 16; a null text has no bytes and the checksum of none, 0. Rows are numbered
    by id, nulls last, then by checksum, size and a hash of the text, so a rerun gives the
    same shards; rows that are equal in all of these may change places with each other.
    An empty table gives an empty result. Other columns are not read.
    """
    text = docs[text_col]
    slim = docs.select(
        docs[id_col].alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.xxhash64(text).alias("tie"),
    )
    slim = stage(slim, "shard-rows")  # the ranges are sampled from small rows, not from texts
    numbered, n = row_numbers(slim, "doc_id", "text_crc32", "size", "tie")
    placed = numbered.withColumn("p", permuted(F.col("number"), n, seed))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("p") % shards).cast("int").alias("shard"),
        F.expr(f"p div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "number",
    )
