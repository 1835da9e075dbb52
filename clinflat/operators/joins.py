"""Left lookup join that holds up when one key has a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflat.session import BROADCAST_BYTES, text_bytes

# Places that rows without a key are spread over.
SPREAD = 256
# A lookup's mean bytes in a partition up to which it is hashed in memory instead of sorted.
HASHED_BYTES = 16 * 1024 * 1024


def left_lookup(
    facts: DataFrame, lookup: DataFrame, on: list[str], limit: int = BROADCAST_BYTES,
    few_keyed: bool = False,
) -> DataFrame:
    """``facts`` left-joined to ``lookup`` on equal keys.

    The lookup is measured and broadcast only if it is at most ``limit`` bytes. A larger
    one is joined by key, once and without copies: partitions that a frequent key makes
    large are split by adaptive execution. The planner may not broadcast it after all: it goes
    by the bytes of the files, and a lookup is unfolded from fewer. The facts are not sorted, which would
    write them to disk again, unless a partition of the lookup is too large for memory.

    Rows without a key match nothing; they get a number from a hash of the row as another key, so
    that they don't pile up. With ``few_keyed`` most rows are of that kind: they stay where they
    are, for the price of reading the facts twice.
    """
    size = text_bytes(lookup)
    if 0 < limit and size <= limit:
        return facts.join(F.broadcast(lookup), on, "left")
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    way = "shuffle_hash" if size <= HASHED_BYTES * partitions else "merge"
    keyless = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    if few_keyed:
        matched = facts.where(~keyless).join(lookup.hint(way), on, "left")
        return matched.unionByName(facts.where(keyless), allowMissingColumns=True)
    place = F.pmod(F.xxhash64(*facts.columns), F.lit(SPREAD)).cast("int") + 1
    spread = facts.withColumn("__spread", F.when(keyless, place).otherwise(0))
    keyed = lookup.withColumn("__spread", F.lit(0)).hint(way)
    return spread.join(keyed, [*on, "__spread"], "left").drop("__spread")
