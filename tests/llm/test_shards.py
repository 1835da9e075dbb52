import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import helpers
from clinflat.llm import feistel_shards as S
from clinflat.llm.queries import ORACLES, op9_sharding
from oracle import compare, connect


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 99, 1000, 4097])
def test_permutation(spark, n):
    a, b = S.domain(n)
    assert a * b >= n and a * b - n < a
    rows = spark.range(n).select(S.permuted(F.col("id"), n).alias("p")).collect()
    got = [r["p"] for r in rows]
    assert sorted(got) == list(range(n))
    again = spark.range(n).select(S.permuted(F.col("id"), n, "other").alias("p")).collect()
    if n > 20:
        assert [r["p"] for r in again] != got
        near = sum(abs(x - y) == 1 for x, y in zip(got, got[1:]))
        assert near < n / 5


def laws(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(counts) <= set(range(shards))
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


def test_shards(spark):
    texts = helpers.awkward_texts() * 9
    docs = helpers.documents(spark, texts, extra=True)
    rows = S.assign(docs).collect()
    laws(rows, S.SHARDS)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
        assert r["number"] == r["doc_id"] and r["law"] == "rows" and r["grown_shard"] is None
    turned = S.assign(docs.orderBy(F.desc("doc_id")).repartition(5)).collect()
    place = lambda rows: {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    assert place(rows) == place(turned)


def test_awkward_tables(spark):
    docs = helpers.awkward_rows(spark)
    rows = S.assign(docs, shards=3).collect()
    assert len(rows) == 7
    laws(rows, 3)
    assert max(r["number"] for r in rows if r["doc_id"] is not None) == 4  # nulls come last
    assert S.assign(helpers.empty(spark)).count() == 0
    same = spark.range(500).select(F.lit(1).cast("long").alias("doc_id"), F.lit("t").alias("text"))
    laws(S.assign(same).collect(), S.SHARDS)


def test_query(spark):
    con = connect(helpers.SF)
    assert compare(op9_sharding(spark, helpers.SF), con, ORACLES["op9_sharding"]) == []
