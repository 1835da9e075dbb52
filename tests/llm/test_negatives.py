import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import helpers
from clinflat.llm import hard_negatives as H
from clinflat.llm.queries import ORACLES, op13_hard_negatives
from oracle import compare, connect

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, positives=5, negatives=5):
    """The contract on a list of (id, vector, label); ids 0, 10, 20 ... are anchors."""
    good = [
        (i, [math.floor(Fraction(x) * 256) for x in v], y) for i, v, y in rows
        if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    ids = lambda i: (i is None, i)
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for a, u, y in good:
        if a is None or a % 10:
            continue
        scored = sorted(
            ((clip(sum(p * q for p, q in zip(u, v))), i, z) for i, v, z in good),
            key=lambda r: (-r[0], ids(r[1])),
        )
        for s, p, _ in [r for r in scored if r[2] == y and r[1] != a][:positives]:
            far = [r for r in scored if r[2] != y and 80 * s <= 100 * r[0] <= 100 * s][:negatives]
            out += [(a, p, k, i, s, t) for k, (t, i, _) in enumerate(far, 1)]
    return out


def mined(spark, rows, extra=False, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "vector", "anchor", "score", "i") if extra else ():
        df = df.withColumn(name, F.lit("x"))
    found = H.mine(df, F.col("vec_id") % 10 == 0, **options)
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    ]
    return found


def in_order(rows):
    return sorted(tuple(r) for r in rows)


def vectors(n, dim=6, seed=1, scale=1.0):
    rng = random.Random(seed)
    centre = [[rng.gauss(0.5, 1) * scale for _ in range(dim)] for _ in range(3)]
    return [
        (k, [c + rng.gauss(0, 0.4) * scale for c in centre[rng.randrange(3)]], rng.randrange(4))
        for k in range(n)
    ]


@pytest.mark.parametrize("dim", [1, 6, 70])
def test_products_are_exact(dim):
    rng = np.random.default_rng(dim)
    for scale in (3, 1 << 10, 1 << 20, 1 << 28):
        block = rng.integers(-scale, scale, (37, dim))
        others = rng.integers(-2 * scale, scale, (5, dim))
        packed = H.Products(block, int(others.min()), int(others.max()))
        for v in others:
            want = [sum(int(x) * int(y) for x, y in zip(v, row)) for row in block]
            assert [int(s) for s in packed.scores(v)] == want
    for width in (4, 8, 11):
        values = np.array([0, 5, (1 << 31) - 1, 7], np.uint64)
        assert H.unpack_fields(H.pack_fields(values, width), 4, width).tolist() == values.tolist()


def test_against_brute_force(spark, monkeypatch):
    rows = vectors(300)
    want = in_order(plain(rows))
    assert len(want) > 100
    assert in_order(mined(spark, rows, extra=True).collect()) == want
    monkeypatch.setattr(H, "ANCHORS", 7)
    monkeypatch.setattr(H, "CANDIDATES", 40)
    assert in_order(mined(spark, rows).collect()) == want


def test_ties_and_one_label_for_most(spark):
    rng = random.Random(5)
    rows = [(k, [float(rng.randrange(3)), 1.0], 0 if k % 10 else 1) for k in range(120)]
    rows += [(1000 + k, [2.0, 1.0], 2) for k in range(40)]
    assert in_order(mined(spark, rows).collect()) == in_order(plain(rows))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 3, 7)
    rows += [
        (100, None, 1), (101, [1.0, None, 2.0], 1), (102, [nan, 1.0, 1.0], 1), (103, [inf, 0.0, 0.0], 0),
        (104, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (110, [], 1), (111, [0.5], 2),
        (120, [1e200, 1e300, -1e250], 1), (121, [1e308, 2.0, 3.0], 2), (130, [3e9, 1.0, 1.0], 3),
    ]
    got = mined(spark, rows).collect()
    assert in_order(((r[3] is None, r[1] is None) + tuple(x or 0 for x in r) for r in got)) == in_order(
        (r[3] is None, r[1] is None) + tuple(x or 0 for x in r) for r in plain(rows)
    )
    assert mined(spark, rows[:1]).count() == mined(spark, []).count() == 0
    twice = vectors(50, 4, 9)
    repeated = in_order(mined(spark, twice + twice[:20]).collect())
    assert {r[0] for r in repeated} <= {r[0] for r in twice}


def test_query(spark):
    con = connect(helpers.SF)
    assert compare(op13_hard_negatives(spark, helpers.SF), con, ORACLES["op13_hard_negatives"]) == []
