import math
import zlib
from collections import Counter

import pytest

import helpers
from clinflat.llm import interpolated_lm as L
from clinflat.llm.packing import pack, unpack
from clinflat.llm.queries import op4_interpolated_lm


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def bucket(c):
    return c.bit_length()


def plain(rows):
    """Weights by EM on held-back documents, then all scores, with dictionaries."""

    def counts(folds):
        word, pair = Counter(), Counter()
        for i, t in rows:
            if fold(i) in folds:
                w = tokens(t)
                word.update(w)
                word[b"\r"] += 1
                pair.update(zip([b"\r", *w], w))
        n = sum(c for w, c in word.items() if w != b"\r")
        return word, pair, n, len(word) - (b"\r" in word)

    word, pair, n, v = counts({0, 1, 4, 5, 6})
    held = []
    for i, t in rows:
        if fold(i) == 3:
            w = tokens(t)
            for h, x in zip([b"\r", *w], w):
                c = word[h]
                held.append((bucket(c), pair[h, x] / c if c else 0.0, word[x] / max(n, 1)))
    held = Counter(held)
    weights = [[0.0, 0.5, 0.5]] + [[1 / 3] * 3 for _ in range(L.BUCKETS - 1)]
    for _ in range(L.STEPS):
        sums = [[0.0] * 3 for _ in weights]
        for (b, p2, p1), k in held.items():
            parts = [weights[b][0] * p2, weights[b][1] * p1, weights[b][2] / (v + 1)]
            for j in range(3):
                sums[b][j] += k * parts[j] / sum(parts)
        new = []
        for old, s in zip(weights, sums):
            s = [x / sum(s) for x in s] if sum(s) else old
            s = [s[0], max(s[1], L.LEAST_WEIGHT), max(s[2], L.LEAST_WEIGHT)]
            new.append([x / sum(s) for x in s])
        change = max(abs(a - b) for x, y in zip(new, weights) for a, b in zip(x, y))
        weights = new
        if change < L.TOLERANCE:
            break
    word, pair, n, v = counts({0, 1, 3, 4, 5, 6})
    out = []
    for i, t in rows:
        w, base, score = tokens(t), 0.0, 0.0
        for h, x in zip([b"\r", *w], w):
            c = word[h]
            a, u, z = weights[bucket(c)]
            p = a * (pair[h, x] / c if c else 0.0) + u * word[x] / max(n, 1) + z / (v + 1)
            score += math.log10(p)
            base += math.log10((word[x] + 1) / (n + v + 1))
        out.append((i, fold(i) == 2, len(w), sum(word[x] > 0 for x in w), n, base, score))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 3))
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("block_bytes,range_keys", [(L.BLOCK_BYTES, L.RANGE_KEYS), (4000, 150)])
def test_against_dictionaries(spark, block_bytes, range_keys):
    texts = helpers.awkward_texts() + [helpers.prose(k % 17, 20 + 7 * (k % 13)) for k in range(70)]
    docs = helpers.documents(spark, texts, extra=True).repartition(3, "doc_id")
    rows = L.score(docs, block_bytes=block_bytes, range_keys=range_keys).collect()
    same(rows, plain(list(enumerate(texts))))


def test_awkward_tables(spark):
    docs = helpers.awkward_rows(spark)
    same(L.score(docs).collect(), plain([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert L.score(helpers.empty(spark)).count() == 0
    unseen = next(k for k in range(100) if fold(k) == 2)
    alone = helpers.documents(spark, ["a b"] * (unseen + 1)).where(f"doc_id = {unseen}")
    row = L.score(alone).first()
    assert row["train_tokens"] == row["n_known"] == 0 and row["base_score"] == 0.0


def test_packing():
    import numpy as np

    for kind in (np.uint32, np.uint64):
        values = np.array([0, 1, 255, 1 << 31, 7], kind)
        assert unpack(pack(values), 5, kind).tolist() == values.tolist()


def test_query(spark):
    rows = op4_interpolated_lm(spark, helpers.SF).collect()
    docs = spark.read.parquet(f"{helpers.SF}/documents.parquet").collect()
    same(rows, plain([(d["doc_id"], d["text"]) for d in docs]))


def test_better_than_the_base_on_unseen_documents(spark):
    rows = op4_interpolated_lm(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r["score"] for r in rows) > 0.95 * sum(r["base_score"] for r in rows)
