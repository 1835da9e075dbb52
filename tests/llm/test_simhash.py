import random

import numpy as np
import pytest
import xxhash

import helpers
from clinflat.llm import simhash_dedup as S
from clinflat.llm.components import connected
from clinflat.llm.queries import op1_simhash


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [words[i : i + width] for i in range(max(len(words) - width + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids, radius=3):
    n = len(prints)
    links = [
        (a, b) for a in range(n) for b in range(a)
        if (prints[a] ^ prints[b]).bit_count() <= radius
    ]
    root = helpers.roots(n, links)
    least = {}
    for k, r in enumerate(root):
        if ids[k] is not None:
            least[r] = min(least.get(r, ids[k]), ids[k])
    return [least.get(r) for r in root]


def test_fingerprint():
    for text in [*helpers.awkward_texts()[:10], "A b C d É"]:
        assert int.from_bytes(S.fingerprint(text), "big") == plain_fingerprint(text)


@pytest.mark.parametrize("depth,radius", [(0, 3), (4, 3), (0, 7), (5, 7)])
def test_close_pairs_in_both_tries(depth, radius):
    rng = random.Random(depth + radius)
    keys = [rng.getrandbits(64) for _ in range(60)]
    keys += [k ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(9))}) for k in keys * 8]
    keys = sorted(set(keys))
    want = {
        (a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if (a ^ b).bit_count() <= radius
    }
    found = set()
    for swap in (False, True):
        turn = lambda k: (k << 32 | k >> 32) & (1 << 64) - 1 if swap else k  # noqa: B023, E731
        nodes = {}
        for k in sorted(map(turn, keys)):
            nodes.setdefault(k >> (64 - depth) if depth else 0, []).append(k)
        tops = sorted(nodes)
        for x in tops:
            for y in tops:
                if x > y:
                    continue
                a, b = (np.array(nodes[t], np.uint64) for t in (x, y))
                for i, j in S.close_pairs(a, b, x == y, depth, radius):
                    for u, v in zip(a[i].tolist(), b[j].tolist()):
                        found.add(tuple(sorted((turn(u), turn(v)))))
    assert found == want


def test_components_split_over_many_tasks(spark):
    base = [helpers.prose(k, 60 + 40 * k) for k in range(6)]
    texts = [helpers.edited(t, 10 * k + c, c % 3) for k, t in enumerate(base) for c in range(12)]
    texts += helpers.awkward_texts()
    docs = helpers.documents(spark, texts, extra=True)
    want = plain_components([plain_fingerprint(t) for t in texts], list(range(len(texts))))
    for most in (10, 40_000):
        rows = S.components(docs, max_nodes=most).collect()
        assert {r["doc_id"]: r["component_id"] for r in rows} == dict(enumerate(want))


def test_awkward_rows(spark):
    docs = helpers.awkward_rows(spark)
    rows = S.components(docs).collect()
    assert len(rows) == docs.count()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"]) for r in rows) == [
        (False, 5, 5), (False, 5, 5), (False, 7, 5), (False, 7, 5), (False, 9, 9), (True, 0, 5), (True, 0, 9),
    ]
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] is None) for r in kept.collect()) == [
        (5, False), (5, False), (9, True),
    ]
    assert S.components(helpers.empty(spark)).count() == S.keep_one(helpers.empty(spark)).count() == 0


def test_keep_one_of_near_copies(spark):
    base = [helpers.prose(50 + k, 4000) for k in range(5)]
    texts = [helpers.edited(t, k, 1) for t in base for k in range(6)] + base
    prints = [plain_fingerprint(t) for t in texts]
    want = set(plain_components(prints, list(range(len(texts)))))
    kept = S.keep_one(helpers.documents(spark, texts, extra=True)).collect()
    assert {r["doc_id"] for r in kept} == want and len(kept) == len(want) < 20


def test_connected(spark):
    rng = random.Random(3)
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, 100 + k) for k in range(1, 60)]
    random_ = [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    links = chain + star + random_ + [(1, 1)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(links, "u long, v long")).collect()}
    root = helpers.roots(300, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {k: root[k] for k in linked}


def test_query(spark):
    rows = op1_simhash(spark, helpers.SF).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{helpers.SF}/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_fingerprint(d["text"]) for d in docs]
    want = plain_components(prints, [d["doc_id"] for d in docs])
    assert [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows] == [
        (d["doc_id"], f"{p:016x}", c) for d, p, c in zip(docs, prints, want)
    ]
