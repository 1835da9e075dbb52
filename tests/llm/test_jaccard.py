import random

import numpy as np
import pytest

import helpers
from clinflat.llm import jaccard_join as J
from clinflat.llm.queries import op12_jaccard


def plain_set(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))}


def plain(texts, share=90, width=3):
    sets = [plain_set(t, width) for t in texts]
    links = [
        (a, b) for a in range(len(sets)) for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])
    ]
    return {k: (len(s), r) for k, (s, r) in enumerate(zip(sets, helpers.roots(len(sets), links)))}


def got(found):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}


def families():
    base = [helpers.prose(30 + k, 40 + 60 * k) for k in range(6)]
    texts = [helpers.edited(t, 50 * k + c, c % 4) for k, t in enumerate(base) for c in range(14)]
    shared = helpers.prose(90, 200)
    for k in range(30):  # a long passage in unlike texts
        texts.append(f"{shared} {helpers.prose(100 + k, 8 + k)}")
    for k in range(12):  # chains: each like the one before it
        words = helpers.prose(7, 400).split()
        texts.append(" ".join(words[10 * k : 10 * k + 280]))
    return texts + helpers.awkward_texts() + ["x y z", "X y\tz", "p q", "p  q", "solo", "solo", ""]


@pytest.mark.parametrize("limits", [{}, {"TILE": 5, "TILE_BYTES": 3000, "WIDE_FROM": 60, "KNOWN_NODES": 3}])
@pytest.mark.parametrize("share", [90, 70])
def test_against_brute_force(spark, monkeypatch, limits, share):
    for name, value in limits.items():
        monkeypatch.setattr(J, name, value)
    texts = families()
    docs = helpers.documents(spark, texts, extra=True).repartition(3)
    assert got(J.components(docs, share=share)) == plain(texts, share)


def test_links_apart_from_home_are_found(spark, monkeypatch):
    # every document in a tile of its own first, so that all links come from the keys
    monkeypatch.setattr(J, "TILE_BYTES", 0)
    texts = families()
    assert got(J.components(helpers.documents(spark, texts))) == plain(texts)


def test_bitmaps_bound_the_overlap():
    rng = random.Random(4)
    known = J.Words()
    for n in (30, 300, 3000):
        text = helpers.prose(n, n)
        sets = [J.shingle_set(known, helpers.edited(text, s, rng.randrange(n // 5)).encode()) for s in range(30)]
        sets.sort(key=len)
        tile = J.Tile(np.array([len(s) for s in sets]), [J.bitmap(s) for s in sets], 90)
        for i in range(len(sets)):
            near = set(tile.near(i, np.arange(i)).tolist())
            linked = {j for j in range(i) if J.alike(sets[i], sets[j], 90)}
            common = {j: len(np.intersect1d(sets[i], sets[j])) for j in range(i)}
            assert linked <= near
            assert linked == {
                j for j, c in common.items() if 100 * c >= 90 * (len(sets[i]) + len(sets[j]) - c)
            }


def test_linked_sets_share_a_key():
    known, counters = J.Words(), np.random.default_rng(1).integers(0, 9, J.COUNTERS)
    for n in range(3, 60):
        text = helpers.prose(n, n)
        a, b = (J.shingle_set(known, t.encode()) for t in (text, helpers.edited(text, n, 1)))
        if J.alike(a, b, 60):
            keys = [J.banded(J.prefix(s, counters, 60), len(s), 60).tolist() for s in (a, b)]
            assert set(keys[0]) & set(keys[1])


def test_awkward_rows(spark):
    rows = J.components(helpers.awkward_rows(spark)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"] > 0, r["component_id"]) for r in rows) == [
        (False, 5, True, 5), (False, 5, True, 5), (False, 7, True, 5), (False, 7, True, 5), (False, 9, False, 9),
        (True, 0, False, None), (True, 0, True, 5),
    ]
    assert J.components(helpers.empty(spark)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{helpers.SF}/documents.parquet").orderBy("doc_id").collect()
    want = plain([d["text"] for d in docs])
    ids = [d["doc_id"] for d in docs]
    assert got(op12_jaccard(spark, helpers.SF)) == {ids[k]: (n, ids[r]) for k, (n, r) in want.items()}
