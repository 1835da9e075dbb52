import re
from collections import Counter

import helpers
from clinflat.llm import decontamination as D
from clinflat.llm.queries import op6_decontamination

SPLIT = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return [w for w in SPLIT.split((text or "").lower()) if w]


def similarity(a, b):
    width = min(5, len(b))
    x, y = (Counter(zip(*(v[k:] for k in range(width)))) for v in (a, b))
    return sum((x & y).values()) / max(sum((x | y).values()), 1)


def plain(docs, items):
    """(document, item) pairs with a window of the item's length at 0.8 or more."""
    found = {}
    for d, text in docs:
        tokens = words(text)
        for i, item in items:
            want = words(item)
            if not want:
                continue
            for s in range(max(len(tokens) - len(want) + 1, 1)):
                v = similarity(tokens[s : s + len(want)], want)
                if v >= 0.8:
                    found[d, i] = max(found.get((d, i), 0), v)
    return found


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def fixture():
    items = [helpers.prose(500 + k, 12 + 6 * k) for k in range(8)] + ["Four little words here", "", None]
    items.append(items[2])
    texts = list(helpers.awkward_texts())
    for k in range(24):
        item = items[k % 8].split()
        if k % 3 == 1:
            item[len(item) // 2] = "changed"
        if k % 3 == 2:
            item.insert(len(item) // 2, "added")
        body = " ".join(item)
        body = body.upper().replace(" ", ", ") if k % 2 else body
        texts.append(f"{helpers.prose(600 + k, 40)}. {body}! {helpers.prose(700 + k, 30)}")
    texts += [items[5], "so, four LITTLE words: here we are", items[0] + " " + items[0]]
    return texts, items


def test_against_all_windows(spark):
    texts, items = fixture()
    docs = helpers.documents(spark, texts, extra=True)
    rows = D.matches(docs, bench(spark, items)).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows}
    want = plain(list(enumerate(texts)), list(enumerate(items)))
    assert len(got) == len(rows) and set(got) <= set(want)
    for k, v in want.items():
        if v > 0.99:
            assert abs(got[k] - v) < 1e-9  # a whole passage has distance zero
    missed = [k for k in want if k not in got]
    assert len(missed) <= 0.05 * len(want)  # beyond the radius of the fingerprints
    for r in rows:
        window = words(texts[r["doc_id"]])[r["start"] : r["start"] + r["n_words"]]
        assert abs(similarity(window, words(items[r["item_id"]])) - r["similarity"]) < 1e-9
        assert r["distance"] <= D.RADIUS and r["n_windows"] >= 1


def test_reordered_passages(spark):
    items, texts = [helpers.prose(900 + n, n) for n in (40, 50, 58, 80)], []
    for k, item in enumerate(items):
        half = item.split()[len(item.split()) // 2 :] + item.split()[: len(item.split()) // 2]
        filler = helpers.prose(1950 + k, 60)
        texts += [f"{filler} {' '.join(half)}", f"{filler} {' '.join(half)} {filler}", " ".join(half)]
    want = plain(list(enumerate(texts)), list(enumerate(items)))
    assert len(want) == 12
    rows = D.matches(helpers.documents(spark, texts), bench(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in rows} == {
        k: round(v, 9) for k, v in want.items()
    }
    for r in rows:  # every window that reaches it is counted
        tokens, item = words(texts[r["doc_id"]]), words(items[r["item_id"]])
        last = max(len(tokens) - 5, 0)
        near = [similarity(tokens[s : s + len(item)], item) >= 0.8 for s in range(last + 1)]
        assert 1 <= r["n_windows"] <= sum(near)


def test_blocks_find_all_within_the_radius(spark):
    import random

    rng, rows = random.Random(5), []
    for k in range(400):
        x = rng.getrandbits(63)
        y = x ^ sum({1 << rng.randrange(63) for _ in range(rng.randrange(D.RADIUS + 1))})
        rows.append((k, x, y))
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "k long, x long, y long")
    probes = df.select("k", F.inline(D._blocks(F.col("x"), True)))
    blocks = df.select("k", F.inline(D._blocks(F.col("y"), False)))
    assert probes.join(blocks, ["k", "block", "value"]).select("k").distinct().count() == 400


def test_simhash(spark):
    from pyspark.sql import functions as F

    hashes = [5, -1, 1 << 40, -(1 << 63), 5]
    got = spark.range(1).select(D.simhash(F.array(*[F.lit(h) for h in hashes]))).first()[0]
    want = 0
    for b in range(64):
        want |= (2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b
    assert got & (1 << 64) - 1 == want


def test_awkward_tables(spark):
    docs = helpers.awkward_rows(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    items = bench(spark, [helpers.prose(11, 200), None, ""])
    assert D.matches(docs, none).count() == D.matches(helpers.empty(spark), items).count() == 0
    found = D.matches(docs, items).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in found) == [(False, 5), (True, None)]
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == [5, 7, 7, 9, None]
    assert D.drop_contaminated(docs, none).count() == docs.count()


def test_query(spark):
    found = op6_decontamination(spark, helpers.SF).collect()
    docs = spark.read.parquet(f"{helpers.SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{helpers.SF}/benchmark.parquet").collect()
    tokens = {d["doc_id"]: " " + " ".join(words(d["text"])) + " " for d in docs}
    verbatim = {
        (d, i["item_id"]) for d, t in tokens.items() for i in items
        if " " + " ".join(words(i["text"])) + " " in t
    }
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert verbatim <= got and len(got) <= 1.2 * len(verbatim) + 2
