import hashlib
import json
import sys

import numpy as np
import pytest
from tokenizers import Tokenizer

import helpers
from clinflat.llm import bpe_chunks as B
from clinflat.llm.queries import op3_bpe_chunks, vocabulary

ODD = [
    "<|startoftext|> hi <|endoftext|>" * 400, "<|ENDOFTEXT|> END<|EndOfText|> ab<|endoftext|>ab! Ab!? AB!" * 50, "I'll we'ré ́ a b c\x1d d\x85e " * 500,
    "\n\n \t" * 3000, "Don't STOP " * 2000 + "'S " * 1000, "nospace" * 4000,
    "x" * 9000 + " " + "y" * 9000, "ÀÉ̀ ﬁ Σίσυφος İ " * 900,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def texts_of(spark):
    rows = spark.read.parquet(f"{helpers.SF}/documents.parquet").collect()
    return [r["text"] for r in rows]


def test_whole_texts(spark, library, monkeypatch):
    texts = [t or "" for t in texts_of(spark) + helpers.awkward_texts() + ODD]
    for cache in (300_000, 50):
        monkeypatch.setattr(B, "PIECE_CACHE", cache)
        encoder = B.Encoder(open(vocabulary(), encoding="utf-8").read())
        for text in texts:
            ids, chunks = encoder.encode(text)
            want, decoded = expected(library, text)
            assert np.frombuffer(ids, "<u4").tolist() == want
            assert encoder.decode(ids) == decoded and chunks == len(B.cuts(text))
        assert encoder.repaired > 100  # cuts inside words do occur, and are repaired


def test_pieces_of_a_large_vocabulary_are_kept(monkeypatch):
    encoder = B.Encoder(open(vocabulary(), encoding="utf-8").read())
    texts = [" ".join(f"w{k}x" for k in range(s, s + 10_000)) for s in range(0, 400_000, 10_000)]
    first = [encoder.direct(text) for text in texts][0]
    monkeypatch.setattr(encoder, "_plain", lambda new: pytest.fail(f"{len(new)} pieces encoded again"))
    assert encoder.direct(texts[0]) == first


def test_pieces_in_use_are_kept(monkeypatch):
    monkeypatch.setattr(B, "PIECE_CACHE", 1000)
    encoder = B.Encoder(open(vocabulary(), encoding="utf-8").read())
    plain, seen = encoder._plain, []
    monkeypatch.setattr(encoder, "_plain", lambda new: seen.extend(new) or plain(new))
    common = [f"c{k}x" for k in range(50)]
    for s in range(0, 6000, 150):
        encoder.direct(" ".join([*common, *(f"w{k}x" for k in range(s, s + 50))]))
        encoder.direct(" ".join(f"w{k}x" for k in range(s + 50, s + 150)))
    assert len(seen) == len(set(seen))
    assert len(encoder.pieces) + len(encoder.older) <= 1000 + 2 * 150


def test_caches_of_a_worker_are_small(monkeypatch):
    encoder = B.Encoder(open(vocabulary(), encoding="utf-8").read())
    for s in range(0, 880_000, 20_000):
        encoder.direct(" ".join(f"w{k}x" for k in range(s, s + 20_000)))
    for s in range(0, 24_000):
        encoder.chunk(f"{s} " + "the license of the work " * 40)
    caches = [getattr(encoder, c, {}) for c in ("pieces", "older", "chunks", "older_chunks")]
    held = sum(sys.getsizeof(c) + sum(sys.getsizeof(x) for kv in c.items() for x in kv) for c in caches)
    assert held < 120e6


def test_chunks_in_use_are_kept(monkeypatch):
    monkeypatch.setattr(B, "CHUNK_CACHE", 20_000)
    encoder = B.Encoder(open(vocabulary(), encoding="utf-8").read())
    common = "the license of the work " * 40
    first = encoder.chunk(common)
    for s in range(200):
        encoder.chunk(f"{s} " + common)
        if s % 5 == 0:
            assert encoder.chunk(common) == first
    assert encoder.reused == 40


def test_other_tokenizers(spark):
    """A tokenizer that keeps white space, for which pieces and joins would be wrong."""
    path = vocabulary("byte_bpe_50k.json")
    other, spec = Tokenizer.from_file(path), open(path, encoding="utf-8").read()
    assert not B.splits_at_space(json.loads(spec))
    assert B.splits_at_space(json.load(open(vocabulary(), encoding="utf-8")))
    texts = [t or "" for t in helpers.awkward_texts() + ODD] + ["two words", " a\n b", "x  y"]
    encoder = B.Encoder(spec)
    for text in texts:
        ids, _ = encoder.encode(text)
        want, decoded = expected(other, text)
        assert np.frombuffer(ids, "<u4").tolist() == want and encoder.decode(ids) == decoded
    rows = B.encode_documents(helpers.documents(spark, texts), path).collect()
    assert {r["doc_id"]: r["decoded"] for r in rows} == {
        k: expected(other, t)[1] for k, t in enumerate(texts)
    }


def test_only_files_that_drop_white_space_are_cut():
    spec = json.load(open(vocabulary(), encoding="utf-8"))
    keep = spec["pre_tokenizer"]["pretokenizers"][0]
    for change in ({"behavior": "Isolated"}, {"invert": False}, {"pattern": {"Regex": r"\S+ ?"}}):
        other = spec | {"pre_tokenizer": keep | change}
        assert not B.splits_at_space(other)
    assert B.splits_at_space(spec | {"pre_tokenizer": {"type": "WhitespaceSplit"}})
    assert not B.splits_at_space(spec | {"pre_tokenizer": None})
    assert not B.splits_at_space(spec | {"normalizer": {"type": "NFKC"}})


def test_chunks_follow_the_content():
    shared = helpers.prose(1, 4000)
    a, b = (f"{helpers.prose(k, 300)} {shared}" for k in (2, 3))
    chunks = [
        {t[s:e] for s, e in zip([0, *B.cuts(t)], B.cuts(t))} for t in (a, b)
    ]
    assert len(chunks[0] & chunks[1]) > 0.7 * len(chunks[0])
    for text in [a, "a" * 50_000, "", "x"]:
        ends = B.cuts(text)
        sizes = np.diff([0, *ends])
        assert ends[-1] == len(text) and (sizes[:-1] >= B.LEAST_CHUNK).all()
        assert (sizes <= B.MOST_CHUNK).all()


def test_shared_chunks_are_encoded_once(spark):
    shared = helpers.prose(4, 5000)
    docs = helpers.documents(spark, [shared] * 6 + [helpers.prose(5, 2000)], extra=True)
    rows = B.encode_documents(docs, vocabulary()).collect()
    found = [r for r in rows if r["doc_id"] < 6]
    assert sum(r["reused"] for r in found) >= 5 * found[0]["chunks"]


def test_awkward_tables(spark, library):
    docs = helpers.awkward_rows(spark)
    rows = B.encode_documents(docs, vocabulary()).collect()
    want = sorted(expected(library, r["text"])[1] for r in docs.collect())
    assert sorted(r["decoded"] for r in rows) == want
    assert B.encode_documents(helpers.empty(spark), vocabulary()).count() == 0


def test_query(spark, library):
    rows = {r["doc_id"]: r for r in op3_bpe_chunks(spark, helpers.SF).collect()}
    for d in spark.read.parquet(f"{helpers.SF}/documents.parquet").collect():
        ids, decoded = expected(library, d["text"])
        r = rows[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
