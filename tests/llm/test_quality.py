import random
from collections import Counter

import helpers
from clinflat.llm import compression_rules as R
from clinflat.llm.queries import op8_quality


def plain(text):
    data = (text or "").encode()
    words = data.split()
    grams = Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    lines, seen, dup = data.split(b"\n"), set(), 0
    for line in lines:
        if line.split():
            dup += line in seen
            seen.add(line)
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    n = len(words)
    return n, chars, symbols, dup, len(inside), n < 50 or 100 * len(inside) > 50 * n


def test_counts():
    for text in helpers.awkward_texts():
        assert R.judge_text(text)[:6] == plain(text)


def test_bands():
    assert R.judge_text(helpers.prose(1, 400))[-1]
    for bad in ("", "word " * 500, "ab cd ef\n" * 400, "one two"):
        assert not R.judge_text(bad)[-1]
    rng = random.Random(2)
    noise = " ".join("".join(chr(rng.randrange(0x21, 0x7F)) for _ in range(8)) for _ in range(3000))
    ratio, bad, chunks = R.compression(noise.encode())
    assert ratio > 0.75 and bad == chunks > 0 and not R.judge_text(noise)[-1]
    assert R.compression(b"") == (None, 0, 0)
    assert R.in_band(100, 1.5, 0, 0) and not R.in_band(100_000, 0.05, 0, 24)
    assert not R.in_band(100_000, 0.4, 7, 24) and R.in_band(100_000, 0.4, 6, 24)


def test_junk_is_found_wherever_it_stands():
    junk = "=" * 3900
    for k in range(5):
        text = helpers.prose(40 + k, 2000).replace("é", "e")[:4140]
        assert R.judge_text(text)[-1]
        for whole in (f"{text} {junk}", f"{junk} {text}"):
            *_, bad, chunks, kept = R.judge_text(whole)
            assert bad >= 1 and chunks == 2 and not kept
    even = helpers.prose(46, 2000).encode()[:8192]
    assert R.compression(even)[1:] == (0, 2) and R.compression(even + b"x")[2] == 3
    assert R.compression(even[:4095])[2] == 0


def test_awkward_tables(spark):
    docs = helpers.awkward_rows(spark)
    judged = R.judge(docs)
    assert judged.count() == docs.count()
    kept = R.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == 5
    texts = helpers.documents(spark, helpers.awkward_texts(), extra=True)
    assert R.keep_good(texts).columns == texts.columns
    assert R.judge(texts).columns[:2] == ["doc_id", "n_words"]
    assert R.judge(helpers.empty(spark)).count() == R.keep_good(helpers.empty(spark)).count() == 0
    odd = docs.withColumnRenamed("lang", "a.b")
    assert R.keep_good(odd).columns == odd.columns


def test_query_keeps_good_documents(spark):
    rows = {r["doc_id"]: r for r in op8_quality(spark, helpers.SF).collect()}
    docs = spark.read.parquet(f"{helpers.SF}/documents.parquet").collect()
    for d in docs:
        r = rows[d["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == plain(d["text"])
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    good = {r["doc_id"] for r in labels.collect()}
    judged = op8_quality(spark, "/root/testdata/sf0.01").where("not base_failed").collect()
    wrong = [r["doc_id"] for r in judged if r["doc_id"] in good and not r["kept"]]
    assert wrong == []
