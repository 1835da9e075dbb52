import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import helpers
from clinflat.llm import collocations as C
from clinflat.llm.queries import ORACLES, op11_collocations
from oracle import compare, connect


def pieces(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
        yield [w for w in re.split(r"[\x20\x09]+", piece) if w]


def plain(rows, least, longest=5, top=2000, share=100):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for words in pieces(text):
            for k in range(1, longest + 1):
                counts[lang or "und" if lang is None else lang].update(zip(*(words[j:] for j in range(k))))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = [p for p, c in f.items() if len(p) > 1 and c >= least]
        inside = {
            q[i : i + m] for q in often for m in range(2, len(q)) for i in range(len(q) - m + 1)
            if 100 * f[q] >= share * f[q[i : i + m]]
        }
        scored = []
        for p in often:
            if p not in inside:
                cuts = [(1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        scored.sort()
        out += [
            (lang, rank, p.decode(), -a, l, r, n, -s)
            for rank, (s, a, p, l, r) in enumerate(scored[:top], 1)
        ]
    return sorted(out)


def texts():
    rng = random.Random(2)
    common = ["new york city", "as well as", "Red Car", "a b c d e f", "is a", "over and over and over"]
    out = []
    for k in range(80):
        words = [rng.choice(common + helpers.VOCABULARY[:6]) for _ in range(rng.randrange(60))]
        out.append("".join(w + rng.choice([" ", "  ", "\t", ", ", ". ", "\n", " \r\n", "\x1c"]) for w in words))
    return out


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "lang string, text string")
    for name in ("h", "f", "n", "words", "phrase", "rank") if extra else ():
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.mark.parametrize("limits", [{}, {"SLICE": 40, "HELD": 50, "KNOWN_WORDS": 9, "PARTS": {1: 3, 2: 2}}])
def test_against_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(C, name, value)
    langs = ["en", "fr", None, "und", ""]
    rows = [(langs[k % 5], t) for k, t in enumerate(texts())]
    rows += [("en", t) for t in helpers.awkward_texts()] + rows[:7]
    docs = frame(spark, rows, extra=True).repartition(3)
    for least, top, share in ((4, 2000, 100), (2, 15, 60)):
        found = C.mine(docs, least=least, top=top, share=share)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        want = plain(rows, least, top=top, share=share)
        assert len(want) > 40
        assert sorted(tuple(r) for r in found.collect()) == want


def test_stripe_sums_are_the_prefix_counts(spark):
    docs = frame(spark, [("en", t) for t in texts()])
    found = C.frequent(docs, 3)[1].collect()
    by_words = {tuple(r["words"]): r for r in found}
    assert all(r["prefix_f"] == r["f"] for r in found if len(r["words"]) < 5)
    for words, r in by_words.items():
        behind = [x["f"] for w, x in by_words.items() if w[:-1] == words]
        assert len(words) == 5 or max(behind, default=0) == (r["right"] if r["right"] >= 3 else 0)


def test_large_counts(spark):
    docs = frame(spark, [("en", "big deal " * 3000)] * 40 + [("en", "big"), ("en", "deal")])
    row = C.mine(docs, least=100, longest=2).where("phrase = 'deal big'").collect()[0]
    a, n = 2999 * 40, 6000 * 40 + 2
    assert (row["a"], row["n"], row["score"]) == (a, n, 1000 * a * n // 120_001**2)


def test_empty_tables(spark):
    assert C.mine(helpers.empty(spark)).count() == 0
    assert C.mine(frame(spark, [(None, None), ("en", ""), (None, " . ")])).count() == 0
    assert C.mine(helpers.awkward_rows(spark), least=2).where("lang not in ('en', 'und')").count() == 0


def test_query(spark):
    con = connect(helpers.SF)
    assert compare(op11_collocations(spark, helpers.SF), con, ORACLES["op11_collocations"]) == []
