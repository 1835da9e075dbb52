import re

import helpers
from clinflat.llm import license_scan as S
from clinflat.llm.queries import op5_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {t.text: t.label for t in S.PHRASES}


def plain(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    places = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({x for _, x in places})),
    )


def base(r):
    return r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]


TEXTS = [
    "All Rights Reserved. all rights reserved, all-rights-reserved",
    "cc by cc by CC/BY", "cc  by nc", "rights reserved all", "General\nPublic License, " * 3,
    "Released under the MIT License.", "released under the new mit license",
    "Licensed under CC BY-NC 4.0.", "É all rights reserved É",
    helpers.prose(1, 50) + " Permission is hereby granted, free of charge, to any person obtaining "
    "a copy of this nice software and associated documentation files to deal in the software "
    "without restriction " + helpers.prose(2, 30),
    "This work is licensed under the GNU General Public License, version 3.",
]


def test_places_and_labels(spark):
    texts = TEXTS + helpers.awkward_texts()
    docs = helpers.documents(spark, texts, extra=True)
    rows = {r["doc_id"]: r for r in S.summary(S.scan(docs)).collect()}
    for k, t in enumerate(texts):
        assert base(rows[k]) == plain(t)
        assert set(filter(None, rows[k]["base_labels"].split(","))) <= set(rows[k]["labels"].split(","))
    labels = [rows[k]["labels"] for k in range(len(TEXTS))]
    assert labels == [
        "reserved", "cc-by", "cc-by", "", "gpl", "mit", "", "cc-by,cc-by-nc-4.0", "reserved", "mit",
        "gpl,gpl-3.0",
    ]
    assert [rows[k]["score"] for k in (0, 3, 5)] == [1.0, 0.0, 1.0] and 0.8 <= rows[9]["score"] <= 1.0


def test_spans(spark):
    docs = helpers.documents(spark, TEXTS)
    found = {r["doc_id"]: r["spans"] for r in S.scan(docs).collect()}
    assert [(s["start"], s["end"]) for s in found[0]] == [(0, 3), (3, 6), (6, 9)]
    notice = found[9][0]  # one word is put in, so two diagonals were merged
    assert (notice["label"], notice["start"], notice["exact"]) == ("mit", 50, False)
    assert notice["end"] >= 50 + len(S.NOTICES[8].text.split())


def test_awkward_tables(spark):
    docs = helpers.awkward_rows(spark).unionByName(helpers.documents(spark, TEXTS[:1] * 2))
    rows = S.summary(S.scan(docs)).collect()
    assert len(rows) == docs.count()
    assert sum(r["n_base"] for r in rows) == 6
    assert S.scan(helpers.empty(spark)).count() == 0


def test_query(spark):
    rows = {r["doc_id"]: r for r in op5_licenses(spark, helpers.SF).collect()}
    for d in spark.read.parquet(f"{helpers.SF}/documents.parquet").collect():
        assert base(rows[d["doc_id"]]) == plain(d["text"])
