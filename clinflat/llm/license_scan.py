"""License scans by diagonal voting.

Hashes of all rolling word k-grams are joined to the positions of the same k-grams in the
templates. A hit at document word p and template word t votes for the diagonal p - t; a
passage that follows a template puts its votes on one diagonal, and an inserted or lost
word moves it to a neighbouring one. Votes are added up by diagonal, neighbouring
diagonals are merged, and what has enough votes is verified word by word.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflat.llm.texts import ascii_lower, row_key, shingle_hashes

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 3
NEIGHBOUR = 2  # diagonals this many words apart are merged
COVERAGE = 0.8  # share of a template's words, and of its k-grams, that must be found


class Template(NamedTuple):
    """``exact`` templates count only whole, as phrases, on a single diagonal."""

    label: str
    text: str
    exact: bool = False


# Phrases that are counted exactly, with their labels.
PHRASES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)

# The wording of common license notices.
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without "
             "modification are permitted provided that the following conditions are met"),
    Template("cc-by-4.0", "licensed under cc by 4 0"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu "
             "general public license as published by the free software foundation"),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy "
             "of this software and associated documentation files to deal in the software "
             "without restriction"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public "
             "license v 2 0"),
)


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; a null text has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(parts, lambda w: w != "")


def _positions(templates: list[Template], df: DataFrame, width: int) -> DataFrame:
    """(hash, template, at) of the k-grams of the templates with this gram width."""
    rows = []
    for k, t in enumerate(templates):
        tokens = t.text.split()
        if min(GRAM, len(tokens)) == width:
            for at in range(len(tokens) - width + 1):
                gram = F.xxhash64(*[F.lit(w) for w in tokens[at : at + width]])
                rows.append(
                    F.struct(gram.alias("hash"), F.lit(k).alias("template"), F.lit(at).alias("at"))
                )
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def _candidates(docs: DataFrame, templates: list[Template]) -> DataFrame:
    """By row key: ``found``, the templates with enough votes and their diagonals."""
    tokens = docs.select("h1", "h2", words(F.col("text")).alias("tokens"))
    votes = []
    for width in sorted({min(GRAM, len(t.text.split())) for t in templates}):
        grams = tokens.select(
            "h1", "h2", F.posexplode(shingle_hashes(F.col("tokens"), width)).alias("pos", "hash")
        )
        # the templates are an argument of the call, some hundred positions
        hits = grams.join(F.broadcast(_positions(templates, docs, width)), "hash")
        votes.append(
            hits.select("h1", "h2", "template", (F.col("pos") - F.col("at")).alias("diagonal"), "at")
        )
    key = ["h1", "h2", "template"]
    lines = (
        reduce(DataFrame.unionByName, votes)
        .groupBy(*key, "diagonal")
        .agg(F.collect_set("at").alias("at"))
    )
    order = Window.partitionBy(*key).orderBy("diagonal")
    exact = F.array(*[F.lit(t.exact) for t in templates])
    grams = F.array(*[F.lit(max(len(t.text.split()) - GRAM + 1, 1)) for t in templates])
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    apart = gap.isNull() | F.get(exact, F.col("template")) | (gap > NEIGHBOUR)
    merged = (
        lines.withColumn("group", F.sum(apart.cast("int")).over(order))
        .groupBy(*key, "group")
        .agg(
            F.array_sort(F.collect_list("diagonal")).alias("diagonals"),
            F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("votes"),
        )
    )
    needed = F.when(F.get(exact, F.col("template")), 1.0).otherwise(COVERAGE)
    enough = merged.where(F.col("votes") >= needed * F.get(grams, F.col("template")))
    return enough.groupBy("h1", "h2").agg(
        F.collect_list(F.struct("template", "diagonals")).alias("found")
    )


def scan(
    docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words`` and ``spans``, a row for each input row.

    ``spans`` lists (label, exact, start, end, coverage) of the verified places, in order:
    words start to end - 1, counted from 0, and the share of the template's words found
    there. Null, empty and short texts have no spans. Repeated rows are scanned alike,
    null ids stay null, an empty table gives an empty result; other columns are not read.
    """
    templates = list(templates or PHRASES + NOTICES)
    h1, h2 = row_key(docs[id_col], docs[text_col])
    slim = docs.select(
        docs[id_col].alias("doc_id"), docs[text_col].alias("text"), h1.alias("h1"), h2.alias("h2")
    )
    joined = slim.join(_candidates(slim, templates), ["h1", "h2"], "left").select(
        "doc_id", words(F.col("text")).alias("tokens"), "found"
    )
    texts = F.array(*[F.array(*[F.lit(w) for w in t.text.split()]) for t in templates])
    labels = F.array(*[F.lit(t.label) for t in templates])
    exact = F.array(*[F.lit(t.exact) for t in templates])

    def verified(c: Column) -> Column:
        text = F.get(texts, c["template"])
        here = F.filter(
            F.sequence(F.lit(0), F.size(text) - 1),
            lambda i: F.exists(
                c["diagonals"],
                lambda d: (d + i >= 0) & F.get(F.col("tokens"), d + i).eqNullSafe(F.get(text, i)),
            ),
        )
        first = F.greatest(F.array_min(c["diagonals"]), F.lit(0))
        last = F.array_max(c["diagonals"]) + F.size(text)
        return F.struct(
            F.get(labels, c["template"]).alias("label"),
            F.get(exact, c["template"]).alias("exact"),
            first.cast("long").alias("start"),
            F.least(last, F.size("tokens")).cast("long").alias("end"),
            (F.size(here) / F.size(text)).alias("coverage"),
        )

    good = F.filter(
        F.transform(F.coalesce("found", F.array().cast(joined.schema["found"].dataType)), verified),
        lambda s: s["coverage"] >= F.when(s["exact"], 1.0).otherwise(COVERAGE),
    )
    by_place = F.array_sort(good, lambda a, b: _by(a, b, "start", "end", "label"))
    return joined.select(
        "doc_id", F.size("tokens").cast("long").alias("n_words"), by_place.alias("spans")
    )


def _by(a: Column, b: Column, *fields: str) -> Column:
    out = F.lit(0)
    for f in reversed(fields):
        out = F.when(a[f] < b[f], -1).when(a[f] > b[f], 1).otherwise(out)
    return out


def summary(scanned: DataFrame) -> DataFrame:
    """Counts and labels of each scanned row: ``n_base``, the first and last word where an
    exact phrase starts, ``base_labels``, all ``labels``, and the best coverage as ``score``."""
    base = F.filter("spans", lambda s: s["exact"])
    named = lambda spans: F.array_join(
        F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ","
    )
    starts = F.transform(base, lambda s: s["start"])
    best = F.array_max(F.transform("spans", lambda s: s["coverage"]))
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        named(base).alias("base_labels"), named(F.col("spans")).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"),
    )
