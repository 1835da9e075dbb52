"""Small fixtures and brute-force versions shared by the tests of this folder."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("a", "en", "ith", "or", "una", "é")]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(text: str, seed: int, changes: int) -> str:
    rng, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice(VOCABULARY) + "x"
    return " ".join(words)


def awkward_texts() -> list[str | None]:
    """Nulls, empty and odd texts, repeats, and one long text."""
    same = prose(1, 120)
    return [
        None, "", " \n\t ", "one", "two words", same, same, edited(same, 2, 1),
        "é" * 300, "a" * 5000, "x y " * 700, "#*$%&|<> " * 30, "line\n" * 60, prose(3, 20_000),
        same + "\n" + prose(4, 80), "日本語 テキスト " * 40, "\x1c\x85   z" * 50,
    ]


def documents(spark, texts, extra: bool = False):
    rows = [(k, t, "en", "src0", None if t is None else len(t)) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    if extra:  # names that operators use themselves
        from pyspark.sql import functions as F

        for name in ("h1", "fp", "row", "hash", "spans", "kept", "number", "block", "n_words"):
            df = df.withColumn(name, F.lit(name))
    return df


def awkward_rows(spark):
    """Rows with null ids, one id twice with other texts, and a row that is there twice."""
    a, b = prose(11, 200), prose(12, 200)
    rows = [
        (None, a, None, None, None), (None, None, None, None, None), (5, a, "en", "s", 1),
        (5, b, "en", "s", 1), (7, b, "en", "s", 1), (7, b, "en", "s", 1), (9, None, "en", None, 0),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def roots(n: int, links) -> list[int]:
    """Smallest member of each node's component, by plain union-find."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
