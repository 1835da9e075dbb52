"""Phrase collocations by stripes.

A stripe belongs to a prefix of words and counts the words that follow it, elementwise: one
entry for each next word, and one (0) for the end of a piece and for next words that can't
make a frequent phrase. Stripes of one prefix from all tasks are merged by adding their
entries. The merged stripe then holds the counts of all one-word extensions of the prefix,
as its sum the prefix's own count, and as its largest entry what may subsume the prefix.

Phrases grow by a word a pass. A phrase is only frequent if the phrases without its first
and without its last word are, so a pass counts what follows the frequent phrases of the
pass before. Tasks know these by a bitmap of their hashes, whose size is fixed; a hash that
is there by chance only costs a count that is dropped later. Long stripes are cut into parts
by the next word, so that no prefix is merged in one task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinflat.llm.membership import bitmap_of, is_member
from clinflat.session import stage

LEAST, LONGEST, TOP = 100, 5, 2000
SCALE = 1000  # of the score
SLICE = 4 << 20  # bytes of text whose words are counted at once, about
KNOWN_WORDS = 300_000  # hashes of words that a task remembers
HELD = 1 << 21  # entries a task adds up before it sends them
PARTS = {1: 16}  # parts that the stripes of one-word prefixes are cut into
SALT = 64
BASE = np.uint64(0x9E3779B97F4A7C15)
END, EMPTY = 0, 1  # ends of pieces and empty strings among the hashes of words

CUT = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
AHEAD = re.compile(rb"(?:[\x20\x09]*[^\x20\x09.,;:!?\x0A-\x0D]+){0,%d}")
SAME = bytes.maketrans(b".,;:!?\x0b\x0c\x0d\t", b"\n" * 9 + b" ")


def _words(data: bytes) -> list[bytes]:
    """Words, line feeds where pieces end, and empty strings."""
    return data.translate(SAME).replace(b"\n", b" \n ").split(b" ")


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
            self.update({b"": EMPTY, b"\n": END})
        self[word] = h = max(xxhash.xxh64_intdigest(word), 2)
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _slices(texts: list[str], ahead: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words of texts in slices of about SLICE bytes, and the parts they come from.

    Parts are (text, words of its own, words after them); the latter are the ``ahead`` words
    that follow in the same piece where a long text is cut.
    """
    words: list[bytes] = []
    parts: list[tuple[int, int, int]] = []
    size, more = 0, re.compile(AHEAD.pattern % ahead)
    for k, text in enumerate(texts):
        data, s = text.encode().lower(), 0
        while s < len(data):
            found = CUT.search(data, s + SLICE)
            e = found.start() if found else len(data)
            own = _words(data[s:e])
            after = [*_words(more.match(data, e)[0]), b"\n"] if e < len(data) else [b"\n"]
            parts.append((k, len(own), len(after)))
            words += own
            words += after
            size += e - s
            if size >= SLICE:
                yield words, parts
                words, parts, size = [], [], 0
            s = e
    if parts:
        yield words, parts


def _hashed(
    known: Hashes, words: list[bytes], parts: list[tuple[int, int, int]], seeds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, by language; whether they are a part's own; their places."""
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    text, own, after = (np.array(x) for x in zip(*parts))
    mine = np.repeat(np.tile([True, False], len(parts)), np.column_stack((own, after)).ravel())
    seed = np.repeat(seeds[text], own + after)
    at = np.flatnonzero(h != EMPTY)
    h, mine, seed = h[at], mine[at], seed[at]
    return np.where(h == END, np.uint64(END), np.maximum(_mixed(h ^ seed), np.uint64(2))), mine, at


def _seeds(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x, 1) for x in langs], np.uint64)


WORDS = pa.schema([("lang", pa.string()), ("word", pa.string()), ("h", pa.int64()), ("n", pa.int64())])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of a task's texts, and without a word those of all of a language."""
    known = Hashes({b"": EMPTY, b"\n": END})
    held: dict[int, list] = {}
    totals: dict[str, int] = {}

    def rows(found: list) -> pa.RecordBatch:
        columns = list(zip(*found)) or [[]] * len(WORDS)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, WORDS)], schema=WORDS
        )

    for batch in batches:
        langs, texts = (c.to_pylist() for c in batch.columns)
        seeds = _seeds(langs)
        for words, parts in _slices(texts, 0):
            h, mine, at = _hashed(known, words, parts, seeds)
            text = np.repeat([p[0] for p in parts], [p[1] + p[2] for p in parts])
            own = np.flatnonzero(mine & (h != END))
            found, first, n = np.unique(h[own], return_index=True, return_counts=True)
            places = at[own[first]].tolist()
            for x, place, count in zip(found.view(np.int64).tolist(), places, n.tolist()):
                lang = langs[text[place]]
                totals[lang] = totals.get(lang, 0) + count
                if x in held:
                    held[x][3] += count
                else:
                    held[x] = [lang, words[place].decode(), x, count]
            if len(held) > KNOWN_WORDS:
                yield rows(list(held.values()))
                held = {}
    yield rows([*held.values(), *((lang, None, 0, n) for lang, n in totals.items())])


STRIPES = pa.schema(
    [("h", pa.int64()), ("part", pa.int32()), ("next", pa.binary()), ("n", pa.binary())]
)
STRIPES_DDL = "h long, part int, next binary, n binary"


def _binaries(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The values from each start to the next as one binary value."""
    width = values.dtype.itemsize
    offsets = np.append(starts, len(values)).astype(np.int32) * np.int32(width)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(starts), buffers)


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of each key, and the sums of ``n`` by key."""
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
    return order[first], np.add.reduceat(n[order], first)


def _count_next(k: int, parts: int, bits: Callable[[], np.ndarray]) -> Callable:
    """Stripes of the prefixes of ``k`` words that the bitmap has."""

    def stripes(h: np.ndarray, nxt: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        part = (nxt % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((part, h))
        h, nxt, n, part = h[order], nxt[order], n[order], part[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (part[1:] != part[:-1])
        starts = np.flatnonzero(new)
        columns = [pa.array(h[starts].view(np.int64)), pa.array(part[starts])]
        columns += [_binaries(nxt, starts), _binaries(n, starts)]
        return pa.RecordBatch.from_arrays(columns, schema=STRIPES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bitmap = Hashes({b"": EMPTY, b"\n": END}), bits()
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            seeds = _seeds(langs)
            for words, own_parts in _slices(texts, k + 1):
                w, mine, _ = _hashed(known, words, own_parts, seeds)
                size, w = len(w), np.concatenate((w, np.zeros(k + 2, np.uint64)))
                h, whole = w, w != END
                for j in range(1, k):
                    h = h[:-1] * BASE + w[j:]
                    whole = whole[:-1] & (w[j:] != END)
                often = whole & is_member(h, bitmap)
                at = np.flatnonzero(often[:size] & mine)
                # the next word counts if the phrase that ends with it is frequent too
                nxt = np.where(often[at + 1], w[at + k], np.uint64(END))
                h = h[at]
                if not len(at):
                    continue
                first, n = _added(_mixed(h * BASE + nxt), np.ones(len(at), np.int64))
                held.append((h[first], nxt[first], n))
                if sum(len(x[0]) for x in held) > HELD:
                    h, nxt, n = (np.concatenate(x) for x in zip(*held))
                    first, n = _added(_mixed(h * BASE + nxt), n)
                    held = [(h[first], nxt[first], n)]
                    if len(n) > HELD // 2:
                        yield stripes(*held[0])
                        held = []
        if held:
            h, nxt, n = (np.concatenate(x) for x in zip(*held))
            first, n = _added(_mixed(h * BASE + nxt), n)
            yield stripes(h[first], nxt[first], n)

    return run


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of binaries, and how many each has."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if len(column) else np.zeros(0, np.uint8)
    return values.view(kind), np.diff(at) // np.dtype(kind).itemsize


MERGED = pa.schema([(x, pa.int64()) for x in ("h", "next", "longer", "f", "most")])


def _merge(least: int) -> Callable:
    """Adds up the stripes of each prefix part, which come one after the other.

    A row for each next word that is frequent after the prefix, with the hash of the longer
    phrase; and one without a next word, with the stripe's sum and its largest entry.
    """

    def emit(h: np.ndarray, part: np.ndarray, nxt: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (part[1:] != part[:-1])
        starts = np.flatnonzero(new)
        total, most = np.add.reduceat(n, starts), np.maximum.reduceat(np.where(nxt == END, 0, n), starts)
        kept = (n >= least) & (nxt != END)
        longer = h[kept] * BASE + nxt[kept]
        zeros = np.zeros(len(starts), np.int64)
        columns = [
            np.concatenate((h[kept], h[starts])).view(np.int64),
            np.concatenate((nxt[kept].view(np.int64), zeros)),
            np.concatenate((longer.view(np.int64), zeros)),
            np.concatenate((n[kept], total)), np.concatenate((n[kept], most)),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=MERGED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            nxt, sizes = _flat(batch.column(2), np.uint64)
            n, _ = _flat(batch.column(3), np.int64)
            h = np.repeat(batch.column(0).to_numpy().view(np.uint64), sizes)
            part = np.repeat(batch.column(1).to_numpy(), sizes)
            if rest is not None:
                h, part, nxt, n = (np.concatenate(x) for x in zip(rest, (h, part, nxt, n)))
            if not len(h):
                continue
            last = (h == h[-1]) & (part == part[-1])
            order = np.lexsort((nxt, part, h))
            h, part, nxt, n, last = h[order], part[order], nxt[order], n[order], last[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (nxt[1:] != nxt[:-1])
            first = np.flatnonzero(new)
            n = np.add.reduceat(n, first)
            h, part, nxt, last = h[first], part[first], nxt[first], last[first]
            rest = tuple(x[last] for x in (h, part, nxt, n))
            if not last.all():
                yield emit(*(x[~last] for x in (h, part, nxt, n)))
        if rest is not None:
            yield emit(*rest)

    return run


def frequent(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang_col: str = "lang",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """``lang, n`` (all words) and ``lang, words, f, prefix_f, right``: all frequent phrases.

    ``f`` counts the places of a phrase of 1 to ``longest`` words, at least ``least``.
    ``prefix_f`` is the sum of its stripe, which is ``f`` again, and ``right`` the count of
    its most frequent extension by a word behind (both null for the longest).
    """
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit("und"))
    slim = docs.select(lang.alias("lang"), docs[text_col].alias("text")).where("text is not null")
    counted = slim.mapInArrow(_count_words, "lang string, word string, h long, n long")
    words = stage(
        counted.groupBy("lang", "word").agg(F.min("h").alias("h"), F.sum("n").alias("f"))
        .where((F.col("f") >= least) | F.col("word").isNull()),
        "words",
    )
    sizes = words.where("word is null").select("lang", F.col("f").alias("n"))
    one = words.where("word is not null").select("h", "lang", F.array("word").alias("words"), "f")
    levels, level = [], one
    for k in range(1, longest):
        parts = PARTS.get(k, 1)
        stripes = slim.mapInArrow(_count_next(k, parts, bitmap_of(level)), STRIPES_DDL)
        merged = stage(
            stripes.repartition("h", "part").sortWithinPartitions("h", "part")
            .mapInArrow(_merge(least), "h long, next long, longer long, f long, most long"),
            "stripes",
        )
        sums = merged.where("next = 0").groupBy("h").agg(
            F.sum("f").alias("prefix_f"), F.max("most").alias("right")
        )
        levels.append(level.join(sums, "h", "left"))
        word = one.select(F.col("h").alias("next"), F.col("words").alias("word"))
        level = stage(
            merged.where("next != 0").select("h", "next", "longer", "f")
            .join(level.select("h", "lang", "words"), "h")
            .join(word, "next")
            .select(F.col("longer").alias("h"), "lang", F.concat("words", "word").alias("words"), "f"),
            "phrases",
        )
    unknown = F.lit(None).cast("long")
    levels.append(level.withColumns({"prefix_f": unknown, "right": unknown}))
    return sizes, reduce(DataFrame.unionByName, levels).drop("h")


def mine(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, share: int = 100,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best ``top`` phrases.

    A-Z count as lower case; pieces end at ``[.,;:!?\\x0A-\\x0D]``, words at spaces and tabs.
    Phrases have 2 to ``longest`` words, inside a piece, and ``a`` places, at least ``least``,
    overlapping ones included. ``l`` and ``r`` count the two parts at the lowest-scoring cut
    (the first, if several), ``n`` all words of the language; the score is
    floor(1000 * a * n / (l * r)), in decimals of 38 digits. Phrases inside a longer one with
    ``share`` per cent of their places are left out. Ties rank by ``a``, then by phrase.

    Null texts are empty, a null language is ``und``; repeated rows count each. An empty table
    gives an empty result. Other columns are not read.
    """
    sizes, found = frequent(docs, least, longest, lang_col, text_col)
    joined = lambda words: F.array_join(words, " ")
    phrases = stage(found.withColumn("phrase", joined(F.col("words"))), "phrases")
    longer = phrases.where(F.size("words") > 1)
    behind = longer.select("lang", joined(F.expr("slice(words, 2, size(words))")).alias("phrase"), "f")
    left = behind.groupBy("lang", "phrase").agg(F.max("f").alias("left"))
    widest = F.greatest(F.coalesce("right", F.lit(0)), F.coalesce("left", F.lit(0)))
    open_ = longer.join(left, ["lang", "phrase"], "left").where(100 * widest < share * F.col("f"))
    cuts = open_.select(
        "lang", "phrase", "words", F.col("f").alias("a"),
        F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"),
    ).select(
        "lang", "phrase", "a", "k", joined(F.expr("slice(words, 1, k)")).alias("first"),
        joined(F.expr("slice(words, k + 1, size(words))")).alias("rest"),
    )
    firsts = phrases.select("lang", F.col("phrase").alias("first"), F.col("prefix_f").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"]).join(sizes, "lang")
    exact = {x: f"cast({x} as decimal(19,0))" for x in (SCALE, "a", "n", "l", "r")}
    quotient = "({} * {} * {}) div ({} * {})".format(*exact.values())
    scored = scored.withColumn("score", F.expr(quotient))
    least_cut = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    ranked = scored.groupBy("lang", "phrase", "a", "n").agg(least_cut).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
    order = F.col("score").desc(), F.col("a").desc(), F.col("phrase")
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALT))
    for by in (["lang", salt], ["lang"]):  # the best of each part, then of all parts
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        ranked = ranked.withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
