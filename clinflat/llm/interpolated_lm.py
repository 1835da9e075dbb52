"""Bigram language model by deleted interpolation, and scores of all documents.

P(w | h) = a_b c(h,w) / c(h) + u_b c(w) / N + z_b / (V + 1), where b is the bucket of the
context's frequency c(h), a power of two. The weights of a bucket are learned by
expectation-maximisation on bigrams that were deleted from the counts: part of the
training documents is held back, the counts of the rest predict it, and once the weights
are known the counts of all training documents are used.

Words are handled as packed arrays inside tasks, since a row for each word would cost more
than the text. Documents are packed into blocks once. Every block sends its distinct
n-grams with its own counts, sorted and cut by hash range; a task adds up one range over
all blocks and answers each block in the order it asked. The answers meet the block again,
where each token's probability is looked up. No vocabulary is held anywhere as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from clinflat.llm.packing import pack, unpack
from clinflat.llm.texts import words_of
from clinflat.session import stage

FOLDS = 7
TEST_FOLD = 2  # documents the model never learns from
HELD_FOLD = 3  # training documents held back while the weights are learned
BLOCK_BYTES = 8 << 20
RANGE_KEYS = 2_000_000  # distinct n-grams of all blocks that one task adds up, about
BUCKETS = 40
STEPS = 20
TOLERANCE = 1e-5
LEAST_WEIGHT = 1e-6
MIX = np.uint64(0x9E3779B97F4A7C15)
END, BEGIN = (np.uint64(xxhash.xxh64_intdigest(b)) for b in (b"\n", b"\r"))  # no word has these


def _blocks(kind: pa.DataType) -> pa.Schema:
    return pa.schema(
        [("block", pa.int64()), ("ids", pa.list_(kind)), ("folds", pa.list_(pa.int32())),
         ("words", pa.binary())]
    )


def _to_blocks(schema: pa.Schema, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number = TaskContext.get().partitionId(), 0
        # held-back documents have blocks of their own, so that learning reads no others
        open_ = {True: [], False: []}
        size = {True: 0, False: 0}
        for batch in batches:
            for doc_id, text, fold in zip(*(c.to_pylist() for c in batch.columns)):
                line, kind = b" ".join(words_of(text)), fold == HELD_FOLD
                open_[kind].append((doc_id, fold, line))
                size[kind] += len(line)
                if size[kind] >= block_bytes:
                    yield block(place, number, *zip(*open_[kind]))
                    number, open_[kind], size[kind] = number + 1, [], 0
        for rows in open_.values():
            if rows:
                yield block(place, number, *zip(*rows))
                number += 1

    def block(place, number, ids, folds, lines):
        data = zstandard.ZstdCompressor(level=1).compress(b"\n".join(lines))
        row = [(place << 32) + number], [ids], [folds], [data]
        arrays = [pa.array(c, f.type) for c, f in zip(row, schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


class Tokens:
    """The tokens of a block: hash of each word and of each bigram, and their documents."""

    def __init__(self, folds: list[int], data: bytes):
        lines = zstandard.ZstdDecompressor().decompress(data).split(b"\n")
        seen: dict[bytes, int] = {}
        flat: list[int] = []
        sizes = []
        for line in lines:
            words = line.split()
            flat.extend([seen.setdefault(w, len(seen)) for w in words])
            flat.append(-1)
            sizes.append(len(words) + 1)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in seen], np.uint64)
        hashes = np.append(hashes, END)  # index -1
        self.sizes = np.array(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.word = hashes[np.array(flat)]
        before = np.empty_like(self.word)
        before[1:] = self.word[:-1]
        before[self.starts] = BEGIN
        self.before = before
        mixed = (before * MIX) ^ (self.word + (before >> np.uint64(29)))
        self.pair = (mixed ^ (mixed >> np.uint64(32))) * MIX
        self.fold = np.repeat(np.array(folds), self.sizes)

    def keys(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For words (with the beginnings) and bigrams: distinct keys in order, and how
        often each stands in kept and in held-back training documents."""
        begins = np.full(len(self.sizes), BEGIN)
        fold = np.concatenate((self.fold, self.fold[self.starts]))
        out = []
        for key, f in ((np.concatenate((self.word, begins)), fold), (self.pair, self.fold)):
            distinct, place = np.unique(key, return_inverse=True)
            held = np.bincount(place[f == HELD_FOLD], minlength=len(distinct))
            kept = np.bincount(
                place[(f != HELD_FOLD) & (f != TEST_FOLD)], minlength=len(distinct)
            )
            out.append((distinct, kept.astype(np.uint32), held.astype(np.uint32)))
        return out


ASKED = "level int, part int, block long, n int, keys binary, kept binary, held binary"
ANSWERED = (
    "level int, part int, block long, n int, kept binary, total binary, "
    "words_kept long, words_total long, known_kept long, known_total long"
)


def _ask(parts: int, schema: pa.Schema):
    edges = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("block", "folds", "words"))
            for b, folds, data in zip(*columns):
                rows = []
                for level, (keys, kept, held) in enumerate(Tokens(folds, data).keys()):
                    cut = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                    for part, (s, e) in enumerate(zip(cut, cut[1:])):
                        if e > s:
                            steps = np.diff(keys[s:e], prepend=np.uint64(0))
                            packed = pack(steps), pack(kept[s:e]), pack(held[s:e])
                            rows.append((level, part, b, e - s, *packed))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _answer(asked: pd.DataFrame) -> pd.DataFrame:
    """Counts over all blocks of one range of keys, in the order of each block's keys."""
    asked = asked.sort_values("block")
    n = asked["n"].to_numpy()
    keys = [np.cumsum(unpack(k, m, np.uint64)) for k, m in zip(asked["keys"], n)]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    kept, held = (
        np.bincount(
            place,
            np.concatenate([unpack(x, m, np.uint32) for x, m in zip(asked[c], n)]),
            len(distinct),
        ).astype(np.uint64)
        for c in ("kept", "held")
    )
    total = kept + held
    ends = np.cumsum(n)
    replies = [
        (pack(kept[place[e - m : e]]), pack(total[place[e - m : e]])) for e, m in zip(ends, n)
    ]
    word = distinct != BEGIN
    sums = (kept[word].sum(), total[word].sum(), (kept[word] > 0).sum(), (total[word] > 0).sum())
    first = np.arange(len(n)) == 0  # a range's sums stand in one of its rows
    out = asked[["level", "part", "block", "n"]].copy()
    out["kept"], out["total"] = zip(*replies)
    for name, value in zip(("words_kept", "words_total", "known_kept", "known_total"), sums):
        out[name] = np.where(first, int(value), 0)
    return out


def _looked_up(folds: list, data: bytes, replies: list[dict], column: str):
    """Tokens of a block with the counts of each token's word, context and bigram."""
    tokens = Tokens(folds, data)
    found = []
    for level, (keys, _, _) in enumerate(tokens.keys()):
        own = sorted((r for r in replies if r["level"] == level), key=lambda r: r["part"])
        counts = np.concatenate([unpack(r[column], r["n"], np.uint64) for r in own])
        found.append((keys, counts.astype(np.int64)))
    (words, of_word), (pairs, of_pair) = found
    at = lambda keys, counts, wanted: counts[np.searchsorted(keys, wanted)]
    return (
        tokens,
        at(words, of_word, tokens.word),
        at(words, of_word, tokens.before),
        at(pairs, of_pair, tokens.pair),
    )


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else one more than the whole power of two in the count."""
    return np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0)


def _held_counts(schema: pa.Schema):
    """Distinct (context, bigram, word) counts of held-back tokens, and how many have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folds, data, replies in zip(
                *(batch.column(n).to_pylist() for n in ("folds", "words", "replies"))
            ):
                tokens, word, context, pair = _looked_up(folds, data, replies, "kept")
                mine = tokens.fold == HELD_FOLD
                rows = np.stack((context[mine], pair[mine], word[mine]), axis=1)
                rows, n = np.unique(rows, axis=0, return_counts=True)
                columns = [bucket_of(rows[:, 0]), *rows.T, n]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def learn_weights(held: DataFrame, n_words: int, n_known: int) -> np.ndarray:
    """Weights (bigram, word, uniform) of each bucket by expectation-maximisation.

    ``held`` has bucket, context, pair, word and n. A step is one aggregation over the
    held-back counts; the driver sees three sums for each bucket. Buckets without any
    held-back token keep equal weights.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = (0.0, 0.5, 0.5)  # without a context there is no bigram estimate
    for _ in range(STEPS):
        w = [
            F.get(F.array(*[F.lit(float(x)) for x in weights[:, k]]), F.col("bucket"))
            for k in range(3)
        ]
        pair = F.when(F.col("context") > 0, F.col("pair") / F.col("context")).otherwise(0.0)
        terms = [w[0] * pair, w[1] * F.col("word") / max(n_words, 1), w[2] / (n_known + 1)]
        parts = held.select("bucket", "n", *[t.alias(f"t{k}") for k, t in enumerate(terms)])
        whole = F.col("t0") + F.col("t1") + F.col("t2")
        sums = parts.groupBy("bucket").agg(
            *[F.sum(F.col("n") * F.col(f"t{k}") / whole).alias(f"s{k}") for k in range(3)]
        )
        new = weights.copy()
        for row in sums.collect():
            share = np.array([row["s0"], row["s1"], row["s2"]])
            new[row["bucket"]] = share / share.sum()
        new = np.maximum(new, [0.0, LEAST_WEIGHT, LEAST_WEIGHT])
        new /= new.sum(axis=1, keepdims=True)
        done = np.abs(new - weights).max() < TOLERANCE
        weights = new
        if done:
            break
    return weights


def _score(weights: np.ndarray, n_words: int, n_known: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, folds, data, replies in zip(
                *(batch.column(n) for n in ("ids", "folds", "words", "replies"))
            ):
                folds = folds.as_py()
                counts = _looked_up(folds, data.as_py(), replies.as_py(), "total")
                tokens, word, context, pair = counts
                w = weights[bucket_of(context)]
                p = w[:, 0] * pair / np.maximum(context, 1)
                p += w[:, 1] * word / max(n_words, 1) + w[:, 2] / (n_known + 1)
                base = np.log10((word + 1) / (n_words + n_known + 1))
                add = lambda x: np.add.reduceat(x, tokens.starts)
                columns = [
                    ids.values, np.array(folds) == TEST_FOLD, tokens.sizes,
                    add((word > 0).astype(np.int64)), np.full(len(folds), n_words),
                    add(base), add(np.log10(p)),
                ]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = BLOCK_BYTES, range_keys: int = RANGE_KEYS,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, a row for
    each input row.

    ``held_out`` documents, those whose checksum of the id has remainder TEST_FOLD, are
    scored and not learned from. Null and empty texts have only the end token. A null id
    counts as an empty one. Repeated rows are counted each and scored alike. Without
    training documents all words are unknown and the weights equal. An empty table gives an
    empty result; other columns are not read. Scores are log10 probabilities of the text.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    fold = F.crc32(F.coalesce(docs[id_col].cast("string"), F.lit(""))) % FOLDS
    slim = docs.select(
        docs[id_col].alias("doc_id"), docs[text_col].alias("text"), fold.cast("int").alias("fold")
    )
    shape = f"block long, ids array<{kind}>, folds array<int>, words binary"
    arrow = lambda ddl: to_arrow_schema(spark.createDataFrame([], ddl).schema)
    id_type = arrow(f"a {kind}").field(0).type
    blocks = stage(slim.mapInArrow(_to_blocks(_blocks(id_type), block_bytes), shape), "lm-blocks")
    # a block of text has about one distinct n-gram in nine bytes
    parts = max(1, blocks.count() * block_bytes // 9 // range_keys)
    asked = blocks.mapInArrow(_ask(parts, arrow(ASKED)), ASKED)
    answered = stage(asked.groupBy("level", "part").applyInPandas(_answer, ANSWERED), "lm-answers")
    names = "words_kept", "words_total", "known_kept", "known_total"
    sums = answered.where("level = 0").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in names]).first()
    reply = F.struct("level", "part", "n", "kept", "total")
    replies = answered.groupBy("block").agg(F.collect_list(reply).alias("replies"))
    learning = F.exists("folds", lambda f: f == HELD_FOLD)
    only = F.struct("level", "part", "n", "kept")
    kept = answered.groupBy("block").agg(F.collect_list(only).alias("replies"))
    held_schema = "bucket int, context long, pair long, word long, n long"
    held = blocks.where(learning).join(kept, "block")
    held = stage(held.mapInArrow(_held_counts(arrow(held_schema)), held_schema), "lm-held")
    weights = learn_weights(held, sums[0], sums[2])
    out = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    met = blocks.join(replies, "block")
    return met.mapInArrow(_score(weights, sums[1], sums[3], arrow(out)), out)
