"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Pairs of trie nodes are followed together from the root: a pair carries the number of
bits in which its two paths differ, and is dropped once that exceeds the error budget.
The trie is built twice, once with the two halves of the fingerprint swapped. Two
fingerprints within ``radius`` bits differ in at most ``radius // 2`` bits of one half,
so while the first half is read the budget is only that, in either trie; every link is
found in at least one of them. The top of the trie is walked as tables of node pairs,
until a pair is small enough for one task; the task walks the rest on sorted arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat.llm.components import connected
from clinflat.llm.texts import map_rows, row_key, words_of
from clinflat.session import stage

BITS = 64
STEP = 4  # bits by which node pairs are deepened as tables
MAX_NODES = 40_000  # fingerprints of a node pair that one task takes
LEAF = 32  # fingerprint pairs that are compared directly
BLOCK = 1 << 15  # node pairs or shingles handled at once in a task


def shingles(text: str | None, width: int) -> Iterator[np.ndarray]:
    """XXH64 of a text's ``width``-word shingles as often as they stand, in blocks.

    A text of fewer words is one shingle; a text without any word has none.
    """
    tokens = words_of(text)
    if not tokens:
        return
    joined = b" ".join(tokens)
    ends = np.cumsum([len(w) + 1 for w in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(tokens) <= width:
        spans = [(0, len(joined))]
    else:
        spans = list(zip(starts[: len(tokens) - width + 1].tolist(), ends[width - 1 :].tolist()))
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(spans), BLOCK):
        yield np.array([digest(joined[s:e], 42) for s, e in spans[k : k + BLOCK]], np.uint64)


def fingerprint(text: str | None, width: int = 3) -> bytes:
    """SimHash of a text's ``width``-word shingles, 8 bytes.

    Shingles count as often as they stand; without any word the fingerprint is zero.
    """
    ones, n = np.zeros(BITS, np.int64), 0
    for h in shingles(text, width):
        n += len(h)
        bits = np.unpackbits(h.astype(">u8").view(np.uint8)).reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(
    docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's bytes) and a row key, row by row."""
    kind = docs.schema[id_col].dataType.simpleString()
    doc, text = docs[id_col], docs[text_col]
    rows, schema = docs.select(doc, text, *row_key(doc, text)), f"doc_id {kind}, h1 long, h2 long, fp binary"
    return map_rows(rows, lambda i, t, *h: (i, *h, fingerprint(t, width)), schema)


def _budget(depth: int, radius: int) -> int:
    """Differing bits allowed in the first ``depth`` bits."""
    return radius // 2 if depth <= BITS // 2 else radius


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, BITS - depth) if depth else F.lit(0).cast("long")


def _word(fp: Column) -> Column:
    """A fingerprint as a long with the same bits."""
    return F.conv(F.hex(fp), 16, -10).cast("long")


def _nodes(distinct: DataFrame) -> DataFrame:
    """Each fingerprint once in both tries."""
    key = _word(F.col("fp"))
    swapped = F.shiftleft(key, 32).bitwiseOR(F.shiftrightunsigned(key, 32))
    tries = [F.struct(F.lit(t).alias("trie"), k.alias("key")) for t, k in enumerate((key, swapped))]
    return distinct.select("node_id", F.inline(F.array(*tries)))


def _ready_members(nodes: DataFrame, radius: int, max_nodes: int) -> list[DataFrame]:
    """Fingerprints dealt out to the node pairs that are small enough for one task.

    Node pairs grow with the number of nodes, not of fingerprint pairs. At full depth a
    node is one fingerprint, so the walk ends for every ``max_nodes`` of 2 or more.
    """
    spark = nodes.sparkSession
    frontier = spark.range(2).select(
        F.col("id").cast("int").alias("trie"), F.lit(0).cast("long").alias("a"),
        F.lit(0).cast("long").alias("b"),
    )
    members = []
    for depth in range(0, BITS + 1, STEP):
        sizes = nodes.groupBy("trie", _prefix(F.col("key"), depth).alias("node")).count()
        a = sizes.select("trie", F.col("node").alias("a"), F.col("count").alias("n_a"))
        b = sizes.select("trie", F.col("node").alias("b"), F.col("count").alias("n_b"))
        if depth:
            up = F.shiftrightunsigned("a", STEP).alias("up_a"), "a", "n_a", "trie"
            down = F.shiftrightunsigned("b", STEP).alias("up_b"), "b", "n_b", "trie"
            split = (
                frontier.select("trie", F.col("a").alias("up_a"), F.col("b").alias("up_b"))
                .join(a.select(*up), ["trie", "up_a"])
                .join(b.select(*down), ["trie", "up_b"])
                .where((F.col("up_a") != F.col("up_b")) | (F.col("a") <= F.col("b")))
            )
            differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
            sized = split.where(differing <= _budget(depth, radius))
        else:
            sized = frontier.join(a, ["trie", "a"]).join(b, ["trie", "b"])
        sized = stage(sized.select("trie", "a", "b", "n_a", "n_b"), "trie-pairs")
        small = F.col("n_a") + F.col("n_b") <= max_nodes
        ready, frontier = sized.where(small), sized.where(~small)
        own = nodes.select("trie", _prefix(F.col("key"), depth).alias("node"), "key", "node_id")
        for side, node in enumerate("ab"):
            pairs = ready if side == 0 else ready.where("a != b")
            on = ["trie", "node"]
            dealt = pairs.select("trie", F.col(node).alias("node"), "a", "b").join(own, on)
            columns = "trie", F.lit(depth).alias("depth"), "a", "b", "key", "node_id"
            members.append(dealt.select(*columns))
        if frontier.isEmpty():
            return members
    return members


def close_pairs(
    a: np.ndarray, b: np.ndarray, same: bool, depth: int, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted unsigned arrays ``a`` and ``b`` within ``radius`` bits.

    All of ``a`` share their first ``depth`` bits, and so do all of ``b``; ``same`` says
    that both are one node, whose pairs then come once each.
    """
    if not len(a) or not len(b):
        return
    used = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(BITS - depth))) if depth else 0
    one = lambda *v: tuple(np.array([x]) for x in v)
    stack = [(depth, *one(0, len(a), 0, len(b), used, same))]
    while stack:
        depth, al, ah, bl, bh, used, same_node = stack.pop()
        if len(al) > BLOCK:
            for k in range(0, len(al), BLOCK):
                part = (x[k : k + BLOCK] for x in (al, ah, bl, bh, used, same_node))
                stack.append((depth, *part))
            continue
        leaf = (ah - al) * (bh - bl) <= LEAF if depth < BITS else np.ones(len(al), bool)
        if leaf.any():
            n_b = (bh - bl)[leaf]
            n = (ah - al)[leaf] * n_b
            pair = np.repeat(np.arange(len(n)), n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            i, j = al[leaf][pair] + k // n_b[pair], bl[leaf][pair] + k % n_b[pair]
            near = np.bitwise_count(a[i] ^ b[j]) <= radius
            near &= ~same_node[leaf][pair] | (i < j)
            if near.any():
                yield i[near], j[near]
        rest = ~leaf
        if not rest.any():
            continue
        al, ah, bl, bh, used, same_node = (x[rest] for x in (al, ah, bl, bh, used, same_node))
        am, bm = _middle(a, al, depth), _middle(b, bl, depth)
        children = [
            (al, am, bl, bm, used, same_node),
            (am, ah, bm, bh, used, same_node),
            (al, am, bm, bh, used + 1, np.zeros(len(al), bool)),
        ]
        mixed = ~same_node
        other = (am, ah, bl, bm, used + 1, np.zeros(len(al), bool))
        children.append(tuple(x[mixed] for x in other))
        joined = [np.concatenate(x) for x in zip(*children)]
        alive = (joined[1] > joined[0]) & (joined[3] > joined[2])
        alive &= joined[4] <= _budget(depth + 1, radius)
        if alive.any():
            stack.append((depth + 1, *(x[alive] for x in joined)))


def _middle(keys: np.ndarray, low: np.ndarray, depth: int) -> np.ndarray:
    """Where the bit after the first ``depth`` becomes 1 in each node that starts at ``low``."""
    shift = np.uint64(BITS - 1 - depth)
    return np.searchsorted(keys, ((keys[low] >> shift) | np.uint64(1)) << shift)


class Forest:
    """Union-find on 0..n-1 in which the smallest member is the root."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return self.parent
            self.parent = up

    def union(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            root = self.roots()
            a, b = root[i], root[j]
            open_ = a != b
            if not open_.any():
                return
            i, j = i[open_], j[open_]
            low, high = np.minimum(a, b)[open_], np.maximum(a, b)[open_]
            np.minimum.at(self.parent, high, low)


def _close_rows(
    key: tuple, rows: pd.DataFrame, radius: int
) -> tuple[pd.DataFrame, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """A node pair's rows in order of their keys, and index pairs of those within the radius."""
    _, depth, node_a, node_b = key
    rows = rows.iloc[np.argsort(rows["key"].to_numpy().view(np.uint64))]
    keys = rows["key"].to_numpy().view(np.uint64)
    if node_a == node_b:
        a = b = np.arange(len(keys))
    else:
        top = (keys >> np.uint64(BITS - depth)).view(np.int64)
        a, b = np.flatnonzero(top == node_a), np.flatnonzero(top == node_b)
    found = close_pairs(keys[a], keys[b], node_a == node_b, depth, radius)
    return rows, ((a[i], b[j]) for i, j in found)


def _walk(radius: int) -> Callable:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows, found = _close_rows(key, rows, radius)
        forest = Forest(len(rows))
        for i, j in found:
            forest.union(i, j)
        root = forest.roots()
        linked = np.flatnonzero(root != np.arange(len(root)))
        ids = rows["node_id"].to_numpy()
        return pd.DataFrame({"u": ids[linked], "v": ids[root[linked]]})

    return run


def links(distinct: DataFrame, radius: int = 3, max_nodes: int = MAX_NODES) -> DataFrame:
    """Pairs (u, v) of ``node_id`` whose components are those of all links.

    ``distinct`` has each fingerprint ``fp`` once. A task gives each of its fingerprints
    at most one partner per node pair, so large groups of near copies come out as stars
    and not as all their pairs.
    """
    members = _ready_members(_nodes(distinct), radius, max_nodes)
    dealt = reduce(DataFrame.unionByName, members).groupBy("trie", "depth", "a", "b")
    return dealt.applyInPandas(_walk(radius), "u long, v long")


def components(
    docs: DataFrame, width: int = 3, radius: int = 3, id_col: str = "doc_id",
    text_col: str = "text", max_nodes: int = MAX_NODES,
) -> DataFrame:
    """``doc_id``, ``fp``, ``h1``, ``h2``, ``root``, ``component_id``, a row for each input row.

    ``component_id`` is the smallest id reachable over links, null if all of these ids are
    null; ``root`` names the component even then. A link is a distance of ``radius`` bits or
    fewer. Null and empty texts have fingerprint zero, which links like any other. Repeated
    rows and equal texts meet as one fingerprint before any pair is formed. An empty table
    gives an empty result. Other columns are not read.
    """
    prints = stage(fingerprints(docs, width, id_col, text_col), "fingerprints")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    distinct = stage(first.withColumn("node_id", _word(F.col("fp"))), "distinct-fps")
    roots = connected(links(distinct.select("node_id", "fp"), radius, max_nodes))
    rooted = distinct.join(roots, distinct["node_id"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "node_id").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "h1", "h2", "root", "component_id")


def keep_one(
    docs: DataFrame, width: int = 3, radius: int = 3, id_col: str = "doc_id",
    text_col: str = "text", max_nodes: int = MAX_NODES,
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the
    smallest id stays (null ids last, then by hashes of the row), once if it is repeated.
    All columns stay as they are."""
    found = components(docs, width, radius, id_col, text_col, max_nodes)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2")
    best = found.groupBy("root").agg(F.min(row).alias("row")).select("row.h1", "row.h2")
    h1, h2 = row_key(docs[id_col], docs[text_col])
    boxed = docs.select(h1.alias("h1"), h2.alias("h2"), F.struct("*").alias("row"))
    kept = boxed.join(best, ["h1", "h2"], "left_semi").groupBy("h1", "h2")
    return kept.agg(F.first("row").alias("row")).select("row.*")
