"""N-gram Jaccard self-join over size-banded tiles with bitmap signatures.

Two documents link if the Jaccard similarity of their sets of word shingles is at least
``share`` per cent. Sets are hashed sorted arrays; equal sets are one node. A tile is a group
of nodes that one task compares: sets that differ too much in size are in different bands
and never meet, and within a band two sets are compared by parity bitmaps. A bit is the
parity of the shingles that hash to it, so the differing bits of two bitmaps are at most the
differing shingles, and half of what remains of the two sizes bounds the overlap from above.
What passes is decided by intersecting the sorted arrays.

1. Each set's smallest hash is its home. Sets with one home meet in a tile with their texts,
   where links are verified at once. Most groups of copies become one label here.
2. Linked sets share one of their rarest shingles at least: of n shingles the first
   n - ceil(share * n) + 1 in a common order. Sets are dealt to these keys, but only to keys
   that have several labels; keys with very many sets are cut by size bands into tiles, and
   pairs of tiles go to a task. A tile gives a spanning forest of its candidates.
3. Candidates are verified on the sets; where one failed, the tiles that still have
   several labels are asked for all that join them.

Which shingles are rare is estimated by counters of hashes over all documents. They only
decide the order, so that a shingle of very many documents is hardly ever a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflat.llm.components import connected
from clinflat.llm.membership import bitmap_of, is_member
from clinflat.llm.texts import row_key
from clinflat.session import is_small, stage

WIDTH, SHARE = 3, 90
NARROW, WIDE = 256, 4096  # bits of the bitmaps; sets of WIDE_FROM shingles have both
WIDE_FROM = 1000
BAND = 1.5  # largest ratio of sizes in a band
TILE = 2048  # nodes of a tile, about
TILE_BYTES = 16 << 20  # text of a tile at most, but for a longer one
COUNTERS, CHUNK = 1 << 17, 1 << 12
KNOWN_WORDS, KNOWN_NODES = 300_000, 300_000
BASE = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(known: Words, text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the different ``width``-word shingles; with fewer words, of them all.

    On UTF-8, ``lower`` changes A-Z only and ``split`` cuts at just the six white spaces.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    have = min(width, len(w))
    h = w[: len(w) - have + 1]
    for j in range(1, have):
        h = h * BASE + w[j : len(w) - have + 1 + j]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(have)
    return np.unique(h ^ (h >> np.uint64(29)))


def name_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed integer."""
    return int.from_bytes(xxhash.xxh64_digest(shingles.tobytes()), "big", signed=True)


def least_overlap(a, b, share: int = SHARE):
    """Shingles that sets of these sizes must have in common to link."""
    return -(-share * (a + b) // (100 + share))


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity bitmap: NARROW bits, or WIDE for a large set; the wide one folds to the narrow."""
    bits = WIDE if len(shingles) >= WIDE_FROM else NARROW
    at = (shingles & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def prefix(shingles: np.ndarray, counters: np.ndarray, share: int = SHARE) -> np.ndarray:
    """The set's rarest shingles, one of which every linked set has among its own."""
    n = len(shingles)
    seen = counters[(shingles >> np.uint64(20) & np.uint64(len(counters) - 1)).astype(np.int64)]
    return shingles[np.argsort(seen, kind="stable")[: n - -(-share * n // 100) + 1]]


def band_of(n, ratio: float = BAND):
    """Number of the size band of sets of n shingles."""
    return np.floor(np.log(n) / np.log(ratio) + 1e-9).astype(np.int64)


def banded(keys: np.ndarray, n: int, share: int) -> np.ndarray:
    """The keys by size band: that of the set, and the next if a linked set may be in it."""
    low, high = band_of(np.array([n, 100 * n / share + 1e-6])).tolist()
    both = [keys * BASE + np.uint64(b) for b in range(low, high + 1)]
    h = np.concatenate(both) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Tile:
    """Nodes of about one size with their bitmaps, compared with each other."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[bytes], share: int):
        self.n, self.share = sizes.astype(np.int64), share
        whole = [np.frombuffer(b, np.uint64) for b in bitmaps]
        words = NARROW // 64
        self.narrow = np.array([np.bitwise_xor.reduce(b.reshape(-1, words)) for b in whole])
        self.large = np.array([len(b) > words for b in whole])
        self.wide = np.zeros((0, WIDE // 64), np.uint64)
        if self.large.any():
            self.wide = np.array([b for b in whole if len(b) > words])
        self.row = np.cumsum(self.large) - 1

    def near(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` whose overlap with i may be large enough."""
        total = self.n[others] + self.n[i]
        need = least_overlap(total, 0, self.share)
        others = others[np.minimum(self.n[others], self.n[i]) >= need]
        for bits, ok in ((self.narrow, None), (self.wide, self.large)):
            if ok is None or ok[i]:
                both = np.ones(len(others), bool) if ok is None else ok[others]
                mine, row = (bits[i], others[both]) if ok is None else (bits[self.row[i]], self.row[others[both]])
                differ = np.bitwise_count(bits[row] ^ mine).sum(axis=1, dtype=np.int64)
                total = self.n[others[both]] + self.n[i]
                passed = np.ones(len(others), bool)
                passed[both] = (total - differ) // 2 >= least_overlap(total, 0, self.share)
                others = others[passed]
        return others


class Groups:
    """Union-find on 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def alike(a: np.ndarray, b: np.ndarray, share: int) -> bool:
    """Whether two sorted sets link, by their exact intersection."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
    return common > 0 and 100 * common >= share * (len(a) + len(b) - common)


PRINTS = "doc_id {}, h1 long, h2 long, node long, n long, home long, chunk int, counts binary"


def _prints(width: int, schema: pa.Schema) -> Callable:
    """A row for each document, and at the end of a task its counters in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counters = Words(), np.zeros(COUNTERS, np.int64)
        for batch in batches:
            rows, seen = [], [np.zeros(0, np.int64)]
            for text in batch.column(1).to_pylist():
                s = shingle_set(known, text, width)
                seen.append((s >> np.uint64(20) & np.uint64(COUNTERS - 1)).astype(np.int64))
                home = int(s[:1].view(np.int64)[0]) if len(s) else None
                rows.append((name_of(s), len(s), home))
            counters += np.bincount(np.concatenate(seen), minlength=COUNTERS)
            columns = [batch.column(0), batch.column(2), batch.column(3)]
            columns += [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 3)]
            none = [pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *none], schema=schema)
        chunks = [k for k in range(COUNTERS // CHUNK) if counters[k * CHUNK : (k + 1) * CHUNK].any()]
        data = [counters[k * CHUNK : (k + 1) * CHUNK].tobytes() for k in chunks]
        empty = [pa.nulls(len(chunks), f.type) for f in schema][:-2]
        columns = [*empty, pa.array(chunks, pa.int32()), pa.array(data, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the counters by chunk, over what a task reads."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(*(c.to_pylist() for c in batch.columns)):
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, np.int64)
    columns = [pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["chunk", "counts"])


def _with_home(width: int) -> Callable:
    """``home, node, text`` of each text with words, of equal sets mostly once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Words(), set()
        for batch in batches:
            rows = []
            for k, text in enumerate(batch.column(0).to_pylist()):
                s = shingle_set(known, text, width)
                node = name_of(s)
                if len(s) and node not in seen:
                    if len(seen) > KNOWN_NODES:
                        seen.clear()
                    seen.add(node)
                    rows.append((k, int(s[:1].view(np.int64)[0]), node))
            at, home, node = zip(*rows) if rows else ((), (), ())
            columns = [pa.array(home, pa.int64()), pa.array(node, pa.int64())]
            columns.append(batch.column(0).take(pa.array(at, pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["home", "node", "text"])

    return run


NODES = pa.schema(
    [("node", pa.int64()), ("n", pa.int64()), ("label", pa.int64()),
     ("keys", pa.list_(pa.int64())), ("bitmap", pa.binary())]
)
NODES_DDL = "node long, n long, label long, keys array<long>, bitmap binary"


def _home_tiles(width: int, share: int, counters: Callable[[], np.ndarray]) -> Callable:
    """The nodes of each tile with their label, keys and bitmap; rows come by tile, node by node."""

    def solve(rows: list[tuple[int, bytes]], known: Words) -> pa.RecordBatch:
        sets = [shingle_set(known, text, width) for _, text in rows]
        maps = [bitmap(s) for s in sets]
        groups = Groups(len(rows))
        if len(rows) > 1:
            order = sorted(range(len(rows)), key=lambda k: (len(sets[k]), rows[k][0]))
            sizes = np.array([len(sets[k]) for k in order])
            tile = Tile(sizes, [maps[k] for k in order], share)
            low = np.searchsorted(sizes, -(-share * sizes // 100))
            for i in range(1, len(order)):
                for j in tile.near(i, np.arange(low[i], i)).tolist():
                    x, y = order[i], order[j]
                    if groups.root(x) != groups.root(y) and alike(sets[x], sets[y], share):
                        groups.join(x, y)
        seen = counters()
        keys = [banded(prefix(s, seen, share), len(s), share).view(np.int64) for s in sets]
        offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        columns = [
            pa.array([r[0] for r in rows], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
            pa.array([rows[groups.root(k)][0] for k in range(len(rows))], pa.int64()),
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys))), pa.array(maps, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=NODES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size, last = Words(), [], 0, None
        for batch in batches:
            for home, salt, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                if held and node == held[-1][0]:
                    continue
                if held and ((home, salt) != last or size > TILE_BYTES):
                    yield solve(held, known)
                    held, size = [], 0
                held.append((node, text))
                size += len(text)
                last = home, salt
        if held:
            yield solve(held, known)

    return run


WORDS = [f"w{k}" for k in range(NARROW // 64)]
MET = pa.schema([(x, pa.int64()) for x in ("key", "node", "label", "n", *WORDS)])
MET_DDL = ", ".join(f"{x} long" for x in MET.names)


def folded(bitmap: bytes) -> np.ndarray:
    """The NARROW bits of a bitmap of either size."""
    return np.bitwise_xor.reduce(np.frombuffer(bitmap, np.uint64).reshape(-1, NARROW // 64))


def _at_keys(bits: Callable[[], np.ndarray]) -> Callable:
    """A row for each of a node's keys that the bitmap of keys has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixed = bits()
        for batch in batches:
            node, label, n, keys, maps = batch.columns
            flat = keys.flatten().to_numpy(False)
            row = np.repeat(np.arange(batch.num_rows), np.diff(keys.offsets.to_numpy()))
            kept = is_member(flat.view(np.uint64), mixed)
            row, flat = row[kept], flat[kept]
            narrow = np.array([folded(b) for b in maps.to_pylist()]).view(np.int64)
            narrow = narrow.reshape(-1, len(WORDS))[row]
            at = pa.array(row)
            columns = [pa.array(flat), *(c.take(at) for c in (node, label, n))]
            columns += [pa.array(np.ascontiguousarray(w)) for w in narrow.T]
            yield pa.RecordBatch.from_arrays(columns, schema=MET)

    return run


PAIRS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _candidates(share: int, forest: bool) -> Callable:
    """Candidate pairs of different labels in each tile: a forest of them, or all.

    A tile's rows come one after the other. Rows of side 1 are compared with those of side 0,
    or, if there are none, those of side 0 with each other. All tiles of a batch are compared
    at once, each row with the one that is d places further, for growing d.
    """

    def solve(tile, node, label, n, side, maps) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((n, tile))
        tile, node, label, n, side, maps = (x[order] for x in (tile, node, label, n, side, maps))
        starts = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1])))
        size = np.diff(np.append(starts, len(tile)))
        within = np.repeat(np.maximum.reduceat(side, starts) == 0, size)
        end = np.repeat(starts + size, size)
        at, found, d = np.arange(len(tile)), [(np.zeros(0, np.int64),) * 2], 1
        while True:
            at = at[at + d < end[at]]
            # sizes grow, so a set that is too small for this one is too small for the rest
            at = at[100 * n[at] >= share * n[at + d]]
            if not len(at):
                break
            i = at[(label[at] != label[at + d]) & (within[at] | (side[at] != side[at + d]))]
            total = n[i] + n[i + d]
            differ = np.bitwise_count(maps[i] ^ maps[i + d]).sum(axis=1, dtype=np.int64)
            i = i[(total - differ) // 2 >= least_overlap(total, 0, share)]
            found.append((i, i + d))
            d += 1
        i, j = (np.concatenate(x) for x in zip(*found))
        if forest and len(i):
            labels = np.unique(np.stack((tile, label)), axis=1, return_inverse=True)[1].ravel()
            groups = Groups(int(labels.max()) + 1)
            joins = [groups.join(x, y) for x, y in zip(labels[i].tolist(), labels[j].tolist())]
            i, j = i[joins], j[joins]
        return np.minimum(node[i], node[j]), np.maximum(node[i], node[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            part = (*columns[:5], np.stack(columns[5:], axis=1).view(np.uint64))
            if rest is not None:
                part = tuple(np.concatenate(x) for x in zip(rest, part))
            last = part[0] == part[0][-1] if len(part[0]) else np.zeros(0, bool)
            rest = tuple(x[last] for x in part)
            if not last.all():
                u, v = solve(*(x[~last] for x in part))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=PAIRS)
        if rest is not None and len(rest[0]):
            u, v = solve(*rest)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=PAIRS)

    return run


def _tiles(met: DataFrame, share: int) -> DataFrame:
    """``tile, node, label, n, side`` and the bitmap: the nodes of each key, cut where they
    are many.

    In a large key, bands are narrow: band b holds sizes from (100 / share)^b on, so linked
    sets are in one or in two neighbouring ones. A band is dealt to tiles by hash; tiles of
    one band, and of it and the next, meet in pairs.
    """
    sizes = met.groupBy("key").count()
    large = stage(sizes.where(F.col("count") > TILE).select("key"), "large-keys")
    rest = ["node", "label", "n"]
    small = met.join(large, "key", "left_anti").select(
        F.xxhash64("key").alias("tile"), *rest, F.lit(0).cast("long").alias("side"), *WORDS
    )
    if large.isEmpty():
        return small
    band = F.floor(F.log("n") / F.log(F.lit(100 / share)))
    banded = met.join(large, "key", "left_semi").withColumn("band", band)
    counts = banded.groupBy("key", "band").agg(F.ceil(F.count("*") / TILE).alias("m"))
    for name, step in (("m", 0), ("up", 1), ("down", -1)):
        other = counts.select("key", (F.col("band") - step).alias("band"), F.col("m").alias(name))
        banded = banded.join(other, ["key", "band"], "left")
    own = F.pmod(F.xxhash64("node"), F.col("m"))

    def places(n: str, tile: Callable, side: Callable):
        every = F.sequence(F.lit(0).cast("long"), F.coalesce(n, F.lit(1)) - 1)
        one = F.transform(every, lambda j: F.struct(tile(j).alias("tile"), side(j).cast("long").alias("side")))
        return F.when(F.col(n).isNotNull(), one).otherwise(F.array().cast("array<struct<tile:bigint,side:bigint>>"))

    name = lambda kind, b, i, j: F.xxhash64("key", F.lit(kind), b, i, j)
    b, low, high = F.col("band"), F.least, F.greatest
    spread = F.concat(
        places("m", lambda j: name(0, b, low(own, j), high(own, j)), lambda j: own > j),
        places("up", lambda j: name(1, b, own, j), lambda j: F.lit(0)),
        places("down", lambda j: name(1, b - 1, j, own), lambda j: F.lit(1)),
    )
    return small.unionByName(banded.select(F.inline(spread), *rest, *WORDS).select("tile", *rest, "side", *WORDS))


def _near(pairs: DataFrame, nodes: DataFrame, share: int) -> DataFrame:
    """The pairs (u, v) that the wide bitmaps of large sets leave."""
    maps = nodes.where(F.col("n") >= WIDE_FROM).select("node", "n", "bitmap").dropDuplicates(["node"])
    for side, (n, bits) in (("u", ("a", "x")), ("v", ("b", "y"))):
        one = maps.select(F.col("node").alias(side), F.col("n").alias(n), F.col("bitmap").alias(bits))
        pairs = pairs.join(one, side, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for _, _, a, x, b, y in zip(*(c.to_pylist() for c in batch.columns)):
                kept.append(x is None or y is None)
                if x and y:
                    differ = (int.from_bytes(x) ^ int.from_bytes(y)).bit_count()
                    kept[-1] = (a + b - differ) // 2 >= least_overlap(a + b, 0, share)
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    return pairs.select("u", "v", "a", "x", "b", "y").mapInArrow(run, "u long, v long")


def _verified(
    pairs: DataFrame, prints: DataFrame, texts: DataFrame, width: int, share: int
) -> DataFrame:
    """The pairs (u, v) that link, by the shingle sets of one document each."""
    asked = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    one = prints.join(asked, "node").groupBy("node").agg(F.min(F.struct("h1", "h2")).alias("row"))
    one = stage(one.select("node", "row.h1", "row.h2"), "asked-sets")
    rows = texts.join(F.broadcast(one) if is_small(one) else one, ["h1", "h2"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            sets = [shingle_set(known, t, width).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "hashes"])

    sets = rows.select("node", "text").mapInArrow(hashed, "node long, hashes binary")
    # a row that is there twice has its set twice
    sets = stage(sets.groupBy("node").agg(F.first("hashes").alias("hashes")), "sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            kept = [alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), share) for x, y in both]
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    for side, hashes in (("u", "x"), ("v", "y")):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("hashes").alias(hashes)), side)
    return pairs.select("u", "v", "x", "y").mapInArrow(check, "u long, v long")


def components(
    docs: DataFrame, width: int = WIDTH, share: int = SHARE, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, a row for each input row.

    Words are separated by white space, A-Z count as lower case; a text of fewer than
    ``width`` words is one shingle. Documents link if ``100 * common >= share * all`` of
    their shingles; ``component_id`` is the smallest id reachable, null if these are all
    null. Texts without words, and null texts, have no shingle and link with nothing.
    Repeated rows link like any others; an empty table gives an empty result; other columns
    are not read. Shingles and sets are told apart by 64-bit hashes.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    h1, h2 = row_key(docs[id_col], docs[text_col])
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("binary").alias("text"), h1.alias("h1"), h2.alias("h2"))
    ddl = PRINTS.format(kind.simpleString())
    found = stage(rows.mapInArrow(_prints(width, _arrow(spark, ddl)), ddl), "shingle-prints")
    prints = found.where("chunk is null").drop("chunk", "counts")
    chunks = found.where("chunk is not null").select("chunk", "counts")
    summed = chunks.repartition("chunk").mapInArrow(_summed, "chunk int, counts binary")
    counters = np.zeros(COUNTERS, np.int64)
    for r in summed.toLocalIterator():  # COUNTERS numbers, whatever the number of documents
        counters[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], np.int64)
    sent = spark.sparkContext.broadcast(counters)

    sets = prints.where("n > 0").groupBy("home", "node").agg(F.lit(1).alias("one"))
    many = sets.groupBy("home").count().where(F.col("count") > TILE)
    many = stage(many.select("home", F.ceil(F.col("count") / TILE).alias("salts")), "large-homes")
    homes = rows.select("text").where("text is not null").mapInArrow(
        _with_home(width), "home long, node long, text binary"
    )
    homes = homes.join(F.broadcast(many) if is_small(many) else many, "home", "left")
    salt = F.pmod("node", F.coalesce("salts", F.lit(1)))
    nodes = stage(
        homes.select("home", salt.alias("salt"), "node", "text")
        .repartition("home", "salt").sortWithinPartitions("home", "salt", "node")
        .mapInArrow(_home_tiles(width, share, lambda: sent.value), NODES_DDL),
        "nodes",
    )

    first = nodes.select(F.col("node").alias("u"), F.col("label").alias("v")).where("u != v")
    keys = nodes.select("label", F.explode("keys").alias("h"))
    mixed = keys.groupBy("h").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y")
    bits = bitmap_of(stage(mixed.select("h"), "mixed-keys"))
    met = stage(
        nodes.select("node", "label", "n", "keys", "bitmap").mapInArrow(
            _at_keys(bits), MET_DDL
        ),
        "met",
    )

    def candidates(met: DataFrame, forest: bool) -> DataFrame:
        dealt = _tiles(met, share).repartition("tile").sortWithinPartitions("tile")
        pairs = dealt.mapInArrow(_candidates(share, forest), "u long, v long")
        return stage(pairs.where("u != v").distinct(), "candidates")

    def linked(pairs: DataFrame) -> DataFrame:
        near = stage(_near(pairs, nodes, share), "candidates")
        return stage(_verified(near, prints, rows, width, share), "links")

    tried = candidates(met, True)
    good = linked(tried)
    links = first.unionByName(good)
    failed = tried.join(good, ["u", "v"], "left_anti").select(F.col("u").alias("node")).distinct()
    if not failed.isEmpty():
        # in a tile where a pair failed, others may join what it did not
        keys = met.join(failed, "node", "left_semi").select("key").distinct()
        label = connected(links).select(F.col("node"), F.col("root").alias("new"))
        again = met.join(keys, "key", "left_semi").join(label, "node", "left")
        again = again.withColumn("label", F.coalesce("new", "node")).select(*MET.names)
        rest = candidates(stage(again, "met"), False).join(tried, ["u", "v"], "left_anti")
        links = links.unionByName(linked(rest))

    roots = connected(links)
    rooted = prints.join(roots, "node", "left").select(
        "doc_id", "n", F.when(F.col("n") > 0, F.coalesce("root", "node")).alias("root")
    )
    named = rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rooted.join(named, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")
    )


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)
