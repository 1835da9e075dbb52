"""Hard-negative mining with Kronecker-packed inner products.

Vectors are scaled and floored to integers. One component of many candidates is biased to
be non-negative and laid into separate fields of one wide integer, so that multiplying it
once by an anchor's component multiplies all of them. The sum over the components holds
each candidate's inner product in its field, exactly, as fields are wide enough for the
largest possible sum.

Anchors and candidates meet in cells of a grid, a block of anchors by a block of rows, each
cell in one task. A first pass finds every anchor's best rows of its own label, a second the
best rows of other labels within the range that each of these positives sets. A cell keeps
only its best rows; the cells' rows are ranked once more.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from math import floor, isinf
from operator import mul

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflat.session import stage

ANCHORS, CANDIDATES = 4096, 4096  # rows of each kind in a cell, about
SAFE = 1 << 40  # components below this are handled as 64-bit integers before packing
LONGS = np.iinfo(np.int64)


def integers(vectors: pa.Array, scale: float) -> np.ndarray:
    """Rows of floor(scale * x), short vectors filled up with zeros.

    64-bit integers, or Python's where a component is very large.
    """
    n = pc.list_value_length(vectors).to_numpy(False).astype(np.int64)
    flat = vectors.flatten().to_numpy(False).astype(np.float64)
    small = not len(flat) or np.abs(flat).max() < SAFE / abs(scale)
    if small:
        values = np.floor(flat * scale).astype(np.int64)
    else:
        products = [x * scale for x in flat.tolist()]
        beyond = [Fraction(x) * Fraction(scale) if isinf(p) else p for x, p in zip(flat.tolist(), products)]
        values = np.array([floor(p) for p in beyond], object)
    out = np.zeros((len(n), int(n.max(initial=0))), np.int64 if small else object)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = values
    return out


def pack_fields(values: np.ndarray, width: int) -> int:
    """One wide integer with a value, none negative, in every ``width`` bytes."""
    if width <= 8:
        return int.from_bytes(values.astype(f"<u{width}").tobytes(), "little")
    return int.from_bytes(b"".join(int(v).to_bytes(width, "little") for v in values), "little")


def unpack_fields(packed: int, n: int, width: int) -> np.ndarray:
    data = packed.to_bytes(n * width, "little")
    if width <= 8:
        return np.frombuffer(data, f"<u{width}")
    fields = [int.from_bytes(data[k : k + width], "little") for k in range(0, len(data), width)]
    return np.array(fields, object)


class Products:
    """Exact inner products of vectors with a block of candidates, packed once."""

    def __init__(self, candidates: np.ndarray, low: int, high: int):
        """``low`` and ``high`` bound the components of all vectors to come."""
        self.n, dim = candidates.shape
        least = min(0, int(candidates.min(initial=0)))
        self.bias, self.shift = -least, -min(0, low)
        most = (int(candidates.max(initial=0)) + self.bias) * (max(high, 0) + self.shift) * dim
        need = (most.bit_length() + 7) // 8
        self.width = 4 if need <= 4 else 8 if need <= 8 else need
        biased = candidates + self.bias
        self.packed = [pack_fields(biased[:, j], self.width) for j in range(dim)]
        # sums, and what the two biases add to them, as 64-bit integers if they fit
        self.kind = np.int64 if most.bit_length() <= 62 else object
        self.own = self.shift * biased.astype(self.kind).sum(axis=1)

    def scores(self, vector: np.ndarray) -> np.ndarray:
        parts = vector.tolist()
        total = sum(map(mul, [x + self.shift for x in parts], self.packed))
        fields = unpack_fields(total, self.n, self.width).astype(self.kind)
        return fields - self.own - self.bias * sum(parts)


def _longs(scores: np.ndarray) -> np.ndarray:
    return np.clip(scores, LONGS.min, LONGS.max).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Places, out of ``at``, of the n highest scores, ties by smaller id."""
    if len(at) > 4 * n:
        least = np.partition(scores[at], len(at) - n)[len(at) - n]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], ~scores[at]))[:n]]  # ~ reverses the order of all longs


FOUND = pa.schema(
    [(x, pa.int64()) for x in ("anchor_id", "positive_id", "positive_score", "place", "id", "score")]
)
FOUND_DDL = ", ".join(f"{x} long" for x in FOUND.names)
NO_ID = LONGS.max


def _cell(n: int, low: int, high: int, base: int, scale: float, positives: bool) -> Callable:
    """A cell's best rows: of an anchor's own label, or for each of its positives of others."""

    def run(cell: pa.Table) -> pa.Table:
        is_anchor = cell["anchor"].to_numpy()
        codes = cell["label"].combine_chunks().dictionary_encode().indices.to_numpy(False)
        ids = pc.fill_null(cell["id"], NO_ID).to_numpy()
        vectors = integers(cell["vector"].combine_chunks(), scale)
        mine, rest = np.flatnonzero(is_anchor), np.flatnonzero(~is_anchor)
        out: list[tuple[np.ndarray, ...]] = []

        def keep(a: int, place: int, positive: tuple, at: np.ndarray, scores: np.ndarray) -> None:
            fixed = (np.full(len(at), v, np.int64) for v in (ids[a], *positive, place))
            out.append((*fixed, ids[rest][at], scores[at]))

        if len(mine) and len(rest):
            least, most = int(vectors[mine].min(initial=0)), int(vectors[mine].max(initial=0))
            if positives:
                for code in np.unique(codes[mine]):
                    same = np.flatnonzero(codes[rest] == code)
                    if not len(same):
                        continue
                    block = Products(vectors[rest[same]], least, most)
                    others = ids[rest[same]]
                    for a in mine[codes[mine] == code]:
                        scores = np.zeros(len(rest), np.int64)
                        scores[same] = _longs(block.scores(vectors[a]))
                        at = same[others != ids[a]]
                        keep(a, 0, (0, 0), _best(scores, ids[rest], at, n), scores)
            else:
                block, lists = Products(vectors[rest], least, most), cell["positives"].to_pylist()
                for a in mine:
                    exact = block.scores(vectors[a])
                    scores = _longs(exact)
                    other = codes[rest] != codes[a]
                    for place, p in enumerate(lists[a] or ()):
                        s = p["score"]
                        fits = other & (scores >= -(-low * s // base)) & (scores <= high * s // base)
                        at = _best(scores, ids[rest], np.flatnonzero(fits), n)
                        keep(a, place, (p["id"], s), at, scores)
        columns = [np.concatenate(c) for c in zip(*out)] or [np.zeros(0, np.int64)] * len(FOUND)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=FOUND)

    return run


def _grid(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int) -> DataFrame:
    """Every anchor with every row, by cells (i, j): no cell holds more than two blocks."""
    down, across = 1 + n_anchors // ANCHORS, 1 + n_rows // CANDIDATES
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spread = F.xxhash64("id", "vector")
    a = anchors.withColumn("i", F.pmod(spread, F.lit(down)).cast("int")).withColumn("j", every(across))
    b = rows.withColumn("j", F.pmod(spread, F.lit(across)).cast("int")).withColumn("i", every(down))
    return a.unionByName(b, allowMissingColumns=True).groupBy("i", "j")


def mine(
    df: DataFrame, anchor: Column, label: Column | None = None, positives: int = 5,
    negatives: int = 5, low: int = 80, high: int = 100, base: int = 100, scale: float = 256.0,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows where ``anchor`` holds; ``label`` replaces the label column. A score
    is the inner product of two vectors of ``floor(scale * x)``, higher ones first, ties by
    smaller id. Each anchor's first ``positives`` other rows of its label get the first
    ``negatives`` rows of other labels with
    ``low * positive_score <= base * score <= high * positive_score``.

    Rows with a null label, a null vector, or a null or non-finite component take no part;
    rows without an id are no anchors and come last in ties. Shorter vectors count as filled
    up with zeros. An id that is there twice as an anchor counts with its smaller label and
    vector, as a candidate with each of its rows; no row of an anchor's id is its positive.
    Scores beyond 64 bits count as the nearest long. Anchors without a positive, or positives
    without a negative, give no row, and so does an empty table. Other columns are not read.
    """
    vector, own = F.col(vector_col), F.col(label_col) if label is None else label
    endless = F.lit(float("inf"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == endless))
    rows = df.where(vector.isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("id"), own.alias("label"), vector.alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).where("label is not null")
    first = rows.where("anchor and id is not null").groupBy("id").agg(
        F.min(F.struct("label", "vector")).alias("row")
    )
    anchors = stage(first.select("id", "row.label", "row.vector", F.lit(True).alias("anchor")), "anchors")
    rows = rows.withColumn("anchor", F.lit(False))
    sizes = anchors.count(), rows.count()
    order = F.col("score").desc(), F.col("id")

    def best(found: DataFrame, n: int, *key: str) -> DataFrame:
        ranked = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
        return found.withColumn("rank", ranked).where(F.col("rank") <= n)

    options = (low, high, base, scale)
    near = _grid(anchors, rows, *sizes).applyInArrow(_cell(positives, *options, True), FOUND_DDL)
    own_best = best(near, positives, "anchor_id").groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("positives")
    )
    asked = stage(
        anchors.join(own_best, anchors["id"] == own_best["anchor_id"]).drop("anchor_id"), "positives"
    )
    far = _grid(asked, rows, *sizes).applyInArrow(_cell(negatives, *options, False), FOUND_DDL)
    return best(far, negatives, "anchor_id", "place").select(
        "anchor_id", F.nullif("positive_id", F.lit(NO_ID)).alias("positive_id"), "rank",
        F.nullif("id", F.lit(NO_ID)).alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
