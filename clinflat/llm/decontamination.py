"""Benchmark decontamination: SimHash of item-sized windows, then exact similarity.

Windows of an item's length are taken wherever enough places of the text share a shingle
with the item, in any order: a window and an item with n and m shingles that are t alike
have at least t (n + m) / (1 + t) such places, so no similar window is left out. Windows
and items get SimHash fingerprints. Each
fingerprint is cut into BLOCKS blocks of 8 bits; two that differ in at most RADIUS =
2 * BLOCKS - 1 bits have a block that differs in at most one bit, so looking each block of
a window up with none or one of its bits flipped finds every item within the radius. The
candidates are held to the exact weighted Jaccard similarity of their shingles, each
shingle weighted by how often it stands there.

Everything is DataFrame work. Words are runs of letters and digits, case ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat.llm.texts import row_key, shingle_hashes
from clinflat.session import is_small, stage

WIDTH = 5
SIMILARITY = 0.8
BLOCKS = 8
BLOCK_BITS = 64 // BLOCKS
RADIUS = 2 * BLOCKS - 1
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of ASCII letters, digits and other characters beyond ASCII, in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def simhash(hashes: Column) -> Column:
    """A bit is 1 if it is set in more than half of the hashes."""

    def ones(bit: Column) -> Column:
        one = lambda n, h: n + F.getbit(h, bit).cast("int")
        return F.aggregate(hashes, F.lit(0), one)

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)),
        F.lit(0).cast("long"),
        lambda fp, bit: F.when(
            2 * ones(bit) > F.size(hashes),
            fp.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit)),
        ).otherwise(fp),
    )


def _blocks(fp: Column, flip: bool) -> Column:
    """(block, value) of a fingerprint; with ``flip`` also each value with one bit flipped."""
    out = []
    for k in range(BLOCKS):
        value = F.shiftrightunsigned(fp, BLOCK_BITS * k).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
        masks = [0, *(1 << j for j in range(BLOCK_BITS))] if flip else [0]
        for m in masks:
            out.append(F.struct(F.lit(k).alias("block"), value.bitwiseXOR(F.lit(m)).alias("value")))
    return F.array(*out)


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Items with words: id, number of words, width of their shingles, hashes, fingerprint."""
    tokens = words(benchmark[text_col])
    items = benchmark.select(benchmark[item_col].alias("item_id"), tokens.alias("tokens"))
    items = items.where(F.size("tokens") > 0)
    width = F.least(F.size("tokens"), F.lit(WIDTH))
    by_width = F.coalesce(
        *[F.when(width == k, shingle_hashes(F.col("tokens"), k)) for k in range(1, WIDTH + 1)]
    )
    items = items.select(
        "item_id", F.size("tokens").alias("n_words"), width.alias("width"), by_width.alias("hashes")
    )
    # the item's place in the table tells items apart that share an id or have none
    return items.withColumn("fp", simhash(F.col("hashes"))).withColumn(
        "item", F.xxhash64("item_id", F.to_json("hashes"))
    ).dropDuplicates(["item", "item_id"])


def _starts(share: Column, low: Column, high: Column | None = None) -> Column:
    """Window starts from ``low`` to ``high`` with ``share * n_i`` or more of the ``places`` inside.

    ``places`` is sorted: with k of them needed, the windows that hold the q-th and the k - 1
    after it are those from the last one's first window to the q-th place itself.
    """
    needed = F.greatest(F.ceil(share * F.col("n_i") - F.lit(1e-9)).cast("int"), F.lit(1))
    none = F.array().cast("array<int>")

    def run(q: Column) -> Column:
        first = F.get("places", q + needed - 1) - (F.col("n_words") - F.col("width"))
        first, last = F.greatest(first, low), F.get("places", q)
        last = last if high is None else F.least(last, high)
        return F.when(first <= last, F.sequence(first, last)).otherwise(none)

    last = F.size("places") - needed
    runs = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), run)
    return F.when(last >= 0, F.array_distinct(F.flatten(runs))).otherwise(none)


def _counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.explode("hashes").alias("hash")).groupBy(*keys, "hash").count()


def matches(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Documents with benchmark passages: ``doc_id, item_id, start, n_words, distance,
    similarity, n_windows`` and the row key ``h1, h2``.

    One row for each document and item: the most similar window (the first, if several),
    where it starts in words, and how many windows reach ``similarity``. Items of fewer
    than five words are one shingle of all their words; items and documents without a
    word match nothing, nor do null texts. Repeated rows give one result, items with the
    same id and text count once, ids may be null. Empty tables give an empty result.
    """
    items = stage(_items(benchmark, item_col, item_text_col), "benchmark-items")
    widths = [r["width"] for r in items.select("width").distinct().collect()]  # five at most
    key = row_key(docs[id_col], docs[text_col])
    whole = docs.select(
        docs[id_col].alias("doc_id"), docs[text_col].alias("text"),
        key[0].alias("h1"), key[1].alias("h2"),
    )
    tokens = whole.select("h1", "h2", words(F.col("text")).alias("tokens"))
    lookup = items.select(
        "item", "n_words", "width", F.size("hashes").alias("n_i"),
        F.explode(F.array_distinct("hashes")).alias("hash"),
    )
    if is_small(lookup):
        lookup = F.broadcast(lookup)
    anchored = []
    for width in widths:
        found = tokens.select(
            "h1", "h2", F.size("tokens").alias("n_tokens"),
            F.posexplode(shingle_hashes(F.col("tokens"), width)).alias("pos", "hash"),
        )
        anchored.append(
            found.join(lookup.where(F.col("width") == width), "hash").select(
                "h1", "h2", "item", "n_words", "width", "n_i", "n_tokens", "pos"
            )
        )
    if not anchored:
        anchored = [tokens.limit(0).select(
            "h1", "h2", *[F.lit(0).cast(t).alias(n) for n, t in (
                ("item", "long"), ("n_words", "int"), ("width", "int"), ("n_i", "int"),
                ("n_tokens", "int"), ("pos", "int"))])]
    pairs = reduce(DataFrame.unionByName, anchored).groupBy(
        "h1", "h2", "item", "n_words", "width", "n_i", "n_tokens"
    ).agg(F.array_sort(F.collect_set("pos")).alias("places"))
    # a window has as many shingles as the item, but for those that the text's end cuts short
    whole_end = F.col("n_tokens") - F.col("n_words")
    cut = _starts(F.lit(similarity), F.greatest(whole_end + 1, F.lit(0)))
    full = _starts(F.lit(2 * similarity / (1 + similarity)), F.lit(0), whole_end)
    starts = pairs.select(
        "h1", "h2", "item", "n_words", "width", F.explode(F.concat(full, cut)).alias("start")
    )
    asked = starts.groupBy("h1", "h2").agg(
        F.collect_list(F.struct("item", "n_words", "width", "start")).alias("asked")
    )
    slices = F.transform(
        "asked",
        lambda a: F.struct(
            a["width"].alias("width"), a["start"].alias("start"), a["item"].alias("item"),
            F.slice("tokens", a["start"] + 1, a["n_words"]).alias("window"),
        ),
    )
    placed = whole.join(asked, ["h1", "h2"]).select(
        "doc_id", "h1", "h2", "asked", words(F.col("text")).alias("tokens")
    )
    placed = placed.select("doc_id", "h1", "h2", F.inline(slices))
    size = F.col("width")
    by_width = F.coalesce(
        F.lit(None).cast("array<long>"),
        *[F.when(size == k, shingle_hashes(F.col("window"), k)) for k in widths],
    )
    text = F.concat_ws(" ", F.col("window"))
    windows = placed.select(
        "doc_id", "h1", "h2", "item", "start", "width", by_width.alias("hashes"),
        F.size("window").alias("n_words"),
        F.xxhash64("width", text).alias("c1"), F.xxhash64(text, "width").alias("c2"),
    )
    windows = stage(windows.where(F.size("hashes") > 0), "windows")
    # equal windows are compared once
    contents = windows.groupBy("c1", "c2", "width").agg(F.first("hashes").alias("hashes"))
    contents = stage(contents.withColumn("fp", simhash(F.col("hashes"))), "window-contents")
    probes = contents.select("c1", "c2", "fp", "width", F.inline(_blocks(F.col("fp"), True)))
    blocks = items.select(
        "item", "width", F.col("fp").alias("item_fp"), F.inline(_blocks(F.col("fp"), False))
    )
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    near = (
        probes.join(blocks, ["block", "value", "width"])
        .withColumn("distance", distance)
        .where(F.col("distance") <= RADIUS)
        .select("c1", "c2", "item", "distance")
        .distinct()
    )
    n_window = contents.select("c1", "c2", F.size("hashes").alias("n_c"))
    n_item = items.select("item", F.size("hashes").alias("n_i")).distinct()
    common = (
        near.join(_counts(contents, "c1", "c2").withColumnRenamed("count", "in_c"), ["c1", "c2"])
        .join(
            _counts(items.dropDuplicates(["item"]), "item").withColumnRenamed("count", "in_i"),
            ["item", "hash"],
        )
        .groupBy("c1", "c2", "item", "distance")
        .agg(F.sum(F.least("in_c", "in_i")).alias("common"))
    )
    similar = F.col("common") / (F.col("n_c") + F.col("n_i") - F.col("common"))
    verified = (
        common.join(n_window, ["c1", "c2"])
        .join(n_item, "item")
        .withColumn("similarity", similar)
        .where(F.col("similarity") >= similarity)
        .select("c1", "c2", "item", "distance", "similarity")
    )
    best = F.struct(
        (-F.col("similarity")).alias("less"), "start", "n_words", "distance", "similarity"
    )
    hits = (
        windows.select("doc_id", "h1", "h2", "start", "n_words", "c1", "c2")
        .distinct()
        .join(verified, ["c1", "c2"])
        .groupBy("doc_id", "h1", "h2", "item")
        .agg(F.min(best).alias("best"), F.count("*").alias("n_windows"))
    )
    return hits.join(items.select("item", "item_id"), "item").select(
        "doc_id", "item_id", "best.start", "best.n_words", "best.distance", "best.similarity",
        "n_windows", "h1", "h2",
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` in which no benchmark passage was found, all columns as they are."""
    found = matches(docs, benchmark, id_col=id_col, text_col=text_col)
    h1, h2 = row_key(docs[id_col], docs[text_col])
    boxed = docs.select(h1.alias("h1"), h2.alias("h2"), F.struct("*").alias("row"))
    return boxed.join(found.select("h1", "h2"), ["h1", "h2"], "left_anti").select("row.*")
