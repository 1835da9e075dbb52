"""Records of CSV files with quoted line breaks, cut by many tasks.

Files are read as lines, which Spark splits anywhere. Whether a line begins inside quotes
depends on all lines before it, but only through one bit, so each line is a function of
that bit: ``s0`` and ``s1`` say whether it ends inside quotes when it begins outside or
inside. Functions are put together first over the lines of a block (a split of a file),
then over the blocks of a file, of which there is one row each.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from clinflat.session import stage

# Where a line lies: its file, the first byte of its split, and its place there.
PLACE = ("path", "block", "n")

BOM = "\ufeff"


def _walk(start: int) -> str:
    """SQL: whether a line that begins in state ``start`` ends inside quotes (1) or not (0).

    Doubled quotes are removed first: they neither open nor close. Outside quotes a quote
    opens only where a cell begins; in the middle of a cell it is text.
    """
    step = "IF(a.s = 1, 0, IF(p = '' AND a.first OR endswith(p, ','), 1, 0))"
    return (
        "aggregate(slice(pieces, 1, size(pieces) - 1), "
        f"named_struct('s', {start}, 'first', true), "
        f"(a, p) -> named_struct('s', {step}, 'first', false), a -> a.s)"
    )


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, block, n, value, text, s0, s1`` of every line; carriage returns stay. ``text``:
    whether the line has any."""
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
        F.when(F.startswith("value", F.lit(BOM)), F.substr("value", F.lit(2)))
        .otherwise(F.col("value")).alias("value"),
    )
    pieces = F.split(F.replace("value", F.lit('""'), F.lit("")), '"').alias("pieces")
    quoted = F.contains("value", F.lit('"'))
    return raw.select("*", pieces).select(
        *PLACE, "value", (~F.col("value").isin("", "\r")).alias("text"),
        F.when(quoted, F.expr(_walk(0))).otherwise(0).alias("s0"),
        F.when(quoted, F.expr(_walk(1))).otherwise(1).alias("s1"),
    )


def _composed(window: WindowSpec, entry: Column) -> Column:
    """State after the rows of ``window``, entered in state ``entry``.

    A row that ends in the same state either way forgets what was before it; the last
    such row counts, and after it only how often the state was swapped.
    """
    swaps = F.sum(F.col("swap")).over(window)
    fixed = F.last(F.when(F.col("s0") == F.col("s1"), F.struct("s0", "swapped")), True).over(window)
    since = F.coalesce(swaps, F.lit(0)) - F.coalesce(fixed["swapped"], F.lit(0))
    return (F.coalesce(fixed["s0"], entry) + since) % 2


def _with_swaps(rows: DataFrame, window: WindowSpec) -> DataFrame:
    swap = (F.col("s0") > F.col("s1")).cast("int")
    return rows.withColumn("swap", swap).withColumn("swapped", F.sum("swap").over(window))


def block_entries(rows: DataFrame) -> DataFrame:
    """``path, block, entry, open_block, open_n, first_n``, one row a block.

    ``entry``: whether the block begins inside quotes; ``open_block, open_n``: the line
    that opened them; ``first_n``: the block's first line with text.
    """
    inside = Window.partitionBy("path", "block").orderBy("n")
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    both = _with_swaps(rows.select(*PLACE, "s0", "s1", "text"), run)
    for k in (0, 1):
        both = both.withColumn(f"b{k}", _composed(before, F.lit(k)))
        both = both.withColumn(f"e{k}", _composed(run, F.lit(k)))
    per_block = both.groupBy("path", "block").agg(
        F.max_by("e0", "n").alias("s0"),
        F.max_by("e1", "n").alias("s1"),
        F.max(F.when(F.col("b0") == 0, F.col("n"))).alias("last0"),
        F.max(F.when(F.col("b1") == 0, F.col("n"))).alias("last1"),
        F.min(F.when(F.col("text"), F.col("n"))).alias("first_n"),
    )
    along = Window.partitionBy("path").orderBy("block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    entered = _with_swaps(
        per_block, along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ).withColumn("entry", _composed(earlier, F.lit(0)))
    begun = F.when(F.col("entry") == 0, F.col("last0")).otherwise(F.col("last1"))
    opened = F.when(begun.isNotNull(), F.struct("block", begun.alias("n")))
    leaves = F.when(F.col("entry") == 0, F.col("s0")).otherwise(F.col("s1"))
    return entered.withColumn("opened", F.last(opened, True).over(earlier)).select(
        "path", "block", "entry", F.col("opened.block").alias("open_block"),
        F.col("opened.n").alias("open_n"), "first_n", leaves.alias("leaves"),
        F.row_number().over(Window.partitionBy("path").orderBy(F.desc("block"))).alias("from_end"),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``path, block, n, record, first`` of every record; ``first`` marks a file's first one.

    A record's line breaks stay as they are, the one that ends it is taken off, and empty
    lines between records are left out. Lines are written once, since how files are split may
    change from one job to the next. Text then crosses the network by block; only records
    of several lines are sent again, to be put together. A file that ends inside
    quotes is refused: its last cell would be the rest of the file. Line breaks are
    ``\\n`` or ``\\r\\n``; compressed files are one block.
    """
    rows = stage(lines(spark, path), "csv_lines")
    blocks = stage(block_entries(rows), "csv_blocks")
    broken = blocks.where((F.col("from_end") == 1) & (F.col("leaves") == 1)).select("path").first()
    if broken is not None:
        raise ValueError(f"{broken['path']} ends inside quotes")
    firsts = (
        blocks.where(F.col("first_n").isNotNull())
        .groupBy("path").agg(F.min(F.struct("block", "first_n")).alias("head"))
    )
    known = blocks.join(firsts, "path", "left").drop("first_n", "leaves", "from_end")
    inside = Window.partitionBy("path", "block").orderBy("n")
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = _with_swaps(rows.join(known, ["path", "block"]), run)
    placed = placed.withColumn("begins", _composed(before, F.col("entry")))
    placed = placed.withColumn("ends", _composed(run, F.col("entry")))
    own = F.last(F.when(F.col("begins") == 0, F.col("n")), True).over(run)
    placed = placed.withColumn("own", own).select(
        "path", F.when(F.col("own").isNull(), F.col("open_block")).otherwise(F.col("block")).alias("of_block"),
        F.coalesce("own", "open_n").alias("of_n"), "block", "n", "value", "text", "begins", "ends", "head",
    )
    single = (F.col("begins") == 0) & (F.col("ends") == 0)
    alone = placed.where(single & F.col("text")).select(
        "path", "block", "n", F.col("value").alias("record"), "head"
    )
    joined = (
        placed.where(~single)
        .groupBy("path", "of_block", "of_n")
        .agg(
            F.sort_array(F.collect_list(F.struct("block", "n", "value"))).alias("parts"),
            F.first("head").alias("head"),
        )
        .select(
            "path", F.col("of_block").alias("block"), F.col("of_n").alias("n"),
            F.array_join("parts.value", "\n").alias("record"), "head",
        )
    )
    first = (F.col("block") == F.col("head.block")) & (F.col("n") == F.col("head.first_n"))
    return alone.unionByName(joined).select(
        "path", "block", "n", F.regexp_replace("record", "\r$", "").alias("record"),
        F.coalesce(first, F.lit(False)).alias("first"),
    )


def header(records: DataFrame) -> list[str]:
    """Trimmed names of the first records. Cells are read by position, so files with
    different headers are an error."""
    heads = records.where("first").select("record").distinct().limit(2).collect()
    if len(heads) > 1:
        raise ValueError("the files have different header rows: read them one by one")
    if not heads:
        return []
    text, options = F.lit(heads[0]["record"]), {"escape": '"'}
    one = records.sparkSession.range(1)
    inferred = one.select(F.schema_of_csv(text, options)).first()[0]
    schema = ", ".join(f"_c{i} string" for i in range(len(re.findall(r"_c\d+:", inferred))))
    row = one.select(F.from_csv(text, schema, options).alias("r")).select("r.*").first()
    return [(c or "").strip() for c in row]


def cells(records: DataFrame, names: list[str], raw: str) -> DataFrame:
    """The records after the headers as text columns ``_c0, _c1, ..``; ``raw`` holds the
    text of a record with more or fewer cells than ``names``, else null."""
    schema = ", ".join(f"_c{i} string" for i in range(len(names))) + f", {raw} string"
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": raw}
    parsed = F.from_csv("record", schema, options)
    return records.where(~F.col("first")).select(F.explode(F.array(parsed)).alias("r")).select("r.*")
