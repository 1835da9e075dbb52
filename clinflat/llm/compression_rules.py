"""Quality rules: word, symbol and repetition counts, and bands of zstandard ratios.

Repetitive text compresses far better than prose, incompressible text far worse. The
ratio of compressed to plain bytes is taken of the whole document and of every chunk of
it, and held against limits that depend on the length: short texts always compress badly,
long ones always well. The last chunk is as long as the others: it ends with the text and
overlaps the one before. A text shorter than a chunk is its own only chunk, which the
whole text's ratio has judged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from clinflat.llm.texts import map_rows


class Band(NamedTuple):
    """Ratios allowed for texts of fewer than ``below`` bytes (of any length if None)."""

    below: int | None
    least: float
    most: float


# Prose has ratios of about 0.4 to 0.7 in the languages tried; the bands leave it room
# on both sides. Under 256 bytes the frame's own bytes outweigh what the text shows.
BANDS = (
    Band(256, 0.25, 9.0),
    Band(1024, 0.30, 0.90),
    Band(4096, 0.25, 0.85),
    Band(16384, 0.20, 0.80),
    Band(None, 0.15, 0.75),
)
CHUNK_BYTES = 4096
CHUNK_BAND = Band(None, 0.15, 0.80)
BAD_CHUNK_SHARE = 0.25
LEVEL = 3
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, bad_chunks long, chunks long, kept boolean"
)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside any ``width``-word window that stands at two or more places."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    window = ids[:n]
    for k in range(1, width):
        # the dense rank of the window so far keeps the product within 64 bits
        window = np.unique(window, return_inverse=True)[1] * len(seen) + ids[k : k + n]
    _, place, count = np.unique(window, return_inverse=True, return_counts=True)
    twice = count[place] > 1
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k : k + n] |= twice
    return int(covered.sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def compression(data: bytes, chunk_bytes: int = CHUNK_BYTES) -> tuple[float | None, int, int]:
    """Ratio of the whole text (None if empty), chunks outside their band, chunks."""
    if not data:
        return None, 0, 0
    zstd = zstandard.ZstdCompressor(level=LEVEL)
    whole = len(zstd.compress(data)) / len(data)
    starts = [*range(0, len(data) - chunk_bytes + 1, chunk_bytes)]
    if starts and len(data) % chunk_bytes:
        starts.append(len(data) - chunk_bytes)
    ratios = [len(zstd.compress(data[s : s + chunk_bytes])) / chunk_bytes for s in starts]
    bad = sum(not CHUNK_BAND.least <= r <= CHUNK_BAND.most for r in ratios)
    return whole, bad, len(ratios)


def in_band(n_bytes: int, ratio: float | None, bad_chunks: int, chunks: int) -> bool:
    if ratio is None:
        return False
    band = next(b for b in BANDS if b.below is None or n_bytes < b.below)
    return band.least <= ratio <= band.most and bad_chunks <= BAD_CHUNK_SHARE * chunks


def judge_text(text: str | None) -> tuple:
    """The columns of SCHEMA for one text."""
    data = (text or "").encode()
    words = data.split()
    n, repeat = len(words), repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeat > REPEAT_PERCENT * n
    chars = len(text or "") - sum((text or "").count(c) for c in SPACES)
    symbols = sum(data.count(c.encode()) for c in SYMBOLS)
    ratio, bad, chunks = compression(data)
    kept = not failed and in_band(len(data), ratio, bad, chunks)
    return n, chars, symbols, duplicate_lines(data), repeat, failed, ratio, bad, chunks, kept


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the columns of SCHEMA, a row for each input row.

    A null text counts as empty: no words, ratio null, not kept. Repeated rows are judged
    alike, null ids stay null, other columns are not read. No shuffle; a task holds one
    batch of texts.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(docs[id_col], docs[text_col])
    return map_rows(chosen, lambda i, t: (i, *judge_text(t)), f"doc_id {kind}, {SCHEMA}")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is kept, all columns as they are."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [judge_text(t)[-1] for t in batch.column(at).to_pylist()]
            yield batch.rename_columns(names).filter(pa.array(kept, pa.bool_()))

    names = docs.columns
    numbered = docs.toDF(*[f"c{k}" for k in range(len(names))])
    return numbered.mapInArrow(run, docs.schema)
