"""BPE encoding and decoding with content-defined chunks that documents share.

A rolling hash over the last ``WINDOW`` characters cuts each text into chunks. The cuts
follow from the text around them, so a passage that stands in many documents gives the
same chunks in all of them, and each chunk is encoded once. Documents with a smallest line
hash in common are dealt to the same task, so that copies and near copies meet there.

A cut may fall inside a word, where the two chunks' tokens differ from those of the whole
text. Each join is therefore encoded again: a window around it, which begins and ends at a
separator, and the window's two halves as they stand in their chunks. The halves must be
the end of the one chunk's tokens and the beginning of the other's, and the window must
agree with them at its outer ends; it then replaces them. Otherwise it grows. A document
with a join that never agrees is encoded as a whole.

All of this needs a tokenizer that splits its text at white space and drops it, which is read
from the file (``splits_at_space``). With any other, every text is encoded as a whole.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 16
MEAN_CHUNK = 1024
LEAST_CHUNK, MOST_CHUNK = 256, 8192
BLOCK = 1 << 20  # characters hashed at once
REPAIR = 32  # characters on each side of a join that are encoded again at first
SEPARATORS = " \n"  # the tokenizer splits here and drops them, whatever stands around
PIECE_CACHE, CHUNK_CACHE = 500_000, 8 << 20  # pieces; characters of chunks
LONG_PIECE = 64
OUT_ROWS = 256
MULTIPLIER = 0x9E3779B97F4A7C15


def cuts(text: str) -> list[int]:
    """Chunk ends: where the hash of the last WINDOW characters is zero in its low bits,
    at least LEAST_CHUNK and at most MOST_CHUNK after the cut before."""
    n, ends, last = len(text), [], 0
    if n <= LEAST_CHUNK:
        return [n]
    mask = np.uint64(MEAN_CHUNK - 1)
    for s in range(0, n - WINDOW + 1, BLOCK):
        part = text[s : s + BLOCK + WINDOW - 1]
        h = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        step = 1
        while step < WINDOW:
            h = h[:-step] * np.uint64(pow(MULTIPLIER, step, 1 << 64)) + h[step:]
            step *= 2
        h = (h ^ (h >> np.uint64(31))) * np.uint64(MULTIPLIER) >> np.uint64(40)
        for p in (np.flatnonzero(h & mask == 0) + s + WINDOW).tolist():
            while p - last > MOST_CHUNK:
                last += MOST_CHUNK
                ends.append(last)
            if p - last >= LEAST_CHUNK:
                ends.append(p)
                last = p
    while n - last > MOST_CHUNK:
        last += MOST_CHUNK
        ends.append(last)
    return [*ends, n] if last < n else ends


PROBES = [" ", "\n", "a b", "a\nb", "1 2", ". ,", "a  'b", "é 一\n\n1 ."]
DROP_SPACE = {"WhitespaceSplit", "Whitespace", "BertPreTokenizer"}
LOCAL = {"NFC", "NFD", "Lowercase", "Replace"}  # normalizers that join nothing across a space


LETTERS_SIGNS = re.compile(r"([A-Za-z]+)([!-&(-/:-@\[-`{-~]+)")  # no apostrophe
LETTERS, SIGNS, DIGITS = r"[\p{L}]+", r"[^\s\p{L}\p{N}]+", r"[\p{N}]"


def steps(part: dict | None, name: str) -> list[dict]:
    return [] if part is None else part[name] if part["type"] == "Sequence" else [part]


def cuts_signs(spec: dict) -> bool:
    """Whether the file's pattern matches runs of letters and runs of other signs apart, and
    nothing else but digits and what begins with an apostrophe."""
    first = (steps(spec.get("pre_tokenizer"), "pretokenizers") or [{"type": None}])[0]
    pattern = first["pattern"].get("Regex", "") if first["type"] == "Split" else ""
    kinds = {k for k in pattern.split("|") if not k.startswith("'")}
    added = "".join(t["content"] for t in spec.get("added_tokens") or ())
    return {LETTERS, SIGNS} <= kinds <= {LETTERS, SIGNS, DIGITS} and added.isascii()


def splits_at_space(spec: dict) -> bool:
    """Whether the tokenizer of this file encodes what stands between white space apart.

    Its first pre-tokenizer must drop white space: one that does so by its kind, or a split
    that keeps only the matches of a pattern, none of which has white space in it. Added
    tokens must not reach over white space either.
    """

    first = (steps(spec.get("pre_tokenizer"), "pretokenizers") or [{"type": None}])[0]
    drops = first["type"] in DROP_SPACE
    if first["type"] == "Split" and first["invert"] and first["behavior"] == "Removed":
        pattern = first["pattern"].get("Regex")
        drops = pattern is not None and not any(
            any(map(str.isspace, m[0])) or not m[0]
            for text in PROBES for m in regex.finditer(pattern, text)
        )
    whole = all(
        not (t["lstrip"] or t["rstrip"] or any(map(str.isspace, t["content"])))
        for t in spec.get("added_tokens") or ()
    )
    normal = steps(spec.get("normalizer"), "normalizers")
    local = all(
        n["type"] in LOCAL and (n["type"] != "Replace" or n["pattern"].get("Regex") == r"\s+" and n["content"] == " ")
        for n in normal
    )
    return drops and whole and local


class Encoder:
    """Token ids as little-endian unsigned 32-bit integers, from bounded caches."""

    def __init__(self, tokenizer_json: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(tokenizer_json)
        self.by_pieces = splits_at_space(spec)
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        # without a decoder the library puts spaces between the tokens
        self.tokens = tokens if self.tokenizer.decoder is None else None
        self.cuts_signs = self.by_pieces and cuts_signs(spec)
        lowers = any(n["type"] == "Lowercase" for n in steps(spec.get("normalizer"), "normalizers"))
        self.lowers = lowers and not any(t["content"].isalpha() for t in spec.get("added_tokens") or ())
        self.pieces: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.older_chunks: dict[str, bytes] = {}
        self.chunk_chars = 0
        self.reused = self.repaired = 0

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in found]

    def _each(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each piece. One of plain letters and signs behind them is put together
        from its two parts, if the tokenizer cuts there, and letters are lower-cased first,
        if it does so, as both make more pieces alike."""
        parts = {}
        for p in pieces:
            cut = LETTERS_SIGNS.fullmatch(p) if self.cuts_signs else None
            plain = cut.groups() if cut else (p,)
            lowers = self.lowers and p.isascii()
            parts[p] = tuple(x.lower() if lowers and x.isalpha() else x for x in plain)
        known, older = self.pieces, self.older
        met = {x for xs in parts.values() for x in xs if x not in known}
        ids = {x: older[x] for x in met if x in older}
        new = [x for x in met if x not in ids]
        ids.update(zip(new, self._plain(new)) if new else ())
        for x, i in ids.items():
            if len(x) <= LONG_PIECE:
                known[x] = i
        return {p: b"".join([ids[x] if x in ids else known[x] for x in xs]) for p, xs in parts.items()}

    def direct(self, text: str) -> bytes:
        """Ids of a text by its pieces between separators, each encoded once.

        Pieces are kept in two halves. When the newer one is full it takes the place of the
        older, and what is met there again moves back: only pieces out of use are lost.
        """
        for c in SEPARATORS[1:]:
            text = text.replace(c, SEPARATORS[0])
        parts = text.split(SEPARATORS[0])
        known = self.pieces
        found = list(map(known.get, parts))
        if None in found:
            older = self.older
            missing = {p for p, ids in zip(parts, found) if ids is None}
            got = {p: older[p] for p in missing if p in older}
            got |= self._each([p for p in missing if p not in got])
            out = b"".join([got[p] if p in got else known[p] for p in parts])
            known.update((p, i) for p, i in got.items() if len(p) <= LONG_PIECE)
            if len(known) > PIECE_CACHE // 2:
                self.older, self.pieces = known, {"": b""}
            return out
        return b"".join(found)

    def chunk(self, text: str) -> bytes:
        """Ids of a chunk as it stands by itself."""
        ids = self.chunks.get(text)
        if ids is not None:
            self.reused += 1
            return ids
        ids = self.older_chunks.get(text)
        if ids is None:
            ids = self.direct(text)
        else:
            self.reused += 1
        if self.chunk_chars + len(text) > CHUNK_CACHE // 2:
            self.older_chunks, self.chunks = self.chunks, {}
            self.chunk_chars = 0
        self.chunks[text] = ids
        self.chunk_chars += len(text)
        return ids

    def join(self, left: str, left_ids: bytes, right: str, right_ids: bytes):
        """Bytes to drop from the end of the left ids, the ids that replace them and what
        to drop from the right ids; None if no window agrees."""
        reach = REPAIR
        while True:
            a, b = left[-reach:], right[:reach]
            at = min((k for k in map(a.find, SEPARATORS) if k >= 0), default=-1)
            to = max(map(b.rfind, SEPARATORS))
            if at >= 0 and to >= 0:
                a, b = a[at:], b[: to + 1]
                a_ids, b_ids, both = self.direct(a), self.direct(b), self.direct(a + b)
                inside = left_ids.endswith(a_ids) and right_ids.startswith(b_ids)
                ends = both[:4] == a_ids[:4] and both[-4:] == b_ids[-4:]
                if inside and ends and a_ids and b_ids:
                    self.repaired += both != a_ids + b_ids
                    return len(a_ids), both, len(b_ids)
            if reach >= max(len(left), len(right)):
                return None
            reach *= 2

    def encode(self, text: str) -> tuple[bytes, int]:
        """Ids of a whole text, and its chunks."""
        if not self.by_pieces:
            return self._plain([text])[0], 1
        ends = cuts(text)
        chunks = [text[s:e] for s, e in zip([0, *ends], ends)]
        ids = [self.chunk(c) for c in chunks]
        out, drop = [], 0
        for k in range(1, len(chunks)):
            found = self.join(chunks[k - 1], ids[k - 1], chunks[k], ids[k])
            if found is None or drop + found[0] > len(ids[k - 1]):
                return self._plain([text])[0], len(chunks)
            out += [ids[k - 1][drop : len(ids[k - 1]) - found[0]], found[1]]
            drop = found[2]
        return b"".join([*out, ids[-1][drop:]]), len(chunks)

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        if self.tokens is not None:
            return " ".join(map(self.tokens.__getitem__, numbers))
        return self.tokenizer.decode(numbers, skip_special_tokens=False)


SCHEMA = pa.schema(
    [("ids", pa.binary()), ("decoded", pa.string()), ("chunks", pa.int64()),
     ("reused", pa.int64()), ("repaired", pa.int64())]
)


def encode_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids, decoded, chunks, reused, repaired``, a row for each input row.

    ``ids`` are the token ids of the whole text as little-endian unsigned 32-bit integers,
    without added special tokens, truncation or padding; ``decoded`` is what the tokenizer
    makes of them. Null and empty texts have no ids. Repeated rows are encoded alike;
    other columns are not read. The tokenizer file is read on the driver and sent along
    (a vocabulary, some MB). Caches are bounded; what they lose is encoded again.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text("utf-8"))
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a worker process keeps its copy of a broadcast, and with it the loaded tokenizer
        if not hasattr(sent, "encoder"):
            sent.encoder = Encoder(sent.value)
        encoder = sent.encoder
        for batch in batches:
            for s in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(s, OUT_ROWS)
                rows = []
                for text in part.column(1).to_pylist():
                    before = encoder.reused, encoder.repaired
                    ids, chunks = encoder.encode(text or "")
                    done = encoder.reused - before[0], encoder.repaired - before[1]
                    rows.append((ids, encoder.decode(ids), chunks, *done))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)]
                names = ["doc_id", *SCHEMA.names]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    text = docs[text_col]
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    near = F.array_min(F.transform(lines, lambda x: F.xxhash64(x)))
    chosen = docs.select(docs[id_col].alias("doc_id"), text.alias("text"), near.alias("near"))
    met = chosen.hint("rebalance", "near").select("doc_id", "text")
    schema = f"doc_id {kind.simpleString()}, ids binary, decoded string, "
    return met.mapInArrow(run, schema + "chunks long, reused long, repaired long")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, the chunk counts, and ``more``."""
    return encoded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
        "chunks", "reused", "repaired", *more,
    )
