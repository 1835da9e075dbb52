"""Integer arrays as compact binary values."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray) -> bytes:
    """Integers compressed by byte planes, as their high bytes are alike."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()
