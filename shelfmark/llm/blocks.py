"""Arrays of whole numbers as compressed bytes, for rows that carry many of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def _compressed(raw: np.ndarray) -> bytes:
    return pa.Codec("zstd", 1).compress(raw.tobytes(), asbytes=True)


def packed(values: np.ndarray) -> bytes:
    """Numbers from 0 to 255 as a byte each, others byte plane by byte plane, and a bit for each that tells which it is."""
    small = (values >= 0) & (values < 256)
    rest = values[~small].astype("<i8")
    planes = np.ascontiguousarray(rest.view(np.uint8).reshape(-1, 8).T)
    parts = [_compressed(x) if len(x) else b"" for x in (np.packbits(small), values[small].astype(np.uint8), planes.ravel())]
    return np.array([len(values), len(rest), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def unpacked(raw: bytes) -> np.ndarray:
    n, n_rest, *sizes = np.frombuffer(raw[:40], np.int64).tolist()
    parts, at = [], 40
    for size, length in zip(sizes, (-(-n // 8), n - n_rest, 8 * n_rest), strict=True):
        parts.append(np.frombuffer(pa.Codec("zstd").decompress(raw[at : at + size], length, asbytes=True), np.uint8) if size else np.zeros(0, np.uint8))
        at += size
    small = np.unpackbits(parts[0])[:n].astype(bool)
    out = np.zeros(n, np.int64)
    out[small] = parts[1]
    out[~small] = np.ascontiguousarray(parts[2].reshape(8, n_rest).T).view("<i8")[:, 0]
    return out


def deltas(keys: np.ndarray) -> np.ndarray:
    """Differences of sorted numbers; their running sum gives them back."""
    return np.diff(keys, prepend=0)
