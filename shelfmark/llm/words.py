"""Words of many UTF-8 texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text handled at once (a longer text is handled alone).
TOGETHER = 1 << 20

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Bytes that belong to words: ASCII letters and digits and whatever is not ASCII; or all but the six ASCII spaces.
ALNUM = (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57)) | ((_LOWER >= 97) & (_LOWER <= 122))
BLACK = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))


class ByteHash:
    """A polynomial hash of byte strings modulo 2**64, by prefix sums."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, np.uint64)
        self.base = int(rng.integers(1 << 20, 1 << 61)) * 8 + 5
        self.power = self.back = np.ones(1, np.uint64)

    def reserve(self, n: int) -> None:
        if len(self.power) <= n:
            n = max(n, TOGETHER + (TOGETHER >> 3))
            power, back = np.full(n + 1, self.base % (1 << 64), np.uint64), np.full(n + 1, pow(self.base, -1, 1 << 64), np.uint64)
            power[0] = back[0] = 1
            self.power, self.back = np.multiply.accumulate(power), np.multiply.accumulate(back)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(data)
        self.reserve(n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values[data] * self.power[:n])])
        return mixed((sums[ends] - sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


_HASHES: dict[int, ByteHash] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def hashed(texts: list[bytes], kind: np.ndarray = ALNUM, seed: int = 3, count: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """``(text, hash)`` of every word of the texts in order, after lower-casing A-Z.

    With ``count`` (a choice of bytes) also the number of such bytes in each word, and the word's length.
    """
    data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    inside = np.concatenate([[False], kind[data]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    text = np.searchsorted(np.cumsum(sizes), starts, side="right")
    if seed not in _HASHES:
        _HASHES[seed] = ByteHash(seed)
    word = _HASHES[seed](data, starts, ends)
    if count is None:
        return text, word
    sums = np.concatenate([[0], np.cumsum(count[data])])
    return text, word, sums[ends] - sums[starts], ends - starts


def rolling(text: np.ndarray, word: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the ``k``-grams that lie within one text, and the hashes of these."""
    n = max(0, len(word) - k + 1)
    gram = np.zeros(n, np.uint64)
    for j in range(k):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + word[j : n + j]
    at = np.flatnonzero(text[:n] == text[k - 1 : n + k - 1])
    return at, mixed(gram[at])


def groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Slices of a list of texts of about ``TOGETHER`` bytes: the first's index, and the texts."""
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= TOGETHER:
            yield first, texts[first : i + 1]
            first, held = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def places(text: np.ndarray) -> np.ndarray:
    """Each word's place in its text, from 0."""
    first = np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(len(text)), 0)) if len(text) else np.zeros(0, np.int64)
    return np.arange(len(text)) - begin
