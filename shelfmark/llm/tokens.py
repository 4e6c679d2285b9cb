"""Token ids of many texts at once by the ``tokenizers`` library, each distinct word of a task encoded once.

Both vocabularies split a text into words before merging, so the ids of a text are the ids of its words in a row. Words are
cut as the vocabularies' patterns cut them, on bytes and with numpy, and known by a 64-bit hash; a word that was met before
is a look-up in a table of hashes, and new words are encoded by the library, many at once. Texts with characters whose kind
(letter, digit, space, other) cannot be told from a byte or two are encoded by the library as they are.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from shelfmark.llm import words

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
#: Words remembered (24 bytes each, and their ids); encoded by the library at once; bytes of text handled together.
_REMEMBER, _AT_ONCE, _TOGETHER = 3 << 17, 20_000, 1 << 20

_SPACE, _LETTER, _DIGIT, _OTHER, _END = range(5)
_B = np.arange(256)
#: The kind of each byte of a plain text: bytes of 128 and more are letters (dashes and quotes are told apart below).
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[(_B >= 9) & (_B <= 13) | (_B == 32)] = _SPACE
_KIND[(_B >= 65) & (_B <= 90) | (_B >= 97) & (_B <= 122) | (_B >= 128)] = _LETTER
_KIND[(_B >= 48) & (_B <= 57)] = _DIGIT
_KIND[0] = _END
#: Bytes that no plain text has: controls, and all beyond U+02AF and U+0080 to U+00BF, but for E2 (dashes, quotes).
_STRANGE = (_B > 0) & (_B < 9) | (_B >= 14) & (_B < 32) | (_B == 127) | (_B == 0xC2) | (_B > 0xCA) & (_B != 0xE2)


def vocabulary(name: str) -> str:
    """The path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _strange(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Places of characters that make a text odd; the bytes of dashes and quotes (U+2010 to U+2027) become ``_OTHER``."""
    found = [np.flatnonzero(_STRANGE[data])]
    # the multiplication and division signs, the dotted capital I, modifiers from U+02B0 on
    for lead, low, high in ((0xC3, 0x97, 0x97), (0xC3, 0xB7, 0xB7), (0xC4, 0xB0, 0xB0), (0xCA, 0xB0, 0xBF)):
        at = np.flatnonzero(data[:-1] == lead)
        found.append(at[(data[at + 1] >= low) & (data[at + 1] <= high)])
    at = np.flatnonzero(data[:-2] == 0xE2)
    if len(at):
        dash = (data[at + 1] == 0x80) & (data[at + 2] >= 0x90) & (data[at + 2] <= 0xA7)
        found.append(at[~dash])
        for j in range(3):
            kind[at[dash] + j] = _OTHER
        # their last bytes are no strange ones
    return np.concatenate(found)


def _contractions(data: np.ndarray, kind: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where ``'s 't 're 've 'm 'll 'd`` stand as words, and their lengths."""
    at = np.flatnonzero(data == 39)
    at = at[(at > 0) & (at < len(data) - 3)]
    at = at[kind[at - 1] != _OTHER]
    if spaced:  # a space before it goes with the quote
        at = at[data[at - 1] != 32]
    one, two = data[at + 1], data[at + 2]
    short = np.isin(one, list(b"stmd"))
    long = (one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    size = np.where(short, 2, np.where(long, 3, 0))
    return at[size > 0], size[size > 0]


def _cut_words(data: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words: letters, single digits, other symbols, contractions; each text's end is a word."""
    before = np.concatenate([[_END], kind[:-1]])
    start = ((kind != before) | (kind == _DIGIT) | (kind == _END)) & (kind != _SPACE)
    at, size = _contractions(data, kind, False)
    start[at + 1] = False
    after = at + size
    start[after] |= kind[after] == _LETTER
    edge = np.flatnonzero(start | (kind == _SPACE) & (before != _SPACE))
    ends = np.append(edge[1:], len(data))
    word = kind[edge] != _SPACE
    return edge[word], ends[word]


def _cut_bytes(data: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words that take one blank before them along; other spaces are words of their own."""
    before, after = np.concatenate([[_END], kind[:-1]]), np.append(kind[1:], _END)
    blank = np.concatenate([[False], data[:-1] == 32])
    black = kind != _SPACE
    start = black & ((kind != before) & ~blank | (kind == _END))
    start |= ~black & ((before != _SPACE) | ((after != _SPACE) & (after != _END)))
    at, size = _contractions(data, kind, True)
    stop = at + size
    start[stop] |= kind[stop] == _LETTER
    # a letter after a quote starts a word unless they are a contraction
    start[at + 1] = False
    edge = np.flatnonzero(start)
    return edge, np.append(edge[1:], len(data))


class _Table:
    """Numbers of 64-bit hashes, by open addressing."""

    def __init__(self, bits: int):
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.numbers = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers, -1 where unknown."""
        slot = (keys >> self.shift).astype(np.int64)
        held = self.keys[slot]
        out = np.where(held == keys, self.numbers[slot], -1)
        open_ = np.flatnonzero((held != keys) & (held != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            held = self.keys[slot[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.numbers[slot[open_[hit]]]
            open_ = open_[~hit & (held != 0)]
        return out

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """New, distinct keys."""
        slot = (keys >> self.shift).astype(np.int64)
        while len(keys):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.numbers[slot[placed]] = numbers[placed]
            keys, numbers, slot = keys[~placed], numbers[~placed], (slot[~placed] + 1) & self.mask


def width_of(size: int) -> str:
    """The type of ids below ``size``."""
    return "<u2" if size <= 1 << 16 else "<u4"


class Encoder:
    """``encode(texts)`` gives the ids of all texts in a row, and where each text's ids end; ``end`` follows each text."""

    def __init__(self, path: str, end: int, remember: int = _REMEMBER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        self.end, self.size = end, max(self.whole.get_vocab_size(), end + 1)
        self.dtype = np.dtype(width_of(self.size))
        self.lower = self.whole.normalizer is not None
        self.cut = _cut_words if self.lower else _cut_bytes
        #: For words that are cut and lower-cased already.
        self.parts = Tokenizer(self.whole.model)
        self.parts.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.CharDelimiterSplit("\0"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.width = np.zeros(self.size, np.int64)  # bytes of text that each id stands for
        for s, i in self.whole.get_vocab().items():
            self.width[i] = len(s.removesuffix("</w>"))
        self.remember = remember
        self.hash = words.ByteHash(13)
        self._forget(remember)

    def _forget(self, room: int) -> None:
        self.table = _Table((2 * room).bit_length())
        self.begin, self.length = np.zeros(room, np.int64), np.zeros(room, np.int32)
        self.ids, self.held, self.known = np.zeros(4 * room, self.dtype), 0, 0
        self._learn(self.hash(np.zeros(1, np.uint8), np.zeros(1, np.int64), np.ones(1, np.int64)), np.array([self.end], self.dtype), np.ones(1, np.int64))

    def _learn(self, hashes: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        while self.held + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), self.dtype)])
        self.ids[self.held : self.held + len(flat)] = flat
        new = slice(self.known, self.known + len(sizes))
        self.begin[new], self.length[new] = self.held + np.cumsum(sizes) - sizes, sizes
        self.table.add(hashes, np.arange(new.start, new.stop, dtype=np.int32))
        self.held, self.known = self.held + len(flat), new.stop

    def _encode_words(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids in a row, and each one's number; where words end shows in the bytes that the ids stand for."""
        ids, sizes = [], []
        for a in range(0, len(new), _AT_ONCE):
            some = new[a : a + _AT_ONCE]
            flat = np.array(self.parts.encode_batch_fast([b"\0".join(some).decode()], add_special_tokens=False)[0].ids, self.dtype)
            reached, wanted = np.cumsum(self.width[flat]), np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
            cut = np.searchsorted(reached, wanted)
            if reached[-1] == wanted[-1] and (reached[cut] == wanted).all():
                ids.append(flat)
                sizes.append(np.diff(cut, prepend=-1))
            else:
                own = [np.array(x.ids, self.dtype) for x in self.parts.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)]
                ids += own
                sizes.append(np.fromiter(map(len, own), np.int64, len(own)))
        return np.concatenate(ids), np.concatenate(sizes)

    def _encode_plain(self, data: np.ndarray, kind: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = self.cut(data, kind)
        hashes = self.hash(data, starts, ends)
        number = self.table.find(hashes)
        unknown = np.flatnonzero(number < 0)
        if len(unknown):
            new, first = np.unique(hashes[unknown], return_index=True)
            if self.known + len(new) > len(self.begin):
                # what this group needs is learnt again
                self._forget(max(self.remember, len(number) + 1))
                number = self.table.find(hashes)
                unknown = np.flatnonzero(number < 0)
                new, first = np.unique(hashes[unknown], return_index=True)
            raw, at = data.tobytes(), unknown[first]
            self._learn(new, *self._encode_words([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]))
            number[unknown] = self.table.find(hashes[unknown])
        sizes = self.length[number].astype(np.int64)
        reached = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.begin[number] - (reached - sizes), sizes) + np.arange(reached[-1])]
        return ids, reached[np.searchsorted(starts, text_ends, side="right") - 1]

    def _encode_group(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A group of texts, each shown with a zero byte at its end."""
        raw = texts.cast(pa.binary()).to_pylist()
        data = np.frombuffer(b"\0".join([*raw, b""]), np.uint8)
        text_ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1) - 1
        kind = _KIND[data]
        marks = np.concatenate([_strange(data, kind), np.setdiff1d(np.flatnonzero(data == 0), text_ends)])
        if self.lower and len(raw):
            small = pc.utf8_lower(texts).cast(pa.binary())
            lowered = np.frombuffer(b"\0".join([*small.to_pylist(), b""]), np.uint8)
            if len(lowered) == len(data):
                data = lowered
            else:  # a letter whose small form has another length
                marks = np.arange(len(data))
        odd = np.unique(np.searchsorted(text_ends, marks))
        if not len(odd):
            return self._encode_plain(data, kind, text_ends)
        text_starts = np.append(0, text_ends[:-1] + 1)
        plain = np.setdiff1d(np.arange(len(raw)), odd)
        parts: list[np.ndarray] = [np.zeros(0, self.dtype)] * len(raw)
        if len(plain):
            keep = np.zeros(len(data) + 1, np.int8)
            keep[text_starts[plain]] += 1
            keep[text_ends[plain] + 1] -= 1
            keep = np.cumsum(keep)[:-1].astype(bool)
            ids, reached = self._encode_plain(data[keep], kind[keep], np.cumsum((text_ends - text_starts + 1)[plain]) - 1)
            for i, own in zip(plain.tolist(), np.split(ids, reached[:-1]), strict=True):
                parts[i] = own
        for i, x in zip(odd.tolist(), self.whole.encode_batch_fast([raw[i].decode() for i in odd], add_special_tokens=False), strict=True):
            parts[i] = np.array([*x.ids, self.end], self.dtype)
        return np.concatenate(parts), np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(first text, texts, ids, ends)`` of slices of ``texts`` (strings without nulls) of about a megabyte."""
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        reached, first = np.cumsum(sizes), 0
        while first < len(texts):
            held = reached[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(reached, held + _TOGETHER, side="right")))
            yield first, stop - first, *self._encode_group(texts.slice(first, stop - first))
            first = stop


def as_binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """An array of binary values, the bytes of each text's ids, without copying."""
    offsets = (np.append(0, ends) * ids.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))])


def crc32_of_ids(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    import zlib

    return zlib.crc32(ids.astype("<u4").tobytes())
