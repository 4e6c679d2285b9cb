"""Byte-level BPE by forced-boundary splitting, and back.

A merge joins two neighbouring pieces into a token, so two bytes that stand beside each other inside no token of the
vocabulary are never joined: between them a text may be cut, whatever the merges are. Where the vocabulary's own word
pattern would read such a cut differently (next to white space, quotes and contractions), none is made (``_safe_pairs``).
The fragments are encoded independently of each other, each distinct one once for many times that it stands somewhere, and
the ids are put in a row again. Both directions run on Arrow buffers, window by window, so that a very long text needs no
more memory than its own bytes and ids.

A null text counts as empty and has no ids; null and repeated ``doc_id`` are kept as they are, a row for each row. Ids
beyond the vocabulary decode to nothing, as in the library; bytes that are no UTF-8 become U+FFFD. Other columns are ignored
by ``encode_texts`` and kept by ``decode_ids``. An empty table gives an empty one.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from shelfmark.llm import tokens
from shelfmark.llm.common import read, texts, tidy

#: Bytes of text cut at once; ids decoded at once; bytes of fragments remembered.
WINDOW, AT_ONCE, REMEMBER = 1 << 21, 1 << 20, 1 << 24

_SPACES = [9, 10, 11, 12, 13, 32]
_QUOTE = 39
#: The contractions of the vocabulary's pattern that have two letters.
_LETTERS_IN_CONTRACTIONS = ((114, 101), (118, 101), (108, 108))


def byte_of_letter() -> dict[str, int]:
    """The bytes that a byte-level vocabulary's letters stand for: printable Latin-1 for itself, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _token_bytes(path: str) -> tuple[list[bytes], dict[str, int]]:
    """Each id's bytes, and the ids of special tokens. Raises ValueError for vocabularies of another kind."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    odd = any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or odd or spec.get("normalizer"):
        raise ValueError(f"{path} is no byte-level BPE vocabulary with the usual word pattern")
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", [])):
        raise ValueError(f"{path} has special tokens that take white space along")
    letters = byte_of_letter()
    out = [b""] * (1 + max([*model["vocab"].values(), *special.values()]))
    for token, i in model["vocab"].items():
        out[i] = b"".join(bytes([letters[c]]) if c in letters else c.encode() for c in token)
    for token, i in special.items():
        out[i] = token.encode()
    return out, special


def pairs_inside(vocabulary: list[bytes]) -> np.ndarray:
    """Which pairs of bytes stand beside each other inside some token: 256 x 256, first byte first."""
    seen = np.zeros((256, 256), bool)
    for token in vocabulary:
        for a, b in zip(token, token[1:]):  # noqa: B905
            seen[a, b] = True
    return seen


def _safe_pairs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs between which a text may be cut: after an ASCII character, and after a character of two bytes from C3 on.

    A cut lies before a character. It never follows white space (a run of it is read by looking at what comes after) or a
    quote (which may begin a contraction), it stands before a quote only after an ASCII letter or digit, and not inside a
    contraction. Whatever else stands on its two sides, the pattern would begin anew there, or cut one run of letters,
    digits or signs in two, whose parts are words again.
    """
    first, second = np.indices((256, 256))
    cut = ~inside & ((second < 128) | (second >= 192))
    for a, b in _LETTERS_IN_CONTRACTIONS:
        cut[a, b] = False
    alnum = (first >= 48) & (first <= 57) | (first >= 65) & (first <= 90) | (first >= 97) & (first <= 122)
    after_ascii = cut & (first > 32) & (first < 127) & (first != _QUOTE) & (alnum | (second != _QUOTE))
    after_two = cut & (first >= 128) & (first < 192) & (second != _QUOTE)
    return after_ascii, after_two


def _flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings in a row, and where each ends, without copying them."""
    values = values.cast(pa.large_binary())
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    raw = values.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and offsets[-1] else np.zeros(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``starts[i] ... starts[i] + sizes[i] - 1`` of all ``i`` in a row."""
    reached = np.cumsum(sizes)
    return np.repeat(starts - (reached - sizes), sizes) + np.arange(reached[-1] if len(reached) else 0)


class Codec:
    """Encodes and decodes with a byte-level vocabulary.

    ``special_text``: whether a special token's string in a text is that token, as the library takes it unless told
    otherwise, or ordinary text.
    """

    def __init__(self, path: str, special_text: bool = True, window: int = WINDOW):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.window = window
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = not special_text
        vocabulary, self.special = _token_bytes(path)
        self.after_ascii, self.after_two = _safe_pairs(pairs_inside(vocabulary))
        self.marks = [s.encode() for s in self.special] if special_text else []
        self.margin = max([4, *map(len, self.marks)])
        self.width = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))
        self.begin = np.cumsum(self.width) - self.width
        self.bytes = np.frombuffer(b"".join(vocabulary), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.at, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int64)
        self.held = self.weight = 0

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Where ``data`` (UTF-8) may be cut, as a mask: place p lies before byte p."""
        mask = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            a, b = data[:-1], data[1:]
            mask[1:-1] = self.after_ascii[a, b]
            mask[2:-1] |= self.after_two[a[1:], b[1:]] & (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
            if self.marks:
                raw = data.tobytes()
                for mark in self.marks:
                    found = raw.find(mark)
                    while found >= 0:
                        mask[found + 1 : found + len(mark)] = False
                        found = raw.find(mark, found + 1)
        return mask

    def _learn(self, new: list[bytes]) -> None:
        """Fragments that were not met before, each encoded by itself."""
        found = [x.ids for x in self.library.encode_batch_fast([f.decode() for f in new], add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        n, total = len(self.known), self.held + int(sizes.sum())
        while total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        while n + len(new) > len(self.at):
            self.at, self.size = np.append(self.at, np.zeros(len(self.at), np.int64)), np.append(self.size, np.zeros(len(self.size), np.int64))
        self.ids[self.held : total] = np.fromiter((i for x in found for i in x), np.uint32, total - self.held)
        self.at[n : n + len(new)], self.size[n : n + len(new)] = self.held + np.cumsum(sizes) - sizes, sizes
        self.known.update(zip(new, range(n, n + len(new)), strict=True))
        self.held, self.weight = total, self.weight + sum(map(len, new))

    def _fragments(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the fragments between ``edges`` in a row, and how many each has."""
        raw = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(np.ascontiguousarray(edges)), pa.py_buffer(data)])
        coded = raw.dictionary_encode()  # by their bytes
        distinct = coded.dictionary.to_pylist()
        if self.weight > REMEMBER:
            self._forget()
        new = [f for f in distinct if f not in self.known]
        if new:
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.size[number]
        return self.ids[_spread(self.at[number], sizes)], sizes

    def encode(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all strings (without nulls) in a row, and where each one's ids end."""
        data, ends = _flat(values)
        reached, out = np.zeros(len(ends), np.int64), []
        begin = done = low = total = 0  # where the open fragment begins; strings that are over; ids so far
        while low < len(data):
            high = min(len(data), low + self.window)
            # what stands over the window's edges is looked at too
            left, right = max(begin, low - self.margin), min(len(data), high + self.margin)
            mask = self.cuts(data[left:right])[low - left + 1 : high - left + 1]  # places low + 1 ... high
            stop = np.searchsorted(ends, high, "right")
            mask[ends[done:stop][ends[done:stop] > low] - low - 1] = True
            edges = np.append(begin, np.flatnonzero(mask) + low + 1)
            if len(edges) > 1:
                last = edges[-1]
                ids, sizes = self._fragments(data[begin:last], edges - begin)
                stop = np.searchsorted(ends, last, "right")
                reached[done:stop] = np.append(total, total + np.cumsum(sizes))[np.searchsorted(edges, ends[done:stop])]
                out.append(ids)
                begin, done, total = int(last), stop, total + len(ids)
            low = high
        reached[done:] = total  # empty strings at the end, or all
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), reached

    def decode(self, ids: np.ndarray, ends: np.ndarray, skip_special_tokens: bool = False) -> pa.Array:
        """The strings of sequences of ids in a row."""
        ids = ids.astype(np.int64)
        drop = (ids < 0) | (ids >= len(self.width))
        if skip_special_tokens:
            drop |= np.isin(ids, list(self.special.values()))
        if drop.any():
            ends = np.append(0, np.cumsum(~drop))[ends]
            ids = ids[~drop]
        parts = []
        for a in range(0, len(ids), AT_ONCE):
            some = ids[a : a + AT_ONCE]
            parts.append(self.bytes[_spread(self.begin[some], self.width[some])])
        data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        offsets = np.append(0, np.append(0, np.cumsum(self.width[ids]))[ends])
        out = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        try:
            return out.cast(pa.large_string())
        except pa.ArrowInvalid:  # no UTF-8
            return pa.array([x.decode("utf-8", "replace") for x in out.to_pylist()], pa.large_string())


def _encoded(path: str, special_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, special_text)
        for batch in batches:
            ids, ends = codec.encode(batch.column("text"))
            counts = pa.array(np.diff(ends, prepend=0))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, tokens.as_binary(ids, ends)], names=["doc_id", "n_tokens", "ids"])

    return run


def _decoded(path: str, ids_col: str, text_col: str, skip_special_tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            data, ends = _flat(batch.column(ids_col))
            found = codec.decode(np.frombuffer(data.tobytes(), "<u4"), ends // 4, skip_special_tokens).cast(pa.string())
            rest = [n for n in batch.schema.names if n != ids_col]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in rest], found], names=[*rest, text_col])

    return run


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = tokens.BYTE_BPE, special_text: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids``: each whole text's ids as little-endian unsigned 32-bit integers."""
    path = tokens.vocabulary(vocabulary)
    return texts(docs, id_col, text_col).mapInArrow(tidy(_encoded(path, special_text)), "doc_id long, n_tokens long, ids binary")


def decode_ids(encoded: DataFrame, ids_col: str = "ids", text_col: str = "text", vocabulary: str = tokens.BYTE_BPE, skip_special_tokens: bool = False) -> DataFrame:
    """The other columns, and the text of the ids (null: empty) in place of them."""
    path = tokens.vocabulary(vocabulary)
    rows = encoded.withColumn(ids_col, F.coalesce(ids_col, F.lit(b"")))
    schema = T.StructType([f for f in encoded.schema.fields if f.name != ids_col] + [T.StructField(text_col, T.StringType())])
    return rows.mapInArrow(tidy(_decoded(path, ids_col, text_col, skip_special_tokens)), schema)


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    encoded = encode_texts(read(spark, sf_dir, "documents"))
    decoded = decode_ids(encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids"), text_col="decoded")
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
