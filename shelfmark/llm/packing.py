"""Lexical retrieval packing: token sequences filled with documents that BM25 finds alike.

Documents are encoded once and written; their lengths and document frequencies are counted over all of them on the way.
They are dealt into shards by a weighted min-hash of their ids, in which rare ids weigh more (weights come from the
frequencies over all documents), so that texts with much
in common come together; each shard keeps a BM25 inverted index of its documents, ``block`` ids at a time. A seed
document starts a window; the unused neighbours that the index returns for it, best first, fill the window; the one that
is cut at its end seeds the next window. When no neighbour is left, the first unused document follows.

Documents are cut freely at the ends of windows, so windows are full. Documents beyond a block's last full window go on
into the next block; what a shard leaves over is cut into sequences whose sizes are powers of two, which need no padding.

A null text counts as empty: its end id alone. Rows that share a ``doc_id`` are packed as documents of their own; a null
``doc_id`` is carried along. An empty table gives an empty result. A text longer than a block fills windows of its own.
Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import tokens
from shelfmark.llm.common import discard, partitions, read, texts, tidy, written

END, WINDOW, BLOCK = 2, 4096, 1 << 19
K1, B = 1.2, 0.75


def _distinct(ids: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, id, times)`` of the distinct ids of each document, in order; ``ends`` are the documents' ends."""
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    key, times = np.unique(doc * size + ids, return_counts=True)
    return key // size, key % size, times


def _encoded(path: str, end: int):
    """``doc_id, ids, n``; a task's last row has how many of its documents have each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.Encoder(path, end)
        counts = np.zeros(encoder.size, np.int64)
        for batch in batches:
            for first, n, ids, ends in encoder.encode(batch.column("text")):
                counts += np.bincount(_distinct(ids, ends, encoder.size)[1], minlength=encoder.size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), tokens.as_binary(ids, ends), pa.array(np.diff(ends, prepend=0)), pa.nulls(n, pa.binary())], names=_ENCODED_NAMES
                )
        one = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays([one, pa.nulls(1, pa.binary()), one, pa.array([counts.tobytes()])], names=_ENCODED_NAMES)

    return run


_ENCODED = "doc_id long, ids binary, n long, counts binary"
_ENCODED_NAMES = [x.split()[0] for x in _ENCODED.split(", ")]


def _least_ranks(width: str, ranks: np.ndarray):
    """``doc_id, ids, near, next``: the two least ranks of a document's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, following = [], []
            for x in batch.column("ids"):
                two = np.partition(np.append(np.unique(ranks[np.frombuffer(x.as_buffer(), width)]), len(ranks)), 1)
                near.append(two[0])
                following.append(two[1])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(near, pa.int64()), pa.array(following, pa.int64())], names=["doc_id", "ids", "near", "next"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, df``: the sum of the tasks' counts that this task reads."""
    total = None
    for batch in batches:
        for x in batch.column("counts"):
            own = np.frombuffer(x.as_buffer(), np.int64)
            total = own.copy() if total is None else total + own
    if total is not None:
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "df"])


def _frequencies(encoded: DataFrame, size: int) -> np.ndarray:
    """Documents that have each id; no more rows than the vocabulary has ids reach the driver."""
    df = np.zeros(size, np.int64)
    counted = encoded.where("counts IS NOT NULL").select("counts").mapInArrow(tidy(_summed), "id long, df long")
    found = counted.groupBy("id").agg(F.sum("df").alias("df")).toArrow()
    df[found["id"].to_numpy()] = found["df"].to_numpy()
    return df


def _idf(df: np.ndarray, count: int) -> np.ndarray:
    return np.log((count - df + 0.5) / (df + 0.5)).clip(0) if count else df * 1.0


def id_ranks(idf: np.ndarray) -> np.ndarray:
    """Each id's place in one random order in which an id is the earlier the rarer it is; common ids come last."""
    chance = np.random.default_rng(5).exponential(size=len(idf))
    return np.argsort(np.argsort(np.divide(chance, idf**2, out=np.full(len(idf), np.inf), where=idf > 0), kind="stable"))


class Index:
    """A BM25 inverted index of one block of documents."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean: float):
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        doc, term, tf = _distinct(np.concatenate(ids).astype(np.int64), np.cumsum(sizes), len(idf))
        telling = idf[term] > 0
        doc, term, tf = doc[telling], term[telling], tf[telling]
        self.terms = np.split(term, np.searchsorted(doc, np.arange(1, len(ids))))
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[doc] / mean))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.begin = np.searchsorted(term[order], np.arange(len(idf) + 1))
        self.size = len(ids)

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Unused documents with a positive score for the seed's terms, best first; ties by place."""
        begin = self.begin[self.terms[seed]]
        n = self.begin[self.terms[seed] + 1] - begin
        at = np.arange(int(n.sum())) + np.repeat(begin - (np.cumsum(n) - n), n)
        score = np.bincount(self.doc[at], self.weight[at], self.size)
        score[used] = 0
        some = np.flatnonzero(score > 0)
        return some[np.argsort(-score[some], kind="stable")]


def packed_order(ids: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> list[int]:
    """The order in which documents fill windows."""
    index = Index(ids, idf, mean)
    sizes = [len(x) for x in ids]
    used = np.zeros(len(ids), bool)
    order: list[int] = []
    next_free, filled = 0, 0

    def put(doc: int) -> None:
        nonlocal filled
        used[doc] = True
        order.append(doc)
        filled += sizes[doc]

    while len(order) < len(ids):
        if order and filled % window:
            seed = order[-1]  # the document that reaches into this window
        else:
            while used[next_free]:
                next_free += 1
            seed = next_free
            put(seed)
        here = filled // window
        if filled % window:
            for doc in index.neighbours(seed, used):
                put(int(doc))
                if filled // window != here:
                    break
            else:
                while next_free < len(ids) and used[next_free]:
                    next_free += 1
                if next_free < len(ids):
                    put(next_free)
    return order


def sequence_sizes(total: int, window: int = WINDOW) -> list[int]:
    """Full windows, then powers of two."""
    rest = total % window
    return [window] * (total // window) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(sizes: list[int], window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` when documents of these sizes follow each other."""
    sequences = sequence_sizes(sum(sizes), window)
    k = offset = 0
    for doc, size in enumerate(sizes):
        start = 0
        while start < size:
            n = min(size - start, sequences[k] - offset)
            yield doc, start, n, k, offset
            start, offset = start + n, offset + n
            if offset == sequences[k]:
                k, offset = k + 1, 0


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def _packed(idf: np.ndarray, mean: float, width: str, window: int, block: int, keep_ids: bool):
    # parts of documents: (doc_id, ids of the document before it, ids of the document, its ids)
    def laid(parts: list[tuple], first: int) -> pa.RecordBatch:
        out = []
        for i, start, n, k, offset in pieces([len(p[3]) for p in parts], window):
            doc_id, before, total, ids = parts[i]
            own = ids[start : start + n]
            out.append((doc_id, before + start, n, zlib.crc32(own.astype("<u4").tobytes()), total, first + k, offset, own.tobytes() if keep_ids else None))
        types = [pa.int64()] * 7 + [pa.binary()]
        names = [x.split()[0] for x in _PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=names)

    def divided(parts: list[tuple]) -> tuple[list[tuple], list[tuple]]:
        """The parts that fill whole windows, and what is left; a part is cut where the last window ends."""
        total = sum(len(p[3]) for p in parts) // window * window
        now: list[tuple] = []
        for i, (doc_id, before, n, ids) in enumerate(parts):
            if len(ids) > total:
                now += [(doc_id, before, n, ids[:total])] * (total > 0)
                # a copy, so that this block's batches can go
                return now, [(doc_id, before + total, n, ids[total:].copy()), *((*p[:3], p[3].copy()) for p in parts[i + 1 :])]
            now.append(parts[i])
            total -= len(ids)
        return now, []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 36
        parts, held = [], 0
        for batch in batches:
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                ids = np.frombuffer(x.as_buffer(), width)
                parts.append((doc_id, 0, len(ids), ids))
                held += len(ids)
                if held < block:
                    continue
                now, parts = divided([parts[i] for i in packed_order([p[3] for p in parts], idf, mean, window)])
                held = sum(len(p[3]) for p in parts)
                if now:
                    done = laid(now, sequence)
                    sequence = done.column("sequence_id")[-1].as_py() + 1
                    yield done
        if parts:
            yield laid([parts[i] for i in packed_order([p[3] for p in parts], idf, mean, window)], sequence)

    return run


def pack(
    docs: DataFrame, vocabulary: str | None = None, end: int = END, window: int = WINDOW, block: int = BLOCK,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and its ``ids`` (bytes; null
    without ``keep_ids``)."""
    spark = docs.sparkSession
    vocabulary = vocabulary or tokens.vocabulary(tokens.WORD_BPE)
    rows = texts(docs, id_col, text_col)
    encoded = written(rows.mapInArrow(tidy(_encoded(vocabulary, end)), _ENCODED), "encoded")
    # the tasks' counts tell the vocabulary's size, so that the driver need not load it
    count, total, size = encoded.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max(F.length("counts")), F.lit(0)) / 8).first()
    size = int(size)
    width = tokens.width_of(size)
    idf, mean = _idf(_frequencies(encoded, size), count), total / count if count else 1.0
    # written, since dealing into ranges reads it twice
    keyed = encoded.where("ids IS NOT NULL").select("doc_id", "ids").mapInArrow(tidy(_least_ranks(width, id_ranks(idf))), "doc_id long, ids binary, near long, next long")
    keyed = written(keyed, "ids")
    discard(encoded)
    order = ["near", "next", F.xxhash64("doc_id")]
    return (
        keyed.repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "ids")
        .mapInArrow(tidy(_packed(idf, mean, width, window, block, keep_ids)), _PIECES)
    )


def op3_packing(spark, sf_dir):
    return pack(read(spark, sf_dir, "documents"), keep_ids=False).drop("ids")
