"""Benchmark decontamination by greedy string tiling.

Every ``seed`` consecutive words of a document are joined to those of the benchmark. Where a document and an item share
seeds, the item is tiled: the longest common runs of words that no tile covers yet are found by running Karp-Rabin
hashes and marked, again and again, down to runs of ``seed`` words. The share of the item's words under tiles is its
coverage, whatever the order of the passages; ``threshold`` or more is a leak.

A benchmark of up to ``small`` seeds travels to the documents as a sorted array; a larger one is joined by shuffling
the seeds of both sides, with the same result. There an item is indexed under its rarest seeds only: an item of ``p``
places of seeds leaks with ``h`` of them in the document at least, so one of any ``p - h + 1`` is among those. Seeds that
very many documents have fall out by this, or are spread over tasks by salts.

Words are ASCII letters and digits and all that is not ASCII, after lower-casing A-Z. Items of fewer words than a seed
leak where they stand as a whole. Null or empty texts and items leak nothing; a null ``doc_id`` or ``item_id`` is
carried along; repeated rows each come back. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import words
from shelfmark.llm.common import HOT_KEYS, HOT_ROWS, partitions, read, text_key, texts, tidy, without, written

SEED, THRESHOLD, SMALL = 5, 0.5, 2_000_000
_BASE, _MOD = 1_000_003, (1 << 61) - 1


def _runs(marked: list[bool]) -> list[tuple[int, int]]:
    """The stretches that are not marked."""
    out, begin = [], None
    for i, m in enumerate([*marked, True]):
        if not m and begin is None:
            begin = i
        elif m and begin is not None:
            out.append((begin, i))
            begin = None
    return out


def _karp_rabin(ids: list[int], marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """``(hash, start)`` of every unmarked run of ``size`` words, rolled along."""
    top = pow(_BASE, size - 1, _MOD)
    for a, b in _runs(marked):
        if b - a < size:
            continue
        h = 0
        for x in ids[a : a + size]:
            h = (h * _BASE + x) % _MOD
        yield h, a
        for i in range(a + size, b):
            h = ((h - ids[i - size] * top) * _BASE + ids[i]) % _MOD
            yield h, i - size + 1


def tiles(item: list[int], doc: list[int], least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(item start, document start, length)``, longest first; ties by item, then document."""
    marked_item, marked_doc = [False] * len(item), [False] * len(doc)
    found: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), len(doc)))
    while True:
        at = defaultdict(list)
        for h, i in _karp_rabin(item, marked_item, size):
            at[h].append(i)
        matches = []
        if at:
            for h, j in _karp_rabin(doc, marked_doc, size):
                for i in at.get(h, ()):
                    if item[i : i + size] == doc[j : j + size]:
                        n = size
                        while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not (marked_item[i + n] or marked_doc[j + n]):
                            n += 1
                        matches.append((-n, i, j))
        again = False
        for n, i, j in sorted(matches):
            n = -n
            if any(marked_item[i : i + n]) or any(marked_doc[j : j + n]):
                again = True
                continue
            found.append((i, j, n))
            marked_item[i : i + n] = marked_doc[j : j + n] = [True] * n
        if size == least and not again:
            return found
        size = max(least, size // 2) if not again else size


def _numbered(item: np.ndarray, doc: np.ndarray) -> tuple[list[int], list[int]]:
    _, ids = np.unique(np.concatenate([item, doc]), return_inverse=True)
    ids = (ids.ravel() + 1).tolist()
    return ids[: len(item)], ids[len(item) :]


def coverage(item: np.ndarray, doc: np.ndarray, seed: int = SEED) -> tuple[int, int]:
    """Words of the item (as hashes) under tiles, and the number of tiles. Only the parts of the document near shared
    seeds are tiled: a tile is made of shared seeds."""
    if len(item) < seed:
        n = len(item)
        hits = np.flatnonzero(words.rolling(np.zeros(len(doc), np.int64), doc, n)[1] == words.rolling(np.zeros(n, np.int64), item, n)[1][0]) if 0 < n <= len(doc) else ()
        return (n, 1) if len(hits) else (0, 0)
    seeds = words.rolling(np.zeros(len(item), np.int64), item, seed)[1]
    at, grams = words.rolling(np.zeros(len(doc), np.int64), doc, seed)
    near = np.zeros(len(doc) + 1, bool)
    hits = at[np.isin(grams, seeds)]
    for j in range(seed):
        near[hits + j] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[False], near]).astype(np.int8)))
    barrier = np.array([0], np.uint64)  # no word has it on both sides: numbered apart below
    parts = [x for a, b in zip(edges[::2], edges[1::2], strict=True) for x in (doc[a:b], barrier)]
    if not parts:
        return 0, 0
    a, b = _numbered(item, np.concatenate(parts))
    gaps = np.cumsum([len(x) for x in parts])[1::2] - 1
    for n, g in enumerate(gaps):
        b[g] = -1 - n
    found = tiles(a, b, seed)
    return sum(n for *_, n in found), len(found)


_LEAKS = "doc_id long, key long, item_id long, covered_words long, item_words long, n_tiles long, coverage double"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 6 + [pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[x.split()[0] for x in _LEAKS.split(", ")])


def _tiled(items: dict, seed: int, threshold: float):
    """Documents against a small benchmark: ``items`` has the sorted seeds, their items, and the items' words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw, out = list(zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), strict=True)), batch.column("text").to_pylist(), []
            for first, some in words.groups(raw):
                text, word = words.hashed(some)
                bounds = np.searchsorted(text, np.arange(len(some) + 1))
                pairs = [np.zeros((2, 0), np.int64)]
                for k, (sorted_seeds, owner) in items["seeds"].items():
                    at, gram = words.rolling(text, word, k)
                    low, high = np.searchsorted(sorted_seeds, gram, "left"), np.searchsorted(sorted_seeds, gram, "right")
                    hit = np.flatnonzero(high > low)
                    n = high[hit] - low[hit]
                    which = np.arange(int(n.sum())) + np.repeat(low[hit] - (np.cumsum(n) - n), n)
                    pairs.append(np.stack([text[np.repeat(at[hit], n)], owner[which]]))
                for t, i in np.unique(np.concatenate(pairs, axis=1), axis=1).T.tolist():
                    item_id, item = items["items"][i]
                    covered, n = coverage(item, word[bounds[t] : bounds[t + 1]], seed)
                    if covered >= threshold * len(item):
                        out.append((*ids[first + t], item_id, covered, len(item), n, covered / len(item)))
            yield _batch(out)

    return run


def _seeded(seed: int, sizes: list[int]):
    """``row, gram``: the distinct seeds of each text (and its runs of the sizes of shorter items)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, some in words.groups(batch.column("text").to_pylist()):
                text, word = words.hashed(some)
                for k in sizes:
                    at, gram = words.rolling(text, word, k)
                    rows = np.unique(np.stack([text[at], gram.view(np.int64)]), axis=1)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[0] + first)), pa.array(rows[1]), pa.array(np.full(rows.shape[1], k))], names=["doc_id", "gram", "k"])

    return run


def _placed(seed: int, threshold: float):
    """``number, gram, k, at, spare``: the seeds of each item by place, and how many of its places need no index.

    A leak has ``c = ceil(threshold * words)`` words under tiles of ``k`` words or more. A tile of ``n`` words covers
    ``n - k + 1`` places, at least ``n / k`` of them, so ``h = ceil(c / k)`` places have their seed in the document: all but
    ``h - 1`` places are enough to meet it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, x in zip(batch.column("number").to_pylist(), batch.column("item").to_pylist(), strict=True):
                word = words.hashed([x])[1]
                if k := min(seed, len(word)):
                    at, gram = words.rolling(np.zeros(len(word), np.int64), word, k)
                    needed = 1 if k < seed else max(1, int(np.ceil(np.ceil(threshold * len(word) - 1e-9) / k)))
                    of = [np.full(len(at), v, np.int64) for v in (number, k, needed - 1)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (of[0], gram.view(np.int64), of[1], at.astype(np.int64), of[2])], names=["number", "gram", "k", "at", "spare"])

    return run


def _met(of_rows: DataFrame, index: DataFrame, salt_rows: int) -> DataFrame:
    """Rows and items of one seed; the rows of a seed that more than ``salt_rows`` rows have are dealt into salts."""
    index = index.withColumn("salts", F.ceil(F.col("n") / salt_rows))
    hot = index.where("salts > 1").select("gram", "k", "salts").distinct()
    if hot.isEmpty():
        return of_rows.join(index, ["gram", "k"])
    # hot seeds are few: each has over salt_rows rows; where they are many, the join shuffles
    side = F.broadcast(hot) if hot.count() <= HOT_KEYS else hot
    salted = of_rows.join(side, ["gram", "k"], "left").withColumn("salt", F.pmod(F.xxhash64("row"), F.coalesce("salts", F.lit(1)))).drop("salts")
    return salted.join(index.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))), ["gram", "k", "salt"])


def _tiled_pairs(seed: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                item, doc = words.hashed([r["item"]])[1], words.hashed([r["text"]])[1]
                covered, n = coverage(item, doc, seed)
                if len(item) and covered >= threshold * len(item):
                    out.append((r["doc_id"], r["key"], r["item_id"], covered, len(item), n, covered / len(item)))
            yield _batch(out)

    return run


def leaks(
    docs: DataFrame, benchmark: DataFrame, seed: int = SEED, threshold: float = THRESHOLD, small: int = SMALL,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", salt_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per leaked pair: ``doc_id, key`` (a hash of the text), ``item_id, covered_words, item_words, n_tiles, coverage``."""
    rows = texts(docs, id_col, text_col).select("doc_id", text_key("text").alias("key"), F.col("text").cast("binary").alias("text"))
    tests = texts(benchmark, item_col, item_text_col).select(F.col("doc_id").alias("item_id"), F.col("text").cast("binary").alias("item"))
    # a word has a byte at least, and a space or an end after it
    if (tests.agg(F.sum(F.length("item") + 1)).first()[0] or 0) <= 2 * small:
        known = [(r["item_id"], words.hashed([bytes(r["item"])])[1]) for r in tests.collect()]
        known = [(i, w) for i, w in known if len(w)]
        grams = defaultdict(list)
        for n, (_, w) in enumerate(known):
            k = min(seed, len(w))
            grams[k].append((words.rolling(np.zeros(len(w), np.int64), w, k)[1], n))
        seeds = {}
        for k, parts in grams.items():
            every, owner = np.concatenate([g for g, _ in parts]), np.repeat([n for _, n in parts], [len(g) for g, _ in parts])
            order = np.argsort(every, kind="stable")
            seeds[k] = (every[order], owner[order])
        return rows.mapInArrow(tidy(_tiled({"seeds": seeds, "items": known}, seed, threshold)), _LEAKS)
    # the larger benchmark: seeds meet by a shuffle, then the texts of candidate pairs; rows and items meet by number,
    # since ids may be null or repeated
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    tests = written(tests.withColumn("number", F.monotonically_increasing_id()), "items")
    of_tests = written(tests.select("number", "item").mapInArrow(tidy(_placed(seed, threshold)), "number long, gram long, k long, at long, spare long"), "seeds")
    # sizes of seeds: that of all but short items, and at most seed - 1 more
    sizes = sorted(r["k"] for r in of_tests.select("k").distinct().collect())
    of_rows = rows.select(F.col("row").alias("doc_id"), "text").mapInArrow(tidy(_seeded(seed, sizes)), "doc_id long, gram long, k long").withColumnRenamed("doc_id", "row")
    wanted = of_tests.select("gram", "k").distinct()
    often = written(of_rows.groupBy("gram", "k").agg(F.count("*").alias("n")).join(wanted, ["gram", "k"]), "often")
    # an item has as many rows here as places; places whose seed no document has would come first, and are left out
    by_item = Window.partitionBy("number")
    ranked = of_tests.join(often, ["gram", "k"]).withColumns({"rank": F.row_number().over(by_item.orderBy(F.col("n").asc(), "at")), "here": F.count("*").over(by_item)})
    kept = ranked.where("rank <= here - spare").select("gram", "k", "number", "n").distinct()
    pairs = _met(of_rows, written(kept, "index"), salt_rows).select("row", "number").distinct()
    full = pairs.join(tests, "number").join(rows, "row").repartition(partitions(docs.sparkSession))
    return full.select("doc_id", "key", "text", "item_id", "item").mapInArrow(tidy(_tiled_pairs(seed, threshold)), _LEAKS)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all its columns, without documents that leak an item."""
    gone = leaks(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    return without(docs, gone, id_col, text_col)


def op5_decontamination(spark, sf_dir):
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("key")
