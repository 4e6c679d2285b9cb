"""Repeated byte strings by external induced sorting, to the depth that the question needs.

A byte is removed if a string of ``depth`` (100) bytes that covers it also starts earlier in the corpus. That asks for
the order of all suffixes to a depth of 100 bytes only, so the sort is induced to that depth:

1. *Sample suffixes.* Of each window of ``depth`` bytes the smallest 32-byte string (by hash) is sampled. Equal windows
   sample the same place, so two equal windows always meet at equal sample suffixes. A sample is named by its 32 bytes
   and by its context: the bytes of all windows that chose it.
2. *Names are sorted first.* Sample tuples ``(name, context, document, place)`` are sorted by Spark's shuffle, whose
   disk-backed sorted runs serve as the external priority queue, and are read as a stream. Samples of equal context
   have equal windows throughout: all but the first are repeats, and no bytes have to be moved. Only names that have
   several contexts go on.
3. *Induction.* For these, the context bytes are fetched. Samples of a name are sorted by the bytes to their right with
   their common-prefix values; from the order at distance ``j`` the order of the suffixes one byte further left follows
   by a stable bucket pass on the preceding byte, and their common prefixes from range minima plus one. Neighbours with
   a common prefix of ``depth`` or more are equal windows, of which the earliest in the corpus stays.

Since only 100 bytes of order are asked for, one level of sampling ends the recursion. Names with very many contexts
(``hot``) are salted: each salt is sorted by itself, and the windows that remain are combined by a 128-bit digest.

Matches never cross documents. A null or empty text, or one shorter than ``depth``, has nothing to remove. Every row is a
document of its own: a null ``doc_id`` ranks before all others, and rows that share one rank in the order of the table
(such tables are numbered by rank first). An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import HOT_KEYS, partitions, read, texts, tidy, written

DEPTH, NAME = 100, 32
#: Bytes that are sampled at once; longer texts are cut with overlap.
_PIECE = 1 << 20
#: Samples that a task folds at once, contexts sorted at once, and contexts of a name beyond which it is salted.
_FOLD, _SORT, HOT = 1_000_000, 30_000, 4096

_HELD: dict[int, tuple[np.ndarray, ...]] = {}


def _tables(n: int) -> tuple[np.ndarray, ...]:
    """Byte values, powers and inverse powers of two polynomial hashes; made once in a task."""
    if n not in _HELD:
        _HELD.clear()
        _HELD[n] = _make_tables(n)
    return _HELD[n]


def _make_tables(n: int) -> tuple[np.ndarray, ...]:
    rng = np.random.default_rng(7)
    out = []
    for _ in range(2):
        values = rng.integers(1, 1 << 63, 256, np.uint64)
        base = int(rng.integers(1 << 20, 1 << 62)) * 8 + 5
        inverse = pow(base, -1, 1 << 64)
        power, back = np.full(n + 1, base % (1 << 64), np.uint64), np.full(n + 1, inverse, np.uint64)
        power[0] = back[0] = 1
        out += [values, np.multiply.accumulate(power), np.multiply.accumulate(back)]
    return tuple(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def samples(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, ...]:
    """The samples of the texts ``data[starts:ends]``: text, place, first and last window, name, context (2).

    Places and windows are positions in ``data``; each sample stands for the windows from its first to its last.
    """
    n = len(data)
    v1, p1, b1, v2, p2, b2 = _tables(max(n, 2 * _PIECE))
    zero = np.zeros(1, np.uint64)
    c1 = np.concatenate([zero, np.cumsum(v1[data] * p1[:n])])
    c2 = np.concatenate([zero, np.cumsum(v2[data] * p2[:n])])
    names = _mixed((c1[NAME:] - c1[:-NAME]) * b1[: n - NAME + 1])
    mask = np.uint64((1 << 24) - 1)
    least = (names & ~mask) | np.arange(len(names), dtype=np.uint64)
    width, wanted = 1, depth - NAME + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if rest := wanted - width:
        least = np.minimum(least[:-rest], least[rest:])
    counts = np.maximum(ends - starts - (depth - 1), 0)
    text = np.repeat(np.arange(len(starts)), counts)
    window = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)
    place = (least[window] & mask).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])])) if len(place) else np.zeros(0, np.int64)
    first = window[cut]
    last = window[np.concatenate([cut[1:], [len(window)]]).astype(np.int64) - 1] if len(cut) else first
    p = place[cut]
    stop = last + depth
    return (
        text[cut], p, first, last, names[p],
        _mixed((c1[stop] - c1[first]) * b1[first] + np.uint64(1)), _mixed((c2[stop] - c2[first]) * b2[first] + (p - first).astype(np.uint64)),
    )


def _pieces(batch: pa.RecordBatch, depth: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The texts of a batch, gathered to about ``_PIECE`` bytes: data, rows, starts, ends, offsets in their texts."""
    column = batch.column("text")
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    rows, begins, stops = [], [], []
    held = 0

    def piece():
        lengths = np.array(stops) - np.array(begins)
        ends = np.cumsum(lengths)
        return np.concatenate([data[a:b] for a, b in zip(begins, stops, strict=True)]), np.array(rows), ends - lengths, ends, np.array(begins) - at[np.array(rows)]

    for row in range(len(column)):
        a, b = int(at[row]), int(at[row + 1])
        while b - a >= depth:
            stop = min(b, a + _PIECE + depth - 1)
            rows.append(row)
            begins.append(a)
            stops.append(stop)
            held += stop - a
            if held >= _PIECE:
                yield piece()
                rows, begins, stops, held = [], [], [], 0
            if stop == b:
                break
            a = stop - (depth - 1)
    if rows:
        yield piece()


_SAMPLE = "part long, name long, c1 long, c2 long, doc_id long, place long, before int, after int, repeat boolean"


def _sampled(depth: int):
    """Each text's samples, folded within the task: of equal contexts only the first goes on, the others are repeats."""

    def fold(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        name, c1, c2, doc, place, before, after = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((place, doc, c2, c1, name))
        name, c1, c2, doc, place, before, after = (x[order] for x in (name, c1, c2, doc, place, before, after))
        same_name = np.concatenate([[False], name[1:] == name[:-1]])
        same = np.concatenate([[False], (c1[1:] == c1[:-1]) & (c2[1:] == c2[:-1])]) & same_name
        moved = np.concatenate([[False], (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])])
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(name))))
        repeat = same & ((doc != doc[head]) | (place != place[head]))
        keep = ~same | moved
        # A name with many contexts is dealt out by context; one of them stays to tell the rest that there are others.
        begin = np.maximum.accumulate(np.where(same_name, 0, np.arange(len(name))))
        rank = np.cumsum(~same) - np.cumsum(~same)[begin]
        part = np.where(repeat, _mixed(doc.view(np.uint64) + place.view(np.uint64)), np.where(rank >= 64, _mixed(name ^ c1), name))
        columns = [part.view(np.int64), name.view(np.int64), c1.view(np.int64), c2.view(np.int64), doc, place, before, after, repeat]
        return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in columns], names=[x.split()[0] for x in _SAMPLE.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for data, rows, starts, ends, skipped in _pieces(batch, depth):
                text, place, first, last, name, c1, c2 = samples(data, starts, ends, depth)
                in_text = place - starts[text] + skipped[text]
                held.append((name, c1, c2, ids[rows[text]], in_text, (place - first).astype(np.int32), (place - last).astype(np.int32)))
                n += len(text)
                if n >= _FOLD:
                    yield fold(held)
                    held, n = [], 0
        if held:
            yield fold(held)

    return run


def _settled(sampled: DataFrame, n: int) -> DataFrame:
    """Samples in the order of their names and contexts, by Spark's external sort; what spills goes to disk.

    Of equal contexts all but the first sample are ``gone``; the first ones go on if their name has other contexts.
    """
    context = Window.partitionBy("part", "repeat", "name", "c1", "c2").orderBy("doc_id", "place")
    name = Window.partitionBy("part", "repeat", "name")
    several = (F.min("c1").over(name) != F.max("c1").over(name)) | (F.min("c2").over(name) != F.max("c2").over(name))
    return (
        sampled.repartition(n, "part")
        .withColumn("head", F.first(F.struct("doc_id", "place")).over(context))
        .withColumn("several", several | (F.col("part") != F.col("name")))
        .withColumn("gone", F.col("repeat") | (F.col("doc_id") != F.col("head.doc_id")) | (F.col("place") != F.col("head.place")))
        .where("gone OR several")
        .select(
            "gone", "doc_id", (F.col("place") - F.col("before")).alias("first"), (F.col("place") - F.col("after")).alias("last"),
            F.when(~F.col("gone"), F.col("name")).alias("name"), "place",
        )
    )


def induced(group: np.ndarray, right: np.ndarray, left: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each distance ``j`` to the left of the samples, the suffixes' order and their common prefixes, by induction.

    ``right`` holds the ``depth`` bytes from each sample on, ``left`` the bytes before it (nearest first), both padded.
    Only samples of one group share a prefix; prefixes are cut at ``depth``.
    """
    n = len(group)
    rows = np.concatenate([group.astype(">i8").view(np.uint8).reshape(n, 8), right], axis=1)
    order = np.argsort(np.ascontiguousarray(rows).view(f"V{rows.shape[1]}")[:, 0], kind="stable") if n else np.zeros(0, np.int64)
    ordered = right[order]
    lcp = np.zeros(n, np.int64)
    if n > 1:
        differs = ordered[1:] != ordered[:-1]
        lcp[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), depth)
        lcp[1:][group[order][1:] != group[order][:-1]] = 0
    yield 0, order, lcp
    for j in range(1, left.shape[1] + 1):
        byte = left[order, j - 1].astype(np.int64)
        g = group[order]
        bucket = np.concatenate([[0], np.cumsum(g[1:] != g[:-1])]) * 256 + byte
        moved = np.argsort(bucket, kind="stable")
        joined = np.concatenate([[False], bucket[moved][1:] == bucket[moved][:-1]])
        at = np.flatnonzero(joined)
        new = np.zeros(n, np.int64)
        if len(at):
            # between two neighbours of a bucket lies the part of the old order whose least prefix they share
            ends = np.stack([moved[at - 1] + 1, moved[at] + 1], axis=1).ravel()
            new[at] = np.minimum(np.minimum.reduceat(np.append(lcp, depth), ends)[::2] + 1, depth)
        order, lcp = order[moved], new
        yield j, order, lcp


def _sorted(depth: int):
    """Induced sorting of whole ``(name, salt)`` groups; repeats come out as runs of windows, and for salted names the
    windows that remain as digests."""
    reach = depth - NAME

    def solve(rows: dict[str, np.ndarray], context: list[bytes]) -> Iterator[pa.RecordBatch]:
        n = len(context)
        first, last, place, doc = rows["first"], rows["last"], rows["place"], rows["doc_id"]
        before, after = place - first, place - last
        matrix = np.zeros((n, depth + reach), np.uint8)
        sizes = np.fromiter(map(len, context), np.int64, n)
        flat = np.frombuffer(b"".join(context), np.uint8)
        row = np.repeat(np.arange(n), sizes)
        column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + (reach - before)[row]
        matrix[row, column] = flat
        changes = (np.diff(rows["name"]) != 0) | (np.diff(rows["salt"]) != 0)
        group = np.concatenate([[0], np.cumsum(changes)])
        seniority = np.empty(n, np.int64)
        by_place = np.lexsort((place, doc))
        seniority[by_place] = np.arange(n)
        out, spare = [], []
        for j, order, lcp in induced(group, matrix[:, reach:], matrix[:, :reach][:, ::-1], depth):
            live = (after[order] <= j) & (j <= before[order])
            if not live.any():
                continue
            run = np.cumsum(lcp < depth)[live]
            who = order[live]
            best = np.full(run.max() + 1, n, np.int64)
            np.minimum.at(best, run, seniority[who])
            winner = by_place[best[run]]
            gone = (doc[who] != doc[winner]) | (place[who] != place[winner])
            out.append(np.stack([doc[who[gone]], place[who[gone]] - j]))
            if (hot := (rows["salts"][who] > 1) & ~gone).any():
                spare += [(matrix[i, reach - j : reach - j + depth].tobytes(), int(doc[i]), int(place[i]) - j) for i in who[hot]]
        if out:
            d, w = np.concatenate(out, axis=1)
            o = np.lexsort((w, d))
            d, w = d[o], w[o]
            cut = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (w[1:] > w[:-1] + 1)])) if len(d) else np.zeros(0, np.int64)
            stop = np.append(cut[1:], len(d))[: len(cut)] - 1
            yield _runs(d[cut], w[cut], w[stop], None)
        if spare:
            yield _runs([s[1] for s in spare], [s[2] for s in spare], [s[2] for s in spare], [xxhash.xxh3_128_digest(s[0]) for s in spare])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, enough = 0, _SORT
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < enough:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            name, salt = table.column("name").to_numpy(), table.column("salt").to_numpy()
            whole = np.flatnonzero((name != name[-1]) | (salt != salt[-1]))
            cut = int(whole[-1]) + 1 if len(whole) else 0
            if cut:
                yield from solve(*_unpacked(table.slice(0, cut)))
            held = table.slice(cut).combine_chunks().to_batches()
            n = len(table) - cut
            enough = max(_SORT, 2 * n)  # what is held is put together a few times only, however large its group
        if n:
            yield from solve(*_unpacked(pa.Table.from_batches(held)))

    return run


def _unpacked(table: pa.Table) -> tuple[dict[str, np.ndarray], list[bytes]]:
    return {c: table.column(c).to_numpy() for c in ("name", "salt", "salts", "doc_id", "place", "first", "last")}, table.column("context").to_pylist()


def _runs(doc, first, last, digest) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [*(pa.array(np.asarray(x, np.int64)) for x in (doc, first, last)), pa.array(digest if digest is not None else [None] * n, pa.binary())],
        names=["doc_id", "first", "last", "digest"],
    )


def repeated_windows(docs: DataFrame, dealt: DataFrame, depth: int = DEPTH, hot: int = HOT) -> DataFrame:
    """Runs ``doc_id, first, last`` of window starts whose ``depth`` bytes also start earlier.

    ``docs`` has ``doc_id`` and ``text`` (binary); ``dealt`` are the same rows, dealt out by ``doc_id``.
    """
    n = partitions(docs.sparkSession)
    found = written(_settled(docs.mapInArrow(tidy(_sampled(depth)), _SAMPLE), n), "samples")
    whole = found.where("gone").select("doc_id", "first", "last")
    open_ = found.where("NOT gone")
    # names of very many contexts: at most one for each ``hot`` rows
    salts = open_.groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("name", F.ceil(F.col("n") / hot).alias("salts"))
    salts = written(salts, "salts")
    if salts.limit(HOT_KEYS + 1).count() <= HOT_KEYS:
        salts = F.broadcast(salts)
    per_doc = (
        open_.join(salts, "name", "left")
        .withColumn("salts", F.coalesce("salts", F.lit(1)))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("name", "salts", "place", "first", "last")).alias("open"))
    )
    fetched = (
        dealt.join(per_doc, "doc_id")
        .select(
            "doc_id",
            F.explode(
                F.transform(
                    "open",
                    lambda s: F.struct(
                        s.getField("name").alias("name"), s.getField("salts").alias("salts"),
                        s.getField("place").alias("place"), s.getField("first").alias("first"), s.getField("last").alias("last"),
                        F.substring(F.col("text"), (s.getField("first") + 1).cast("int"), (s.getField("last") - s.getField("first") + depth).cast("int")).alias("context"),
                    ),
                )
            ).alias("s"),
        )
        .select("doc_id", "s.*")
        .where(F.length("context") == F.col("last") - F.col("first") + depth)
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "place"), F.col("salts")))  # of one long text too
    )
    runs = (
        fetched.repartition(n, "name", "salt")
        .sortWithinPartitions("name", "salt")
        .mapInArrow(tidy(_sorted(depth)), "doc_id long, first long, last long, digest binary")
    )
    spare = runs.where("digest IS NOT NULL")
    earliest = spare.groupBy("digest").agg(F.min(F.struct("doc_id", "first")).alias("e"), F.count("*").alias("n")).where("n > 1")
    late = (
        spare.join(earliest, "digest")
        .where("doc_id <> e.doc_id OR first <> e.first")
        .select("doc_id", "first", "last")
    )
    return whole.unionByName(runs.where("digest IS NULL").select("doc_id", "first", "last")).unionByName(late)


def _removed(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, runs in zip(*(batch.column(c) for c in ("doc_id", "text", "runs")), strict=True):
                text, found = text.as_py(), runs.values
                spans: list[list[int]] = []
                if found is not None and len(found):
                    a, b = found.field("first").to_numpy(), found.field("last").to_numpy() + depth
                    order = np.lexsort((b, a))
                    a, reach = a[order], np.maximum.accumulate(b[order])
                    new = np.flatnonzero(np.concatenate([[True], a[1:] > reach[:-1]]))
                    stops = reach[np.append(new[1:], len(a)) - 1]
                    spans = [[int(x), min(int(y), len(text))] for x, y in zip(a[new], stops, strict=True) if x < len(text)]
                kept, at = [], 0
                for x, y in spans:
                    kept.append(text[at:x])
                    at = y
                kept.append(text[at:])
                left = b"".join(kept)
                out.append((doc_id.as_py(), len(text), len(text) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def _ranked(rows: DataFrame) -> DataFrame:
    """The rows with ``rank``, a number that grows with ``(doc_id, place in the table)``."""
    n = partitions(rows.sparkSession)
    numbered = written(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    order = numbered.select("doc_id", "row").repartitionByRange(n, "doc_id", "row").sortWithinPartitions("doc_id", "row")
    ranks = written(order.select("row", F.monotonically_increasing_id().alias("rank")), "ranks")
    return numbered.join(ranks, "row").drop("row")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, hot: int = HOT) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and the remaining bytes ``kept``."""
    n = partitions(docs.sparkSession)
    rows = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    own = rows.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").isEmpty()
    if not own:
        ranked = written(_ranked(rows), "ranked")
        rows = ranked.select(F.col("rank").alias("doc_id"), "text")
    # the same exchange serves the fetch of contexts and the last join
    dealt = rows.repartition(n, "doc_id")
    runs = repeated_windows(rows, dealt, depth, hot).groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    left = dealt.join(runs, "doc_id", "left").mapInArrow(
        tidy(_removed(depth)), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    if own:
        return left
    ids = ranked.select("rank", F.col("doc_id").alias("id"))
    return left.join(ids, F.col("doc_id") == F.col("rank")).select(F.col("id").alias("doc_id"), *left.columns[1:])


def op1_suffix_array_dedup(spark, sf_dir):
    return remove_repeats(read(spark, sf_dir, "documents")).drop("kept")
