"""How far sources of one language differ in their words: an exact recount by minimal perfect hashes.

1. Every document's distinct terms are counted, and the terms of at least ``least_docs`` documents of their language kept.
2. The kept (language, term) pairs are cut into shards of some ``SHARD`` pairs by hash. A task builds each shard's minimal
   perfect hash by hashing and displacing: buckets, largest first, look for a displacement that puts their keys on free
   slots; buckets of one key are given a slot outright. The shard stores its keys in the order of their slots.
3. The shards travel to the tasks by broadcast, in waves of at most ``WAVE_BYTES`` (a larger vocabulary takes more waves,
   each of which reads the documents again). Each occurrence is hashed to its slot, the stored key is compared with it byte
   by byte, and a dense array of the group (language, source) counts the slot. A task holds at most ``DENSE_SLOTS`` slots at
   a time and gives out what it has counted before it takes more.
4. Counts become exact whole-number shares; pairs of sources are compared shard by shard, in tiles of ``TILE`` sources.

Null text, language and source are read as ''. Only A-Z are lower-cased. Every row is a document, repeated rows too; ids
and further columns are not read. Groups without terms take part with counts of 0; a language without kept terms gives
each pair of its sources 0. An empty table gives an empty result. Shares are exact while a language has fewer than 9 * 10^17
occurrences and terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import read, tidy, written

#: Keys of a shard; bytes of shards broadcast at once; slots that a task counts at once; sources compared at once; bytes
#: of text handled at once; rows of groups and languages up to which they are broadcast; pairs of language and term that a
#: task gathers.
SHARD, WAVE_BYTES, DENSE_SLOTS, TILE, TOGETHER, SMALL, GATHERED = 4096, 64 << 20, 1 << 23, 128, 1 << 22, 100_000, 200_000
SCALE, LEAST_DOCS, TERM_RANKS = 1_000_000_000, 3, 200
#: Keys of a bucket on average; displacements tried; the displacement that tells buckets apart.
_BUCKET, _TRIES, _BUCKETS = 4, 1 << 16, 1 << 40

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_TERM = (_LOWER >= 97) & (_LOWER <= 122) | (_BYTES >= 128)


def terms_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[bytes]]]:
    """``(first text, text of each term, number of each term, distinct terms)`` of slices of some megabytes.

    Terms are runs of ASCII letters, lower-cased, and of characters beyond ASCII; they never cross texts.
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw, first = texts.buffers()[2] if len(texts) else None, 0
    while first < len(texts):
        stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + TOGETHER, "right")) - 1)
        begins = offsets[first:stop] - offsets[first]
        size = int(offsets[stop] - offsets[first])
        data = np.zeros(size, np.uint8) if raw is None else _LOWER[np.frombuffer(raw, np.uint8)[offsets[first] : offsets[stop]]]
        inside = np.append(_TERM[data], False)
        edge = np.zeros(size + 1, bool)
        edge[begins] = True
        before = np.append(False, inside[:-1])
        starts, ends = np.flatnonzero(inside & (~before | edge)), np.flatnonzero(before & (~inside | edge))
        # a run and what parts it from the next are one value each: every second one is a term
        bounds = np.stack([starts, ends], 1).ravel()
        values = pa.Array.from_buffers(pa.large_binary(), max(0, len(bounds) - 1), [None, pa.py_buffer(bounds), pa.py_buffer(data)]) if len(bounds) else pa.array([], pa.large_binary())
        coded = values.take(pa.array(np.arange(0, len(values), 2))).dictionary_encode()
        text = np.repeat(np.arange(stop - first), np.diff(np.append(np.searchsorted(starts, begins), len(starts))))
        yield first, text, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
        first = stop


def _coded(values: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def _document_counts(gathered: int):
    """How many documents of a language have each term; a task gathers ``gathered`` pairs before it gives them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, int]] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "term", "n_docs"]
                )
            held.clear()

        for batch in batches:
            lang_of, langs = _coded(batch.column("lang"))
            for first, text, number, distinct in terms_of(batch.column("text")):
                if not len(number):
                    continue
                pairs = np.sort(text * len(distinct) + number)
                once = pairs[np.append(True, pairs[1:] != pairs[:-1])]  # of one document
                counts = np.bincount(lang_of[first + once // len(distinct)] * len(distinct) + once % len(distinct))
                for key, n in zip(np.flatnonzero(counts).tolist(), counts[counts > 0].tolist(), strict=True):
                    own = held.setdefault(langs[key // len(distinct)], {})
                    term = distinct[key % len(distinct)]
                    own[term] = own.get(term, 0) + n
                if sum(map(len, held.values())) > gathered:
                    yield from given()
        yield from given()

    return run


def _mixed(h: np.ndarray, d: np.ndarray) -> np.ndarray:
    """A new 64-bit hash of each ``h`` for each displacement."""
    x = h ^ (d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def key_hash(lang: str, term: bytes) -> int:
    """As ``xxhash64(lang, term)`` in Spark, unsigned."""
    return xxhash.xxh64_intdigest(term, xxhash.xxh64_intdigest(lang.encode(), 42))


def _bucket_of(hashes: np.ndarray, n_buckets: np.ndarray | int) -> np.ndarray:
    """Mixed anew, since the keys of a shard agree in their hash modulo the number of shards."""
    return (_mixed(hashes, np.full(len(hashes), _BUCKETS)) % np.asarray(n_buckets).astype(np.uint64)).astype(np.int64)


def minimal_perfect_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(displacements, slots)`` for distinct 64-bit hashes: each key's slot, 0 to n - 1, without a gap.

    A displacement of d >= 0 puts the keys of its bucket at ``_mixed(h, d) % n``; -1 - s puts its only key at slot s. Where
    a bucket finds no place, all is tried again with twice as many buckets.
    """
    n_buckets = max(1, len(hashes) // _BUCKET)
    while (found := _displaced(hashes, n_buckets)) is None:
        n_buckets *= 2
    return found


def _displaced(hashes: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray] | None:
    n = len(hashes)
    bucket = _bucket_of(hashes, n_buckets)
    displacement, slots, free = np.zeros(n_buckets, np.int32), np.full(n, -1, np.int64), np.ones(n, bool)
    sizes = np.bincount(bucket, minlength=n_buckets)
    members = np.split(np.argsort(bucket, kind="stable"), np.cumsum(sizes)[:-1])
    for b in np.argsort(-sizes, kind="stable"):
        own = members[b]
        if len(own) < 2:
            break
        for low in range(0, _TRIES, 256):
            d = np.arange(low, low + 256)
            put = np.sort((_mixed(hashes[own][None, :], d[:, None]) % np.uint64(n)).astype(np.int64), 1)
            good = np.flatnonzero(free[put].all(1) & (put[:, 1:] != put[:, :-1]).all(1))
            if len(good):
                displacement[b] = d[good[0]]
                slots[own] = (_mixed(hashes[own], np.full(len(own), displacement[b])) % np.uint64(n)).astype(np.int64)
                free[slots[own]] = False
                break
        else:
            return None
    alone = np.flatnonzero(sizes == 1)
    left = np.flatnonzero(free)
    displacement[alone] = -1 - left
    slots[np.array([members[b][0] for b in alone], np.int64)] = left
    return displacement, slots


def _built(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One shard: its displacements, and its keys (language, zero byte, term) in the order of their slots."""
    langs, terms = table.column("lang").to_pylist(), table.column("term").to_pylist()
    hashes = np.array([key_hash(a, b.encode()) for a, b in zip(langs, terms, strict=True)], np.uint64)
    displacement, slots = minimal_perfect_hash(hashes)
    order = np.argsort(slots)
    keys = pa.array([f"{langs[i]}\0{terms[i]}".encode() for i in order], pa.binary())
    sizes = np.diff(np.frombuffer(keys.buffers()[1], np.int32)[: len(keys) + 1]).astype("<i4")
    codes, names = _coded(pa.array([langs[i] for i in order], pa.string()))
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([len(slots)], pa.int64()), "displacement": pa.array([displacement.astype("<i4").tobytes()], pa.binary()),
            "sizes": pa.array([sizes.tobytes()], pa.binary()), "keys": pa.array([b"".join(keys.to_pylist())], pa.binary()), "langs": pa.array([names], pa.list_(pa.string())), "lang_of": pa.array([codes.astype("<i4").tobytes()], pa.binary()),
        }
    )


class Shards:
    """Looks keys up in some of ``n_shards`` shards: ``place(hash, key)`` is -1 where the stored key is another."""

    def __init__(self, rows: list, n_shards: int):
        rows = sorted(rows, key=lambda r: r[0])
        self.n_shards = n_shards
        self.known, self.n = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
        self.start = np.cumsum(self.n) - self.n
        tables = [np.frombuffer(r[2], "<i4") for r in rows]
        self.buckets = np.array([len(t) for t in tables], np.int64)
        self.first_bucket, self.displacement = np.cumsum(self.buckets) - self.buckets, np.concatenate(tables)
        ends = np.append(0, np.cumsum(np.concatenate([np.frombuffer(r[3], "<i4") for r in rows]), dtype=np.int64))
        self.keys = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(b"".join(r[4] for r in rows))])
        self.total = int(self.n.sum())
        self.shard_of_place = np.repeat(self.known, self.n)
        self.slot_of_place = np.arange(self.total) - np.repeat(self.start, self.n)
        # a language's places are numbered by themselves, so that a group's array has those of its language only
        self.langs = sorted({x for r in rows for x in r[5]})
        number = {x: i for i, x in enumerate(self.langs)}
        lang = np.concatenate([np.array([number[x] for x in r[5]], np.int64)[np.frombuffer(r[6], "<i4")] for r in rows])
        sizes = np.bincount(lang, minlength=len(self.langs))
        self.size, self.places = dict(zip(self.langs, sizes.tolist(), strict=True)), dict(zip(self.langs, np.split(np.argsort(lang, kind="stable"), np.cumsum(sizes)[:-1]), strict=True))
        self.within = np.zeros(self.total, np.int64)
        for places in self.places.values():
            self.within[places] = np.arange(len(places))

    def place(self, hashes: np.ndarray, keys: list[bytes]) -> np.ndarray:
        """Each key's place among all slots of these shards, or -1."""
        # Spark's pmod of the signed hash
        shard = hashes.view(np.int64) % self.n_shards
        i = np.minimum(np.searchsorted(self.known, shard), len(self.known) - 1)
        here = self.known[i] == shard
        d = self.displacement[self.first_bucket[i] + _bucket_of(hashes, self.buckets[i])]
        slot = np.where(d < 0, -1 - d, (_mixed(hashes, np.maximum(d, 0)) % self.n[i].astype(np.uint64)).astype(np.int64))
        place = self.start[i] + slot
        same = pc.equal(self.keys.take(pa.array(place)), pa.array(keys, pa.large_binary())).to_numpy(zero_copy_only=False)
        return np.where(here & same, place, -1)


def _recounted(shared, n_shards: int, dense_slots: int):
    """Counts every occurrence of a key of the broadcast shards into dense arrays, one for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(shared.value, n_shards)
        seeds: dict[str, int] = {}
        held: dict[tuple[str, str], np.ndarray] = {}
        room = dense_slots

        def given() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in held.items():
                at = np.flatnonzero(counts)
                place = shards.places[lang][at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x] * len(at), pa.string()) for x in (lang, source)] + [pa.array(shards.shard_of_place[place]), pa.array(shards.slot_of_place[place].astype(np.int32)), pa.array(counts[at].astype(np.int64))],
                    names=["lang", "source", "shard", "slot", "count"],
                )
            held.clear()

        for batch in batches:
            lang_of, langs = _coded(batch.column("lang"))
            source_of, sources = _coded(batch.column("source"))
            for lang in langs:
                seeds.setdefault(lang, xxhash.xxh64_intdigest(lang.encode(), 42))
            # one group after the other
            group = lang_of * len(sources) + source_of
            order = np.argsort(group, kind="stable")
            group = group[order]
            for first, text, number, distinct in terms_of(batch.column("text").take(pa.array(order))):
                if not len(number):
                    continue
                # each distinct (language, term) is looked up once
                own = group[first + text]
                key = own // len(sources) * len(distinct) + number
                there = np.zeros(len(langs) * len(distinct), bool)
                there[key] = True
                keys = np.flatnonzero(there)
                hashes, stored = np.zeros(len(keys), np.uint64), []
                edges = np.searchsorted(keys, np.arange(len(langs) + 1) * len(distinct)).tolist()
                for i, (low, high) in enumerate(zip(edges, edges[1:])):  # noqa: B905
                    some, seed, name = [distinct[k] for k in (keys[low:high] - i * len(distinct)).tolist()], seeds[langs[i]], langs[i].encode() + b"\0"
                    hashes[low:high] = np.fromiter((xxhash.xxh64_intdigest(b, seed) for b in some), np.uint64, len(some))
                    stored += [name + b for b in some]
                found = shards.place(hashes, stored)
                within = np.full(len(there), -1, np.int64)
                within[keys] = np.where(found >= 0, shards.within[found], -1)
                at = within[key]
                edges = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                for low, high in zip(edges.tolist(), [*edges[1:].tolist(), len(own)], strict=True):
                    name = (langs[own[low] // len(sources)], sources[own[low] % len(sources)])
                    some = at[low:high]
                    some = some[some >= 0]
                    if not len(some):
                        continue
                    if name not in held:
                        if held and room < shards.size[name[0]]:
                            yield from given()
                            room = dense_slots
                        held[name] = np.zeros(shards.size[name[0]], np.int64)
                        room -= shards.size[name[0]]
                    np.add.at(held[name], some, 1)
        yield from given()

    return run


def kept_terms(rows: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, term`` of the terms that at least ``least_docs`` documents of their language have."""
    counted = rows.select("lang", "text").mapInArrow(tidy(_document_counts(GATHERED)), "lang string, term string, n_docs long")
    return counted.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs")).where(F.col("n_docs") >= least_docs)


def _waves(shards: DataFrame, wave_bytes: int) -> Iterator[list]:
    """The shards' rows, at most ``wave_bytes`` of them at a time (a shard has at most some ten thousand keys)."""
    sizes = shards.select("shard", (F.length("keys") + F.length("sizes") + F.length("displacement")).alias("b")).orderBy("shard")
    low = held = 0
    bounds = []
    for r in sizes.toLocalIterator():  # numbers alone
        if held and held + r["b"] > wave_bytes:
            bounds.append((low, r["shard"] - 1))
            low, held = r["shard"], 0
        held += r["b"]
    for a, b in [*bounds, (low, None)]:
        some = shards.where((F.col("shard") >= a) & (F.lit(b is None) | (F.col("shard") <= F.lit(b)))).collect()
        if some:
            yield [tuple(r) for r in some]


def _small(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast while it has few rows."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def recount(docs: DataFrame, least_docs: int = LEAST_DOCS, wave_bytes: int = WAVE_BYTES, dense_slots: int = DENSE_SLOTS, shard_keys: int = SHARD) -> tuple[DataFrame, ...]:
    """``(groups, kept, counts)``, written tables.

    ``groups``: ``lang, source``; ``kept``: ``lang, term, shard, slot``; ``counts``: ``lang, source, shard, slot, count``
    of the kept terms that a group has. And the number of shards.
    """
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = written(rows.select("lang", "source").groupBy("lang", "source").agg(F.count("*").alias("docs")), "groups")
    terms = written(kept_terms(rows, least_docs), "terms")
    n_shards = max(1, -(-terms.count() // shard_keys))
    sharded = terms.select("lang", "term", F.pmod(F.xxhash64("lang", "term"), F.lit(n_shards)).alias("shard"))
    shards = written(sharded.groupBy("shard").applyInArrow(_built, "shard long, n long, displacement binary, sizes binary, keys binary, langs array<string>, lang_of binary"), "shards")
    slots = shards.mapInArrow(_listed, "lang string, term string, shard long, slot int")
    counts = None
    for some in _waves(shards, wave_bytes):
        shared = spark.sparkContext.broadcast(some)
        found = rows.mapInArrow(tidy(_recounted(shared, n_shards, dense_slots)), "lang string, source string, shard long, slot int, count long")
        found = written(found.groupBy("lang", "source", "shard", "slot").agg(F.sum("count").alias("count")), "counts")
        shared.unpersist()
        counts = found if counts is None else counts.unionByName(found)
    if counts is None:
        counts = spark.createDataFrame([], "lang string, source string, shard long, slot int, count long")
    return groups, slots, counts, n_shards


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of shards with their slots."""
    for batch in batches:
        for row in batch.to_pylist():
            ends = np.cumsum(np.frombuffer(row["sizes"], "<i4"))
            keys = [row["keys"][b - a : b] for a, b in zip(np.frombuffer(row["sizes"], "<i4").tolist(), ends.tolist(), strict=True)]
            parts = [k.decode().rpartition("\0") for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in parts], pa.string()), pa.array([p[2] for p in parts], pa.string()), pa.array([row["shard"]] * len(parts), pa.int64()), pa.array(np.arange(len(parts), dtype=np.int32))],
                names=["lang", "term", "shard", "slot"],
            )


def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / total)`` exactly, by long division; ``count`` is below ``total``."""
    rest, out = count + 1, np.zeros_like(count)
    out, rest = rest // total, rest % total
    for _ in range(9):
        rest = rest * 10
        out, rest = out * 10 + rest // total, rest % total
    return out + 1


def _compared(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The parts of all pair values of two tiles of sources that come from one shard.

    Rows with a null slot name the groups, with their number of occurrences and the language's terms in the shard and in
    all; the others are counts.
    """
    left_tile, right_tile = key[2].as_py(), key[3].as_py()
    heads = table.filter(pc.is_null(table.column("slot"))).to_pylist()
    rows = table.filter(pc.is_valid(table.column("slot")))
    slots, at = np.unique(rows.column("slot").to_numpy(), return_inverse=True)
    number = {h["source"]: i for i, h in enumerate(heads)}
    source, names = _coded(rows.column("source").combine_chunks() if rows.num_rows else pa.array([], pa.string()))
    counts = np.zeros((len(heads), len(slots)), np.int64)
    counts[np.array([number[n] for n in names], np.int64)[source], at] = rows.column("count").to_numpy()
    n_terms, in_shard = (heads[0]["n_terms"], heads[0]["in_shard"]) if heads else (0, 0)
    out: dict[str, list] = {"lang": [], "source": [], "item": [], "value": []}
    if n_terms:
        total = np.array([h["n"] + n_terms for h in heads], np.int64)
        p = share(counts, total[:, None])
        none = share(np.zeros(len(heads), np.int64), total)
    for i, a in enumerate(heads):
        if a["tile"] != left_tile:
            continue
        others = [j for j, b in enumerate(heads) if b["tile"] == right_tile and j != i]
        if n_terms:
            q, q0 = p[others], none[others]
            values = ((p[i] - q) ** 2 // q).sum(1) + (none[i] - q0) ** 2 // q0 * (in_shard - len(slots))
        else:
            values = np.zeros(len(others), np.int64)
        out["lang"] += [a["lang"]] * len(others)
        out["source"] += [a["source"]] * len(others)
        out["item"] += [heads[j]["source"] for j in others]
        out["value"] += values.tolist()
    return pa.table({k: pa.array(v, pa.int64() if k == "value" else pa.string()) for k, v in out.items()})


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, term_ranks: int = TERM_RANKS, wave_bytes: int = WAVE_BYTES, dense_slots: int = DENSE_SLOTS,
               shard_keys: int = SHARD, tile: int = TILE) -> DataFrame:
    """``lang, source, part, item, value, rank``: of each group all other sources of its language, and its leading terms."""
    groups, kept, counts, n_shards = recount(docs, least_docs, wave_bytes, dense_slots, shard_keys)
    kept = written(kept, "kept")
    of_group = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    langs = groups.groupBy("lang").agg(F.count("*").alias("n_sources")).join(kept.groupBy("lang").agg(F.count("*").alias("n_terms")), "lang", "left")
    langs = _small(langs.join(counts.groupBy("lang").agg(F.sum("count").alias("n_lang")), "lang", "left").na.fill(0))
    heads = written(groups.join(of_group, ["lang", "source"], "left").na.fill(0).join(langs, "lang").select("lang", "source", "n", "n_lang", "n_terms", "n_sources"), "heads")

    tiles = F.ceil(F.col("n_sources") / tile).cast("int")
    own = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    in_shard = kept.groupBy("lang", "shard").agg(F.count("*").alias("in_shard"))
    named = heads.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)).cast("array<bigint>"))).join(in_shard, ["lang", "shard"], "left").na.fill(0, ["in_shard"])
    cells = ["lang", "source", "shard", "n_sources", "slot", "count", "n", "n_terms", "in_shard"]
    none = F.lit(None)
    both = named.withColumns({"slot": none.cast("int"), "count": none.cast("long")}).select(*cells).unionByName(
        counts.join(langs.select("lang", "n_sources"), "lang").withColumns({c: none.cast("long") for c in ("n", "n_terms", "in_shard")}).select(*cells)
    )
    both = both.withColumn("tiles", tiles).withColumn("tile", own)
    numbers = F.sequence(F.lit(0), F.col("tiles") - 1)
    here, there = F.transform(numbers, lambda j: F.struct(F.col("tile").alias("i"), j.alias("j"))), F.transform(numbers, lambda i: F.struct(i.alias("i"), F.col("tile").alias("j")))
    cell = both.withColumn("cell", F.explode(F.array_distinct(F.concat(here, there)))).select("lang", "source", "shard", "slot", "count", "n", "n_terms", "in_shard", "tile", "cell.i", "cell.j")
    pairs = cell.groupBy("lang", "shard", "i", "j").applyInArrow(_compared, "lang string, source string, item string, value long")
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value")).withColumn("part", F.lit("pair"))

    # decimals where a product passes a long
    p = lambda count, n: F.expr(
        f"1 + if({count} < {(1 << 62) // SCALE}, ({SCALE}L * ({count} + 1)) div ({n} + n_terms), (cast({SCALE} as decimal(10,0)) * cast({count} + 1 as decimal(20,0))) div cast({n} + n_terms as decimal(20,0)))"
    )
    of_lang = counts.groupBy("lang", "shard", "slot").agg(F.sum("count").alias("in_lang"))
    shares = counts.join(of_lang, ["lang", "shard", "slot"]).join(_small(heads), ["lang", "source"]).withColumns({"p": p("count", "n"), "q": p("in_lang", "n_lang")}).where("p > q")
    terms = shares.join(kept, ["lang", "shard", "slot"]).select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"), F.lit("term").alias("part"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).alias("rank")
    columns = ["lang", "source", "part", "item", "value"]
    return pairs.select(*columns, rank).unionByName(terms.select(*columns, rank).where(F.col("rank") <= term_ranks))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(read(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), w AS (SELECT i, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY 1, 2 HAVING count(DISTINCT i) >= 3),
grp AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM grp) g LEFT JOIN kept k USING (lang) GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
full_c AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c FROM grp g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang, source) + v) AS p FROM full_c JOIN v USING (lang)),
l AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang) + v) AS q FROM (SELECT lang, term, sum(c) AS c FROM full_c GROUP BY 1, 2) JOIN v USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(f), 0)::BIGINT AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS s, y.source AS o, ((x.p - y.p) * (x.p - y.p)) // y.p AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source) t
  ON t.lang = a.lang AND t.s = a.source AND t.o = b.source GROUP BY 1, 2, 3),
term AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p JOIN l USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT *, 'pair' AS part FROM pair UNION ALL BY NAME SELECT *, 'term' AS part FROM term)
SELECT * FROM (SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM ranked)
WHERE part = 'pair' OR rank <= 200
"""
