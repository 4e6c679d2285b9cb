"""Near copies by the exact Jaccard similarity of their sets of word shingles.

The near stage of the corpus pipeline takes five words and a similarity of 0.8, at which SimHash fingerprints differ in some
ten bits: no cut into segments finds those by equality. So the filter of operator 9 joins sets exactly instead.

Two sets of similarity ``least`` or more share a member among the first ``n - ceil(least * n) + 1`` of each, in any one
order of all shingles (prefix filtering), so no pair is lost. The order puts shingles that a sample of documents has
often last; that only makes candidates fewer.

1. Documents of equal sets are one node. Nodes are indexed under the shingles of their prefixes.
2. SimHash fingerprints of the sets are linked where they differ in two bits or fewer (``linked``, operator 9's join), and
   under each shingle the nodes are compared with the least of them. Groups of many near copies are joined by this.
3. While shingles have many open nodes (``MANY`` comparisons a node on average), each node names the most promising node of
   another component under each shingle, ``ROUNDS`` times at most.
4. What is not connected then is compared pair by pair under each shingle.

Candidates whose sizes and places in the order allow ``least``, and whose sketches do, are verified on their whole sets. A
sketch has one bit for each residue of a shingle's hash: whether an odd number of the set's shingles have it. Two sketches
differ in no more bits than the sets in shingles, so what they rule out is not similar; of sets of many thousand shingles
they rule out little. No more than a pair for each node and shingle leaves steps 2 and 3, and step 4 gives the pairs
out that sketches allow. The components are those of all pairs: pairs are left out only if they are connected already.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; shingles are told apart by 64-bit hashes; a shorter text is one
shingle; texts without words (or null) are equal. A null ``doc_id`` takes part but is never a ``component_id`` unless its
whole component has none. Repeated rows each come back. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import words
from shelfmark.llm.common import SMALL_IDS, discard, joined_hot, text_key, texts, tidy, without, written
from shelfmark.llm.graph import components

SIZE, LEAST = 5, 0.8
#: Documents sampled to find common shingles (of more, the share of all), how many of these must have one, and shingles that
#: are told apart as common (the most frequent; 16 bytes each in the driver and in tasks).
SAMPLE, SHARE, COMMON, LISTED = 10_000, 0.2, 4, 1 << 20
#: Rows of a batch whose texts become Python objects at once.
PIECE = 1000
#: Bits of a sketch; times that nodes name another node before pairs are compared; comparisons a node from which they do.
BITS, ROUNDS, MANY = 1024, 3, 16


def shingle_sets(texts_: list[bytes], size: int = SIZE) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text, as hashes."""
    for _, some in words.groups(texts_):
        text, word = words.hashed(some, words.BLACK)
        at, gram = words.rolling(text, word, size)
        bounds, ends = np.searchsorted(text[at], np.arange(len(some) + 1)), np.searchsorted(text, np.arange(len(some) + 1))
        for a, b, x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            if b > a or x == y:
                yield np.unique(gram[a:b])
            else:  # fewer words than a shingle: one of them all
                yield words.rolling(np.zeros(y - x, np.int64), word[x:y], y - x)[1] + np.uint64(y - x)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE):
            yield batch.slice(start, PIECE)


def _needed(least: float, total: int) -> int:
    """Members that two sets of ``total`` members together must share."""
    return int(np.ceil(least * total / (1 + least) - 1e-9))


def _counted(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            grams = np.concatenate([np.zeros(0, np.uint64), *shingle_sets(batch.column("text").to_pylist(), size)])
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64))], names=["gram"])

    return run


def common_shingles(rows: DataFrame, size: int = SIZE, sample: int = SAMPLE, common: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (``LISTED`` at most) that ``common`` or more sampled documents have, sorted, and how many have them.

    The sample grows with the documents: what is common among them must not become rare in it.
    """
    some = rows.select("text").sample(min(1.0, max(SHARE, sample / max(1, rows.count()))), seed=5)
    often = written(some.mapInArrow(tidy(_counted(size)), "gram long").groupBy("gram").count().where(F.col("count") >= common), "common")
    found = often
    if often.count() > LISTED:
        # a row for each count, which is at most the sample's
        held, least = 0, None
        for r in often.groupBy("count").agg(F.count("*").alias("grams")).orderBy(F.desc("count")).toLocalIterator():
            held += r["grams"]
            if held > LISTED:
                break
            least = r["count"]
        found = often.where(F.lit(False) if least is None else F.col("count") >= least)
    found = found.toArrow()
    discard(often)
    gram, n = found["gram"].to_numpy().view(np.uint64), found["count"].to_numpy()
    order = np.argsort(gram)
    return gram[order], n[order]


def _mixed(grams: np.ndarray) -> np.ndarray:
    x = grams * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sketch(grams: np.ndarray) -> bytes:
    """The parities of a set's hashes by residue."""
    counts = np.bincount((_mixed(grams) % np.uint64(BITS)).astype(np.int64), minlength=BITS)
    return np.packbits(counts.astype(np.uint8) & 1).tobytes()


def fingerprint(grams: np.ndarray) -> int:
    """The set's SimHash, as a long: the bits that over half of its hashes have."""
    bits = np.unpackbits(_mixed(grams).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(grams), bitorder="little").view(np.int64)[0])


_INDEXED = "row long, doc_id long, key long, digest binary, n int, fp long, bits binary, keys array<long>"


def _indexed(size: int, least: float, gram: np.ndarray, often: np.ndarray):
    """The set's digest, its size, fingerprint and sketch, and its prefix in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            digests, sizes, prints, sketches, keys = [], [], [], [], []
            for own in shingle_sets(batch.column("text").to_pylist(), size):
                digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                sizes.append(len(own))
                prints.append(fingerprint(own))
                sketches.append(sketch(own))
                if len(gram):
                    at = np.minimum(np.searchsorted(gram, own), len(gram) - 1)
                    own = own[np.argsort(np.where(gram[at] == own, often[at], 0), kind="stable")]
                prefix = len(own) - int(np.ceil(least * len(own) - 1e-9)) + 1 if len(own) else 0
                keys.append(own[:prefix].view(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *keys])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("doc_id"), batch.column("key"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(prints, pa.int64()),
                    pa.array(sketches, pa.binary()), pa.ListArray.from_arrays(ends, flat),
                ],
                names=[x.split()[0] for x in _INDEXED.split(", ")],
            )

    return run


def _possible(least: float, n, at, m, other_at):
    """Whether sets of these sizes that first meet at these places can be similar enough."""
    needed = F.ceil(least * (n + m) / (1 + least) - 1e-9)
    return F.least(n - at, m - other_at) >= needed


def _words(column) -> np.ndarray:
    """Sketches as rows of 64-bit words."""
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.uint64).reshape(-1, BITS // 64)


def _far(least: float, n: np.ndarray, m: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """By how many bits sketches differ more than sets of these sizes may that are similar enough."""
    needed = np.ceil(least * (n + m) / (1 + least) - 1e-9).astype(np.int64)
    return np.bitwise_count(x ^ y).sum(1, dtype=np.int64) - (n + m - 2 * needed)


def _candidates(least: float, best: bool):
    """Pairs ``a < b`` of each bucket's members where components differ and sketches allow similarity; with ``best``, of
    each member the pair of the nearest sketches only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("members")
            fields, sizes = members.flatten(), np.asarray(members.value_lengths(), np.int64)
            bucket = np.repeat(np.arange(len(sizes)), sizes)
            row, n, at, component = (fields.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("row", "n", "at", "component"))
            order = np.lexsort((row, bucket))
            row, n, at, component, bits = (x[order] for x in (row, n, at, component, _words(fields.field("bits"))))
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            found, held, left = [np.zeros((2, 0), np.int64)], 0, np.arange(len(row))
            nearest, partner = np.full(len(row), np.iinfo(np.int64).max), np.arange(len(row))
            for gap in range(1, int(sizes.max(initial=0))):
                left = left[place[left] >= gap]
                here = left[component[left] != component[left - gap]]
                other = here - gap
                needed = np.ceil(least * (n[here] + n[other]) / (1 + least) - 1e-9)
                here = here[np.minimum(n[here] - at[here], n[other] - at[other]) >= needed]
                other = here - gap
                far = _far(least, n[here], n[other], bits[here], bits[other])
                here, other, far = here[far <= 0], other[far <= 0], far[far <= 0]
                if best:
                    for x, y in ((here, other), (other, here)):  # a gap has each member once on either side
                        nearer = far < nearest[x]
                        nearest[x[nearer]], partner[x[nearer]] = far[nearer], y[nearer]
                    continue
                found.append(np.stack([row[other], row[here]]))
                held += len(here)
                if held > 500_000:
                    yield _pairs(found)
                    found, held = [np.zeros((2, 0), np.int64)], 0
            if best:
                some = np.flatnonzero(partner != np.arange(len(row)))
                x, y = row[some], row[partner[some]]
                found.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))
            yield _pairs(found)

    return run


def _allowed(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "m"))
            far = _far(least, n, m, _words(batch.column("x")), _words(batch.column("y")))
            yield batch.select(["a", "b"]).filter(pa.array(far <= 0))

    return run


def _pairs(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(p)) for p in pairs], names=["a", "b"])


def _similar(size: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            sides = (shingle_sets(batch.column(c).to_pylist(), size) for c in ("left", "right"))
            for x, y in zip(*sides, strict=True):
                both = np.concatenate([x, y])
                both.sort()
                keep.append(int((both[1:] == both[:-1]).sum()) >= _needed(least, len(both)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_copies(
    docs: DataFrame, size: int = SIZE, least: float = LEAST, sample: int = SAMPLE, common: int = COMMON,
    id_col: str = "doc_id", text_col: str = "text", linked: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, key`` (a hash of the text), ``component_id`` (smallest doc_id reachable over similar
    pairs). ``linked`` gives the pairs ``a, b`` of near fingerprints ``fp``."""
    rows = texts(docs, id_col, text_col).select("doc_id", text_key("text").alias("key"), F.col("text").cast("binary").alias("text"))
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    indexed = numbered.mapInArrow(tidy(_indexed(size, least, *common_shingles(rows, size, sample, common))), _INDEXED)
    indexed = written(indexed, "prefixes")
    nodes = written(indexed.groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id"), F.count("*").alias("n")), "nodes")
    # nodes of several documents are few beside the others: the rows that are no nodes are left out by them
    copies = indexed.select("digest", "row").join(nodes.where("n > 1").select("digest", "node"), "digest").where("row <> node").select("row")
    single = indexed.join(copies, "row", "left_anti")
    keyed = single.select("row", "n", F.posexplode("keys").alias("at", "gram"))
    by_gram = Window.partitionBy("gram").orderBy("row")
    shared = keyed.withColumn("head", F.first(F.struct("row", "n", "at")).over(by_gram)).withColumn("next", F.lead("row").over(by_gram))
    # rows of shingles that other nodes have in their prefix too
    shared = written(shared.where("row <> head.row OR next IS NOT NULL").drop("next"), "shared")

    sketches = written(single.select("row", F.col("n").alias("size"), "bits", "fp"), "sketches")

    def allowed(pairs: DataFrame) -> DataFrame:
        x, y = (sketches.select(F.col("row").alias(r), F.col("size").alias(n), F.col("bits").alias(bits)) for r, n, bits in (("a", "n", "x"), ("b", "m", "y")))
        return written(pairs.join(x, "a").join(y, "b").mapInArrow(tidy(_allowed(least)), "a long, b long"), "allowed")

    def verified(pairs: DataFrame) -> DataFrame:
        # a row's text is found again by its id and its hash; rows that share both have one text
        wanted = indexed.select("row", F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
        wanted = written(wanted.join(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "row"), "wanted")
        same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key"))
        some = rows.join(F.broadcast(wanted) if wanted.count() <= SMALL_IDS else wanted, same).select("row", "text").dropDuplicates(["row"])
        some = written(some, "texts")
        left, right = (some.select(F.col("row").alias(x), F.col("text").alias(side)) for x, side in (("a", "left"), ("b", "right")))
        found = written(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(tidy(_similar(size, least)), "a long, b long"), "edges")
        for table in (wanted, some):
            discard(table)
        return found

    may = _possible(least, F.col("head.n"), F.col("head.at"), F.col("n"), F.col("at"))
    first = shared.where("row <> head.row").where(may).select(F.col("head.row").alias("a"), F.col("row").alias("b"))
    if linked is not None:
        prints = sketches.groupBy("fp").agg(F.min("row").alias("least"))
        equal = sketches.join(prints, "fp").where("row <> least").select(F.col("least").alias("a"), F.col("row").alias("b"))
        ends = [prints.select(F.col("fp").alias(f"fp_{x}"), F.col("least").alias(x)) for x in ("a", "b")]
        near = linked(prints.select("fp")).select(F.col("a").alias("fp_a"), F.col("b").alias("fp_b")).join(ends[0], "fp_a").join(ends[1], "fp_b")
        first = first.unionByName(equal).unionByName(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    tried = written(first.distinct(), "stars")
    found = components(verified(allowed(tried)))

    def labelled() -> DataFrame:
        return shared.select("gram", "row", "n", "at").join(found.withColumnRenamed("node", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))

    def opened() -> DataFrame:
        # shingles of three nodes and more, not all of one component
        groups = labelled().groupBy("gram").agg(F.count("*").alias("m"), F.min("component").alias("low"), F.max("component").alias("high"))
        return written(groups.where("m > 2 AND low <> high").select("gram", "m"), "open")

    def candidates(open_: DataFrame, best: bool) -> DataFrame:
        members = labelled().join(open_.select("gram"), "gram").join(sketches.select("row", "bits"), "row")
        members = members.groupBy("gram").agg(F.collect_list(F.struct("row", "n", "at", "component", "bits")).alias("members"))
        pairs = members.select("members").mapInArrow(tidy(_candidates(least, best)), "a long, b long").distinct()
        return written(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")

    best = True
    for left in range(ROUNDS, -1, -1):
        open_ = opened()
        nodes_open, pairs_open = open_.agg(F.sum("m"), F.sum(F.col("m") * (F.col("m") - 1) / 2)).first()
        if not nodes_open:
            break
        best = best and left > 0 and pairs_open > MANY * nodes_open
        more = candidates(open_, best)
        if best and more.isEmpty():
            best, more = False, candidates(open_, False)
        discard(open_)
        if not more.isEmpty():
            # what is connected stays so; its stars stand for the edges
            found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(verified(more)))
            tried = tried.unionByName(more)
        if not best:
            break
    roots = nodes.join(found, "node", "left").select("digest", "least_id", F.coalesce("component", "node").alias("root"), "n")
    named = roots.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = written(roots.join(named, "root").select("digest", "component_id", "n"), "classes")
    out = written(joined_hot(indexed.select("doc_id", "key", "digest"), classes, "digest").select("doc_id", "key", "component_id"), "near")
    for table in (indexed, nodes, shared, sketches, classes):
        discard(table)
    return out


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all its columns; of each group of near copies the rows of the smallest id stay."""
    gone = near_copies(docs, id_col=id_col, text_col=text_col, **options).where("NOT (doc_id <=> component_id)")
    return without(docs, gone, id_col, text_col)
