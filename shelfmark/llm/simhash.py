"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into two segments of 32 bits. Of two fingerprints that differ in at most two bits, one segment
differs in at most one, so both fingerprints share one of that segment's 32 one-wildcard variants. Fingerprints are
indexed under these variants (and under the exact segments), joined by equality, and verified on all 64 bits.

Only distinct fingerprints are linked, and of the links in a bucket only a spanning forest leaves it. A variant with more
than ``bucket`` fingerprints is not compared pair by pair: its fingerprints are indexed again with wildcards in the other segment too. Equality there leaves two free bits, so
such a group has four fingerprints at most, all of them linked. No link is lost, and no group is expanded into pairs.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, shingles are three words, repeats included; a shorter text is
one shingle; a text without words (or null) has fingerprint zero and links as any other. A null ``doc_id`` takes part
but is never a ``component_id`` unless its whole component has none. Repeated rows each come back with the same
component. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import joined_hot, partitions, read, texts, tidy, written
from shelfmark.llm.graph import components, forest
from shelfmark.llm.near_copies import drop_near_copies

SHINGLE, SEED, BUCKET = 3, 42, 4096
_AT_ONCE = 200_000


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    """XXH64 of each space-joined shingle; ``text`` is UTF-8."""
    words = text.lower().split()  # of bytes: A-Z, and the six ASCII spaces
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[size:])]  # noqa: B905


def _majorities(hashes: list[int], sizes: list[int]) -> np.ndarray:
    """The fingerprint of each run of ``hashes``: the bits set in over half of them."""
    out = np.zeros(len(sizes), np.uint64)
    n = np.array(sizes, np.int64)
    some = np.flatnonzero(n)
    if len(some):
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begin = (np.cumsum(n) - n)[some]
        counts = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * counts > n[some, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts, hashes, sizes = [np.zeros(0, np.uint64)], [], []
        for text in batch.column("text"):
            own = shingle_hashes(text.as_py())
            hashes += own
            sizes.append(len(own))
            if len(hashes) > _AT_ONCE:
                parts.append(_majorities(hashes, sizes))
                hashes, sizes = [], []
        parts.append(_majorities(hashes, sizes))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.concatenate(parts).view(np.int64))], names=["doc_id", "fp"]
        )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long) of each row."""
    rows = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(tidy(_fingerprints), "doc_id long, fp long")


def _low(column):
    return column.bitwiseAND(F.lit(0xFFFFFFFF))


def _high(column):
    return F.shiftrightunsigned(column, 32)


def _without(segment, bit):
    """``segment`` with the bit numbered ``bit`` cleared; all its bits where ``bit`` is 32."""
    return segment.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))))


def _keyed(fps: DataFrame) -> DataFrame:
    """Each fingerprint under its 2 x (32 one-wildcard variants + the exact segment): ``key, fp``."""
    variant = F.explode(F.array(*[F.lit(v).cast("long") for v in range(66)])).alias("variant")
    segment = F.when(F.col("variant") < 33, _high(F.col("fp"))).otherwise(_low(F.col("fp")))
    key = F.shiftleft(F.col("variant"), 32).bitwiseOR(_without(segment, F.col("variant") % 33))
    return fps.select("fp", variant).select(key.alias("key"), "fp")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the fingerprints of each small bucket; what is linked comes out as edges of a spanning forest."""

    def edges(flat, left, right):
        if not left:
            return
        label = forest(np.concatenate(left), np.concatenate(right), len(flat))
        moved = np.flatnonzero(label != np.arange(len(flat)))
        pairs = np.unique(np.stack([flat[moved], flat[label[moved]]]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)) for p in np.ascontiguousarray(pairs)], names=["a", "b"])

    for batch in batches:
        members = batch.column("members")
        flat = members.flatten().to_numpy().view(np.uint64)
        sizes = np.asarray(members.value_lengths(), np.int64)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left, right, held = [], [], 0
        at = np.arange(len(flat))
        for gap in range(1, int(sizes.max(initial=0))):
            at = at[place[at] >= gap]
            near = at[np.bitwise_count(flat[at] ^ flat[at - gap]) <= 2]
            if len(near):
                left.append(near)
                right.append(near - gap)
                held += len(near)
            if held > 1_000_000:
                yield from edges(flat, left, right)
                left, right, held = [], [], 0
        yield from edges(flat, left, right)


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a, b`` whose components are those of all pairs of distinct ``fp`` that differ in two bits or fewer."""
    # dealt out anew: each row becomes 66
    keyed = _keyed(fps.repartition(4 * partitions(fps.sparkSession), "fp"))
    counted = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    counted = written(counted, "buckets")
    pairs = counted.where("n = 2").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2).select("a", "b")
    shared = joined_hot(keyed, counted.where("n > 2").select("key", "n"), "key")
    small = (
        shared.where(F.col("n") <= bucket)
        .groupBy("key")
        .agg(F.collect_list("fp").alias("members"))
        .select("members")
        .mapInArrow(tidy(_verified), "a long, b long")
    )
    hot = shared.where(F.col("n") > bucket).select(
        "key", "fp", F.shiftrightunsigned("key", 32).alias("variant")
    ).withColumn("other", F.when(F.col("variant") < 33, _low(F.col("fp"))).otherwise(_high(F.col("fp"))))
    one = F.explode(F.array(*[F.lit(j) for j in range(32)])).alias("j")
    two = F.explode(F.array(*[F.lit(i * 33 + j) for i in range(32) for j in range(i)])).alias("j")
    again = (
        hot.where("variant % 33 < 32").select("key", "fp", "other", one).withColumn("rest", _without(F.col("other"), F.col("j")))
    ).unionByName(
        hot.where("variant % 33 = 32")
        .select("key", "fp", "other", two)
        .withColumn("rest", _without(_without(F.col("other"), F.floor(F.col("j") / 33)), F.col("j") % 33))
    )
    stars = (
        again.groupBy("key", "j", "rest")
        .agg(F.min("fp").alias("a"), F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
        .select("a", F.explode("members").alias("b"))
        .where("a <> b")
    )
    return pairs.unionByName(small).unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits), ``component_id`` (smallest doc_id reachable)."""
    prints = written(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n"))
    found = components(links(distinct.select("fp"), bucket))
    roots = distinct.join(found, distinct.fp == found.node, "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("root"), "n"
    )
    named = roots.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = written(roots.select("fp", "root", "n").join(named, "root").select("fp", "component_id", "n"), "classes")
    return joined_hot(prints, classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with all its columns; of each group of near copies the rows of the smallest id stay.

    A filter takes five words and a Jaccard similarity of 0.8. Near fingerprints (of those shingles) come first, by ``links``,
    and are verified. Texts of that similarity may differ in some ten bits, which segments cannot find by equality, so an
    exact join of the sets (``near_copies``) finds what fingerprints miss.
    """
    return drop_near_copies(docs, id_col, text_col, linked=links, **options)


def op9_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))
