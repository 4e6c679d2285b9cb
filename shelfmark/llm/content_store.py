"""Token ids in a content-addressed store.

Texts are encoded, and each id stream is cut where a rolling hash of its last ids hits a pattern, so that equal passages
give equal chunks wherever they stand. A chunk is known by its SHA-256 and stored once, with the first document (by
``doc_id``) that has it. The files of a store, in ascending ``doc_id`` order:

``documents``: one row per document: its place (``part``, ``start`` within the part), the Merkle root of its chunks, its
recipe (the chunks' digests), and the bytes of those chunks of which it is the owner (others are null; ``missing`` has their
places). ``shared`` tells which of its chunks other documents need too, ``uses`` how often the most used of these is.
``parts``: one row per part: the number of ids in it and the Merkle root of its documents' roots.

Reading back resolves recipes, checks every chunk against its digest and every document and part against its Merkle
root, and raises ``CorruptStore`` if one fails. Roots of parts are folded as documents stream by, in memory that grows
with the logarithm of their number.

A null text counts as empty: a document of the end id alone. A null ``doc_id`` comes first. Rows that share a ``doc_id``
are stored one after the other, each as a document of its own. An empty table gives an empty store. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import tokens
from shelfmark.llm.common import HOT_ROWS, discard, joined_hot, new_path, partitions, read, texts, tidy, written

END, WINDOW, LEAST, MOST, MASK = 0, 16, 64, 8192, (1 << 9) - 1


class Merkle:
    """The root of digests that come one after the other, as ``merkle_root`` gives it."""

    def __init__(self):
        self.held: list[tuple[int, bytes]] = []

    def add(self, digest: bytes) -> None:
        level = 0
        while self.held and self.held[-1][0] == level:
            digest = hashlib.sha256(self.held.pop()[1] + digest).digest()
            level += 1
        self.held.append((level, digest))

    def root(self) -> bytes:
        if not self.held:
            return merkle_root([])
        root = self.held[-1][1]
        for _, left in self.held[-2::-1]:
            root = hashlib.sha256(left + root).digest()
        return root


class CorruptStore(Exception):
    """A chunk, document or part does not match its digest."""


def merkle_root(digests: list[bytes]) -> bytes:
    """Pairs are hashed level by level; a digest left over moves up as it is."""
    level = list(digests) or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        up = [hashlib.sha256(a + b).digest() for a, b in zip(level[::2], level[1::2])]  # noqa: B905
        level = up + level[len(up) * 2 :]
    return level[0]


def _gear(size: int) -> np.ndarray:
    return np.random.default_rng(11).integers(0, 1 << 63, size, np.uint64)


def _hits(ids: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """Places after which the rolling hash of the last ``WINDOW`` ids lets a stream be cut."""
    # the bits that are looked at do not depend on higher ones
    rolling, n = gear.astype(np.uint32)[ids], 1
    while n < WINDOW:  # a power of two: the hash of 2 n ids is that of the last n and that of the n before, shifted
        before = rolling[:-n] << np.uint32(n)
        rolling[n:] += before
        n *= 2
    return np.flatnonzero(rolling & np.uint32(MASK << 20) == 0) + 1


def cut_points(n: int, hits: list[int]) -> list[int]:
    """The ends of the chunks of a stream of ``n`` ids."""
    ends, at = [], 0
    for hit in hits:
        while hit - at > MOST:
            at += MOST
            ends.append(at)
        if hit - at >= LEAST and hit < n:
            ends.append(hit)
            at = hit
    while n - at > MOST:
        at += MOST
        ends.append(at)
    return [*ends, n]


def _encoded(path: str, end: int):
    """Ids, chunk ends and chunk digests of each text; rows are numbered within the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.Encoder(path, end)
        gear = _gear(encoder.size)
        size, row = encoder.dtype.itemsize, TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, n, ids, stops in encoder.encode(batch.column("text")):
                begins = np.append(0, stops[:-1])
                # a hash may reach into the text before: such places are cut by the text's own ids all the same
                hits = _hits(ids, gear)
                low, high = np.searchsorted(hits, begins + WINDOW), np.searchsorted(hits, stops, "right")
                raw = memoryview(np.ascontiguousarray(ids)).cast("B")
                ends, digests = [], []
                for a, b, x, y in zip(begins.tolist(), stops.tolist(), low.tolist(), high.tolist(), strict=True):
                    own = cut_points(b - a, (hits[x:y] - a).tolist())
                    ends.append(own)
                    digests.append([hashlib.sha256(raw[(a + i) * size : (a + j) * size]).digest() for i, j in zip([0, *own], own)])  # noqa: B905
                rows = np.arange(row, row + n)
                row += n
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, n), pa.array(rows), tokens.as_binary(ids, stops), pa.array(ends, pa.list_(pa.int32())),
                        pa.array(digests, pa.list_(pa.binary())),
                    ],
                    names=["doc_id", "row", "ids", "ends", "recipe"],
                )

    return run


_DOCUMENTS = (
    "doc_id long, row long, part int, start long, n_ids int, root binary, recipe array<binary>, sizes array<int>, "
    "chunks array<binary>, shared array<boolean>, missing array<int>, uses long, part_ids long, part_root binary"
)


def _laid_out(size: int):
    """Reads (notes of a document, document) in ascending order; adds places and roots, drops chunks that others own.

    The last document of a part also has the part's number of ids and its root.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, merkle = TaskContext.get().partitionId(), 0, Merkle()
        notes: dict[int, bool] = {}
        noted, uses, held = None, None, None
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in _SCHEMA}
            rows, recipes, ends = (batch.column(c).to_pylist() for c in ("row", "recipe", "ends"))
            for i, (doc_id, row, ids) in enumerate(zip(batch.column("doc_id").to_pylist(), rows, batch.column("ids"), strict=True)):
                if not ids.is_valid:
                    noted, notes = row, dict(zip(batch.column("note")[i].as_py(), batch.column("owned")[i].as_py(), strict=True))
                    uses = batch.column("uses")[i].as_py()
                    continue
                own = notes if noted == row else {}
                raw, bounds = ids.as_py(), [0, *ends[i]]
                root = merkle_root(recipes[i])
                merkle.add(root)
                values = (
                    doc_id, row, part, start, bounds[-1], root, recipes[i], [b - a for a, b in zip(bounds, ends[i])],  # noqa: B905
                    [raw[a * size : b * size] if own.get(k, True) else None for k, (a, b) in enumerate(zip(bounds, ends[i]))],  # noqa: B905
                    [own.get(k, False) for k in range(len(ends[i]))], sorted(k for k, mine in own.items() if not mine) or None, uses if own else None, None, None,
                )
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
                start += bounds[-1]
            if out["row"]:
                if held:
                    yield _laid_batch(held)
                held = out
        if held:
            held["part_ids"][-1], held["part_root"][-1] = start, merkle.root()
            yield _laid_batch(held)

    return run


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("row", pa.int64()), ("part", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int32()), ("root", pa.binary()),
        ("recipe", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int32())), ("chunks", pa.list_(pa.binary())), ("shared", pa.list_(pa.bool_())),
        ("missing", pa.list_(pa.int32())), ("uses", pa.int64()), ("part_ids", pa.int64()), ("part_root", pa.binary()),
    ]
)


def _laid_batch(columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in _SCHEMA], schema=_SCHEMA)


def write_store(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` and write them as a store below ``path``."""
    spark = docs.sparkSession
    vocabulary = vocabulary or tokens.vocabulary(tokens.BYTE_BPE)
    size = tokens.Encoder(vocabulary, end, 1 << 10).dtype.itemsize
    encoded = written(
        texts(docs, id_col, text_col).mapInArrow(
            tidy(_encoded(vocabulary, end)), "doc_id long, row long, ids binary, ends array<int>, recipe array<binary>"
        ),
        "ids",
    )
    # Only digests are shuffled to find the owners; and only chunks that occur again make notes for their documents.
    uses = encoded.select("doc_id", "row", F.posexplode("recipe").alias("i", "digest"))
    owners = written(uses.groupBy("digest").agg(F.min(F.struct("doc_id", "row", "i")).alias("owner"), F.count("*").alias("n")).where("n > 1"), "owners")
    mine = (F.col("owner.row") == F.col("row")) & (F.col("owner.i") == F.col("i"))
    notes = (
        joined_hot(uses, owners, "digest")
        .groupBy("doc_id", "row")
        .agg(F.collect_list("i").alias("note"), F.collect_list(mine).alias("owned"), F.max(F.when(mine, F.col("n"))).alias("uses"))
    )
    rows = encoded.select("doc_id", "row", "ids", "ends", "recipe", F.lit(None).cast("array<int>").alias("note"), F.lit(None).cast("array<boolean>").alias("owned"), F.lit(None).cast("long").alias("uses"))
    rows = rows.unionByName(notes, allowMissingColumns=True)
    (
        rows.repartitionByRange(partitions(spark), "doc_id", "row")
        .sortWithinPartitions("doc_id", "row", F.col("ids").isNotNull())
        .mapInArrow(tidy(_laid_out(size)), _DOCUMENTS)
        .write.option("compression", "zstd")
        .parquet(f"{path}/documents")
    )
    for table in (encoded, owners):
        discard(table)
    stored = spark.read.schema(_DOCUMENTS).parquet(f"{path}/documents")
    # a row per part
    stored.where("part_root IS NOT NULL").select("part", F.col("part_ids").alias("n_ids"), F.col("part_root").alias("root")).coalesce(1).write.parquet(f"{path}/parts")


def _part_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part, n_ids, root`` of parts whose documents stream by in order."""

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n_ids]), pa.array([merkle.root()], pa.binary())], names=["part", "n_ids", "root"])

    part, n_ids, merkle = None, 0, Merkle()
    for batch in batches:
        for here, n, root in zip(*(batch.column(c).to_pylist() for c in ("part", "n_ids", "root")), strict=True):
            if here != part:
                if part is not None:
                    yield done()
                part, n_ids, merkle = here, 0, Merkle()
            n_ids += n
            merkle.add(root)
    if part is not None:
        yield done()


def _read_back(width: str, keep_ids: bool):
    size = np.dtype(width).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "part", "start", "root", "recipe", "sizes", "chunks", "fetched"))
            for doc_id, part, start, root, recipe, sizes, chunks, fetched in zip(*columns, strict=True):
                if fetched:
                    found = {f["i"]: f["chunk"] for f in fetched}
                    chunks = [c if c is not None else found.get(i) for i, c in enumerate(chunks)]
                for chunk, digest, n in zip(chunks, recipe, sizes, strict=True):
                    if chunk is None or len(chunk) != n * size or hashlib.sha256(chunk).digest() != digest:
                        raise CorruptStore(f"document {doc_id}: chunk {digest.hex()}")
                if merkle_root(recipe) != root:
                    raise CorruptStore(f"document {doc_id}: Merkle root")
                ids = b"".join(chunks)
                out.append((doc_id, part, start, len(ids) // size, tokens.crc32_of_ids(np.frombuffer(ids, width)), len(chunks), root.hex(), ids if keep_ids else None))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ["doc_id", "part", "start", "n_tokens", "ids_crc32", "n_chunks", "merkle_root", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names=names)

    return run


def _check_parts(spark: SparkSession, path: str) -> DataFrame:
    """``part, before`` (ids of all parts before it), after checking each part's Merkle root."""
    stored = spark.read.schema(_DOCUMENTS).parquet(f"{path}/documents").select("part", "start", "n_ids", "root")
    again = stored.repartition("part").sortWithinPartitions("part", "start").mapInArrow(tidy(_part_roots), "part int, n_ids long, root binary")
    parts = spark.read.parquet(f"{path}/parts")
    wrong = parts.join(again.select("part", F.col("n_ids").alias("n2"), F.col("root").alias("r2")), "part", "full").where("NOT (n_ids <=> n2 AND root <=> r2)")
    if found := wrong.select("part").head(1):
        raise CorruptStore(f"part {found[0][0]}: Merkle root")
    # one row per part, as few as the shuffle has partitions
    before, rows = 0, []
    for r in parts.select("part", "n_ids").orderBy("part").collect():
        rows.append((r["part"], before))
        before += r["n_ids"]
    return spark.createDataFrame(rows, "part int, before long")


def read_store(spark: SparkSession, path: str, vocabulary: str | None = None, keep_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, n_chunks, merkle_root, ids`` of each document, rebuilt and verified."""
    width = tokens.Encoder(vocabulary or tokens.vocabulary(tokens.BYTE_BPE), END, 1 << 10).dtype.str
    stored = spark.read.schema(_DOCUMENTS).parquet(f"{path}/documents").drop("part_ids", "part_root")
    # who needs what is told without reading a chunk's bytes
    needs = stored.where("missing IS NOT NULL").select("row", "recipe", F.explode("missing").alias("i"))
    needs = needs.select("row", "i", F.get("recipe", "i").alias("digest"))
    kept = stored.where("uses IS NOT NULL").select(F.explode(F.arrays_zip("recipe", "chunks", "shared")).alias("c")).where("c.shared AND c.chunks IS NOT NULL")
    kept = kept.select(F.col("c.recipe").alias("digest"), F.col("c.chunks").alias("chunk"))
    if (stored.agg(F.max("uses")).first()[0] or 0) > HOT_ROWS:
        # a chunk of very many documents is fetched by as many tasks as share it
        found = joined_hot(needs, kept.join(needs.groupBy("digest").agg(F.count("*").alias("n")), "digest"), "digest")
    else:
        found = needs.join(kept, "digest")
    fetched = found.groupBy("row").agg(F.collect_list(F.struct("i", "chunk")).alias("fetched"))
    # whole documents need no shuffle
    whole = stored.where("missing IS NULL").withColumn("fetched", F.lit(None).cast("array<struct<i:int,chunk:binary>>"))
    mended = stored.where("missing IS NOT NULL").join(fetched, "row", "left").select(*whole.columns)
    rebuilt = whole.unionByName(mended).mapInArrow(
        tidy(_read_back(width, keep_ids)), "doc_id long, part int, start long, n_tokens long, ids_crc32 long, n_chunks long, merkle_root string, ids binary"
    )
    return rebuilt.join(F.broadcast(_check_parts(spark, path)), "part").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "n_chunks", "merkle_root", "ids"
    )


def op6_content_store(spark, sf_dir):
    path = new_path(spark, "store")
    write_store(read(spark, sf_dir, "documents"), path)
    return read_store(spark, path, keep_ids=False).drop("ids")
