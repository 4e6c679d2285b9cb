"""Exact duplicates by skew-safe combining.

Copies are folded three times, and each time whole texts are compared, not only digests:

1. inside each Arrow batch, before anything is shuffled,
2. inside each (digest, salt) group, so that a third of all rows being one text is spread over ``salts`` tasks,
3. over the salt winners, of which a text has at most ``salts``.

Equal texts are those that are identical after lower-casing A-Z. The row with the largest ``doc_id`` stays.
Rows are then told their winner by digest (SHA-256 and a second hash of 64 bits); only texts of several rows are joined,
and those of very many by broadcast.

A null text counts as empty; a null ``doc_id`` ranks below every other. Rows that share the winning ``doc_id`` and an equal
text are all ``kept`` in the report, which goes by ids; the filter keeps one of them. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import joined_hot, text_key, texts, tidy, unused, without, written

SALTS = 8
_KEYS = "doc_id long, key long, text_sha256 string, text_xxh long"


def normalised(text: bytes) -> bytes:
    return text.lower()  # of bytes: A-Z only


def _keys(text: bytes) -> tuple[str, int]:
    return hashlib.sha256(text).hexdigest(), xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [_keys(normalised(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64())],
            names=["doc_id", "key", "text_sha256", "text_xxh"],
        )


def _local_winners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best: dict[bytes, tuple[int | None, int]] = {}
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            text = normalised(text)
            old, n = best.get(text, (None, 0))
            best[text] = (doc_id if old is None else old if doc_id is None else max(old, doc_id), n + 1)
        keys = [_keys(t) for t in best]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.array(list(best), pa.binary()),
                pa.array([v[0] for v in best.values()], pa.int64()),
                pa.array([v[1] for v in best.values()], pa.int64()),
            ],
            names=["text_sha256", "text_xxh", "content", "keep_id", "n"],
        )


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per distinct text: ``text_sha256, text_xxh, keep_id, group_size``."""
    rows = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    local = rows.mapInArrow(tidy(_local_winners), "text_sha256 string, text_xxh long, content binary, keep_id long, n long")
    salted = (
        local.withColumn("salt", F.pmod(F.xxhash64("keep_id"), F.lit(salts)))
        .groupBy("text_sha256", "text_xxh", "salt", "content")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    )
    return (
        salted.groupBy("text_sha256", "text_xxh", "content")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
        .drop("content")
    )


def _judged(docs: DataFrame, id_col: str, text_col: str, salts: int) -> DataFrame:
    """``doc_id, key, keep_id, group_size, text_sha256, text_xxh`` of every row."""
    rows = texts(docs, id_col, text_col).select("doc_id", text_key("text").alias("key"), F.col("text").cast("binary").alias("text"))
    best = winners(docs, id_col, text_col, salts)
    keys = rows.mapInArrow(tidy(_digests), _KEYS)
    # only texts of several rows have to be looked up; the hot ones are broadcast, so that no task gets all rows of one
    several = written(best.where("group_size > 1").withColumn("n", F.col("group_size")), "winners")
    found = joined_hot(keys, several, ["text_sha256", "text_xxh"], "left").drop("n")
    alone = F.col("group_size").isNull()
    return found.withColumn("keep_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))).withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long")))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per document, dropped ones too: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    return _judged(docs, id_col, text_col, salts).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """``docs`` with all its columns, without the rows that an equal text of a larger ``doc_id`` replaces; of rows that
    share the winning id and an equal text, any one stays."""
    judged = written(_judged(docs, id_col, text_col, salts).where("group_size > 1").select("doc_id", "key", "keep_id", "text_sha256", "text_xxh"), "copies")
    left = without(docs, judged.where("NOT (doc_id <=> keep_id)"), id_col, text_col)
    twice = judged.where("doc_id <=> keep_id").groupBy("doc_id", "text_sha256", "text_xxh").agg(F.count("*").alias("n"), F.collect_set("key").alias("keys")).where("n > 1")
    twice = written(twice.select("doc_id", "text_sha256", F.explode("keys").alias("key")), "twice")
    if twice.isEmpty():
        return left
    # rows that share id and text: few, and only they are grouped
    own_id, own_key, own_sha = unused("id"), unused("key"), unused("sha")
    same = F.col(id_col).cast("long").eqNullSafe(F.col(own_id)) & (text_key(text_col) == F.col(own_key))
    marks = twice.select(F.col("doc_id").alias(own_id), F.col("key").alias(own_key), F.col("text_sha256").alias(own_sha))
    again = left.join(marks, same).drop(own_key).dropDuplicates([own_id, own_sha]).drop(own_id, own_sha)
    return left.join(marks, same, "left_anti").unionByName(again)


def op7_exact_dedup(spark, sf_dir):
    from shelfmark.llm.common import read

    return exact_duplicates(read(spark, sf_dir, "documents"))


OP7_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), g AS (
  SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
