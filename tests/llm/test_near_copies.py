"""The pipeline's near stage against all pairs."""

import random

import duckdb
import pytest

import corpus_pipeline
from shelfmark.llm import near_copies
from tests.conftest import SF
from tests.llm.frames import empty, odd


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({x: " " for x in (9, 10, 11, 12, 13)}).split(" ")
    words = [w for w in words if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def by_hand(rows):
    """doc_id -> least id of its component, by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in parent}


def edited(seed=6):
    """A large group of copies with edits of all degrees, a chain in which only neighbours are alike, and a common line."""
    rng = random.Random(seed)
    draw = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    base, line, texts = draw(150), draw(12), []
    for _ in range(60):
        t = list(base)
        for _ in range(rng.randrange(9)):
            t[rng.randrange(len(t))] = f"e{rng.randrange(10**6)}"
        texts.append(t)
    chain = draw(400)
    texts += [chain[k : k + 100] for k in range(0, 100, 8)]
    texts += [[*draw(20), *line, *draw(20)] for _ in range(30)]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("common", [5, 10**6])
def test_edited_copies(spark, common):
    rows = edited()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(df, common=common).collect()}
    want = by_hand(rows)
    assert got == want and 30 < len(set(want.values())) < len(rows)


def test_near_stage_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, SF).select("doc_id").collect())
    assert kept == [i for i, least in by_hand(rows).items() if i == least]


def test_near_stage_drops_edited_copies(spark):
    rows = edited()
    kept = corpus_pipeline.near_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted(r["doc_id"] for r in kept) == [i for i, least in by_hand(rows).items() if i == least]


def test_odd_rows(spark):
    left = near_copies.drop_near_copies(odd(spark))
    assert left.columns == odd(spark).columns and {1, 3, 4, 7, 13}.isdisjoint(r["doc_id"] for r in left.select("doc_id").collect())
    assert near_copies.near_copies(odd(spark)).count() == 16 and near_copies.near_copies(empty(spark)).count() == 0


def test_a_batch_is_indexed_in_pieces():
    """A worker holds the Python objects of few texts at a time, and what comes out is the same."""
    import numpy as np
    import pyarrow as pa

    n = 2500
    texts = [f"one two three four five six {i % 7} {i}".encode() for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64())] * 3 + [pa.array(texts, pa.binary())], names=["row", "doc_id", "key", "text"])
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = list(near_copies._indexed(5, 0.8, *none)(iter([batch])))
    assert max(b.num_rows for b in out) <= 1000
    one_by_one = [b for i in range(n) for b in near_copies._indexed(5, 0.8, *none)(iter([batch.slice(i, 1)]))]
    assert pa.Table.from_batches(out).to_pylist() == pa.Table.from_batches(one_by_one).to_pylist()
