"""op3 and op6: exact round trips, and the encoder against the library."""

import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import content_store, packing, tokens
from shelfmark.llm.common import new_path
from tests.conftest import SF
from tests.llm.frames import ODD, empty, odd


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


def library_ids(name, texts, end):
    t = Tokenizer.from_file(tokens.vocabulary(name))
    t.encode_special_tokens = True
    return [np.array(x.ids + [end], "<u4") for x in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", [tokens.WORD_BPE, tokens.BYTE_BPE])
def test_encoder(name):
    rng = random.Random(0)
    pool = "ab zÉé ß\n\t  ''s'll'd12½²_-!?.…　 ́eͅ漢字Ωσς\x85\x1d|<|endoftext|>\r\n"
    texts = [t for _, t in documents()] + ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(4000)] + ["", "<|endoftext|>"]
    want = library_ids(name, texts, 0)
    for remember in (1 << 19, 1 << 14):  # with room for all words, and starting anew again and again
        encoder = tokens.Encoder(tokens.vocabulary(name), 0, remember)
        for _ in range(2):  # the second time from memory
            got = [x for _, _, ids, ends in encoder.encode(pa.array(texts, pa.string())) for x in np.split(ids, ends[:-1])]
            assert len(got) == len(want) and all(np.array_equal(x, y) for x, y in zip(got, want, strict=True))


def test_op6_documents(spark):
    got = {r["doc_id"]: r for r in content_store.op6_content_store(spark, SF).collect()}
    docs, start = documents(), 0
    for (i, _), ids in zip(docs, library_ids(tokens.BYTE_BPE, [t for _, t in docs], 0), strict=True):
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op6_chunks_once_and_corruption(spark):
    path = new_path(spark, "store")
    text = " ".join(f"word{i % 977}" for i in range(6000))
    docs = spark.createDataFrame([(i, text if i % 2 else text[: 9000 + i]) for i in range(20)], "doc_id long, text string").repartition(4)
    content_store.write_store(docs, path)
    stored = spark.read.parquet(f"{path}/documents")
    chunks = stored.select(F.explode(F.arrays_zip("recipe", "chunks")).alias("c")).where("c.chunks IS NOT NULL")
    assert chunks.count() == chunks.select("c.recipe").distinct().count() == stored.select(F.explode("recipe")).distinct().count()
    assert content_store.read_store(spark, path).count() == 20
    bad = new_path(spark, "bad")
    broken = F.transform("chunks", lambda c: F.when(c.isNotNull(), F.concat(F.unhex(F.lit("FFFF")), F.substring(c, 3, 1 << 30))))
    stored.withColumn("chunks", broken).write.parquet(f"{bad}/documents")
    spark.read.parquet(f"{path}/parts").write.parquet(f"{bad}/parts")
    with pytest.raises(Exception, match="CorruptStore"):
        content_store.read_store(spark, bad).collect()


@pytest.mark.parametrize("hot", [2, 50_000])
def test_op6_missing_chunks_are_told_without_their_bytes(spark, monkeypatch, hot):
    monkeypatch.setattr(content_store, "HOT_ROWS", hot)
    monkeypatch.setattr("shelfmark.llm.common.HOT_ROWS", hot)
    path = new_path(spark, "store")
    text = " ".join(f"word{i % 977}" for i in range(6000))
    docs = spark.createDataFrame([(i, text[i % 2 :]) for i in range(12)] + [(12, "alone")], "doc_id long, text string").repartition(3)
    content_store.write_store(docs, path)
    for r in spark.read.parquet(f"{path}/documents").collect():
        assert (r["missing"] or []) == [i for i, c in enumerate(r["chunks"]) if c is None]
        assert (r["uses"] is not None) == any(r["shared"]) and (r["uses"] or 12) >= 2
    got = {r["doc_id"]: r["ids"] for r in content_store.read_store(spark, path).collect()}
    assert len(got) == 13 and got[0] == got[10] and got[1] == got[11] != got[0]
    plan = content_store.read_store(spark, path)._jdf.queryExecution().sparkPlan().toString()
    scans = [x.split("[")[1].split("]")[0] for x in plan.split("\n") if "FileScan parquet [" in x]
    assert any("missing#" in x and "chunks#" not in x for x in scans) and (hot == 2 or sum("chunks#" in x for x in scans) == 3)


def test_op6_hits_are_those_of_the_whole_sum():
    import numpy as np

    gear, rng = content_store._gear(50_257), np.random.default_rng(2)
    for n in (0, 1, 15, 16, 17, 40_000):
        ids = rng.integers(0, 50_257, n).astype("<u2")
        sums = np.zeros(n, np.uint64)
        for j in range(min(content_store.WINDOW, n)):
            sums[j:] += gear[ids][: n - j] << np.uint64(j)
        assert content_store._hits(ids, gear).tolist() == (np.flatnonzero((sums >> np.uint64(20)) & np.uint64(content_store.MASK) == 0) + 1).tolist()


def test_op6_odd_rows(spark):
    path = new_path(spark, "store")
    content_store.write_store(odd(spark), path)
    got = sorted(content_store.read_store(spark, path).collect(), key=lambda r: r["start"])
    assert len(got) == len(ODD) and [r["doc_id"] for r in got][:3] == [None, None, 0]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))  # noqa: B905
    path = new_path(spark, "store")
    content_store.write_store(empty(spark), path)
    assert content_store.read_store(spark, path).count() == 0


def check_pieces(rows, ids, window=4096):
    cover, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]]
        assert zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(own)
        cover[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts, total in [*((cover[i], len(x)) for i, x in ids.items()), *((s, None) for s in sequences.values())]:
        at = 0
        for a, n in sorted(parts):
            assert a == at
            at += n
        if total is None:
            assert at == window or at < window and at & (at - 1) == 0
        else:
            assert at == total


def test_op3_documents(spark):
    docs = documents()
    ids = dict(zip([i for i, _ in docs], library_ids(tokens.WORD_BPE, [t for _, t in docs], 2), strict=True))
    check_pieces(packing.op3_packing(spark, SF).collect(), ids)


def test_op3_neighbours_meet():
    """Documents on one topic fill a window before those on another."""
    rng = np.random.default_rng(1)
    ids = [rng.integers(100 * (i % 3), 100 * (i % 3) + 100, 40).astype("<u2") for i in range(30)]
    df = np.bincount(np.concatenate([np.unique(x) for x in ids]), minlength=300)
    idf = np.log((30 - df + 0.5) / (df + 0.5)).clip(0)
    order = packing.packed_order(ids, idf, 40.0, window=400)
    assert sorted(order) == list(range(30)) and all(len({d % 3 for d in order[k : k + 10]}) == 1 for k in (0, 10, 20))
    index = packing.Index(ids, idf, 40.0)
    scores = [sum(idf[t] * (x == t).sum() * 2.2 / ((x == t).sum() + 1.2 * (0.25 + 0.75 * 40 / 40.0)) for t in np.unique(ids[0])) for x in ids]
    best = sorted((d for d in range(1, 30) if scores[d] > 0), key=lambda d: (-round(scores[d], 9), d))
    assert index.neighbours(0, np.eye(30, dtype=bool)[0]).tolist()[:5] == best[:5]


def test_op3_odd_rows(spark):
    rows = packing.pack(odd(spark)).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 12) == 2 * next(r["doc_tokens"] for r in rows if r["doc_id"] == 12)
    assert {r["doc_id"] for r in rows} == {r[0] for r in ODD} and packing.pack(empty(spark)).count() == 0
