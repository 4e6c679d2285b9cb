"""op1, op7 and op9 against brute force."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
import xxhash

from shelfmark.llm import exact, graph, simhash, suffix
from tests.conftest import SF
from tests.llm.frames import empty, odd, shared_texts
from tests.oracle import oracle, rows_of


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


def without_repeats(docs, depth=100):
    seen, out = set(), {}
    for i, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - depth + 1):
            w = b[k : k + depth]
            if w in seen:
                gone[k : k + depth] = b"\1" * depth
            seen.add(w)
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out[i] = (i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeats(df, **options):
    return {r["doc_id"]: tuple(r)[:5] for r in suffix.remove_repeats(df, **options).collect()}


def test_op1_documents(spark):
    assert repeats(spark.read.parquet(f"{SF}/documents.parquet")) == without_repeats(documents())


@pytest.mark.parametrize("hot", [4096, 5])
def test_op1_shared_passages(spark, hot):
    rows = [*shared_texts(), (900, "x" * 350), (901, "y" + "x" * 150), (902, "xy" * 120), (903, "yx" * 120), (904, None), (905, "z" * 99)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert repeats(df, hot=hot) == without_repeats(rows)


@pytest.mark.parametrize("hot, batch", [(4096, 1 << 17), (7, 1 << 17), (1 << 20, 50)])
def test_op1_hot_name_inside_one_text(spark, monkeypatch, hot, batch):
    """One line stands in a text many times, with other words around it and at times with the same ones; few others have it."""
    rng = np.random.default_rng(4)
    line = "0000 this line stands everywhere in one long text 0000"
    around = [" ".join(rng.choice(["ab", "cde", "fg", "hijk"], 14)) for _ in range(40)]
    rows = [(1, "".join(f"{around[rng.integers(40)]} {line} {around[rng.integers(40)]} {i}" for i in range(300))), (2, f"{around[0]} {line} {around[1]}"), (3, f"x{around[0]} {line} {around[1]}")]
    monkeypatch.setattr(suffix, "_SORT", batch)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert repeats(df, hot=hot) == without_repeats(rows)


def test_op1_odd_rows(spark):
    got = suffix.remove_repeats(odd(spark)).collect()
    assert len(got) == 16
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["n_removed"] == by_id[0]["n_bytes"] * 2 // 3 and by_id[1]["n_removed"] == by_id[1]["n_bytes"] and by_id[2]["n_bytes"] == 0 and by_id[8]["n_spans"] == 1
    assert suffix.remove_repeats(empty(spark)).count() == 0


def test_op1_repeated_and_null_ids(spark):
    """Each row is a document: what one row repeats is cut out of it alone."""
    rng = np.random.default_rng(8)
    draw = lambda n: bytes(rng.integers(97, 123, n, np.uint8)).decode()
    shared, other = draw(150), draw(400)
    rows = [(1, shared), (2, draw(100) + shared), (2, other), (None, shared + "!"), (None, draw(300)), (3, other + draw(50))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in suffix.remove_repeats(df).collect())
    want = [(False, 0, 151, 0), (False, 0, 300, 0), (True, 1, 150, 150), (True, 2, 250, 150), (True, 2, 400, 0), (True, 3, 450, 400)]
    assert got == want


def test_op1_long_texts(spark):
    """Texts over the size of a piece, and repeats across its border."""
    rng = np.random.default_rng(9)
    long = bytes(rng.integers(97, 123, 2_500_000, np.uint8)).decode()
    rows = [(1, long), (2, "short " + long[1_048_000:1_049_500]), (3, long[2_400_000:] + "tail"), (4, long[:200])]
    got = {r["doc_id"]: r["n_removed"] for r in suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1500, 3: 100_000, 4: 200}


def test_op7_sql(spark):
    cols, rows = rows_of(exact.op7_exact_dedup(spark, SF))
    assert (cols, rows) == oracle(exact.OP7_SQL, SF)


def test_op7_odd_rows(spark):
    got = exact.exact_duplicates(odd(spark)).collect()
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert len(got) == 16 and {3, 7, 13, 8} <= kept and not kept & {0, 1, 2, 12}
    assert {r["group_size"] for r in got if r["doc_id"] == 12} == {3}
    left = exact.drop_exact_duplicates(odd(spark))
    assert left.columns == odd(spark).columns and {0, 1, 2, 12}.isdisjoint(r["doc_id"] for r in left.select("doc_id").collect())
    rows = [(5, "X same"), (9, "x same"), (5, "a unique text"), (None, "x same"), (None, "junk"), (None, "junk"), (6, "twice"), (6, "Twice")]
    left = exact.drop_exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"].lower()) for r in left) == [(0, "junk"), (5, "a unique text"), (6, "twice"), (9, "x same")]
    assert exact.exact_duplicates(empty(spark)).count() == 0


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(prints):
    """fingerprint -> root, by comparing all pairs."""
    every = sorted(set(prints))
    arr, parent = np.array(every, np.uint64), list(range(len(every)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(every)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 2):
            parent[find(int(j))] = find(i)
    return {f: find(i) for i, f in enumerate(every)}


def test_op9_documents(spark):
    prints = {i: fingerprint(t) for i, t in documents()}
    roots = linked(prints.values())
    least = {}
    for i, f in prints.items():
        least[roots[f]] = min(least.get(roots[f], i), i)
    want = {i: (f"{f:016x}", least[roots[f]]) for i, f in prints.items()}
    assert {r[0]: (r[1], r[2]) for r in simhash.op9_simhash_near_dedup(spark, SF).collect()} == want


@pytest.mark.parametrize("bucket", [3, 4096])
def test_op9_links(spark, bucket):
    """A ball of near fingerprints, chains of one and two bits, and far ones; with and without hot buckets."""
    rng = np.random.default_rng(3)
    core = int(rng.integers(1 << 62))
    prints = {core}
    for _ in range(150):
        a, b, c = rng.integers(64, size=3)
        prints |= {core ^ (1 << int(a)), core ^ (1 << int(a)) ^ (1 << int(b)), core ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c))}
    prints |= {int(x) for x in rng.integers(1 << 62, size=40)} | {0, 3, 7, 31, (1 << 64) - 1}
    roots = linked(prints)
    signed = [int(np.uint64(f).astype(np.int64)) for f in prints]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket)
    found = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    mine = {f: found.get(s, s) for f, s in zip(prints, signed, strict=True)}
    pairs = {(roots[f], mine[f]) for f in prints}
    assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})


def test_op9_odd_rows(spark):
    got = simhash.near_duplicates(odd(spark)).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == 16 and by_id[1]["component_id"] == by_id[7]["component_id"] == 0 and by_id[4]["component_id"] == 2
    assert by_id[2]["fingerprint"] == "0" * 16
    assert simhash.near_duplicates(empty(spark)).count() == 0
    left = simhash.drop_near_duplicates(odd(spark))
    assert left.columns == odd(spark).columns and {1, 7, 3, 4}.isdisjoint(r["doc_id"] for r in left.select("doc_id").collect())


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    found = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    assert all(found[i] == 0 for i in range(201)) and found[501] == 500 and len(found) == 203
