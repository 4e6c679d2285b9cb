"""op13 against SQL and plain Python: perfect hashes, waves, dense slots, tiles, odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shelfmark.llm import divergence
from tests.conftest import SF
from tests.llm.frames import ODD, empty, odd
from tests.oracle import oracle, rows_of


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 4096, 9000])
def test_perfect_hash_is_minimal(n):
    hashes = np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.arange(n, dtype=np.uint64) % np.uint64(2)
    for some in (hashes, hashes // np.uint64(64) * np.uint64(64)):  # also such as agree modulo the number of shards
        _, slots = divergence.minimal_perfect_hash(np.unique(some))
        assert sorted(slots.tolist()) == list(range(n))


def test_shards_verify_keys():
    rng = random.Random(1)
    keys = sorted({("en", "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 9)))) for _ in range(3000)} | {("", "x"), ("a\0b", "x")})
    by = defaultdict(list)
    for lang, term in keys:
        by[np.array([divergence.key_hash(lang, term.encode())], np.uint64).view(np.int64)[0] % 5].append((lang, term))
    rows = []
    for shard in (0, 1, 3, 4):  # one is in another wave
        table = pa.table({"lang": [k[0] for k in by[shard]], "term": [k[1] for k in by[shard]]})
        rows.append(tuple(divergence._built((pa.scalar(shard),), table).to_pylist()[0].values()))
    shards = divergence.Shards(rows, 5)
    place = lambda some: shards.place(np.array([divergence.key_hash(a, b.encode()) for a, b in some], np.uint64), [f"{a}\0{b}".encode() for a, b in some])
    here = [k for s in (0, 1, 3, 4) for k in by[s]]
    assert sorted(place(here).tolist()) == list(range(len(here)))
    others = by[2] + [("de", t) for _, t in keys if ("de", t) not in keys]
    assert (place(others) == -1).all()


def test_terms():
    texts = pa.array(["The cat's É1x", "", "ab", "cD\x7fe f", "漢字-kanji"])
    got = defaultdict(list)
    for first, text, number, distinct in divergence.terms_of(texts.slice(0)):
        for t, k in zip(text, number, strict=True):
            got[first + t].append(distinct[k].decode())
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    assert got == {i: w for i, t in enumerate(texts.to_pylist()) if (w := re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t)))}


def brute(rows, least=3, ranks=200):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups.add((lang or "", source or ""))
        seen[lang or ""].update(set(words))
        counts[lang or "", source or ""].update(words)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in seen[lang].items() if n >= least)
        own = sorted(s for a, s in groups if a == lang)
        total = {s: sum(counts[lang, s][t] for t in kept) for s in own}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 1) // (total[s] + len(kept)) for t in kept} for s in own}
        whole = {t: sum(counts[lang, s][t] for s in own) for t in kept}
        q = {t: 1 + 10**9 * (whole[t] + 1) // (sum(whole.values()) + len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in own:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
                out += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most], 1)]
    return sorted(out)


COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def got(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_many_shards_waves_and_tiles(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randrange(1, 6))) for _ in range(400)]
    rows = []
    for _ in range(300):  # a third of all rows in one group, a third of all words one word
        lang, source = ("en", "hot") if rng.random() < 0.35 else (rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", "d", "e", None]))
        rows.append((" ".join("the" if rng.random() < 0.33 else rng.choice(vocabulary) for _ in range(rng.randrange(40))), lang, source))
    rows += [("alone here", "xx", "a"), (None, "xx", "b"), ("", "xx", "c"), ("12 34", "yy", "only")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(6)
    want = brute(rows)
    assert got(divergence.divergence(df)) == want
    small = divergence.divergence(df, wave_bytes=2000, dense_slots=300, shard_keys=50, tile=2)
    assert got(small) == want
    assert {r[2:5] for r in want if r[0] == "xx"} >= {("pair", "b", 0), ("pair", "c", 0)}


def test_odd_rows(spark):
    assert got(divergence.divergence(odd(spark))) == brute([r[1:4] for r in ODD])
    assert divergence.divergence(empty(spark)).count() == 0


def test_shares_are_exact():
    rng = random.Random(2)
    for _ in range(500):
        total = rng.randrange(1, 1 << rng.randrange(1, 59))
        count = rng.randrange(total)
        assert divergence.share(np.array([count]), np.array([total]))[0] == 1 + 10**9 * (count + 1) // total


def test_op13(spark):
    assert rows_of(divergence.op13_source_divergence(spark, SF)) == oracle(divergence.OP13_SQL, SF)
