"""op2, op4, op5, op8 and op10."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import blocks, chaining, decontaminate, licenses, quality, secret_scan
from shelfmark.llm.common import read
from tests.conftest import SF
from tests.llm.frames import ODD, empty, odd


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


# --- op8


def spans_by_hand(text):
    """The base patterns, character by character."""
    out = []
    lower = text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)
    i = 0
    while i < len(text):
        m = next((k for k in ("password", "passwd", "secret", "token", "api_key", "apikey") if lower.startswith(k, i)), None)
        if m is None:
            i += 1
            continue
        j = i + len(m)
        j += text[j : j + 1] in ("'", '"') and text[j : j + 1] != ""
        while text[j : j + 1] == " ":
            j += 1
        if text[j : j + 1] not in (":", "="):
            i += 1
            continue
        j += 1
        while text[j : j + 1] == " ":
            j += 1
        j += text[j : j + 1] in ("'", '"') and text[j : j + 1] != ""
        k = j
        while k < len(text) and re.match(r"[A-Za-z0-9+/_.=-]", text[k]):
            k += 1
        if k == j:
            i += 1
            continue
        if k - j >= 6:
            out.append(("assign", i, k))
        i = k
    for kind, chars, least in (("access", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 20), ("hex", "0123456789abcdef", 24)):
        i = 0
        while i < len(text):
            if kind == "access" and not (text.startswith("AKIA", i) and text[i + 4 : i + 5] in chars and text[i + 4 : i + 5]):
                i += 1
                continue
            j = i
            while j < len(text) and text[j] in chars:
                j += 1
            if j == i:
                i += 1
                continue
            if j - i >= least:
                out.append((kind, i, j))
            i = j
    return sorted(out, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))


CASES = [
    "password=short1 password = abc passwd:'longenough' SECRET:\"abcdefgh\" api_key: x api-key=1234567", "tokentoken=abcdef123", "AKIA" + "A1" * 8 + " AKIA123 xAKIA" + "Z" * 30,
    "é deadbeefdeadbeefdeadbeef0 DEADBEEF " + "a" * 24 + "g" + "b" * 23, "secret=" + "0123456789abcdef" * 2, 'token"  =  "==//++..', "password==abcdefgh",
]


@pytest.mark.parametrize("text", CASES)
def test_op8_base(text):
    assert secret_scan.base_spans(text) == spans_by_hand(text)


def test_op8_documents(spark):
    import hashlib

    got = {r["doc_id"]: r for r in secret_scan.op8_secret_scan(spark, SF).collect()}
    for i, text in documents():
        base = spans_by_hand(text or "")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(got[i]["spans"].split(","))


def test_op8_pairs():
    found = lambda t: {t[a:b] for _, a, b in secret_scan.pairs(t)}
    assert found('base = "q8Zt4LmX92bV"\nauth_token = base\n') == {'"q8Zt4LmX92bV"', "base"}
    assert '"hunter2-Xy9" + "Zq81"' in found('dbPassword = "hunter2-Xy9" + "Zq81"\n')
    assert found('{"client_secret": "aG93LWFyZS15b3U4OQ"}') == {'"aG93LWFyZS15b3U4OQ"'}
    assert not found('password = "changeme"\ncolour = "q8Zt4LmX92bV77"\ntime: 12:30\nurl = "https://example.org/a"')


V = "q8Zt4LmX92bV"
#: Texts and the literals that they leak, by syntax.
LABELLED = [
    (f'base = "{V}"\nauth_token = base\n', {f'"{V}"', "base"}), ('SECRET = """abc9Xk2-\nQq81zzT"""\n', {'"""abc9Xk2-\nQq81zzT"""'}), (f"<password>{V}</password>", {V}),
    (f'<add key="ApiToken" value="{V}"/>', {f'"{V}"'}), (f'<db password="{V}" port="1"/>', {f'"{V}"'}), (f"def f():\n    api_token = T\nT = '{V}'\n", {f"'{V}'", "T"}),
    ("secret: |\n  q8Zt4LmX\n  92bVkk1\nother: 1", {"  q8Zt4LmX\n  92bVkk1\n"}), (f"auth_token: Bearer {V}", {V}), (f"curl --password {V} x", {V}), (f"db = postgres://me:{V}@host/db", {V}),
    (f'a = "{V}"\ntoken = f"{{a}}-tail"\n', {f'"{V}"', 'f"{a}-tail"'}), (f'a = "{V}"\ntoken="${{a}}"\n', {f'"{V}"', '"${a}"'}), (f"export DB_PASSWORD={V} # c", {V}), (f'x["api_key"] = "{V}"', {f'"{V}"'}),
    (f'def g(password="{V}"):', {f'"{V}"'}), (f'let c = {{password: "{V}"}};', {f'"{V}"'}), (f"[db]\npasswd={V}\n", {V}), (f"client_secret := `{V}`", {f"`{V}`"}), (f'secret_key => "{V}",', {f'"{V}"'}),
    ('password = "q8Zt4" \\\n    "LmX92bV"\n', {'"q8Zt4" \\\n    "LmX92bV"'}), (r'password = "a\"b9Xk2-Qq81"', {r'"a\"b9Xk2-Qq81"'}), (f"one = '{V}'\ntwo = one\nthree_token = two", {f"'{V}'", "two"}),
    (f"token = SecretStr('{V}')", {f"SecretStr('{V}')"}), (f"if a:\n    k = '{V}'\n    my_password = k\n", {f"'{V}'", "k"}),
    ("password = get_secret('x9Yz81kk')\n", set()), ("primary_key: Ab39xkQ91z\n", set()), ("monkey_token_count = 81723981\n", set()), ('password = "changeme"', set()), (f'colour = "{V}77"', set()),
    ("password: the user must remember this", set()), (f'if token == "{V}": pass', set()), ('password = "${DB_PASS}"', set()), ('token = "<your token here>"', set()), ("api_key_name = 'X-Request-Key-9'", set()),
    (f"if a:\n    k = '{V}'\nmy_password = k\n", set()), (f"# k = '{V}'\nmy_password = k\n", set()), ('keyboard = "QWERTZ-105-de_DE"', set()), ("password_reset = 'https://a.b/r/9Xk2'", set()),
    ("secret = os.environ['DB_SECRET']", set()), ("token = tokens[i9Xk2]", set()), ('passwordLabel: "Kennwort2-Eingabe"', set()),
]


def test_op8_labelled():
    """Precision and recall of the method's spans over configuration and source in many syntaxes."""
    right = wrong = missed = 0
    for text, want in LABELLED:
        got = {text[a:b] for _, a, b in secret_scan.pairs(text)}
        right, wrong, missed = right + len(got & want), wrong + len(got - want), missed + len(want - got)
    assert right / (right + missed) >= 0.95 and right / (right + wrong) >= 0.95


@pytest.mark.parametrize("text", ["word ", "word: ", "a=b ", '"', "<a", "token = 'a' + ", "token `\\\\", "--token ", "token key name="])
def test_op8_long_lines(text):
    """Time grows with the text, however long its lines are."""
    import time

    def seconds(n):
        began = time.perf_counter()
        secret_scan.scan("secret " + text * n)
        return time.perf_counter() - began

    assert seconds(40_000) < 40 * max(seconds(4_000), 0.01)


def test_op8_odd_rows(spark):
    assert secret_scan.find_secrets(odd(spark)).count() == len(ODD) and secret_scan.find_secrets(empty(spark)).count() == 0
    red = secret_scan.redact_secrets(spark.createDataFrame([(1, "a password=abcdefgh b")], "doc_id long, text string")).first()
    assert red["text"] == "a [SECRET] b"


# --- op10


def phrases_by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    at = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in at}))


def test_op10_documents(spark):
    got = {r["doc_id"]: r for r in licenses.op10_license_scan(spark, SF).collect()}
    for i, text in documents():
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == phrases_by_hand(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1


def test_op10_diagonals(spark):
    apache = "Licensed under the Apache License, Version 2.0"
    texts = [
        "cc by cc by 4.0", f"words before. {apache}. and after", "Licensed under the new Apache License, Version 2.0", "licensed under something else entirely", "",
        "ALL RIGHTS RESERVED", "permission is hereby granted, free of charge, to any person obtaining a copy of some software and associated documentation files",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.find_licenses(df).collect()}
    assert got[0]["n_base"] == 2 and (got[0]["first_word"], got[0]["last_word"]) == (0, 2)
    assert got[1]["labels"] == "apache-2.0" and got[1]["score"] == 1.0
    assert got[2]["labels"] == "apache-2.0" and 0.5 <= got[2]["score"] < 1  # one word put in: two diagonals, merged
    assert got[3]["labels"] == "" and got[4]["n_words"] == 0 and got[5]["labels"] == "reserved" and got[6]["labels"] == "mit"
    span = licenses.license_spans(df).where("doc_id = 1").first()
    assert (span["first_word"], span["last_word"]) == (2, 9)


def test_op10_whole_texts(spark):
    """Whole license texts are covered to their ends; a warranty clause alone, or that of another license, names none."""
    whole = [(label, t) for label, t in licenses.TEMPLATES if len(t.split()) > 92]
    assert {label for label, _ in whole} == {"mit", "isc", "zlib", "bsd", "bsd-3", "bsl-1.0", "unlicense"} and all(len(t.split()) <= 90 for label, t in licenses.TEMPLATES if (label, t) not in whole)
    texts = [f"Copyright someone. {t.upper()} int main" for _, t in whole] + [t[t.index(" is provided ") :] for label, t in whole if label != "zlib"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.find_licenses(df).collect()}
    for i, (label, _) in enumerate(whole):
        assert got[i] == ("bsd,bsd-3" if label == "bsd-3" else label, 1.0)
    assert all(got[i] == ("", 0.0) for i in range(len(whole), len(texts)))
    spans = {(r["doc_id"], r["label"]): (r["first_word"], r["last_word"]) for r in licenses.license_spans(df).where("share = 1").orderBy("last_word").collect()}
    assert all(spans[i, label] == (2, 1 + len(t.replace(".", " ").split())) for i, (label, t) in enumerate(whole))


def test_op10_odd_rows(spark):
    assert licenses.find_licenses(odd(spark)).count() == len(ODD) and licenses.find_licenses(empty(spark)).count() == 0


# --- op5


def tiled_by_hand(a, b, least):
    used_a, used_b, total = [False] * len(a), [False] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not used_a[i + n] and not used_b[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return total
        used_a[i : i + n] = used_b[j : j + n] = [True] * n
        total += n


def test_op5_tiles():
    rng = np.random.default_rng(2)
    for _ in range(120):
        a = rng.integers(1, 6, rng.integers(1, 30)).tolist()
        b = [x for _ in range(3) for x in [*a[rng.integers(len(a)) :][: rng.integers(20)], *rng.integers(1, 6, rng.integers(4)).tolist()]]
        assert sum(n for *_, n in decontaminate.tiles(a, b, 3)) == tiled_by_hand(a, b, 3)


def test_op5_leaks(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    words = item.split()
    texts = [f"before {item} after", " ".join(words[6:] + ["gap"] + words[:6]), " ".join(words[:5]) + " and nothing else", "clean text", None, "short item", item.upper().replace(" ", "-")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(70, item), (71, "short item"), (72, ""), (73, None)], "item_id long, text string")
    want = [(0, 70, 1.0), (1, 70, 1.0), (5, 71, 1.0), (6, 70, 1.0)]
    for small in (2_000_000, 0):
        got = decontaminate.leaks(docs, bench, small=small).collect()
        assert sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in got) == want
    left = decontaminate.drop_leaks(docs, bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4]


def test_op5_null_and_repeated_ids(spark):
    """Small and large benchmarks give the same rows, also for null and repeated ids."""
    item, other = "one two three four five six seven eight", "red green blue white black brown pink grey"
    docs = spark.createDataFrame([(1, item), (None, item), (2, other), (2, f"x {item}"), (2, other), (3, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item), (7, other), (7, item)], "item_id long, text string")
    small, large = (sorted(map(repr, decontaminate.leaks(docs, bench, small=n).collect())) for n in (2_000_000, 0))
    assert small == large and len(small) == 8
    for n in (2_000_000, 0):
        # rows are told apart by id and text: the leaking row without id goes, and a clean row would stay
        more = docs.union(spark.createDataFrame([(None, "clean too"), (2, "also clean")], "doc_id long, text string"))
        assert sorted(r["text"] for r in decontaminate.drop_leaks(more, bench, small=n).collect()) == ["also clean", "clean", "clean too"]


@pytest.mark.parametrize("salt_rows", [50_000, 7])
def test_op5_large_benchmark_with_a_common_seed(spark, salt_rows):
    """Rarest seeds and salts lose no leak: the shuffled way gives what the other does, with a seed in most documents."""
    rng = np.random.default_rng(11)
    common = "this page is part of the public record"
    pick = lambda n: " ".join(f"w{i}" for i in rng.zipf(1.3, n) % 400)
    items = [f"{common} {pick(rng.integers(1, 30))}" for _ in range(30)] + [pick(rng.integers(1, 9)) for _ in range(30)] + [common] * 2
    texts = []
    for _ in range(150):
        words = items[rng.integers(len(items))].split()
        a = int(rng.integers(len(words)))
        texts.append(" ".join([pick(5), common, *words[a:], pick(3), *words[:a], pick(4)]) if rng.random() < 0.7 else f"{common} {pick(20)}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    small, large = (sorted(map(repr, decontaminate.leaks(docs, bench, small=n, salt_rows=salt_rows).collect())) for n in (2_000_000, 0))
    assert small == large and len(small) > 100


def test_op5_documents(spark):
    words = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())
    bench = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    want = {(d, i) for d, t in documents() for i, b in bench if b and " ".join(words(b)) in " ".join(words(t or ""))}
    assert want <= {(r["doc_id"], r["item_id"]) for r in decontaminate.op5_decontamination(spark, SF).collect()}


def test_op5_odd_rows(spark):
    bench = read(spark, SF, "benchmark")
    assert decontaminate.leaks(odd(spark), bench).count() == 0
    assert decontaminate.leaks(empty(spark), bench).count() == 0 and decontaminate.leaks(odd(spark), bench.limit(0)).count() == 0


def test_op8_has_no_caps():
    """Constants behind many others of their name, long chains, long values, elements and flags."""
    key = "q8Zt4LmX2vRb7NcY"
    named = lambda text: [text[a:b] for k, a, b in secret_scan.pairs(text) if k == "pair"]
    source = lambda text: [text[a:b] for k, a, b in secret_scan.pairs(text) if k == "source"]
    inner = "".join(f"def f{i}():\n    v = 'plain words {i}'\n" for i in range(300))
    assert source(f"v = '{key}'\n{inner}password = v\n") == [f"'{key}'"]
    assert source(f"password = v\n{inner.replace('v =', 'w =')}v = '{key}'\n") == [f"'{key}'"]
    chain = f"a0 = '{key}'\n" + "".join(f"a{i + 1} = a{i}\n" for i in range(3000)) + "password = a3000\n"
    assert source(chain) == [f"'{key}'"] and named(chain) == ["a3000"]
    long = (key * 700)[:10_000]
    for text in (f"secret_key = '{long}'", f"<password>{long}</password>", f"run --password {long}", f'<add key="password" value="{long}"/>', f"ftp://me:{long}@host/", f"password{' ' * 90}= '{long}'"):
        assert any(long in x for x in named(text)), text[:40]
    parts = " + ".join(f"'{key}'" for _ in range(600))
    assert named(f"api_secret = {parts}\n") == [parts]
    query = f"url=https://host/?{'a=1&' * 5000}token={long}&b=2"
    assert long in named(query)
    # values within values take no time of their own
    for part in ("password=a+", "a://b:", "secret=x/"):
        secret_scan.pairs(part * 40_000)
    # constants that double each other, and rings, end
    bomb = f"b0 = '{key}'\n" + "".join(f'b{i + 1} = "${{b{i}}}${{b{i}}}"\n' for i in range(60)) + 'password = "${b60}"\n'
    secret_scan.pairs(bomb)
    assert secret_scan.pairs("password = one\none = two\ntwo = one\n") == []


# --- op4


def test_op4_chains():
    place = np.array([0, 4, 9, 20, 100, 104]), np.array([50, 54, 59, 71, 3, 7])
    found = chaining.chains(*place, k=6, window=8, gap=0.25, least=15, span=15)
    assert [(c[0][0], c[-1][0]) for c in found] == [(0, 20)]
    assert chaining._common(np.array([1, 2, 3, 4]), np.array([2, 4, 5])) == 2


def test_op4_passages(spark):
    rng = np.random.default_rng(4)
    draw = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    passage = draw(70)
    fuzzy = [*passage[:20], "new", *passage[20:45], *passage[47:]]
    texts = [[*draw(30), *passage, *draw(10)], [*draw(5), *passage, *draw(50)], [*draw(80), *fuzzy], draw(200), [*draw(20), *passage[:20], *draw(20)], *[[*draw(3), *passage] for _ in range(30)]]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = chaining.repeated_passages(df).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == {0, 1, 2, *range(5, 35)}
    assert any(r["first_word"] == 5 and r["n_words"] == 70 and r["other_id"] == 0 and r["other_first_word"] == 30 and r["identity"] == 1 for r in by_doc[1])
    assert any(r["first_word"] == 80 and r["n_words"] == 69 and r["equal_words"] == 68 for r in by_doc[2])
    assert len(got) <= 6 * len(texts)  # three partners at most in a large group, each pair told from both sides


@pytest.mark.parametrize("parts", [1, 4])
def test_op4_passage_twice_in_one_text(spark, parts):
    """Each place of a passage that the other texts have once gets a partner, whichever text comes first."""
    rng = np.random.default_rng(5)
    draw = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    passage = draw(60)
    texts = [[*draw(9), *passage], [*passage, *draw(40), *passage], [*draw(25), *passage]]
    for order in ([0, 1, 2], [1, 0, 2]):
        df = spark.createDataFrame([(i, " ".join(texts[n])) for i, n in enumerate(order)], "doc_id long, text string").repartition(parts)
        got = {(order[r["doc_id"]], r["first_word"]) for r in chaining.repeated_passages(df).collect() if r["n_words"] == 60}
        assert {(0, 9), (1, 0), (1, 100), (2, 25)} <= got


def edited(rng, passage, share):
    """The passage with that share of its words replaced, left out or followed by a new one."""
    out, at = [], set(rng.choice(len(passage), round(share * len(passage)), replace=False).tolist())
    for i, w in enumerate(passage):
        kind = rng.integers(4) if i in at else None
        out += [w] if kind is None else [f"n{rng.integers(10**9)}"] if kind < 2 else [] if kind == 2 else [w, f"n{rng.integers(10**9)}"]
    return out


@pytest.mark.parametrize(("words_", "share", "recall"), [(50, 0.0, 1.0), (60, 0.1, 0.93), (100, 0.1, 0.97), (100, 0.15, 0.9), (150, 0.17, 0.9)])
def test_op4_recall(spark, words_, share, recall):
    """Passages that an alignment of all pairs would find, by their share of edited words."""
    rng = np.random.default_rng(7)
    draw = lambda n: [f"w{x}" for x in rng.zipf(1.3, n) % 50_000]
    texts, pairs = [], 100
    for _ in range(pairs):
        passage = draw(words_)
        texts += [[*draw(60), *passage, *draw(60)], [*draw(90), *edited(rng, passage, share), *draw(30)]]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    found = {(r["doc_id"], r["other_id"]) for r in chaining.repeated_passages(df).collect()}
    assert sum((2 * i, 2 * i + 1) in found and (2 * i + 1, 2 * i) in found for i in range(pairs)) >= recall * pairs
    # nothing but the pairs, and common words alike by chance are none
    assert sum(a // 2 != b // 2 for a, b in found) <= 2


def test_op4_pieces_elsewhere(spark):
    """A passage is found though earlier and later documents have overlapping pieces of it that are too short to count."""
    rng = np.random.default_rng(11)
    draw = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    passage = draw(100)
    pieces = [[*draw(40), *passage[a : a + 34], *draw(40)] for a in (0, 22, 44, 66)]
    whole = [[*draw(30), *passage, *draw(30)] for _ in range(80)]
    texts = [*pieces, *whole, *[[*draw(5), *p[40:74]] for p in pieces]]
    for parts in (1, 5):
        df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(parts)
        found = {r["doc_id"] for r in chaining.repeated_passages(df).collect() if r["n_words"] >= 100}
        assert found == set(range(4, 84))


@pytest.mark.parametrize("parts", [1, 4])
@pytest.mark.parametrize(("words_", "pieces"), [(120, (36, 43)), (52, (36, 45)), (90, (44, 45))])
def test_op4_excerpts_before_between_and_after(spark, words_, pieces, parts):
    """Two texts that share a passage are found though many others, wherever they stand, have overlapping excerpts of it
    that are too short to be passages."""
    rng = np.random.default_rng(13)
    draw = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    texts, pairs = [], []
    for _ in range(20):
        passage = draw(words_)
        excerpts = []
        for i in range(24):
            n = int(rng.integers(*pieces))
            a = round((words_ - n) * i / 23)
            excerpts.append([*draw(25), *passage[a : a + n], *draw(25)])
        rng.shuffle(excerpts := [" ".join(e) for e in excerpts])
        x, y = (" ".join([*draw(30), *passage, *draw(30)]) for _ in range(2))
        pairs.append((len(texts) + 8, len(texts) + 17))
        texts += [*excerpts[:8], x, *excerpts[8:16], y, *excerpts[16:]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    got = {(r["doc_id"], r["other_id"]): r for r in chaining.repeated_passages(df).collect()}
    assert all(got[p]["n_words"] >= words_ and got[p[::-1]]["n_words"] >= words_ for p in pairs)
    assert {d for d, _ in got} == {d for p in pairs for d in p}


@pytest.mark.parametrize("parts", [1, 4])
def test_op4_edited_passage_among_excerpts(spark, parts):
    """Two texts with a passage of which every piece is in many others too, and no 45 words in a row are alike."""
    rng = np.random.default_rng(15)
    draw = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    texts, pairs = [], []
    for _ in range(20):
        passage = draw(90)
        excerpts = [[*draw(25), *passage[a : a + 36], *draw(25)] for a in rng.permutation(np.linspace(0, 54, 24).astype(int))]
        x = [*draw(30), *passage, *draw(30)]
        y = [*draw(50), *(w for i, w in enumerate(passage) if i % 22 != 21), *draw(10)]
        pairs.append((len(texts) + 8, len(texts) + 17))
        texts += [*excerpts[:8], x, *excerpts[8:16], y, *excerpts[16:]]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(parts)
    got = {(r["doc_id"], r["other_id"]): r for r in chaining.repeated_passages(df).collect()}
    assert set(got) == {p for x, y in pairs for p in ((x, y), (y, x))}
    assert all(got[p]["equal_words"] >= 80 for p in pairs)


def test_op4_second_passage_half_of_a_common_line(spark):
    """A passage whose one half stands in many texts is found, though its texts have another passage in common."""
    rng = np.random.default_rng(17)
    draw = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    texts = []
    for _ in range(20):
        first, line, own = draw(60), draw(26), draw(24)
        whole = lambda: [*draw(10), *first, *draw(80), *line, *draw(1), *own, *draw(10)]  # noqa: B023, E731
        texts += [whole() if i in (3, 7) else [*draw(20), *line, *draw(20)] for i in range(10)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["other_id"], r["first_word"] > 100) for r in chaining.repeated_passages(df).collect()}
    assert got == {(10 * i + a, 10 * i + 10 - a, later) for i in range(20) for a in (3, 7) for later in (False, True)}


def test_op4_all_links_are_told(spark):
    """Each link of 50 words in both texts that an alignment of all pairs finds, however many documents share its seeds, has
    its seeds told in both texts, in one class."""
    rng = np.random.default_rng(16)
    draw = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    chunks = [draw(int(n)) for n in rng.integers(12, 40, 14)]
    texts = []
    for _ in range(300):
        text = draw(int(rng.integers(5, 20)))
        for c in rng.choice(len(chunks), int(rng.integers(1, 6)), replace=False):
            text += [*edited(rng, chunks[c], rng.choice([0, 0, 0.05, 0.1])), *draw(int(rng.choice([0, 0, 2, 12])))]
        texts.append([*text, *draw(5)])
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    told = [tuple(r)[:6] for r in chaining.repeated_passages(df).collect()]
    # regions of each text, and their classes
    regions, label = {}, {}
    for d, first, n in sorted({(d, f, n) for d, _, f, n, _, _ in told}):
        if d in regions and first < regions[d][-1][1]:
            regions[d][-1][1] = max(regions[d][-1][1], first + n)
        else:
            regions.setdefault(d, []).append([first, first + n])
    region = lambda d, low, high: next(((d, a) for a, b in regions.get(d, []) if a <= low and high <= b), None)

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for d, o, f, n, g, m in told:
        if (one := region(d, f, f + n)) and (two := region(o, g, g + m)):
            label[root(one)] = root(two)
    text, word = chaining.words.hashed([" ".join(t).encode() for t in texts], chaining.words.BLACK)
    at, gram = chaining.seeds(text, word)
    place = chaining.words.places(text)
    members = chaining.Members(gram, text[at], place[at], np.zeros(len(at), np.int64))
    assert (members.size > chaining.FEW).mean() > 0.3
    links = np.stack(members.links(*members.pairs(len(texts))))
    own = np.split(word, np.flatnonzero(np.diff(text)) + 1)
    n_links = lost = 0
    for a, b in {(int(a), int(b)) for a, b in links[:2].T}:
        p, o = links[2:, (links[0] == a) & (links[1] == b)]
        for chain in chaining.chains(p, o):
            for x, y, u, v, _ in chaining.passages(own[a], own[b], chain, chaining.LEAST, chaining.IDENTITY):
                for i, j in zip(p.tolist(), o.tolist(), strict=True) if min(y - x, v - u) >= chaining.LEAST else ():
                    if x <= i and i + 4 <= y and u <= j and j + 4 <= v and any(s <= i < s + n and i - s == j - t for s, t, n in chain):
                        n_links += 1
                        one, two = region(a, i, i + 4), region(b, j, j + 4)
                        lost += one is None or two is None or root(one) != root(two)
    assert n_links > 1000 and lost == 0, (n_links, lost)


def test_op4_runs_of_any_passage():
    """Of any stretch of ``least`` words one run is chosen, and the same one wherever the stretch stands."""
    rng = np.random.default_rng(14)
    text, word = np.repeat([0, 1, 2, 3], [300, 49, 50, 400]), rng.integers(0, 1 << 63, 799).astype(np.uint64)
    word[500:560] = word[100:160]
    at, gram = chaining.runs(text, word, 50)
    size = int(chaining.RUN * 50)
    for t in range(4):
        (own,) = np.nonzero(text == t)
        for a in own[: max(0, len(own) - 49)]:
            assert ((at >= a) & (at + size <= a + 50)).any()
    assert not (text[at] == 1).any() and (text[at] == text[at + size - 1]).all()
    inside = [set(gram[(at >= a) & (at + size <= a + 60)].tolist()) for a in (100, 500)]
    assert len(inside[0] & inside[1]) >= 2


def test_op4_links_against_brute_force():
    """Few documents of a seed are all linked, many each with one that stays the same and with one that goes on alike."""
    rng = np.random.default_rng(12)
    seed, doc = rng.integers(0, 40, 600).astype(np.uint64), rng.integers(0, 60, 600)
    place, then = rng.integers(0, 1000, 600), rng.integers(0, 3, 600)
    members = chaining.Members(seed, doc, place, then)
    left, right = members.pairs(6)
    got = {(int(members.seed[members.begin[a]]), int(members.doc[members.begin[a]]), int(members.doc[members.begin[b]])) for a, b in zip(left, right, strict=True)}
    for s in range(40):
        docs = sorted(set(doc[seed == s].tolist()))
        every = {(s, a, b) for a in docs for b in docs if a > b}
        mine = {x for x in got if x[0] == s}
        assert mine <= every and (mine == every if len(docs) <= 6 else {(s, d, docs[0]) for d in docs[1:]} | {(s, docs[-1], d) for d in docs[:-1]} <= mine and len(mine) <= 3 * len(docs))
    where = {(int(d), int(p)) for d, p in zip(doc, place, strict=True)}
    for d, o, p, q in zip(*members.links(left, right), strict=True):
        assert d > o and (int(d), int(p)) in where and (int(o), int(q)) in where


def test_op4_odd_rows(spark):
    got = chaining.repeated_passages(odd(spark)).collect()
    assert {0, 1, 7} <= {r["doc_id"] for r in got} and chaining.repeated_passages(empty(spark)).count() == 0


# --- op2


SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def split_words(text):
    return SPACES.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def discounts_by_hand(counts):
    n1, n2, n3, n4 = (sum(c == i for c in counts) for i in (1, 2, 3, 4))
    if not n1:
        return {1: 0.5, 2: 1.0, 3: 1.5}
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return {i + 1: min(max(x, 0.1), i + 1.0) for i, x in enumerate(d)}


class ModelByHand:
    """Interpolated modified Kneser-Ney trigrams of one language, from dictionaries."""

    def __init__(self, texts):
        seen = Counter(w for t in texts for w in split_words(t))
        self.words = {w for w, n in seen.items() if n > 1}
        tri = Counter()
        for t in texts:
            ws = ["<s>", "<s>", *map(self.form, split_words(t))]
            tri.update(zip(ws, ws[1:], ws[2:]))  # noqa: B905
        before = defaultdict(set)
        for u, v, w in tri:
            before[v, w].add(u)
        bi = {(v, w): tri["<s>", "<s>", w] if v == "<s>" else len(us) for (v, w), us in before.items()}
        uni = Counter(w for _, w in bi)
        self.size = len(self.words) + 4
        every = [*uni.values()]
        d = discounts_by_hand(every)
        self.rest = sum(d[min(c, 3)] for c in every) / self.size
        self.p1 = {w: (max(c - d[min(c, 3)], 0) + self.rest) / sum(every) for w, c in uni.items()}
        self.p0 = self.rest / sum(every)
        self.high, self.low = self.order(tri), self.order(bi)

    @staticmethod
    def order(counts):
        d, total, rest = discounts_by_hand(list(counts.values())), Counter(), Counter()
        for gram, c in counts.items():
            total[gram[:-1]] += c
            rest[gram[:-1]] += d[min(c, 3)]
        return {g: max(c - d[min(c, 3)], 0) / total[g[:-1]] for g, c in counts.items()}, {g: rest[g] / total[g] for g in total}

    def form(self, word):
        if word in self.words:
            return word
        symbols = sum(c.isascii() and not c.isalnum() for c in word)
        return (3 if symbols == len(word.encode()) else min(symbols, 3),)

    def p(self, u, v, w):
        low = self.low[0].get((v, w), 0) + self.low[1].get((v,), 1) * self.p1.get(w, self.p0)
        return self.high[0].get((u, v, w), 0) + self.high[1].get((u, v), 1) * low

    def log(self, text):
        ws = ["<s>", "<s>", *map(self.form, split_words(text))]
        return sum(math.log(self.p(*g)) for g in zip(ws, ws[1:], ws[2:]))  # noqa: B905


def test_op2_against_dictionaries(spark):
    """The sums of log probabilities of all documents, and that probabilities sum to 1."""
    rows = quality._rows(read(spark, SF, "documents"), quality.trusted_ids(read(spark, SF, "labels")), "doc_id", "text", "lang")
    every = [r.asDict() for r in rows.collect()]
    models = {lang: ModelByHand([r["text"].decode() for r in every if r["lang"] == lang and r["side"] == 1]) for lang in {r["lang"] for r in every if r["side"] == 1}}
    got = {r["doc_id"]: r for r in quality.perplexities(rows).collect()}
    assert len(got) == len(every) and len(models) > 1
    for r in every:
        want = models[r["lang"]].log(r["text"].decode()) if r["lang"] in models else 0.0
        assert got[r["doc_id"]]["total"] == pytest.approx(want, rel=1e-9) and got[r["doc_id"]]["n_words"] == len(split_words(r["text"].decode()))
    model = max(models.values(), key=lambda m: m.size)
    predicted = [*model.words, *((i,) for i in range(4))]
    for u, v in [("<s>", "<s>"), *list(model.high[1])[:5], ("no", "such")]:
        assert sum(model.p(u, v, w) for w in predicted) == pytest.approx(1, rel=1e-9)


def test_op2_small_vocabulary(spark):
    """With little room the rarest counts are left out, whole counts at a time."""
    good = spark.createDataFrame([("a", "x x x y y z z q"), ("b", "m m n n n n")], "lang string, text string").select("lang", F.col("text").cast("binary").alias("text"))
    sizes = lambda room: {lang: len(w) for lang, w in quality.known_words(good, room).words.items()}
    assert sizes(1000) == {"a": 3, "b": 2} and sizes(10 + 2) == {"a": 1, "b": 1} and sizes(10) == {"a": 0, "b": 0}


def test_op2_keeps_clean(spark):
    sf = SF.replace("0.001", "0.01")  # the smallest tables have a dozen trusted texts in some languages
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels).collect()}
    good = [r["doc_id"] for r in labels.where("quality = 1").collect()]
    assert sum(kept[i] for i in good) >= 0.97 * len(good)


def test_packed_numbers():
    for values in ([], [5], [0, -3, 1 << 62, 7]):
        assert blocks.unpacked(blocks.packed(np.array(values, np.int64))).tolist() == values


def test_op2_held_out_junk(spark):
    """Texts of symbols are rejected though no label says so."""
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels).collect()}
    junk = [r["doc_id"] for r in docs.where("size(split(text, '%%%')) > 20 OR size(split(text, '!!')) > 30").select("doc_id").collect()]
    assert junk and sum(kept[i] for i in junk) <= 0.2 * len(junk)


def test_op2_odd_rows(spark):
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, None), (None, 1, 0), (10, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.judge(odd(spark), labels).collect()
    assert len(got) == len(ODD) and not any(r["kept"] for r in got if r["doc_id"] == 2) and all(r["kept"] for r in got if r["lang"] == "fr")
    assert quality.judge(empty(spark), labels).count() == 0
    assert quality.judge(odd(spark), labels.limit(0)).count() == len(ODD)
    left = quality.keep_good(odd(spark), labels)
    assert left.columns == odd(spark).columns
