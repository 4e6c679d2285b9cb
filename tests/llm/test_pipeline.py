"""The corpus pipeline against a chain of plain Python versions of its stages."""

import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfmark.llm import decontaminate, quality, tokens
from shelfmark.llm.common import written
from tests.conftest import SF
from tests.llm.frames import ODD, empty, odd
from tests.llm.test_near_copies import by_hand as near_by_hand
from tests.llm.test_text_scans import ModelByHand, split_words
from tests.llm.test_tokens_and_stores import check_pieces, library_ids


def good_by_hand(rows):
    """Ids that the quality stage keeps: ``rows`` are (id, language, text, side)."""
    models = {lang: ModelByHand([t for _, x, t, side in rows if x == lang and side == 1]) for lang in {x for _, x, _, side in rows if side == 1}}
    figures, kept = {}, set()
    for i, lang, text, side in rows:
        ws = ["<s>", "<s>", *map(models[lang].form, split_words(text))] if lang in models else []
        logs = [math.log(models[lang].p(*g)) for g in zip(ws, ws[1:], ws[2:])]  # noqa: B905
        figures[i] = (lang, side, len(split_words(text)), sum(logs), sum(x * x for x in logs))
    for lang in {f[0] for f in figures.values()}:
        own = {i: f for i, f in figures.items() if f[0] == lang and f[2]}
        held = [f for f in own.values() if f[1] == 2 and lang in models]
        if not held:
            kept |= set(own)
            continue
        words = sum(f[2] for f in held)
        mean = sum(f[3] for f in held) / words
        within = sum(f[4] for f in held) / words - mean**2
        between = max(0.0, sum((f[3] / f[2] - mean) ** 2 - within / f[2] for f in held) / len(held))
        score = lambda f: (f[3] / f[2] - mean) / math.sqrt(within / f[2] + between)  # noqa: B023, E731
        low = sorted(map(score, held))[max(0, math.ceil(quality.QUANTILE * len(held)) - 1)]
        kept |= {i for i, f in own.items() if score(f) >= low - 1e-9}
    return kept


def leaks_by_hand(text, items):
    doc = decontaminate.words.hashed([text.encode()])[1].tolist()
    for item in items:
        own = decontaminate.words.hashed([item.encode()])[1].tolist()
        if own and len(own) < decontaminate.SEED:
            if any(doc[i : i + len(own)] == own for i in range(len(doc))):
                return True
        elif own and sum(n for *_, n in decontaminate.tiles(own, doc)) >= decontaminate.THRESHOLD * len(own):
            return True
    return False


def test_stages_against_plain_python(spark):
    rng = random.Random(3)
    docs = duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    items = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    long = [d for d in docs if len((d[1] or "").split()) > 100]
    planted = []
    for k, d in enumerate(rng.sample(long, 12)):
        ws = d[1].split(" ")
        near = " ".join(w if rng.random() > 0.01 else f"edit{rng.randrange(1000)}" for w in ws)
        planted += [(10_000 + 3 * k, d[1].swapcase() if k % 2 else d[1], *d[2:]), (10_001 + 3 * k, near, *d[2:]), (10_002 + 3 * k, f"{d[1]} {rng.choice(items)}", *d[2:])]
    planted += [(20_000, "%% ## @@ !! ?? " * 60, "en", "x", 1), (20_001, None, "en", "x", 0), (20_002, "", "en", "x", 0)]
    docs += planted
    now = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    left = {i: (text or "", lang) for i, text, lang, *_ in docs}
    rows = quality._rows(now, quality.trusted_ids(spark.read.parquet(f"{SF}/labels.parquet")), "doc_id", "text", "lang")
    sides = {r["doc_id"]: r["side"] for r in rows.select("doc_id", "side").collect()}

    kept = good_by_hand([(i, lang, text, sides[i]) for i, (text, lang) in left.items()])
    expected = [kept]
    best = {}
    for i in kept:
        key = left[i][0].translate({c: c + 32 for c in range(65, 91)})
        best[key] = max(best.get(key, i), i)
    expected.append(set(best.values()))
    expected.append({i for i, least in near_by_hand([(i, left[i][0]) for i in sorted(expected[-1])]).items() if i == least})
    expected.append({i for i in expected[-1] if not leaks_by_hand(left[i][0], items)})
    for (name, stage), want in zip(corpus_pipeline.STAGES, expected):  # noqa: B905
        now = written(stage(spark, now, SF), "stage")
        assert {r["doc_id"] for r in now.select("doc_id").collect()} == want, name
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(len(a) > len(b) for a, b in zip([left, *expected], expected))  # noqa: B905
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    ids = sorted(expected[-1])
    check_pieces(pieces, dict(zip(ids, library_ids(tokens.WORD_BPE, [left[i][0] for i in ids], 2), strict=True)))


def test_run(spark):
    """run() is its stages, one after the other."""
    rows = corpus_pipeline.run(spark, SF).collect()
    cover = defaultdict(int)
    for r in rows:
        cover[r["doc_id"]] += r["length"]
    assert rows and all(cover[r["doc_id"]] == r["doc_tokens"] for r in rows)
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in cover for i in good) >= 0.7 * len(good)  # what is missing are copies and leaks


@pytest.mark.parametrize("stage", range(4))
def test_stages_on_odd_rows(spark, stage):
    frame = odd(spark).withColumn("gone", F.lit(1))
    out = corpus_pipeline.STAGES[stage][1](spark, frame, SF)
    assert out.columns == frame.columns and {(r["doc_id"], r["text"]) for r in out.collect()} <= {(r[0], r[1]) for r in ODD}
    assert corpus_pipeline.STAGES[stage][1](spark, empty(spark), SF).count() == 0


def test_quality_stage_keeps_rows_of_shared_ids(spark):
    """A bad text takes no good one of the same id along."""
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    good = docs.where("lang = 'en' AND n_chars BETWEEN 800 AND 3000").orderBy("doc_id").limit(1)
    bad = good.withColumn("text", F.lit("%% ## @@ !! ?? " * 60))
    out = corpus_pipeline.STAGES[0][1](spark, docs.join(good.select("doc_id"), "doc_id", "left_anti").unionByName(good).unionByName(bad), SF.replace("0.001", "0.01"))
    mine = out.join(good.select("doc_id"), "doc_id").select("text").collect()
    assert [r["text"] for r in mine] == [good.first()["text"]]


def test_crc(spark):
    rows = corpus_pipeline.STAGES[-1][1](spark, spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), SF).collect()
    own = library_ids(tokens.WORD_BPE, ["a b c"], 2)[0]
    assert [r["ids_crc32"] for r in sorted(rows, key=lambda r: r["start"])][0] == zlib.crc32(own[: np.int64(min(rows, key=lambda r: r["start"])["length"])].tobytes())
