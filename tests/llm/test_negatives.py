"""op11 against brute force: exact products, ties, hot vectors, odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import negatives
from tests.conftest import SF
from tests.oracle import oracle, rows_of


@pytest.mark.parametrize("most", [1, 300, 1 << 20, 1 << 29, 1 << 58])
def test_packed_products(most):
    rng = random.Random(most)
    for _ in range(20):
        n, m, d = rng.randrange(0, 9), rng.randrange(0, 40), rng.randrange(0, 7)
        low = rng.choice([-min(most, 1 << 29), 0, min(most, 1 << 29) // 2])
        draw = lambda k, top: [[rng.randrange(max(-top, min(low, top)), top + 1) for _ in range(d)] for _ in range(k)]
        a, c = draw(n, most), draw(m, min(most, 1 << 29 if most < 1 << 30 else 1))
        got = negatives.packed_products(np.array(a, np.int64).reshape(n, d), np.array(c, np.int64).reshape(m, d))
        assert got.tolist() == [[sum(x * y for x, y in zip(p, q, strict=True)) for q in c] for p in a] and got.dtype == np.int64


def test_products_beyond_a_long():
    big = np.full((1, 4), 1 << 32, np.int64)
    with pytest.raises(ArithmeticError):
        negatives.packed_products(big, big)


def brute(rows, is_anchor):
    good = []
    for vec_id, label, v in rows:
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((vec_id, label, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for i, (a, label, v) in enumerate(good):
        if a is None or not is_anchor(a):
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), b, l) for j, (b, l, w) in enumerate(good) if j != i]  # noqa: B905, E741
        positives = sorted((s[:2] for s in scored if s[2] == label and s[1] != a), key=order)[:5]
        for p, b in positives:
            fits = sorted((s[:2] for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p), key=order)[:10]
            out += [(a, b, r, n, p, s) for r, (s, n) in enumerate(fits, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("groups", [1, 3])
def test_mined(spark, monkeypatch, groups):
    monkeypatch.setattr(negatives, "STRIPE_LEAST", 40)
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    monkeypatch.setattr(negatives, "CANDIDATES", 16)
    rng = random.Random(3)
    rows = [(i, rng.randrange(3), [rng.uniform(-0.2, 0.6) for _ in range(6)]) for i in range(300)]
    rows += [(i, 1, [0.5, 0.25, 0.1, 0.0, 0.0, 0.3]) for i in range(300, 420)]  # one vector of very many rows
    rows += [(420, None, [0.1] * 6), (430, 1, None), (440, 1, [0.1, None] * 3), (450, 0, [float("nan")] * 6), (460, 2, [float("inf")] * 6), (470, 2, []), (480, 1, [0.5]), (None, 2, [0.4] * 6), (490, 0, [9.0] * 8)]
    rows += [rows[40], rows[50], rows[7]]  # repeated rows, anchors and others
    monkeypatch.setattr(negatives, "GROUP_CELLS", 8 * 60 // groups)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({"row": F.lit("clash"), "cell": F.lit(1)}).repartition(5)
    got = negatives.mined(df, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, lambda a: a % 10 == 0)


def test_empty_and_alone(spark):
    schema = "vec_id long, label int, embedding array<float>"
    for rows in ([], [(100, 1, [0.5])], [(100, 1, [0.5]), (101, 1, [0.5])], [(5, 1, [0.5])]):
        assert negatives.mined(spark.createDataFrame(rows, schema), F.col("vec_id") % 100 == 0).count() == 0
    with pytest.raises(Exception, match="does not fit a long"):
        negatives.mined(spark.createDataFrame([(100, 1, [1e30])], schema), F.col("vec_id") % 100 == 0).collect()


def test_op11(spark):
    assert rows_of(negatives.op11_hard_negatives(spark, SF)) == oracle(negatives.OP11_SQL, SF)
