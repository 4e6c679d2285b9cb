"""What the near stage compares grows with the texts, not with the square of a group that is somewhat alike."""

import random

from shelfmark.llm import near_copies, simhash
from tests.llm.test_near_copies import by_hand


def test_texts_somewhat_alike_give_few_pairs(spark, monkeypatch):
    rng = random.Random(4)
    draw = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    core = draw(110)
    rows = [(i, " ".join([*core, *draw(40)])) for i in range(120)]
    counts, linked = [], []
    monkeypatch.setattr(near_copies, "written", lambda df, name, real=near_copies.written: counts.append((name, t := real(df, name))) or t)
    monkeypatch.setattr(simhash, "links", lambda fps, real=simhash.links: linked.append(1) or real(fps))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(df, common=10**6).collect()}
    assert kept == {i for i, least in by_hand(rows).items() if i == least} and linked
    assert sum(t.count() for name, t in counts if name == "pairs") <= 2 * len(rows)


def test_what_is_common_does_not_become_rare_among_more_texts(spark, monkeypatch):
    """The sample grows with the documents: shingles of one share of them stay at the end of the order."""
    monkeypatch.setattr(near_copies, "SAMPLE", 100)
    found = []
    for n in (500, 5000):
        rows = [(i, f"a b c d {i % 50} and x{i} y{i} z{i}") for i in range(n)]
        gram, often = near_copies.common_shingles(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("cast(text AS binary) AS text").repartition(3), sample=100, common=5)
        found.append((len(gram), int(often.sum())))
    assert found[1][0] >= 40 and found[1][1] > 5 * found[0][1]


def test_common_shingles_are_listed_up_to_a_number(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "LISTED", 10)
    rows = [(i, f"one two three four five {'six' if i % 2 else i}") for i in range(400)] + [(400 + i, " ".join(f"w{i % 20}-{j}" for j in range(6))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gram, often = near_copies.common_shingles(df.selectExpr("cast(text AS binary) AS text"), sample=10**6)
    assert len(gram) == 2 and sorted(often.tolist()) == [200, 400]
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(df).collect()}
    assert got == by_hand(rows)
