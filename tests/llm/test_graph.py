"""Components by few jobs, and by rounds where edges are too many for that."""

import random

import pytest

import corpus_pipeline
from shelfmark.llm import graph, tokens


def edges_of(n=300):
    """A shuffled chain, a hub, loops and repeated edges."""
    rng = random.Random(2)
    chain = rng.sample(range(1000, 9000), n)
    rows = [*zip(chain, chain[1:], strict=False), *((7, 10_000 + i) for i in range(n)), (5, 5), (chain[3], chain[2])]  # noqa: RUF005
    rng.shuffle(rows)
    want = {x: min(chain) for x in chain} | {10_000 + i: 7 for i in range(n)} | {7: 7}
    return rows, want


@pytest.mark.parametrize(("held", "most"), [(graph.HELD, 2), (150, 60)])
def test_components(spark, monkeypatch, held, most):
    rows, want = edges_of()
    tables = []
    monkeypatch.setattr(graph, "written", lambda df, name, real=graph.written: tables.append(name) or real(df, name))
    df = spark.createDataFrame(rows, "a long, b long").repartition(6)
    found = [(r["node"], r["component"]) for r in graph.components(df, held=held).collect()]
    assert len(found) == len(want) and dict(found) == want and len(tables) <= most
    assert (len(tables) > 2) == (held < len(rows))


def test_no_edges(spark):
    assert graph.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_packing_loads_no_vocabulary_in_the_driver(spark, monkeypatch):
    def encoder(*_):
        raise AssertionError("loaded in the driver")

    monkeypatch.setattr(tokens, "Encoder", encoder)
    with pytest.raises(Exception, match="loaded in the driver") as e:  # a task loads it, and only there
        corpus_pipeline.packing_stage(spark, spark.createDataFrame([(1, "one two")], "doc_id long, text string"), "")
    assert not isinstance(e.value, AssertionError)
