"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import discard, tidy, written

#: Edges that a task holds at once.
HELD = 500_000


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least index connected with each of ``n`` indices by the pairs ``a, b``."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        low = np.minimum(x, y)
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _forests(held: int):
    """Edges that connect what ``held`` of a task's edges connect: each node with the least that it reaches among them."""

    def least(parts: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.concatenate([np.zeros((2, 0), np.int64), *parts], axis=1)
        node, at = np.unique(pairs, return_inverse=True)
        at = at.reshape(pairs.shape)
        label = forest(at[0], at[1], len(node))
        moved = np.flatnonzero(label != np.arange(len(node)))
        return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[label[moved]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            if parts and n + batch.num_rows > held:
                yield least(parts)
                parts, n = [], 0
            parts.append(np.stack([batch.column(c).to_numpy() for c in ("a", "b")]))
            n += batch.num_rows
        yield least(parts)

    return run


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 60, held: int = HELD) -> DataFrame:
    """``node, component`` (the smallest node reachable) for each node of the undirected ``edges(a, b)``.

    Nodes are longs; loops are ignored. Edges go to tasks of about ``held`` each, which reduce them to stars by union-find. No
    more edges than that are done by this; of more, the tasks' stars are joined in rounds, whose number grows with the
    logarithm of the longest chain. Minima are combined before the shuffle and only then joined, so that a hub's edges may
    be split over tasks; each round is written to the shared folder, and the first that changes nothing is the last.
    """
    given = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    tasks = max(1, -(-given.count() // held))
    now = given.coalesce(tasks).mapInArrow(tidy(_forests(held)), "a long, b long")
    now = written(now if tasks == 1 else now.distinct(), "edges")
    discard(given)
    seen = _state(now) if tasks > 1 else None
    for _ in range(rounds if seen else 0):
        then = written(_small_star(_large_star(now)), "edges")
        state = _state(then)
        discard(now)
        now = then
        if state == seen:
            break
        seen = state
    else:
        if seen:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
