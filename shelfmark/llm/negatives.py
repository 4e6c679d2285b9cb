"""Hard negatives by exact inner products, several candidates to a multiplication.

Components are whole numbers (``floor(scale * x)``). A candidate's are shifted to be at least 0 and put beside those of
others into one wide integer, each in a field wide enough for its whole inner product with any anchor of the block; a wide
integer is multiplied once by an anchor's (shifted) component and summed over the components, and the fields then hold the
exact products, from which the shifts are taken out again. Integers of at most 53 bits are carried by doubles, whose
matrix product is exact as long as no sum passes 2^53; where fields are too wide for two of them, Python's integers carry
``WIDE_FIELDS`` candidates.

Anchors and candidates meet in cells: candidates are dealt into stripes, anchors into groups of at most ``GROUP_CELLS``
components, and each cell (stripe, group) is one key, whose anchors come first and whose candidates stream by in ascending
``vec_id``. A cell keeps the best of each anchor so far, so a later candidate matters only if it scores higher; it gives
out no more than these, and the cells' lists are merged by a limited window. No pair of rows is ever written.

1. positives: the ``n_positives`` best other rows of an anchor's label;
2. negatives: of the other labels, the ``n_negatives`` best within the two bounds that each positive's score sets.

Rows with a null label or vector, or a null or non-finite component, take no part. Vectors of different lengths are
compared as if the shorter ended in zeros. A null ``vec_id`` is no anchor and comes last among ties. Rows that share a
``vec_id`` are copies of one row: each is an anchor of its own where the id is one, none is another's positive, and as
negatives each counts. Components and scores that do not fit a long raise ArithmeticError. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import partitions, read, tidy, written

#: Components of the anchors of a group; candidates of a stripe, at least and at most; rows compared at once.
GROUP_CELLS, STRIPE_LEAST, STRIPE_MOST, ANCHORS, CANDIDATES = 1 << 21, 512, 100_000, 512, 2048
WIDE_FIELDS = 16
_EXACT = 53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _rows_of(values: pa.Array) -> np.ndarray:
    """Lists of whole numbers as a matrix, shorter ones filled with zeros."""
    sizes = np.diff(values.offsets.to_numpy())
    flat = values.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _padded(values: np.ndarray, width: int) -> np.ndarray:
    return values if values.shape[1] == width else np.pad(values, ((0, 0), (0, width - values.shape[1])))


def packed_products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """``anchors @ candidates.T`` of whole numbers, exactly, several candidates to a wide integer."""
    width = max(anchors.shape[1], candidates.shape[1])
    anchors, candidates = _padded(anchors, width), _padded(candidates, width)
    n = len(candidates)
    if not width or not n or not len(anchors):
        return np.zeros((len(anchors), n), np.int64)
    shift_a, shift_c = -min(0, int(anchors.min())), -min(0, int(candidates.min()))
    most = width * (int(anchors.max()) + shift_a) * (int(candidates.max()) + shift_c)
    field = max(1, most.bit_length())
    fields = min(_EXACT // field, n)
    kind = np.float64 if _EXACT // field >= 2 else object
    if kind is object:
        fields = min(WIDE_FIELDS, n)
    words = -(-n // fields)
    plain = candidates.astype(object) if kind is object else candidates
    shifted = np.zeros((words * fields, width), plain.dtype)
    shifted[:n] = plain + shift_c
    wide = np.zeros((words, width), plain.dtype)
    for k in range(fields):  # candidate w * fields + k is field k of word w
        wide += shifted[k::fields] << (field * k) if kind is not object else shifted[k::fields] * (1 << (field * k))
    left = anchors.astype(object) + shift_a if kind is object else (anchors + shift_a)
    sums = left.astype(kind) @ wide.astype(kind).T  # one product for each word and anchor component
    sums = sums if kind is object else sums.astype(np.int64)
    mask, parts = (1 << field) - 1, np.zeros((len(anchors), words * fields), sums.dtype)
    for k in range(fields):
        parts[:, k::fields] = (sums >> (field * k)) & mask
    # sum of (a - s)(c - t) = sum of ac - s * sum of c - t * sum of a + n * s * t, for shifted a and c
    out = parts[:, :n] - shift_a * shifted[:n].sum(1)[None, :] - shift_c * left.sum(1)[:, None] + width * shift_a * shift_c
    if kind is object:
        if any(not _LEAST <= x <= _MOST for x in (out.min(), out.max())):
            raise ArithmeticError("a score does not fit a long")
        out = out.astype(np.int64)
    return out


class Best:
    """The ``k`` best (score, id) of each anchor within bounds, of candidates that come in ascending id."""

    def __init__(self, k: int, low: np.ndarray, high: np.ndarray):
        self.k, self.low, self.high = k, low.copy(), high
        self.anchor, self.score, self.id, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, first: int, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        """``scores`` of anchors from ``first`` on. What only equals the least that is held is later, so it is none."""
        low, high = self.low[first : first + len(scores), None], self.high[first : first + len(scores), None]
        a, c = np.nonzero(allowed & (scores >= low) & (scores <= high))
        if not len(a):
            return
        touched = np.zeros(len(self.low), bool)
        touched[first + a] = True
        old = touched[self.anchor]
        anchor = np.concatenate([self.anchor[old], first + a])
        score, order = np.concatenate([self.score[old], scores[a, c]]), np.arange(len(anchor))
        id_, known_ = np.concatenate([self.id[old], ids[c]]), np.concatenate([self.known[old], known[c]])
        # held ones come first among equal scores, and candidates in their order
        best = np.lexsort((order, -score, anchor))
        anchor = anchor[best]
        rank = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
        keep = rank < self.k
        full = anchor[keep & (rank == self.k - 1)]
        best, rest = best[keep], ~old
        self.low[full] = score[best][(rank == self.k - 1)[keep]] + 1
        self.anchor, self.score = np.concatenate([self.anchor[rest], anchor[keep]]), np.concatenate([self.score[rest], score[best]])
        self.id, self.known = np.concatenate([self.id[rest], id_[best]]), np.concatenate([self.known[rest], known_[best]])


def _valid(scale: int):
    """Rows that take part, their components as whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v").cast(pa.list_(pa.float64()))
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # a null is no number
            bad = np.append(0, np.cumsum(~np.isfinite(values)))
            ends = np.cumsum(sizes)
            good = np.flatnonzero(bad[ends] == bad[ends - sizes])
            whole = np.floor(scale * np.where(np.isfinite(values), values, 0.0))
            if (np.abs(whole) >= 2.0**63).any():
                raise ArithmeticError("a component does not fit a long")
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(whole.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(good)), batch.column("label").take(pa.array(good)), lists.take(pa.array(good))], names=["vec_id", "label", "v"])

    return run


_CELL = "cell long, side int, a long, vec_id long, label long, v array<long>, bounds array<struct<low: long, high: long>>"


def _cell_best(k: int, same_label: bool):
    """Of each cell, every anchor's best candidates by bound: ``a, slot, id, score``.

    A cell's anchors (side 0) come before its candidates, these in ascending id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, heads, ready, best = None, [], None, []

        def given() -> Iterator[pa.RecordBatch]:
            if ready is not None:
                for slot, b in enumerate(best):
                    if len(b.anchor):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ready[0][b.anchor]), pa.array(np.full(len(b.anchor), slot, np.int32)), pa.array(b.id, mask=~b.known), pa.array(b.score)], names=["a", "slot", "id", "score"]
                        )

        def prepared(rows: list[pa.RecordBatch]):
            table = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            bounds = table.column("bounds")
            sizes, flat = np.diff(bounds.offsets.to_numpy()), bounds.flatten()
            slots = int(sizes.max())
            low, high = np.full((slots, len(table)), 1, np.int64), np.zeros((slots, len(table)), np.int64)  # nothing lies between
            at = np.repeat(np.arange(len(table)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            low[at[1], at[0]], high[at[1], at[0]] = flat.field("low").to_numpy(), flat.field("high").to_numpy()
            own = [table.column(c).to_numpy(zero_copy_only=False) for c in ("a", "vec_id", "label")]
            return (*own, _rows_of(table.column("v"))), [Best(k, low[s], high[s]) for s in range(slots)]

        for batch in batches:
            keys = np.stack([batch.column("cell").to_numpy(), batch.column("side").to_numpy()])
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), len(batch)]
            for lo, hi in zip(edges, edges[1:]):  # noqa: B905
                if hi == lo:
                    continue
                part = batch.slice(lo, hi - lo)
                if keys[0, lo] != cell:
                    yield from given()
                    cell, heads, ready, best = keys[0, lo], [], None, []
                if keys[1, lo] == 0:
                    heads.append(part)
                    continue
                if not heads:
                    continue  # no anchors in this cell
                if ready is None:
                    ready, best = prepared(heads)
                _, anchor_ids, anchor_labels, anchors = ready
                for x in range(0, len(part), CANDIDATES):
                    some = part.slice(x, CANDIDATES)
                    known = some.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
                    ids, labels = some.column("vec_id").fill_null(0).to_numpy(), some.column("label").to_numpy()
                    vectors = _rows_of(some.column("v"))
                    for y in range(0, len(anchors), ANCHORS):
                        scores = packed_products(anchors[y : y + ANCHORS], vectors)
                        same = anchor_labels[y : y + ANCHORS, None] == labels[None, :]
                        allowed = same & ~(known[None, :] & (anchor_ids[y : y + ANCHORS, None] == ids[None, :])) if same_label else ~same
                        for b in best:
                            b.add(y, scores, allowed, ids, known)
        yield from given()

    return run


def _met(rows: DataFrame, anchors: DataFrame, stripes: int, groups: int, k: int, same_label: bool) -> DataFrame:
    """``a, slot, id, score, rank``: the ``k`` best of each anchor and bound over all candidates."""
    none = F.lit(None)
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cell = lambda stripe, group: (stripe * groups + group).cast("long")
    heads = anchors.withColumn("s", numbers(stripes)).select(
        cell(F.col("s"), F.pmod("a", F.lit(groups))).alias("cell"), F.lit(0).alias("side"), "a", "vec_id", "label", "v", "bounds"
    )
    others = rows.withColumn("g", numbers(groups)).select(
        cell(F.pmod("row", F.lit(stripes)), F.col("g")).alias("cell"), F.lit(1).alias("side"), none.cast("long").alias("a"), "vec_id", "label", "v",
        none.cast("array<struct<low: bigint, high: bigint>>").alias("bounds"),
    )
    cells = max(partitions(rows.sparkSession), stripes * groups)
    dealt = heads.unionByName(others).repartition(cells, "cell").sortWithinPartitions("cell", "side", F.asc_nulls_last("vec_id"))
    found = dealt.mapInArrow(tidy(_cell_best(k, same_label)), "a long, slot int, id long, score long")
    rank = F.row_number().over(Window.partitionBy("a", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def mined(vectors: DataFrame, anchor: Column, low: tuple[int, int] = (30, 100), high: tuple[int, int] = (90, 100), n_positives: int = 5, n_negatives: int = 10,
          scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows for which ``anchor`` holds.

    A negative's score s lies between two fractions of the positive's p: ``low[0] * p <= low[1] * s`` and
    ``high[1] * s <= high[0] * p``.
    """
    spark = vectors.sparkSession
    is_anchor = F.coalesce(anchor, F.lit(False))
    named = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = named.where("label IS NOT NULL AND v IS NOT NULL").mapInArrow(tidy(_valid(scale)), "vec_id long, label long, v array<long>")
    rows = written(rows.withColumns({"row": F.monotonically_increasing_id(), "is_anchor": is_anchor}), "vectors")
    n, n_anchors, width = rows.agg(F.count("*"), F.count_if("is_anchor"), F.max(F.size("v"))).first()
    groups = max(1, -(-n_anchors * max(width or 1, 1) // GROUP_CELLS))
    # row numbers leave gaps, but those of a partition follow each other
    stripes = max(1, min(partitions(spark), n // STRIPE_LEAST), -(-n // STRIPE_MOST))
    heads = rows.where("is_anchor").select(F.col("row").alias("a"), "vec_id", "label", "v")
    every = F.array(F.struct(F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high")))
    positives = _met(rows, heads.withColumn("bounds", every), stripes, groups, n_positives, True)
    positives = written(positives.select("a", F.col("rank").alias("p_rank"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # positives of one score have the same negatives
    exact = lambda times, over, up: F.expr(f"cast({'ceil' if up else 'floor'}(cast({times} as decimal(10,0)) * positive_score / {over}) as bigint)")
    ranges = positives.select("a", "positive_score").distinct().withColumns({"low": exact(*low, True), "high": exact(*high, False)}).where("low <= high")
    bounds = ranges.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("positive_score", "low", "high"))).alias("b"))
    bounds = written(bounds, "bounds")  # at most n_positives for each anchor
    led = heads.join(bounds, "a")
    found = _met(rows, led.withColumn("bounds", F.transform("b", lambda b: F.struct(b.low.alias("low"), b.high.alias("high")))).drop("b"), stripes, groups, n_negatives, False)
    slots = bounds.select("a", F.posexplode("b").alias("slot", "b")).select("a", "slot", F.col("b.positive_score").alias("positive_score"))
    ids = heads.select("a", F.col("vec_id").alias("anchor_id"))
    pairs = positives.join(slots, ["a", "positive_score"]).join(ids, "a")
    return pairs.join(found, ["a", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; labels of ids divisible by 7 are moved on by one first."""
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score FROM r a JOIN r c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""
