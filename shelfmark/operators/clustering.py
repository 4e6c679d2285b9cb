"""Clusters of stores: k-means over candidates, scores, choice and labels."""

from __future__ import annotations

import math
from functools import reduce
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.scratch import staged
from shelfmark.plans.specs import Feature

FEW = 11
#: Starts of each candidate.
STARTS = 3


def vectors(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)


#: Algorithms of candidates, Spark's distributed ones; ``mixture`` besides.
ALGORITHMS = {"kmeans": KMeans, "bisecting": BisectingKMeans}


def _best_model(algorithm: str, k: int, vec: DataFrame, seed: int, starts: int):
    """Of several starts the one with the least sum of squares."""
    best = None
    for s in range(seed, seed + max(1, starts)):
        model = ALGORITHMS[algorithm](k=k, seed=s, featuresCol="features", predictionCol="labels").fit(vec)
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    return best


def _mixture(k: int, vec: DataFrame, seed: int, starts: int) -> DataFrame:
    """``vec`` with ``labels`` of a Gaussian mixture whose weights, means and covariances start from the best k-means.

    A mixture that starts from random rows often ends in a local optimum. The driver gets a row for each cluster.
    """
    from pyspark.mllib.clustering import GaussianMixture
    from pyspark.mllib.linalg import DenseMatrix, DenseVector
    from pyspark.mllib.stat.distribution import MultivariateGaussian

    labelled = _best_model("kmeans", k, vec, seed, starts).transform(vec).withColumn("__a", vector_to_array("features"))
    n = len(labelled.select("__a").first()[0])
    dim = [F.col("__a")[i] for i in range(n)]
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    rows = labelled.groupBy("labels").agg(
        F.count("*").alias("n"), *[F.avg(d).alias(f"m{i}") for i, d in enumerate(dim)], *[F.covar_pop(dim[i], dim[j]).alias(f"c{i}_{j}") for i, j in pairs]
    ).orderBy("labels").collect()
    total = sum(r["n"] for r in rows)
    # a little spread in every direction, so that equal points make no singular start
    ridge = 1e-9 * max([r[f"m{i}"] ** 2 + r[f"c{i}_{i}"] for r in rows for i in range(n)]) + 1e-12
    gaussians = []
    for r in rows:
        cov = [r[f"c{min(i, j)}_{max(i, j)}"] + (ridge if i == j else 0.0) for j in range(n) for i in range(n)]
        gaussians.append(MultivariateGaussian(DenseVector([r[f"m{i}"] for i in range(n)]), DenseMatrix(n, n, cov)))
    start = SimpleNamespace(k=len(rows), weights=[r["n"] / total for r in rows], gaussians=gaussians)
    points = labelled.select("__a").rdd.map(lambda r: r[0])  # what a start can be given to takes an RDD
    model = GaussianMixture.train(points, len(rows), seed=seed, initialModel=start)
    parts = [(w, g.mu.toArray(), g.sigma.toArray()) for w, g in zip(model.weights, model.gaussians, strict=True)]

    @F.pandas_udf("int")
    def label(values: pd.Series) -> pd.Series:
        x = np.stack(values.to_numpy())
        scores = []
        for weight, mean, cov in parts:
            values_, axes = np.linalg.eigh(cov)
            values_ = np.maximum(values_, max(values_.max(), 1e-300) * 1e-12)
            scores.append(np.log(max(weight, 1e-300)) - 0.5 * (np.log(values_).sum() + (((x - mean) @ axes) ** 2 / values_).sum(1)))
        return pd.Series(np.argmax(scores, 0), dtype="int32")

    return labelled.withColumn("labels", label("__a")).drop("__a")


def candidate_grid(vec: DataFrame, ks: list[int], algorithms: tuple[str, ...] = ("kmeans",), seed: int = 1, starts: int = STARTS) -> dict[tuple[str, int], DataFrame]:
    """``vec`` (with ``features``) with a column ``labels``, for each algorithm and k (M9); as ``score_clusters`` and
    ``select_outputs`` take them. A start may end in a local optimum, so the best of ``starts`` is taken, and a mixture
    starts from the best k-means."""
    if unknown := set(algorithms) - {*ALGORITHMS, "mixture"}:
        raise ValueError(f"unknown algorithms {sorted(unknown)}")
    # written once: fits, scores and the labelled rows themselves would each make the features again
    vec = staged(vec, "features")
    cached = vec.persist()
    try:
        models = {(a, k): _mixture(k, cached, seed, starts) if a == "mixture" else _best_model(a, k, cached, seed, starts) for a in algorithms for k in ks}
        return {c: m if c[0] == "mixture" else m.transform(vec) for c, m in models.items()}
    finally:
        cached.unpersist()


def kmeans_grid(vec: DataFrame, ks: list[int], seed: int = 1) -> dict[int, DataFrame]:
    """The k-means candidates by k."""
    return {k: df for (_, k), df in candidate_grid(vec, ks, seed=seed).items()}


def score_clusters(vec: DataFrame, labels: str = "labels") -> DataFrame:
    """One row ``silhouette, davies_bouldin, calinski_harabasz, n_labels`` (M10). The driver gets one row per cluster."""
    arr = vec.withColumn("__a", vector_to_array("features"))
    n = len(arr.select("__a").first()[0])
    dims = [F.col("__a")[i] for i in range(n)]
    centres = arr.groupBy(labels).agg(F.count("*").alias("n"), *[F.avg(d).alias(f"c{i}") for i, d in enumerate(dims)])
    square = reduce(lambda a, b: a + b, [(d - F.col(f"c{i}")) ** 2 for i, d in enumerate(dims)])
    spread = arr.join(F.broadcast(centres), labels).groupBy(labels, "n", *[f"c{i}" for i in range(n)]).agg(F.avg(F.sqrt(square)).alias("s"), F.sum(square).alias("w"))
    rows = spread.orderBy(labels).collect()
    k, total = len(rows), sum(r["n"] for r in rows)
    points = [[r[f"c{i}"] for i in range(n)] for r in rows]
    mean = [sum(r["n"] * p[i] for r, p in zip(rows, points, strict=True)) / total for i in range(n)]
    silhouette = davies = calinski = None
    if k >= 2:
        worst = [max((rows[i]["s"] + rows[j]["s"]) / d if (d := math.dist(points[i], points[j])) else math.inf for j in range(k) if j != i) for i in range(k)]
        davies = sum(worst) / k
        between = sum(r["n"] * math.dist(p, mean) ** 2 for r, p in zip(rows, points, strict=True))
        within = sum(r["w"] for r in rows)
        calinski = (between / (k - 1)) / (within / (total - k)) if within and total > k else math.inf
        silhouette = ClusteringEvaluator(predictionCol=labels, featuresCol="features").evaluate(vec)
    return vec.sparkSession.createDataFrame([(silhouette, davies, calinski, k)], "silhouette double, davies_bouldin double, calinski_harabasz double, n_labels int")


def rank_candidates(scores: dict[str, dict[str, float]], weights: dict[str, float] | None = None) -> str:
    """The candidate of the least weighted sum of ranks; those with under two labels are left out; ties by name."""
    weights = weights or {"silhouette": 1.0, "davies_bouldin": 1.0, "calinski_harabasz": 1.0}
    able = {c: s for c, s in scores.items() if (s.get("n_labels") or 0) >= 2}
    if not able:
        raise ValueError("no candidate has two labels")
    sums = dict.fromkeys(able, 0.0)
    for metric, weight in weights.items():
        order = sorted(able, key=lambda c: (able[c][metric] if metric == "davies_bouldin" else -able[c][metric], c))
        for rank, c in enumerate(order, 1):
            sums[c] += weight * rank
    return min(sums, key=lambda c: (sums[c], c))


def select_outputs(candidates: dict[tuple[str, int], DataFrame], scores: dict[tuple[str, int], dict], mode: str) -> dict[str, DataFrame]:
    """Candidates are ``(algorithm, k)``: the best of each k, the algorithm that is best most often, or the best of all."""
    name = lambda c: f"{c[0]}:{c[1]:04d}"
    best_of = {}
    for k in sorted({c[1] for c in candidates}):
        able = {name(c): scores[c] for c in candidates if c[1] == k and (scores[c].get("n_labels") or 0) >= 2}
        if able:
            best_of[k] = rank_candidates(able)
    back = {name(c): c for c in candidates}
    if mode == "per_k":
        return {str(k): candidates[back[b]] for k, b in best_of.items()}
    if mode == "consistent":
        wins: dict[str, int] = {}
        for b in best_of.values():
            wins[back[b][0]] = wins.get(back[b][0], 0) + 1
        algorithm = min(wins, key=lambda a: (-wins[a], a))
        return {str(k): candidates[(algorithm, k)] for k in best_of if (algorithm, k) in candidates}
    if mode == "overall":
        best = rank_candidates({name(c): scores[c] for c in candidates})
        return {str(back[best][1]): candidates[back[best]]}
    raise ValueError(f"unknown mode {mode!r}")


def letter(i: int) -> str:
    """A ... Z, AA ... ZZ."""
    return chr(65 + i) if i < 26 else chr(65 + i // 26 - 1) + chr(65 + i % 26)


def relabel(df: DataFrame, labels: str = "labels", by: str | None = None, letters: bool = False) -> DataFrame:
    """Labels numbered from 0 by descending mean of a column (by the old label without one), as letters if wanted."""
    key = F.avg(by) if by else -F.first(labels)
    order = df.groupBy(labels).agg(key.alias("__m"))
    w = Window.orderBy(F.desc("__m"), labels)  # one row per cluster
    numbered = order.select(labels, (F.row_number().over(w) - 1).alias("__new"))
    new = F.col("__new")
    if letters:
        n = 26 * 27
        new = F.element_at(F.array(*[F.lit(letter(i)) for i in range(n)]), F.col("__new") + 1)
    return df.join(F.broadcast(numbered), labels).withColumn(labels, new).drop("__new")


def store_clusters(master: DataFrame, level: list[str], features: list[Feature], ks: list[int], seed: int = 1) -> DataFrame:
    """``level..., store_code, labels, cluster_name`` (M13): stores of each level clustered by their features.

    Levels are few (channels); up to 11 stores make one cluster. ``cluster_name`` is the level and the label.
    """
    stores = staged(master.groupBy(*level, "store_code").agg(*[F.expr(f.expr).alias(f.name) for f in features]).na.fill(0.0), "store-features")
    names = [f.name for f in features]
    parts = []
    for r in stores.groupBy(*level).count().orderBy(*level).collect():
        mine = reduce(lambda d, c: d.where(F.col(c).eqNullSafe(F.lit(r[c]))), level, stores)
        able = [k for k in ks if 2 <= k < r["count"]]
        if r["count"] <= FEW or not able:
            labelled = mine.withColumn("labels", F.lit(0))
        else:
            grid = kmeans_grid(vectors(mine, names), able, seed)
            scores = {f"{k:04d}": score_clusters(df).first().asDict() for k, df in grid.items()}
            usable = {c: s for c, s in scores.items() if s["n_labels"] >= 2}
            labelled = grid[int(rank_candidates(usable))].drop("features") if usable else mine.withColumn("labels", F.lit(0))
        parts.append(relabel(labelled, by=names[0]))
    out = reduce(DataFrame.unionByName, parts)
    name = F.concat_ws("-", *level, F.col("labels").cast("string"))
    return out.withColumn("cluster_name", name).select(*level, "store_code", "labels", "cluster_name").distinct()


def cluster_summary(df: DataFrame, level: list[str], features: list[str]) -> DataFrame:
    """Means of numbers and modes of categories by cluster (M14); ties of a mode go to the least value."""
    aggs = [F.avg(c).alias(c) if isinstance(df.schema[c].dataType, T.NumericType) else F.mode(c, True).alias(c) for c in features]
    return df.groupBy(*level, "cluster_name").agg(F.count("*").alias("n"), *aggs)
