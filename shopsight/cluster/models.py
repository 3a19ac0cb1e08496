"""Centroid and mixture models with restarts, parameter sweeps, and weighted Ward trees."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from shopsight.cluster.blocks import distances
from shopsight.cluster.kmeans import START_ROWS, CentreModel, assign_to_centres, fit_many, label_nearest, lloyd, spread, start_centres, start_sample, summed
from shopsight.cluster.metrics import (
    MEASURES,
    calinski_harabasz,
    centroid_table,
    davies_bouldin,
    exact_silhouette,
    squared_silhouette,
)
from shopsight.session import cut_lineage, together

MICRO_CLUSTERS = 2000
MICRO_ROUNDS = 20
MICRO_STARTS = 4  # rows for each centre among which start values are chosen
COVARIANCE_RIDGE = 1e-6
MIN_WEIGHT = 1e-12
ROWS_AT_ONCE = 8_192


def fit_kmeans(vectors: DataFrame, k: int, seed: int = 42, restarts: int = 10, max_iter: int = 300) -> CentreModel:
    """The restart with the lowest cost; all restarts share their passes. `vectors` should be persisted by the caller."""
    return fit_many(vectors, [k], seed, restarts, max_iter)[k]


def sweep_kmeans(
    vectors: DataFrame,
    id_column: str,
    ks: Iterable[int] = range(2, 11),
    seed: int = 42,
    restarts: int = 10,
    silhouette: str = "squared",
    threads: int = 4,
    models: dict[int, CentreModel] | None = None,
) -> DataFrame:
    """k, inertia, silhouette (by the given measure), davies_bouldin, calinski_harabasz and measure for each k.

    The models of all k and restarts are fitted in the same passes, unless fitted ones are given.
    """
    if silhouette not in MEASURES:
        raise ValueError(f"silhouette is one of {MEASURES}")

    ks = list(ks)
    models = models or fit_many(vectors, ks, seed, restarts)

    def once(k: int) -> tuple:
        model = models[k]
        labelled = model.transform(vectors).withColumnRenamed("prediction", "cluster").persist()
        score = exact_silhouette(labelled, id_column) if silhouette == "exact" else squared_silhouette(labelled)
        centroids = centroid_table(labelled).persist()
        row = (k, model.cost, score, davies_bouldin(centroids), calinski_harabasz(centroids), silhouette)
        centroids.unpersist()
        labelled.unpersist()
        return row

    rows = together(vectors.sparkSession, once, ks, threads)
    schema = "k int, inertia double, silhouette double, davies_bouldin double, calinski_harabasz double, measure string"
    return vectors.sparkSession.createDataFrame(rows, schema)


def best_k(sweep: DataFrame) -> int:
    """The k with the highest silhouette, lowest k on ties."""
    return sweep.agg(F.max_by("k", F.struct("silhouette", -F.col("k")))).first()[0]


def gap_statistic(vectors: DataFrame, ks: Iterable[int], samples: int = 5, seed: int = 42, restarts: int = 1) -> DataFrame:
    """Mean log cost on uniform data in the same box minus the log cost on the data, per k.

    Each sample and the data have passes of their own, which run at the same time.
    """
    spark = vectors.sparkSession
    xs = vectors.select(vector_to_array("features").alias("x")).persist()
    dims = len(xs.first()["x"])
    box = xs.agg(
        F.array(*[F.min(F.col("x")[i]) for i in range(dims)]).alias("lo"),
        F.array(*[F.max(F.col("x")[i]) for i in range(dims)]).alias("hi"),
    ).first()
    n, ks = xs.count(), list(ks)

    def logs_of(b: int) -> dict[int, float]:
        if b == samples:
            return {k: np.log(m.cost) for k, m in fit_many(vectors, ks, seed, restarts).items()}
        axes = [F.lit(box["lo"][i]) + F.rand(seed + b * dims + i) * (box["hi"][i] - box["lo"][i]) for i in range(dims)]
        uniform = spark.range(n).select(array_to_vector(F.array(*axes)).alias("features")).persist()
        found = {k: np.log(model.cost) for k, model in fit_many(uniform, ks, seed, restarts).items()}
        uniform.unpersist()
        return found

    *drawn, costs = together(spark, logs_of, range(samples + 1), samples + 1)
    logs = {k: [one[k] for one in drawn] for k in ks}
    rows = [(k, float(np.mean(logs[k]) - costs[k]), float(np.std(logs[k]) * np.sqrt(1 + 1 / samples))) for k in ks]
    xs.unpersist()
    return spark.createDataFrame(rows, "k int, gap double, deviation double")


@dataclass
class Mixture:
    """Gaussians with full covariances. `log_likelihood` is the total of the rows under these parameters."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray | None
    log_likelihood: float = -np.inf
    rounds: int = 0

    @property
    def k(self) -> int:
        return len(self.means)

    def whitening(self) -> tuple[list[np.ndarray], list[float]]:
        """Of each component: the inverse of the Cholesky factor, and the logarithm of weight times density at the mean."""
        halves = [np.linalg.cholesky(c) for c in self.covariances]
        dims = self.means.shape[1]
        peaks = [
            float(np.log(max(w, MIN_WEIGHT)) - 0.5 * dims * np.log(2 * np.pi) - np.log(np.diag(h)).sum())
            for w, h in zip(self.weights, halves, strict=True)
        ]
        return [np.linalg.inv(h) for h in halves], peaks

    def shares(self, x: np.ndarray) -> tuple[np.ndarray, float]:
        """Posterior of each component for every row, and the log-likelihood of the rows; nearest mean without covariances."""
        if self.covariances is None:
            gaps = np.stack([((x - m) ** 2).sum(axis=1) for m in self.means], axis=1)
            return np.eye(self.k)[gaps.argmin(axis=1)], -np.inf
        inverses, peaks = self.whitening()
        logs = np.stack([p - 0.5 * (((x - m) @ h.T) ** 2).sum(axis=1) for m, h, p in zip(self.means, inverses, peaks, strict=True)], axis=1)
        top = logs.max(axis=1, keepdims=True)
        total = top[:, 0] + np.log(np.exp(logs - top).sum(axis=1))
        return np.exp(logs - total[:, None]), float(total.sum())

    def improved(self, sums: np.ndarray) -> Mixture:
        """The next parameters, from sums about the means: weight, vector and outer products of each component."""
        dims = self.means.shape[1]
        mass = np.maximum(sums[:, 0], MIN_WEIGHT)
        moved = sums[:, 1 : 1 + dims] / mass[:, None]
        outer = sums[:, 1 + dims :].reshape(-1, dims, dims) / mass[:, None, None]
        spread = outer - moved[:, :, None] * moved[:, None, :] + COVARIANCE_RIDGE * np.eye(dims)
        return Mixture(mass / mass.sum(), self.means + moved, spread, rounds=self.rounds + 1)


def _mixture_sums(points: DataFrame, models: list[Mixture]) -> list[tuple[float, np.ndarray]]:
    """(log-likelihood, sums) of every model, in one pass over the points.

    What a task returns depends on the models and the dimensions only.
    """
    shared = points.sparkSession.sparkContext.broadcast(models)
    dims = models[0].means.shape[1]
    bounds = np.cumsum([0, *(m.k for m in models)]).tolist()

    def total(every: np.ndarray, models: list[Mixture]) -> np.ndarray:
        totals = np.zeros((bounds[-1], 2 + dims + dims * dims))
        for at in range(0, len(every), ROWS_AT_ONCE):
            x = every[at : at + ROWS_AT_ONCE]
            for first, model in zip(bounds, models):
                share, likelihood = model.shares(x)
                for j, mean in enumerate(model.means):
                    away = x - mean
                    weighed = away * share[:, j : j + 1]
                    totals[first + j] += np.concatenate([[likelihood, share[:, j].sum()], weighed.sum(axis=0), (away.T @ weighed).ravel()])
        return totals

    found = summed(points, shared, total, (bounds[-1], 2 + dims + dims * dims), dims)
    shared.destroy()
    return [(float(found[a, 0]), found[a:b, 1:]) for a, b in zip(bounds, bounds[1:])]


def _start(x: np.ndarray, k: int, rng: np.random.Generator) -> Mixture:
    return Mixture(np.full(k, 1 / k), start_centres(x, k, rng), None)


def fit_mixtures(
    vectors: DataFrame, ks: Sequence[int], seed: int = 42, restarts: int = 5, max_iter: int = 200, tol: float = 1e-3, start_rows: int = START_ROWS
) -> dict[int, Mixture]:
    """For each k, the restart with the highest likelihood.

    Expectation-maximisation over all rows, from K-Means centres of at most `start_rows` of them, chosen by a hash.
    Every round is one pass over the rows for all models that still move; a model stops when the mean log-likelihood
    of a row gains less than `tol`. Decompositions of the small covariances are numpy's.
    """

    near = start_sample(vectors, start_rows)  # start values only; every round reads all rows
    points = spread(vectors)
    jobs = [(k, offset) for k in ks for offset in range(restarts)]
    models = {(k, offset): _start(near, k, np.random.default_rng(seed + offset)) for k, offset in jobs}
    n = vectors.count()
    likelihoods = dict.fromkeys(jobs, -np.inf)
    moving = jobs
    while moving:
        found = _mixture_sums(points, [models[job] for job in moving])
        still = []
        for job, (likelihood, sums) in zip(moving, found, strict=True):
            model, before = models[job], likelihoods[job]
            model.log_likelihood = likelihoods[job] = likelihood
            if model.covariances is None or (likelihood - before > tol * n and model.rounds < max_iter):
                models[job] = model.improved(sums)
                still.append(job)
        moving = still
    points.unpersist()
    return {k: max((models[k, o] for o in range(restarts)), key=lambda m: m.log_likelihood) for k in ks}


def fit_gmm(vectors: DataFrame, k: int, seed: int = 42, restarts: int = 5, max_iter: int = 200) -> Mixture:
    """The restart with the highest likelihood. `vectors` should be persisted by the caller."""
    return fit_mixtures(vectors, [k], seed, restarts, max_iter)[k]


def gmm_criteria(log_likelihood: float, k: int, dims: int, n: int) -> tuple[float, float]:
    """(BIC, AIC) of a mixture with full covariances."""
    parameters = k * dims + k * dims * (dims + 1) // 2 + k - 1
    return -2 * log_likelihood + parameters * float(np.log(n)), -2 * log_likelihood + 2 * parameters


def sweep_gmm(
    vectors: DataFrame, ks: Iterable[int] = range(2, 11), seed: int = 42, restarts: int = 5, max_iter: int = 200, models: dict[int, Mixture] | None = None
) -> DataFrame:
    """n (components), log_likelihood, bic and aic; the models of all k are fitted in the same passes, unless fitted ones are given."""
    rows_read, ks = vectors.count(), list(ks)
    models = models or fit_mixtures(vectors, ks, seed, restarts, max_iter)
    rows = [(k, models[k].log_likelihood, *gmm_criteria(models[k].log_likelihood, k, models[k].means.shape[1], rows_read)) for k in dict.fromkeys(ks)]
    return vectors.sparkSession.createDataFrame(rows, "n int, log_likelihood double, bic double, aic double")


def gmm_labels(model: Mixture, vectors: DataFrame) -> DataFrame:
    """cluster (lowest number on ties) and the probability of it, as expressions."""
    inverses, peaks = model.whitening()

    def log_density(mean: np.ndarray, inverse: np.ndarray, peak: float) -> Column:
        dot = lambda row: F.aggregate(F.zip_with("_x", F.lit(row.tolist()), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        sides = F.array(*[dot(row) - F.lit(float(row @ mean)) for row in inverse])
        return F.lit(peak) - F.aggregate(sides, F.lit(0.0), lambda s, v: s + v * v) / 2

    logs = F.array(*[log_density(*one) for one in zip(model.means, inverses, peaks, strict=True)])
    scored = vectors.withColumn("_x", vector_to_array("features")).withColumn("_logs", logs)
    top = F.array_max("_logs")
    sure = 1 / F.aggregate(F.transform("_logs", lambda v: F.exp(v - F.array_max("_logs"))), F.lit(0.0), lambda s, v: s + v)
    others = [c for c in vectors.columns if c not in ("cluster", "confidence")]
    return scored.select(*others, (F.array_position("_logs", top) - 1).cast("int").alias("cluster"), sure.alias("confidence"))


def merge_tree(centres: np.ndarray, sizes: np.ndarray, method: str = "ward") -> np.ndarray:
    """Agglomeration of at most a few thousand weighted centres: rows (left, right, height, size).

    Lance-Williams updates on the distance matrix; a new node i has number len(centres) + i.
    """
    m = len(centres)
    sizes = sizes.astype(float).copy()
    gaps = distances(centres.ravel(), m, centres.ravel(), m)
    if method == "ward":
        gaps *= np.sqrt(2.0 * np.multiply.outer(sizes, sizes) / np.add.outer(sizes, sizes))
    np.fill_diagonal(gaps, np.inf)
    node, alive, merges = np.arange(m), np.ones(m, bool), []
    nearest = gaps.argmin(axis=1)
    reach = gaps[np.arange(m), nearest]
    for step in range(m - 1):
        i = int(np.where(alive, reach, np.inf).argmin())
        j = int(nearest[i])
        height, ni, nj = gaps[i, j], sizes[i], sizes[j]
        merges.append((min(node[i], node[j]), max(node[i], node[j]), height, ni + nj))
        if method == "ward":
            total = ni + nj + sizes
            joined = ((ni + sizes) * gaps[i] ** 2 + (nj + sizes) * gaps[j] ** 2 - sizes * height**2) / total
            joined = np.sqrt(np.maximum(joined, 0.0))
        elif method == "complete":
            joined = np.maximum(gaps[i], gaps[j])
        elif method == "average":
            joined = (ni * gaps[i] + nj * gaps[j]) / (ni + nj)
        else:
            raise ValueError(f"unknown linkage: {method}")
        alive[j] = False
        joined[~alive] = np.inf
        joined[i] = np.inf
        gaps[i], gaps[:, i] = joined, joined
        gaps[j], gaps[:, j] = np.inf, np.inf
        sizes[i], node[i] = ni + nj, m + step
        stale = alive & ((nearest == i) | (nearest == j))
        stale[i] = True
        for r in np.flatnonzero(stale):
            nearest[r] = gaps[r].argmin()
            reach[r] = gaps[r, nearest[r]]
        closer = alive & (gaps[:, i] < reach)
        nearest[closer], reach[closer] = i, gaps[closer, i]
    return np.array(merges, dtype=float)


def cut_tree(merges: np.ndarray, leaves: int, clusters: int) -> np.ndarray:
    """Cluster number of every leaf after undoing the last merges; numbered by first leaf."""
    parent = np.arange(2 * leaves)
    for step, (left, right, _, _) in enumerate(merges[: leaves - clusters]):
        parent[int(left)] = parent[int(right)] = leaves + step

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    roots = [top(i) for i in range(leaves)]
    order = {r: n for n, r in enumerate(dict.fromkeys(roots))}
    return np.array([order[r] for r in roots])


def micro_clusters(vectors: DataFrame, id_column: str, m: int = MICRO_CLUSTERS, seed: int = 42) -> DataFrame:
    """(id, micro): the nearest of at most m K-Means centres, fitted in passes over all rows whatever their number."""
    near = start_sample(vectors, MICRO_STARTS * m)
    points = spread(vectors)
    (model,) = lloyd(points, [start_centres(near, m, np.random.default_rng(seed))], MICRO_ROUNDS)
    points.unpersist()
    return label_nearest(vectors.select(id_column, "features"), model.centres, "micro")


def ward_tree(
    vectors: DataFrame, id_column: str, m: int = MICRO_CLUSTERS, method: str = "ward", seed: int = 42
) -> tuple[DataFrame, list[int], np.ndarray]:
    """(rows with their micro cluster, micro numbers in leaf order, merges)."""
    assigned = cut_lineage(micro_clusters(vectors, id_column, m, seed))
    dims, x = len(assigned.first()["features"]), vector_to_array("features")
    leaves = assigned.groupBy("micro").agg(F.count("*").alias("size"), *[F.avg(x[i]).alias(f"x{i}") for i in range(dims)])
    # At most m centres reach the driver, whatever the number of rows.
    table = sorted(leaves.collect())
    centres = np.array([r[2:] for r in table], dtype=float)
    sizes = np.array([r["size"] for r in table])
    merges = merge_tree(centres, sizes, method) if len(table) > 1 else np.empty((0, 4))
    return assigned, [r["micro"] for r in table], merges


def hierarchical(
    vectors: DataFrame, id_column: str, clusters: int, m: int = MICRO_CLUSTERS, method: str = "ward", seed: int = 42
) -> DataFrame:
    """(id, cluster, method, micro_clusters): the tree is built on at most m weighted centres, the number in the last column."""
    assigned, leaves, merges = ward_tree(vectors, id_column, m, method, seed)
    labels = cut_tree(merges, len(leaves), min(clusters, len(leaves)))
    rows = [(int(leaf), int(c)) for leaf, c in zip(leaves, labels)]
    names = vectors.sparkSession.createDataFrame(rows, "micro long, cluster int")
    return assigned.join(names, "micro").select(id_column, "cluster", F.lit(method).alias("method"), F.lit(len(leaves)).alias("micro_clusters"))


def linkage_table(vectors: DataFrame, id_column: str, m: int = MICRO_CLUSTERS, method: str = "ward") -> DataFrame:
    """The merges as rows: step, left, right, height, size, method and the number of micro clusters."""
    _, leaves, merges = ward_tree(vectors, id_column, m, method)
    rows = [(i + 1, int(a), int(b), float(h), int(s), method, len(leaves)) for i, (a, b, h, s) in enumerate(merges)]
    return vectors.sparkSession.createDataFrame(rows, "step int, left int, right int, height double, size long, method string, micro_clusters int")
