"""K-Means for many numbers of clusters and restarts at once: every Lloyd round is one pass over the rows for all models."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

START_ROUNDS = 10
START_ROWS = 4096
HASH_MARGIN = 4
# Rows times centres whose gaps are held at once, so that they stay in a core's cache, and rows totalled at once.
BATCH_CELLS = 1 << 17
STRETCH_ROWS = 1 << 15
TASK_ROWS = 8_192
PACKED_CELLS = 1 << 16
MOST_TASK_ROWS = 2_000_000


def assign_to_centres(vectors: DataFrame, centres: list[list[float]], features: str = "features") -> DataFrame:
    """Nearest of the given centres (lowest number on ties), as an expression."""
    x = vector_to_array(features) if dict(vectors.dtypes)[features] != "array<double>" else F.col(features)
    options = []
    for i, centre in enumerate(centres):
        point = F.array(*[F.lit(float(v)) for v in centre])
        gap = F.aggregate(F.zip_with(x, point, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, g: s + g)
        options.append(F.struct(gap.alias("d"), F.lit(i).alias("i")))
    nearest = F.array_min(F.array(*options))
    return vectors.withColumns({"cluster": nearest["i"], "distance": F.sqrt(nearest["d"])})


def label_nearest(vectors: DataFrame, centres: np.ndarray, name: str) -> DataFrame:
    """Nearest of many centres (lowest number on ties), by matrix products over batches of rows."""
    shared, (k, dims) = vectors.sparkSession.sparkContext.broadcast(centres), centres.shape

    def labels(x: pa.Array) -> pa.Array:
        rows = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        return pa.array(next(nearest(rows, shared.value, [0, k]))[0])

    return vectors.withColumn(name, F.arrow_udf(labels, "long")(vector_to_array("features")))


@dataclass
class CentreModel:
    """Fitted centres. `cost` is the sum of squared distances of the rows to the nearest of them."""

    centres: np.ndarray
    cost: float = np.inf
    rounds: int = 0

    @property
    def k(self) -> int:
        return len(self.centres)

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, vectors: DataFrame) -> DataFrame:
        """`vectors` with `prediction`, the nearest centre (lowest number on ties)."""
        found = assign_to_centres(vectors.select(F.struct("*").alias("_row"), F.col("features")), self.centres.tolist())
        return found.select("_row.*", F.col("cluster").alias("prediction"))

    def save(self, uri: str) -> None:
        rows = [(i, c, self.cost, self.rounds) for i, c in enumerate(self.centres.tolist())]
        spark = SparkSession.active()
        spark.createDataFrame(rows, "cluster int, centre array<double>, cost double, rounds int").coalesce(1).write.mode("overwrite").parquet(uri)

    @classmethod
    def load(cls, uri: str) -> CentreModel:
        rows = SparkSession.active().read.parquet(uri).orderBy("cluster").collect()
        return cls(np.array([r["centre"] for r in rows], float), rows[0]["cost"], rows[0]["rounds"])


def nearest(x: np.ndarray, centres: np.ndarray, bounds: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(label, squared distance) of the rows for each model, whose centres lie between two bounds: one matrix product for all."""
    labels = np.empty((len(bounds) - 1, len(x)), np.int64)
    half, step = (centres * centres).sum(axis=1) / 2, max(1, BATCH_CELLS // len(centres))
    for at in range(0, len(x), step):
        gaps = half - x[at : at + step] @ centres.T  # half the squared distance, less what is the same for all centres
        for label, a, b in zip(labels, bounds, bounds[1:]):
            label[at : at + step] = gaps[:, a:b].argmin(axis=1)
    for label, a in zip(labels, bounds):
        away = x - centres[a + label]
        yield label, np.einsum("ij,ij->i", away, away)


def spread(vectors: DataFrame) -> DataFrame:
    """The vectors dealt evenly for many passes and persisted: two tasks a core, fewer for few rows, more for very many.

    A row holds the coordinates of many vectors (x), one after the other, so that a pass moves few large values to Python.
    """
    points = vectors.select(vector_to_array("features").alias("x"))
    rows, cores = points.count(), points.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(2 * cores, math.ceil(rows / TASK_ROWS)), math.ceil(rows / MOST_TASK_ROWS))
    return points.repartition(tasks).mapInArrow(_packed, "x array<double>").persist()


def _packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Coordinates of many batches in one row, however small the session's batches are."""
    waiting, cells = [], 0

    def row() -> pa.RecordBatch:
        x = pa.concat_arrays(waiting)
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(x)], x)], names=["x"])

    for part in parts:
        waiting.append(part.column("x").flatten())
        cells += len(waiting[-1])
        if cells >= PACKED_CELLS:
            yield row()
            waiting, cells = [], 0
    if cells:
        yield row()


def summed(points: DataFrame, shared, total: Callable[[np.ndarray, object], np.ndarray], shape: tuple[int, int], dims: int) -> np.ndarray:
    """The sum of `total(vectors, value of shared)` over all vectors, in one stage: a task returns one array of the given shape.

    A row of `points` holds one vector of `dims` coordinates, or several one after the other.
    """
    parts = points.mapInArrow(_work(shared, total, shape, dims), "sums binary").collect()
    return np.sum([np.frombuffer(row["sums"]).reshape(shape) for row in parts], axis=0) if parts else np.zeros(shape)


def _work(shared, total: Callable, shape: tuple[int, int], dims: int) -> Callable:
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = np.zeros(shape), False
        for part in parts:
            if part.num_rows:
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                sums, seen = sums + total(x, shared.value), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    return work


def _pass(points: DataFrame, models: list[np.ndarray]) -> list[np.ndarray]:
    """For each model a row for each centre: number of rows, their cost, and their coordinate sums.

    What a task returns depends on the models and dimensions only.
    """
    bounds = np.cumsum([0, *map(len, models)]).tolist()
    shared = points.sparkSession.sparkContext.broadcast(np.concatenate(models))
    dims = models[0].shape[1]

    def total(every: np.ndarray, centres: np.ndarray) -> np.ndarray:
        totals = np.zeros((len(centres), 2 + dims))
        for at in range(0, len(every), STRETCH_ROWS):
            x = every[at : at + STRETCH_ROWS]
            axes = np.ascontiguousarray(x.T)
            for (a, b), (label, gap) in zip(zip(bounds, bounds[1:]), nearest(x, centres, bounds)):
                for place, values in enumerate((None, gap, *axes)):
                    totals[a:b, place] += np.bincount(label, values, b - a)
        return totals

    found = summed(points, shared, total, (bounds[-1], 2 + dims), dims)
    shared.destroy()
    return [found[a:b] for a, b in zip(bounds, bounds[1:])]


def start_sample(vectors: DataFrame, rows: int) -> np.ndarray:
    """The `rows` vectors with the smallest hashes. Only hashes small enough are sorted, unless too few rows have such."""
    hashed = vectors.select(vector_to_array("features").alias("x")).withColumn("hash", F.xxhash64("x"))
    share = HASH_MARGIN * rows / max(1, vectors.count())
    found = []
    for part in [hashed] if share >= 1 else [hashed.where(F.col("hash") < F.lit(int(share * 2**64) - 2**63)), hashed]:
        if len(found) < rows:
            found = part.orderBy("hash", "x").limit(rows).collect()
    if not found:
        raise ValueError("no rows to cluster")
    return np.array([row["x"] for row in found], float)


def start_centres(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = START_ROUNDS) -> np.ndarray:
    """Centres of a few rows: spread by squared distances, then moved some rounds."""
    centres = x[[rng.integers(len(x))]]
    gaps = ((x - centres[0]) ** 2).sum(axis=1)
    for _ in range(k - 1):
        total = gaps.sum()
        centres = np.vstack([centres, x[rng.choice(len(x), p=gaps / total if total > 0 else None)]])
        gaps = np.minimum(gaps, ((x - centres[-1]) ** 2).sum(axis=1))
    for _ in range(rounds):
        label, _ = next(nearest(x, centres, [0, k]))
        centres = np.stack([x[label == j].mean(axis=0) if (label == j).any() else centres[j] for j in range(k)])
    return centres


def lloyd(points: DataFrame, starts: list[np.ndarray], max_iter: int = 300, tol: float = 1e-4) -> list[CentreModel]:
    """Every start moved until no centre goes further than `tol`; centres without rows stay.

    Each round is one pass for all models that still move. Starts that have become equal to another model of theirs are
    followed once. The cost is that of the centres returned.
    """
    models = [CentreModel(np.asarray(s, float)) for s in starts]
    moving, same = list(range(len(models))), {}
    while moving:
        found = _pass(points, [models[i].centres for i in moving])
        still, known = [], {}
        for i, sums in zip(moving, found, strict=True):
            model = models[i]
            model.cost = float(sums[:, 1].sum())
            means = np.where(sums[:, :1] > 0, sums[:, 2:] / np.maximum(sums[:, :1], 1), model.centres)
            if model.rounds >= max_iter or np.sqrt(((means - model.centres) ** 2).sum(axis=1)).max() <= tol:
                continue
            model.centres, model.rounds = means, model.rounds + 1
            twin = known.setdefault(np.round(np.array(sorted(means.tolist())), 9).tobytes(), i)
            if twin != i:
                same[i] = twin
            else:
                still.append(i)
        moving = still

    def final(i: int) -> CentreModel:
        return final(same[i]) if i in same else models[i]

    return [final(i) for i in range(len(models))]


def fit_many(
    vectors: DataFrame, ks: Sequence[int], seed: int = 42, restarts: int = 10, max_iter: int = 300, tol: float = 1e-4, start_rows: int = START_ROWS
) -> dict[int, CentreModel]:
    """For each k the restart with the lowest cost, all fitted in the same passes.

    Start values come from at most `start_rows` rows, chosen by a hash; every round reads all rows. `vectors` should be
    persisted by the caller.
    """
    near = start_sample(vectors, start_rows)
    points = spread(vectors)
    jobs = [(k, offset) for k in dict.fromkeys(ks) for offset in range(restarts)]
    fitted = lloyd(points, [start_centres(near, k, np.random.default_rng(seed + offset)) for k, offset in jobs], max_iter, tol)
    points.unpersist()
    best: dict[int, CentreModel] = {}
    for (k, _), model in zip(jobs, fitted, strict=True):
        if k not in best or model.cost < best[k].cost:
            best[k] = model
    return best
