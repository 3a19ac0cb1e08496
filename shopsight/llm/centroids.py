"""Centroid clustering of integer vectors: exact k-means by Shallot search.

Vectors with exactly `size` finite components become integers, floor(`SCALE` x). The first centroids are the kept vectors
with the smallest hash of their identifier. Each round assigns every vector to its nearest centroid (ties: smaller
number) and replaces each non-empty centroid by the floor of its vectors' exact mean; then vectors are assigned once more.

Search. A vector remembers its nearest and second-nearest centroid, an upper bound of the distance to the first and a lower
bound of the distance to all but the first. When centroids move, bounds move with them. Where the upper bound
stays below the lower one, or below half the way from the centroid to its next neighbour, nothing is computed. Else the
distances to the two remembered centroids are computed and the scan starts from the closer one, c: other centroids follow in
ascending distance from c, in a ball around c of radius (distance to c) + (second-smallest distance so far), which
shrinks as the second-smallest distance falls; whoever lies outside can't be among the two nearest. Bounds are
floats with a margin (`MARGIN`); whatever survives them is compared in integers.

Work. A round is one pass over a written table of vectors and bounds, which also writes each task's sums for each centroid;
sums are added up by Spark as decimals, and only `k` centroids reach the driver and the tasks. A round's table is
removed once the next one stands, so that two of them exist at most.

Vectors that are null, of another length, or with a null, NaN or infinite component are left out. Null identifiers hash as the
empty text. Repeated identifiers and vectors are rows like others; equal start hashes go by the vector. With fewer kept
vectors than `k` there are as many centroids as vectors. An empty table gives an empty result. Components beyond
2^`MAX_BITS` in size raise an error, as squared distances would not fit 64 bits. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopsight.llm.common import batch_rows, removed, stored

SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SIZE = 64
SALT = "2:"
MAX_BITS = 27
MARGIN = 1e-9
BATCH_VECTORS = 8192
STATE = "vec_id long, v binary, a int, b int, upper double, lower double, distance long, part int, sums binary"
ARROW = pa.schema(
    [("vec_id", pa.int64()), ("v", pa.binary()), ("a", pa.int32()), ("b", pa.int32()), ("upper", pa.float64()), ("lower", pa.float64()),
     ("distance", pa.int64()), ("part", pa.int32()), ("sums", pa.binary())]
)


def whole_vectors(table: DataFrame, size: int = SIZE) -> DataFrame:
    """vec_id and v (integers, scaled and floored) of the kept rows."""
    x = F.transform(F.col("embedding"), lambda e: e.cast("double"))
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where((F.size("x") == size) & fine)
    return rows.select("vec_id", F.transform("x", lambda e: F.floor(e * SCALE)).alias("v"))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS) -> np.ndarray:
    """The k vectors with the smallest hashes, in their order."""
    digest = F.sha2(F.concat(F.lit(SALT), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _packed(values: np.ndarray) -> list[bytes]:
    """Rows in the narrowest of 2, 4 or 8 bytes a component."""
    top = int(np.abs(values).max(initial=0))
    kind = "<i2" if top < 1 << 15 else "<i4"
    return [row.tobytes() for row in values.astype(kind)]


def _unpacked(rows: list[bytes], size: int) -> np.ndarray:
    if len({len(r) for r in rows}) == 1:
        return np.frombuffer(b"".join(rows), {2: "<i2", 4: "<i4"}[len(rows[0]) // size]).reshape(-1, size).astype(np.int64)
    return np.array([np.frombuffer(r, {2: "<i2", 4: "<i4"}[len(r) // size]) for r in rows], np.int64)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two integer arrays."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


class Shallot:
    """The centroids of a round and what the search needs of them: neighbours in order, half ways, movements."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None):
        self.c = centroids
        k = len(centroids)
        apart = np.array([squared(centroids, centroids[i : i + 1]) for i in range(k)])
        self.apart = np.sqrt(apart.astype(np.float64)) * (1 - MARGIN)  # never above the true distance
        np.fill_diagonal(self.apart, -1.0)
        self.order = np.argsort(self.apart, axis=1, kind="stable")  # itself first
        np.fill_diagonal(self.apart, 0.0)
        self.half = self.apart[np.arange(k), self.order[:, min(1, k - 1)]] / 2 if k > 1 else np.full(k, np.inf)
        self.moved = np.zeros(k) if before is None else np.sqrt(squared(centroids, before).astype(np.float64)) * (1 + MARGIN)
        top = np.argsort(-self.moved, kind="stable")
        others = np.full(k, self.moved[top[0]])
        others[top[0]] = self.moved[top[1]] if k > 1 else 0.0
        self.others_moved = others  # the largest movement of any other centroid

    def assign(self, v: np.ndarray, a: np.ndarray, b: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, ...]:
        """New a, b, upper, lower of vectors and how many of them were compared with more than bounds."""
        a, b = a.copy(), b.copy()
        upper = (upper + self.moved[a]) * (1 + MARGIN)
        lower = np.maximum(lower - self.others_moved[a], 0.0) * (1 - MARGIN)
        open_ = np.flatnonzero(upper >= np.maximum(lower, self.half[a]))
        if not len(open_):
            return a, b, upper, lower, 0
        x = v[open_]
        near, second = a[open_], b[open_]
        d1, d2 = squared(x, self.c[near]), squared(x, self.c[second])
        alone = near == second  # a single centroid, or no second one known yet
        d2 = np.where(alone, np.iinfo(np.int64).max, d2)
        swap = (d2 < d1) | ((d2 == d1) & (second < near))
        near, second = np.where(swap, second, near), np.where(swap, near, second)
        d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
        start, seen = near.copy(), second.copy()
        reach = np.sqrt(d1.astype(np.float64)) * (1 + MARGIN)  # from the start to the vector
        left = np.arange(len(open_))
        for place in range(1, len(self.c)):
            other = self.order[start[left], place]
            inside = self.apart[start[left], other] <= reach[left] + np.sqrt(d2[left].astype(np.float64)) * (1 + MARGIN)
            left, other = left[inside], other[inside]
            if not len(left):
                break
            new = other != seen[left]
            rows, other = left[new], other[new]
            d = squared(x[rows], self.c[other])
            first = (d < d1[rows]) | ((d == d1[rows]) & (other < near[rows]))
            runner = ~first & ((d < d2[rows]) | ((d == d2[rows]) & (other < second[rows])))
            better, behind = rows[first], rows[runner]
            d2[better], second[better] = d1[better], near[better]
            d1[better], near[better] = d[first], other[first]
            d2[behind], second[behind] = d[runner], other[runner]
        a[open_], b[open_] = near, second
        upper[open_] = np.sqrt(d1.astype(np.float64)) * (1 + MARGIN)
        lower[open_] = np.where(near == second, np.inf, np.sqrt(d2.astype(np.float64)) * (1 - MARGIN))
        return a, b, upper, lower, len(open_)


def _round(state: DataFrame, search: Shallot, size: int, last: bool) -> DataFrame:
    """The next state: rows with new bounds, and for each task a row for each centroid with the sums of its vectors."""
    k = len(search.c)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for part in parts:
            if not part.num_rows:
                continue
            v = _unpacked(part.column("v").to_pylist(), size)
            old = [part.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "upper", "lower")]
            a, b, upper, lower, _ = search.assign(v, *old)
            own, times = np.unique(a, return_counts=True)
            sums[own] += np.add.reduceat(v[np.argsort(a, kind="stable")], np.cumsum(times) - times, axis=0)
            counts[own] += times
            distance = squared(v, search.c[a]) if last else np.zeros(len(a), np.int64)
            yield _batch({"vec_id": part.column("vec_id"), "v": None if last else part.column("v"), "a": a, "b": b, "upper": upper, "lower": lower, "distance": distance}, len(a))
        if not last and counts.any():
            rows = np.concatenate([sums, counts[:, None]], axis=1).astype("<i8")
            yield _batch({"part": np.arange(k), "sums": [row.tobytes() for row in rows]}, k)

    with batch_rows(state.sparkSession, BATCH_VECTORS):
        return stored(state.where("part is null").mapInArrow(work, STATE), "centroid-rows")


def _batch(columns: dict, rows: int) -> pa.RecordBatch:
    made = [pa.array(columns[f.name], type=f.type) if columns.get(f.name) is not None else pa.nulls(rows, f.type) for f in ARROW]
    return pa.RecordBatch.from_arrays(made, schema=ARROW)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the exact means; a centroid without vectors stays."""
    size = centroids.shape[1]

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = np.array([np.frombuffer(s, "<i8") for s in part.column("sums").to_pylist()], np.int64).reshape(-1, size + 1)
            place = np.tile(np.arange(size + 1, dtype=np.int32), len(rows))
            which = np.repeat(part.column("part").to_numpy(zero_copy_only=False), size + 1)
            yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(place), pa.array(rows.ravel())], names=["part", "place", "total"])

    sums = state.where("part is not null").select("part", "sums").mapInArrow(work, "part int, place int, total long")
    new, counts, totals = centroids.copy(), [0] * len(centroids), {}
    for row in sums.groupBy("part", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():  # k (size + 1) rows
        if row["place"] == size:
            counts[row["part"]] = int(row["total"])
        else:
            totals[row["part"], row["place"]] = int(row["total"])
    for (j, place), total in totals.items():
        if counts[j]:
            new[j, place] = total // counts[j]
    return new


def _first_state(vectors: DataFrame, size: int) -> DataFrame:
    """All vectors, with bounds that hold nothing yet."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            v = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            if np.abs(v).max(initial=0) > 1 << MAX_BITS or (v == np.iinfo(np.int64).min).any():
                raise ValueError(f"components are at most 2^{MAX_BITS} in size after scaling")
            n = len(v)
            zero = np.zeros(n, np.int32)
            yield _batch({"vec_id": part.column("vec_id"), "v": _packed(v), "a": zero, "b": zero, "upper": np.full(n, np.inf), "lower": np.zeros(n)}, n)

    with batch_rows(vectors.sparkSession, BATCH_VECTORS):
        return stored(vectors.mapInArrow(work, STATE), "centroid-rows")


def clustered(table: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and distance (squared) of every kept vector, and the centroids of the last assignment."""
    vectors = whole_vectors(table, size)
    centroids, before = first_centroids(vectors, k), None
    if not len(centroids):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids
    state = _first_state(vectors, size)
    for turn in range(rounds + 1):
        last = turn == rounds
        new = _round(state, Shallot(centroids, before), size, last)
        removed(state)
        state = new
        if not last:
            before, centroids = centroids, _means(state, centroids)
    return state.select("vec_id", F.col("a").alias("cluster"), "distance"), centroids


def described(table: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE) -> DataFrame:
    """`clustered` rows with cluster_inertia, inertia and centroid_sha256."""
    rows, centroids = clustered(table, k, rounds, size)
    digests = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())]
    named = table.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    per_cluster = named.join(sums, "cluster").select("cluster", "own", "centroid_sha256").collect()  # at most k rows
    total = sum(int(r["own"]) for r in per_cluster)
    small = table.sparkSession.createDataFrame([(r["cluster"], int(r["own"]), total, r["centroid_sha256"]) for r in per_cluster], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(small), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
