"""Neighbour distances and density clustering, exact, over blocks that visit those near them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shopsight.cluster.blocks import BLOCK_ROWS, as_points, nearest_distances, within
from shopsight.cluster.tiles import ROUNDING, Tiles, box_gaps, near_first, write_tiles
from shopsight.operators.graphs import connected_components
from shopsight.operators.ranking import global_rank, quantile_table
from shopsight.session import cut_lineage


def distinct_points(points: DataFrame) -> DataFrame:
    """One row per place with the number of rows there and the smallest id: copies are never compared."""
    return points.groupBy("x").agg(F.min("id").alias("id"), F.count("*").alias("w")).select("id", "x", "w")


def k_distances(
    df: DataFrame, id_column: str, k: int = 5, features: str = "features", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Per row, the distance to its k-th nearest neighbour; the row itself is neighbour 1.

    A block visits others from the nearest box on, until the next box is further than the k-th neighbour of every
    point of it; in a box only points nearer to it than their k-th neighbour so far are compared.
    """
    points = as_points(df, id_column, features)
    tiles = write_tiles(distinct_points(points), block_rows)

    def nearest(tiles: Tiles, group: range) -> Iterator[pd.DataFrame]:
        mine = [tiles.points(i) for i in group]
        order, gaps = near_first(tiles, group)
        near = [nearest_distances(x, len(x), x, len(x), w, k) for x, w, _ in mine]
        reach = np.array([known[:, -1].max() for known in near])
        gaps[np.arange(len(mine)), list(group)] = np.inf  # the own block was visited
        for j in order:
            visits = np.flatnonzero(gaps[:, j] <= reach * (1 + ROUNDING))
            if not len(visits):
                if j not in group and gaps[:, j].min() > reach.max() * (1 + ROUNDING):
                    break
                continue
            other, weights, _ = tiles.points(j)
            for g in visits:
                x, known = mine[g][0], near[g]
                rows = np.flatnonzero(box_gaps(x, x, tiles.lo[j], tiles.hi[j]) <= known[:, -1] * (1 + ROUNDING))
                if not len(rows):
                    continue
                far = known[rows, -1].max() * (1 + ROUNDING)
                columns = np.flatnonzero(box_gaps(other, other, np.fmin.reduce(x[rows]), np.fmax.reduce(x[rows])) <= far)
                if len(columns):
                    known[rows] = nearest_distances(x[rows], len(rows), other[columns], len(columns), weights[columns], k, known[rows])
                    reach[g] = known[:, -1].max()
        for (_, _, ids), known in zip(mine, near):
            yield pd.DataFrame({"_first": ids, "k_distance": known[:, -1]})

    # Written, since percentiles read the distances several times.
    found = cut_lineage(tiles.on_groups(nearest, "_first long, k_distance double"))
    tiles.release()
    places = points.groupBy("x").agg(F.min("id").alias("_first"))
    rows = points.join(places, "x").select("id", "_first")
    return rows.join(found, "_first").select(F.col("id").alias(id_column), "k_distance")


def suggest_eps(k_distance: DataFrame, probs: Sequence[float] = (0.90, 0.95, 0.99)) -> dict[float, float]:
    """Percentiles of the k-distance curve."""
    row = quantile_table(k_distance, ["k_distance"], probs).first()
    return dict(zip(probs, row["q"]))


def _local_components(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of the connected part each point belongs to."""
    label = np.full(len(ids), -1, dtype=np.int64)
    for start in np.argsort(ids):
        if label[start] >= 0:
            continue
        front = np.zeros(len(ids), bool)
        front[start] = True
        while front.any():
            label[front] = ids[start]
            front = near[front].any(axis=0) & (label < 0)
    return label


def _facing(x: np.ndarray, rows: np.ndarray, other: np.ndarray, columns: np.ndarray, far: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of some points of two blocks that are near enough to the box of the other's."""
    if len(rows) and len(columns):
        rows = rows[box_gaps(x[rows], x[rows], np.fmin.reduce(other[columns]), np.fmax.reduce(other[columns])) <= far]
    if len(rows) and len(columns):
        columns = columns[box_gaps(other[columns], other[columns], np.fmin.reduce(x[rows]), np.fmax.reduce(x[rows])) <= far]
    return rows, columns


def _met_parts(near: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names, met): the different parts of the columns, and which of them each row meets."""
    order = np.argsort(parts, kind="stable")
    names, first = np.unique(parts[order], return_index=True)
    return names, np.logical_or.reduceat(near[:, order], first, axis=1)


class _Joined:
    """Which parts a task knows to be connected."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, part: int) -> int:
        while (up := self.parent.get(part, part)) != part:
            self.parent[part] = self.parent.get(up, up)
            part = up
        return part

    def one(self, *parts: np.ndarray) -> bool:
        """Whether all these parts are connected already."""
        return len({self.root(p) for some in parts for p in np.unique(some).tolist()}) <= 1

    def join(self, a: int, b: int) -> bool:
        """Whether the parts were apart until now."""
        a, b = self.root(a), self.root(b)
        self.parent[a] = b
        return a != b


def _linked(
    joined: _Joined, x: np.ndarray, rows: np.ndarray, parts: np.ndarray, other: np.ndarray, columns: np.ndarray, other_parts: np.ndarray, eps: float, far: float
) -> list[tuple[int, int]]:
    """Links of parts of two blocks that the task did not know to be connected."""
    rows, columns = _facing(x, rows, other, columns, far)
    if not len(rows) or not len(columns):
        return []
    # Most neighbouring parts meet at the point that is nearest to the middle of the other side.
    middle = other[columns].mean(axis=0)
    first = rows[[((x[rows] - middle) ** 2).sum(axis=1).argmin()]]
    links = []
    for some in (first, rows):
        if joined.one(parts[rows], other_parts[columns]):
            break
        names, met = _met_parts(within(x[some], len(some), other[columns], len(columns), eps), other_parts[columns])
        at, name = np.nonzero(met)
        pairs = np.unique(np.stack([parts[some[at]], names[name]], axis=1), axis=0).tolist()
        links += [(a, b) for a, b in pairs if joined.join(a, b)]
    return links


def dbscan(
    df: DataFrame,
    id_column: str,
    eps: float,
    min_samples: int = 10,
    features: str = "features",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, cluster): clusters numbered by their smallest core id, -1 for noise.

    A point counts among its own neighbours. A border point joins the adjacent cluster with the lowest
    number. Ids must be unique and not negative.
    """
    points = as_points(df, id_column, features)
    tiles = write_tiles(distinct_points(points), block_rows)
    far = eps * (1 + ROUNDING)

    # Core points of one block that reach each other inside it form a part, named by its smallest id.
    def parts_of(tiles: Tiles, group: range) -> Iterator[tuple[int, np.ndarray]]:
        mine = [tiles.points(i) for i in group]
        totals = [np.zeros(len(x), np.int64) for x, _, _ in mine]
        order, gaps = near_first(tiles, group)
        for j in order[gaps.min(axis=0)[order] <= far]:
            other = None
            for g in np.flatnonzero(gaps[:, j] <= far):
                x, total = mine[g][0], totals[g]
                open_rows = np.flatnonzero(total < min_samples)
                if not len(open_rows):
                    continue
                other = other or tiles.points(j)
                if tiles.reach(group[g], j) * (1 + ROUNDING) <= eps:
                    total[open_rows] += other[1].sum()
                    continue
                rows, columns = _facing(x, open_rows, other[0], np.arange(len(other[0])), far)
                if len(rows) and len(columns):
                    near, weights = within(x[rows], len(rows), other[0][columns], len(columns), eps), other[1][columns]
                    total[rows] += np.count_nonzero(near, axis=1) if (weights == 1).all() else near @ weights
        for i, (x, _, ids), total in zip(group, mine, totals):
            core = total >= min_samples
            part = np.full(len(ids), -1, dtype=np.int64)
            if core.any():
                near = within(x[core], core.sum(), x[core], core.sum(), eps)
                part[core] = _local_components(near, ids[core])
            yield i, part

    tiles.add_parts("parts", parts_of)

    # Links of parts of different blocks, as a forest within the task, and the parts that each point belongs to or borders.
    def meet(tiles: Tiles, group: range) -> Iterator[pd.DataFrame]:
        mine = [(*tiles.points(i), tiles.parts(i)) for i in group]
        order, gaps = near_first(tiles, group)
        joined, links = _Joined(), []
        for j in order[gaps.min(axis=0)[order] <= far]:
            b_parts = tiles.parts(j)
            b_core = np.flatnonzero(b_parts >= 0)
            if not len(b_core):
                continue
            other = None
            for g in np.flatnonzero(gaps[:, j] <= far):
                x, _, ids, parts = mine[g]
                border, core = np.flatnonzero(parts < 0), np.flatnonzero(parts >= 0)
                if j <= group[g] or joined.one(parts[core], b_parts[b_core]):
                    core = core[:0]
                if not len(border) + len(core):
                    continue
                other = tiles.points(j)[0] if other is None else other
                if len(core):
                    links += _linked(joined, x, core, parts, other, b_core, b_parts, eps, far)
                rows, columns = _facing(x, border, other, b_core, far)
                if len(rows) and len(columns):
                    near = within(x[rows], len(rows), other[columns], len(columns), eps)
                    names, met = _met_parts(near, b_parts[columns])
                    at, name = np.nonzero(met)
                    yield pd.DataFrame({"id": ids[rows[at]], "part_a": -1, "part_b": names[name]})
        yield pd.DataFrame([(-1, a, b) for a, b in links], columns=["id", "part_a", "part_b"], dtype=np.int64)
        for _, _, ids, parts in mine:
            yield pd.DataFrame({"id": ids[parts >= 0], "part_a": -1, "part_b": parts[parts >= 0]})

    met = cut_lineage(tiles.on_groups(meet, "id long, part_a long, part_b long", "parts"))
    tiles.release()
    links = met.where(F.col("part_a") >= 0).select("part_a", "part_b").distinct()
    roots = connected_components(links, "part_a", "part_b")
    members = met.where(F.col("part_a") < 0).select("id", F.col("part_b").alias("part"))
    named = members.join(roots, F.col("part") == F.col("node"), "left").select(
        "id", F.coalesce("root", "part").alias("root")
    )
    chosen = named.groupBy("id").agg(F.min("root").alias("root"))
    numbers = global_rank(chosen.select("root").distinct(), ["root"], "_rank")
    numbered = chosen.join(numbers, "root").select(F.col("id").alias("_first"), (F.col("_rank") - 1).alias("cluster"))
    places = points.groupBy("x").agg(F.min("id").alias("_first"))
    rows = points.join(places, "x").select("id", "_first")
    return rows.join(numbered, "_first", "left").select(
        F.col("id").alias(id_column), F.coalesce(F.col("cluster"), F.lit(-1)).cast("int").alias("cluster")
    )
