"""Points in small boxes, kept in files that every task reads: a group of blocks visits the others, the nearest first.

Points are ranked along a Z-curve and cut into chunks; a chunk is halved across its widest side until a block holds at
most a given number of points, so that boxes are tight wherever the curve jumps. Blocks are written once below the
checkpoint folder, which all executors reach, beside a list of their boxes. A task takes a few blocks that follow each
other and reads those near enough one at a time: rows are shuffled once to be cut and never again, whatever the number
of pairs of blocks, and a task holds its own blocks, one other, and the list of boxes.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from shopsight.cluster.blocks import ranked_blocks
from shopsight.session import drop_folder, scratch_uri

CHUNK_BLOCKS = 16
CHUNK_CELLS = 1 << 20
GROUP_BLOCKS = 16
GROUPS_PER_CORE = 8
MOST_TASKS = 10_000
OPEN_FILES = 64
# Boxes and points that are this much (relatively) too far are still looked at, as both distances are rounded.
ROUNDING = 1e-12


def open_store(uri: str):
    """The file system of a folder that all executors reach, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def halved(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of the points, cut across the widest side at the median until no part has more than `most`, in order."""
    parts, waiting = [], [np.arange(len(x))]
    while waiting:
        rows = waiting.pop()
        if len(rows) <= most:
            parts.append(rows)
            continue
        some = x[rows]
        axis = int(np.nan_to_num(np.fmax.reduce(some) - np.fmin.reduce(some)).argmax())
        order, middle = some[:, axis].argsort(kind="stable"), len(rows) // 2
        waiting += [rows[order[middle:]], rows[order[:middle]]]
    return parts


def _box(x: np.ndarray) -> tuple[list[float], list[float]]:
    """Lowest and highest coordinates; a side with a value that is no number is open."""
    return np.nan_to_num(x.min(axis=0), nan=-np.inf).tolist(), np.nan_to_num(x.max(axis=0), nan=np.inf).tolist()


class ArrayWriter:
    """Arrays of one task, one after the other in a file of its own: a repeated task writes another, which nobody lists."""

    def __init__(self, uri: str):
        self.store, folder = open_store(uri)
        self.store.create_dir(folder, recursive=True)
        self.name, self.at = uuid.uuid4().hex, 0
        self.out = self.store.open_output_stream(f"{folder}/{self.name}")

    def add(self, *arrays: np.ndarray) -> int:
        start = self.at
        for array in arrays:
            data = np.ascontiguousarray(array).tobytes()
            self.out.write(data)
            self.at += len(data)
        return start


class Tiles:
    """The blocks as a task sees them. `parts` names a further list with one whole number for each point."""

    def __init__(self, uri: str, parts: str | None = None):
        import pyarrow.parquet as pq

        self.uri, (self.store, self.folder) = uri, open_store(uri)
        listed = pq.read_table(f"{self.folder}/list", filesystem=self.store).sort_by("block")
        self.block, self.n, self.at = (listed.column(c).to_numpy() for c in ("block", "n", "at"))
        self.file = listed.column("file").to_pylist()
        lo, hi = (listed.column(c).combine_chunks().flatten().to_numpy().reshape(len(self.n), -1) for c in ("lo", "hi"))
        self.lo, self.hi, self.dims = lo, hi, lo.shape[1]
        self.files: dict[str, object] = {}
        if parts:
            more = pq.read_table(f"{self.folder}/{parts}-list", filesystem=self.store).sort_by("block")
            self.part_file, self.part_at, self.parts_folder = more.column("file").to_pylist(), more.column("at").to_numpy(), parts

    def _read(self, name: str, at: int, size: int) -> bytes:
        if name not in self.files:
            if len(self.files) >= OPEN_FILES:
                self.files.pop(next(iter(self.files))).close()
            self.files[name] = self.store.open_input_file(f"{self.folder}/{name}")
        return self.files[name].read_at(size, at)

    def points(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Coordinates, weights and ids of block i."""
        n, cells = int(self.n[i]), int(self.n[i]) * self.dims
        data = self._read(f"points/{self.file[i]}", int(self.at[i]), 8 * (cells + 2 * n))
        whole = np.frombuffer(data, np.int64, 2 * n, 8 * cells)
        return np.frombuffer(data, np.float64, cells).reshape(n, self.dims), whole[:n], whole[n:]

    def parts(self, i: int) -> np.ndarray:
        return np.frombuffer(self._read(f"{self.parts_folder}/{self.part_file[i]}", int(self.part_at[i]), 8 * int(self.n[i])), np.int64)

    def gaps(self, i: int) -> np.ndarray:
        """Smallest distance of the box of block i to every box."""
        return box_gaps(self.lo, self.hi, self.lo[i], self.hi[i])

    def reach(self, i: int, j: int) -> float:
        """Largest distance between points of two boxes."""
        return float(np.sqrt((np.maximum(self.hi[i] - self.lo[j], self.hi[j] - self.lo[i]) ** 2).sum()))

    def close(self) -> None:
        for file in self.files.values():
            file.close()


def box_gaps(lo: np.ndarray, hi: np.ndarray, lo_b: np.ndarray, hi_b: np.ndarray) -> np.ndarray:
    """Smallest distance of every box (a point is one, with lo = hi) to the box b; 0 where it can't be told."""
    side = np.maximum(np.maximum(lo - hi_b, lo_b - hi), 0.0)
    return np.nan_to_num(np.sqrt(np.einsum("ij,ij->i", side, side)))


@dataclass
class TileSet:
    """Written blocks: `number` of them, of `dims` coordinates. Release after use."""

    spark: SparkSession
    uri: str
    number: int
    dims: int
    block_rows: int

    def on_groups(self, work: Callable[[Tiles, range], Iterator[pd.DataFrame]], schema: str, parts: str | None = None) -> DataFrame:
        """Run `work` on a few blocks that follow each other at a time."""
        uri, number = self.uri, self.number
        cores = self.spark.sparkContext.defaultParallelism
        most = max(1, min(GROUP_BLOCKS, CHUNK_CELLS // (self.block_rows * max(1, self.dims))))
        size = max(1, min(most, number // (GROUPS_PER_CORE * cores)))
        groups = math.ceil(number / size)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            tiles = None
            for batch in batches:
                for group in batch["id"]:
                    tiles = tiles or Tiles(uri, parts)
                    yield from work(tiles, range(group * size, min(number, (group + 1) * size)))
            if tiles is not None:
                tiles.close()

        return self.spark.range(0, groups, 1, max(1, min(groups, MOST_TASKS))).mapInPandas(run, schema)

    def add_parts(self, name: str, work: Callable[[Tiles, range], Iterator[tuple[int, np.ndarray]]]) -> None:
        """Write one whole number for each point; `work` gives them as (block, numbers) for a few blocks at a time."""
        uri = self.uri

        def write(tiles: Tiles, group: range) -> Iterator[pd.DataFrame]:
            out = ArrayWriter(f"{uri}/{name}")
            rows = [(int(tiles.block[i]), out.name, out.add(numbers.astype(np.int64))) for i, numbers in work(tiles, group)]
            out.out.close()
            yield pd.DataFrame(rows, columns=["block", "file", "at"])

        self.on_groups(write, "block long, file string, at long").write.parquet(f"{uri}/{name}-list")

    def release(self) -> None:
        drop_folder(self.spark, self.uri)


def write_tiles(points: DataFrame, block_rows: int) -> TileSet:
    """Cut `points` (id, x, w) into blocks of at most `block_rows` and write them."""
    spark = points.sparkSession
    uri = scratch_uri(spark, "tiles")
    ranked, chunks, lows, _ = ranked_blocks(points, lambda dims: block_rows * max(1, min(CHUNK_BLOCKS, CHUNK_CELLS // (block_rows * max(1, dims)))))
    dims = len(lows)
    schema = "block long, file string, at long, n long, lo array<double>, hi array<double>"

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        out, chunk, waiting = None, None, []

        def cut() -> pa.RecordBatch:
            x, w, ids = (np.concatenate(arrays) for arrays in zip(*waiting))
            rows = []
            for place, part in enumerate(halved(x, block_rows)):
                some = x[part]
                start = out.add(some, w[part], ids[part])
                rows.append((chunk << 20 | place, out.name, start, len(part), *_box(some)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["block", "file", "at", "n", "lo", "hi"])

        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or ArrayWriter(f"{uri}/points")
            number = batch.column("block").to_numpy()
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(number), dims)
            w, ids = (batch.column(c).to_numpy() for c in ("w", "id"))
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
            for a, b in zip(cuts, cuts[1:]):
                if number[a] != chunk:
                    if waiting:
                        yield cut()
                    chunk, waiting = int(number[a]), []
                waiting.append((x[a:b], w[a:b], ids[a:b]))
        if waiting:
            yield cut()
            out.out.close()

    tasks = min(chunks, GROUPS_PER_CORE * spark.sparkContext.defaultParallelism)
    together = ranked.select("block", "x", "w", "id").repartition(tasks, "block").sortWithinPartitions("block")
    together.mapInArrow(write, schema).write.parquet(f"{uri}/list")
    number = spark.read.schema(schema).parquet(f"{uri}/list").count()
    return TileSet(spark, uri, number, dims, block_rows)


def near_first(tiles: Tiles, group: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """(order, gaps): all blocks by their smallest gap to a block of the group, and the gaps, one row for each block of it."""
    gaps = np.stack([tiles.gaps(i) for i in group])
    gaps[np.arange(len(group)), list(group)] = -1.0
    return gaps.min(axis=0).argsort(kind="stable"), gaps
