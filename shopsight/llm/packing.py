"""Best-fit packing of token sequences, improved by swaps between underfull bins.

Documents are encoded whole and followed by the end id. A document longer than a sequence is cut into full
pieces and a last, shorter one; nothing else is cut. A full piece is a sequence of its own. Other pieces are packed
in windows of bounded size as the texts stream by: first best fit decreasing, then local search. The search
exchanges pieces one for one, two for one, or moves one or two between two underfull bins wherever that raises the sum
of squared fills, so that bins drain until one is empty. It looks at all underfull bins of a group, stops when they lack
less than a sequence, and in any case after `SEARCH_WORK` comparisons, or `LEFTOVER_WORK` in the far fewer groups of leftovers.

What a window leaves in bins that aren't full (a few bins of a window) is written apart. These leftovers meet
in rounds: `WINDOW_TOKENS` worth of pieces in each group, packed together, and what is again left moves on with
fewer groups, until one group is left or nothing changes. A piece carries its ids, so no join follows.

Sequence numbers are unique and otherwise free. Null text is empty: one piece with the end id. Rows that
repeat are packed each. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shopsight.llm.common import WordEncoder, bounded_batches, stored, text_column

WINDOW_TOKENS = 4_000_000
SEARCH_WORK = 1_000_000
LEFTOVER_WORK = 10_000_000
OUT_ROWS = 1024
PIECES = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long, settled boolean"
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("settled", pa.bool_())]
)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Best fit decreasing: bins as lists of places in `lengths`. Free room is found in a bitmask of rooms in use."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        left = room - need
        if left:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return bins


def _open_pieces(bins: list[Counter], fills: list[int], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and length of every different piece of the underfull bins, and for each of these bins a place without a piece (length 0)."""
    places, lengths = [], []
    for b, pieces in enumerate(bins):
        if 0 < fills[b] < size:
            places.extend([b] * (len(pieces) + 1))
            lengths.append(0)
            lengths.extend(pieces)
    return np.array(places, np.int64), np.array(lengths, np.int64)


def _gifts(own: Counter) -> tuple[np.ndarray, Callable[[int], tuple[int, ...]]]:
    """Ascending sums of one or two pieces of a bin, and the lengths behind each."""
    ones = np.array(sorted(own), np.int64)
    first, second = np.triu_indices(len(ones))
    twice = np.array([own[n] > 1 for n in ones.tolist()])
    real = (first != second) | twice[first]
    first, second = ones[first[real]], ones[second[real]]
    sums = np.concatenate([ones, first + second])
    order = np.argsort(sums, kind="stable")

    def lengths_of(place: int) -> tuple[int, ...]:
        k = int(order[place])
        return (int(ones[k]),) if k < len(ones) else (int(first[k - len(ones)]), int(second[k - len(ones)]))

    return sums[order], lengths_of


def _best_exchange(donor: int, bins: list[Counter], fills: np.ndarray, places: np.ndarray, lengths: np.ndarray, size: int):
    """The exchange of `donor` with any other underfull bin that raises the sum of squared fills most, or None.

    The donor gives one piece or two and takes one piece or none. For every piece that it could take, the longest gift
    that still fits is looked up among the sorted gifts: (target, lengths given, lengths taken).
    """
    gifts, given_of = _gifts(bins[donor])
    room = size - fills[places] + lengths
    found = np.searchsorted(gifts, room, "right") - 1
    moved = np.where((found >= 0) & (places != donor), gifts[np.maximum(found, 0)] - lengths, 0)
    gain = np.where(moved > 0, moved * (fills[places] - fills[donor] + moved), 0)
    best = int(gain.argmax())
    if gain[best] <= 0:
        return None
    taken = int(lengths[best])
    return int(places[best]), given_of(found[best]), (taken,) if taken else ()


def local_search(bins: list[list[int]], lengths: list[int], size: int, work: int = SEARCH_WORK) -> list[list[int]]:
    """Exchange pieces between underfull bins while the sum of squared fills rises; empty bins go.

    The emptiest bin gives pieces to whichever underfull bin gains most, until it is empty or nothing moves; then the next
    emptiest one does. Pieces of one length in a bin are one entry, and a bin like one that could not give is not tried
    again before something moves. The search ends when all underfull bins together lack less than a sequence, when no bin
    can give, or after comparing `work` entries, with the bins it has then.
    """
    members: list[dict[int, list[int]]] = []
    for b in bins:
        by_length: dict[int, list[int]] = {}
        for i in b:
            by_length.setdefault(lengths[i], []).append(i)
        members.append(by_length)
    counts = [Counter({n: len(rows) for n, rows in m.items()}) for m in members]
    fills = np.array([sum(n * k for n, k in c.items()) for c in counts], np.int64)
    left = work
    stuck: set[tuple] = set()
    tried: set[int] = set()
    places, sizes = _open_pieces(counts, fills.tolist(), size)
    while left > 0:
        underfull = np.flatnonzero((fills > 0) & (fills < size))
        if len(underfull) < 2 or (size - fills[underfull]).sum() < size:
            break  # not one bin fewer is possible
        order = underfull[np.argsort(fills[underfull], kind="stable")].tolist()
        donor = next((b for b in order if b not in tried and not (tried and tuple(sorted(counts[b].items())) in stuck)), None)
        if donor is None:
            break
        moved = False
        while fills[donor] and left > 0:
            n = len(counts[donor])
            left -= len(places) + n * n
            found = _best_exchange(donor, counts, fills, places, sizes, size)
            if found is None:
                break
            moved = True
            target, given, taken = found
            for source, goal, which in ((donor, target, given), (target, donor, taken)):
                for length in which:
                    members[goal].setdefault(length, []).append(members[source][length].pop())
                    counts[goal][length] += 1
                    counts[source][length] -= 1
                    if not counts[source][length]:
                        del counts[source][length], members[source][length]
            change = sum(given) - sum(taken)
            fills[target] += change
            fills[donor] -= change
            stay = (places != donor) & (places != target)
            fresh = [b for b in (donor, target) if 0 < fills[b] < size]
            more_places, more_sizes = _open_pieces([counts[b] for b in fresh], [int(fills[b]) for b in fresh], size)
            places = np.concatenate([places[stay], np.array(fresh, np.int64)[more_places]]) if fresh else places[stay]
            sizes = np.concatenate([sizes[stay], more_sizes]) if fresh else sizes[stay]
        if moved:
            tried, stuck = set(), set()
            if fills[donor]:
                tried.add(donor)
        else:
            tried.add(donor)
            stuck.add(tuple(sorted(counts[donor].items())))
    return [[i for rows in m.values() for i in rows] for m, fill in zip(members, fills.tolist(), strict=True) if fill]


def pack(lengths: list[int], size: int, work: int = SEARCH_WORK) -> list[list[int]]:
    """Bins of at most `size`, as lists of places in `lengths`."""
    return local_search(best_fit(lengths, size), lengths, size, work)


class _Window:
    """Pieces of one window, packed and given out together."""

    def __init__(self, size: int, sequences: Iterator[int], work: int):
        self.size, self.sequences, self.work = size, sequences, work
        self.rows: list[tuple] = []
        self.tokens = 0

    def add(self, doc_id, piece: int, start: int, ids: bytes) -> None:
        self.rows.append((doc_id, piece, start, len(ids) // 4, ids))
        self.tokens += len(ids) // 4

    def packed(self, last_round: bool) -> Iterator[pa.RecordBatch]:
        lengths = [row[3] for row in self.rows]
        out: list[tuple] = []
        for members in pack(lengths, self.size, self.work):
            sequence, offset = next(self.sequences), 0
            settled = last_round or sum(lengths[i] for i in members) >= self.size
            for i in members:
                out.append((*self.rows[i], sequence, offset, settled))
                offset += lengths[i]
            if len(out) >= OUT_ROWS:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)
        self.rows, self.tokens = [], 0


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


def _numbers(stage: int) -> Iterator[int]:
    """Numbers that no other task of any round gives: round, partition, running number."""
    n = (stage << 56) | (TaskContext.get().partitionId() << 32)
    while True:
        yield n
        n += 1


def packed_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, keep_memo: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids (binary, unsigned 32-bit), sequence_id and offset of every piece.

    With `keep_memo` the words that a worker knows stay for its next task; without, they go with the task, for executors
    that run other jobs too.
    """
    spark = docs.sparkSession
    bounded_batches(spark)

    def first(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, numbers = WordEncoder.of(tokenizer), _numbers(0)
        window = _Window(size, numbers, SEARCH_WORK)
        for part in parts:
            found = encoder.encode_all(part.column("text").to_pylist())
            for doc_id, own in zip(part.column("doc_id").to_pylist(), found, strict=True):
                ids = np.append(np.frombuffer(own, encoder.dtype), end_id).astype("<u4").tobytes()
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    window.add(doc_id, piece, at // 4, ids[at : at + 4 * size])
                    if window.tokens >= WINDOW_TOKENS:
                        yield from window.packed(False)
        yield from window.packed(False)
        if not keep_memo:
            encoder.forget()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().cast("binary").alias("text"))
    done = stored(texts.mapInArrow(first, PIECES), "pieces")
    settled = [done.where("settled")]
    stage, left = 1, done.where("not settled")
    before = None
    while True:
        tokens, n = left.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
        groups = -(-tokens // WINDOW_TOKENS)
        last = groups <= 1 or (before is not None and tokens > 0.9 * before)
        again = stored(_repacked(left, groups, size, stage, last), "leftovers")
        settled.append(again.where("settled"))
        if last or not n:
            break
        stage, left, before = stage + 1, again.where("not settled"), tokens
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.drop("settled")


def _repacked(left: DataFrame, groups: int, size: int, stage: int, last: bool) -> DataFrame:
    """Leftover pieces packed anew in `groups` groups of whole former bins."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = _Window(size, _numbers(stage), LEFTOVER_WORK)
        for part in parts:
            for row in zip(*(part.column(c).to_pylist() for c in ("doc_id", "piece", "start", "ids"))):
                window.add(*row)
                if window.tokens >= 2 * WINDOW_TOKENS:
                    yield from window.packed(last)
        yield from window.packed(last)

    return left.repartition(max(1, groups), F.xxhash64("sequence_id", F.lit(stage))).mapInArrow(work, PIECES)
