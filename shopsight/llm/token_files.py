"""Token ids in binary shards of patched frame-of-reference blocks.

Shard file (little-endian):

    magic "PFOR0001"
    blocks, one after another, each of BLOCK ids (the last may be shorter):
        u32 minimum, u8 width, u8 0, u16 exceptions,
        packed: (id - minimum) mod 2**width, `width` bits each, lowest bit first, filled up to a byte,
        u16 place of each exception, u32 (id - minimum) of each exception
    u64 start of each block in the file
    per document: i64 doc_id (0 if null), u8 1 if doc_id is null, u64 ids of the shard before it
    u64 blocks, u64 documents, u64 ids, magic "PFOR0001"

The width of a block holds the `PERCENTILE` smallest part of its differences; larger ones are exceptions. The
list of block starts lets a reader open any document without the blocks before it.

Writing: texts are dealt by ranges of doc_id, so shard numbers ascend with doc_id; each task encodes, packs and
writes its shard with a few blocks in memory, under a name of its own, and moves it into place: a repeated task
replaces the shard by an equal one. The written list of shards (number, path, documents, ids) is the table to read
back. Ranges of one repeated doc_id are cut further by the hash of the text. Null ids come first, rows that
repeat are all written, a null text has the end id only, an empty table gives no shard.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from shopsight.llm.common import WordEncoder, bounded_batches, input_partitions, stored, text_column
from shopsight.session import scratch_uri

MAGIC = b"PFOR0001"
BLOCK = 1024
PERCENTILE = 0.9
BLOCKS_AT_ONCE = 128
HEAD = np.dtype([("minimum", "<u4"), ("width", "u1"), ("zero", "u1"), ("exceptions", "<u2")])
SHARDS = "shard int, path string, n_docs long, n_ids long"
READ_DOCS = 256
READ_IDS = 1 << 20


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of BLOCK ids; only the last may be shorter."""
    out: list[bytes] = []
    whole = len(ids) // BLOCK
    for k in range(0, whole, BLOCKS_AT_ONCE):
        out += _pack_rows(ids[k * BLOCK : min(whole, k + BLOCKS_AT_ONCE) * BLOCK].reshape(-1, BLOCK))
    if len(ids) % BLOCK:
        out += _pack_rows(ids[whole * BLOCK :].reshape(1, -1))
    return out


def _pack_rows(rows: np.ndarray) -> list[bytes]:
    n = rows.shape[1]
    minimum = rows.min(axis=1)
    above = rows - minimum[:, None]
    limit = np.partition(above, int(PERCENTILE * (n - 1)), axis=1)[:, int(PERCENTILE * (n - 1))]
    widths = np.frexp(limit.astype(np.float64))[1]  # bits of the limit, 0 for 0
    out: list[bytes] = [b""] * len(rows)
    for width in np.unique(widths).tolist():
        chosen = np.flatnonzero(widths == width)
        bits = (above[chosen][:, :, None] >> np.arange(width, dtype=np.uint32)).astype(np.uint8) & 1
        packed = np.packbits(bits.reshape(len(chosen), n * width), axis=1, bitorder="little")
        for row, data in zip(chosen.tolist(), packed, strict=True):
            places = np.flatnonzero(above[row] >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
            head = struct.pack("<IBBH", int(minimum[row]), width, 0, len(places))
            out[row] = head + data.tobytes() + places.astype("<u2").tobytes() + above[row][places].astype("<u4").tobytes()
    return out


def unpack_block(data: bytes, n: int) -> np.ndarray:
    minimum, width, _, exceptions = struct.unpack_from("<IBBH", data)
    size = -(-n * width // 8)
    if width:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, size, HEAD.itemsize), count=n * width, bitorder="little").reshape(n, width)
        padded = np.zeros((n, 32), np.uint8)
        padded[:, :width] = bits
        ids = np.packbits(padded, axis=1, bitorder="little").view("<u4").reshape(n).copy()
    else:
        ids = np.zeros(n, "<u4")
    at = HEAD.itemsize + size
    places = np.frombuffer(data, "<u2", exceptions, at)
    ids[places] = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    return ids + np.uint32(minimum)


def _open_store(uri: str):
    """The file system of a folder or file that all executors reach, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


class ShardWriter:
    """One shard, written block by block."""

    def __init__(self, uri: str, shard: int):
        self.store, folder = _open_store(uri)
        self.store.create_dir(folder, recursive=True)
        self.final, self.shard = f"{folder}/shard-{shard:06d}.pfor", shard
        self.temporary = f"{folder}/.{shard:06d}-{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.temporary)
        self.out.write(MAGIC)
        self.at, self.starts, self.docs, self.n_ids = len(MAGIC), [], [], 0
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((0 if doc_id is None else doc_id, doc_id is None, self.n_ids))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK * BLOCKS_AT_ONCE:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, "<u4")
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for block in pack_blocks(ids[:whole]):
            self.starts.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def close(self, scheme_uri: str) -> tuple[int, str, int, int]:
        self._flush(True)
        docs = np.array(self.docs, DOC)
        self.out.write(np.array(self.starts, "<u8").tobytes() + docs.tobytes())
        self.out.write(struct.pack("<QQQ", len(self.starts), len(docs), self.n_ids) + MAGIC)
        self.out.close()
        self.store.move(self.temporary, self.final)
        return self.shard, f"{scheme_uri}/{self.final.rpartition('/')[2]}", len(docs), self.n_ids


DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("before", "<u8")])
TRAILER = 24 + len(MAGIC)


class ShardReader:
    """Documents of one shard; only the blocks that hold the asked documents are read."""

    def __init__(self, uri: str):
        store, path = _open_store(uri)
        self.file = store.open_input_file(path)
        end = self.file.size()
        blocks, docs, self.n_ids, magic = struct.unpack("<QQQ8s", self._bytes(end - TRAILER, TRAILER))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        self.end_of_blocks = end - TRAILER - docs * DOC.itemsize - 8 * blocks
        index = self._bytes(self.end_of_blocks, 8 * blocks + docs * DOC.itemsize)
        self.starts = np.frombuffer(index, "<u8", blocks)
        self.docs = np.frombuffer(index, DOC, docs, 8 * blocks)
        self.bounds = np.append(self.docs["before"], np.uint64(self.n_ids)).astype(np.int64)

    def _bytes(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of documents first to last - 1, one after another."""
        begin, end = int(self.bounds[first]), int(self.bounds[last])
        if begin == end:
            return np.empty(0, "<u4")
        block, stop = begin // BLOCK, -(-end // BLOCK)
        limits = [*self.starts[block : stop + 1].tolist(), *([self.end_of_blocks] if stop >= len(self.starts) else [])]
        data = self._bytes(limits[0], limits[stop - block] - limits[0])
        found = [
            unpack_block(data[limits[i] - limits[0] : limits[i + 1] - limits[0]], min(BLOCK, self.n_ids - (block + i) * BLOCK))
            for i in range(stop - block)
        ]
        return np.concatenate(found)[begin - block * BLOCK : end - block * BLOCK]


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encode every text, write the shards into `folder` (default: the shared scratch folder), return their list."""
    spark = docs.sparkSession
    folder = folder or scratch_uri(spark, "token-shards")
    bounded_batches(spark)

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = WordEncoder.of(tokenizer), None
        for part in parts:
            if writer is None and part.num_rows:
                writer = ShardWriter(folder, TaskContext.get().partitionId())
            ids = encoder.encode_all(part.column("text").to_pylist())
            for doc_id, own in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                writer.add(doc_id, np.append(np.frombuffer(own, encoder.dtype), end_id).astype("<u4"))
        if writer is not None:
            shard, path, n_docs, n_ids = writer.close(folder)
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "n_docs": n_docs, "n_ids": n_ids}], schema=LIST)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().cast("binary").alias("text"))
    texts = texts.withColumn("tie", F.xxhash64("text"))
    dealt = texts.repartitionByRange(input_partitions(docs), "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    return stored(dealt.mapInArrow(write, SHARDS), "token-shard-list")


LIST = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def read_token_files(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (binary, little-endian unsigned 32-bit) of every document in the shards.

    start counts the ids of all documents before it. The totals before each shard come from the list of
    shards, one short row for each file.
    """
    bounded_batches(shards.sparkSession)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    listed = shards.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    dealt = listed.repartitionByRange(max(1, shards.count()), "shard").select("path", "base")

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for path, base in zip(part.column("path").to_pylist(), part.column("base").to_pylist(), strict=True):
                shard = ShardReader(path)
                first = 0
                while first < len(shard.docs):
                    reach = int(np.searchsorted(shard.bounds, shard.bounds[first] + READ_IDS, "right")) - 1
                    last = min(max(reach, first + 1), first + READ_DOCS, len(shard.docs))
                    yield _documents(shard, first, last, base)
                    first = last

    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _documents(shard: ShardReader, first: int, last: int, base: int) -> pa.RecordBatch:
    ids, bounds = shard.ids(first, last), shard.bounds[first : last + 1]
    docs = shard.docs[first:last]
    offsets = ((bounds - bounds[0]) * 4).astype(np.int32)
    column = pa.BinaryArray.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.tobytes())])
    doc_ids = pa.array(docs["doc_id"].copy(), pa.int64(), mask=docs["null"].astype(bool))
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(bounds[:-1] + base), pa.array(np.diff(bounds)), column], names=["doc_id", "start", "n_tokens", "ids"]
    )
