"""What the operators share: bounded Arrow batches, written tables, bounded memos, id encoders."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopsight.session import scratch_uri

BATCH_ROWS = 256
MEMO_ENTRIES = 800_000
MEMO_WORD_BYTES = 64


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most `BATCH_ROWS` rows, since one text may be long; a smaller setting of the session stays."""
    for key in ("spark.sql.execution.arrow.maxRecordsPerBatch",):
        if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
            spark.conf.set(key, str(BATCH_ROWS))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of `rows` narrow rows for the jobs that run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, "10000")
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read again: later stages restart from files, not from lost executors."""
    uri = scratch_uri(df.sparkSession, name)
    df.write.parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def removed(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more: the folders below the scratch folder that hold their files."""
    for table in tables:
        spark = table.sparkSession
        base = scratch_uri(spark, "x").rsplit("/", 1)[0]
        inside = base.rsplit("/", 1)[-1] + "/"
        for top in {f.split(inside, 1)[0] + inside + f.split(inside, 1)[1].split("/", 1)[0] for f in table.inputFiles() if inside in f}:
            path = spark._jvm.org.apache.hadoop.fs.Path(top)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def input_partitions(df: DataFrame) -> int:
    """The number of scan tasks, which follows the bytes of the input; no job runs."""
    return max(1, df.rdd.getNumPartitions())


def text_column(name: str = "text") -> Column:
    """Null counts as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def batches(df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """`mapInArrow` of a function from one batch to columns; empty batches pass."""
    bounded_batches(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                made = work(part)
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


# Combining marks start at U+0300, whose first byte is CC.
UNSAFE = re.compile(rb"[\xcc-\xff]")
TAIL = re.compile(rb"[!-/:-@\[-`{-~](?<=[a-z0-9].)[!-/:-@\[-`{-~]*(?![^ \t-\r])")
BETWEEN = "\u2603"
JOINED_PARTS = 500


class Memo(dict):
    """word -> made(word), in two generations of at most `entries` words; long words are not kept."""

    def __init__(self, made: Callable, entries: int = MEMO_ENTRIES // 2, longest: int = MEMO_WORD_BYTES):
        super().__init__()
        self.made, self.entries, self.longest, self.older = made, entries, longest, {}

    def __missing__(self, word):
        value = self.older.get(word)
        if value is None:
            value = self.made(word)
            if len(word) > self.longest:
                return value
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[word] = value
        return value


class WordEncoder:
    """Ids of whole texts by a `tokenizers` file whose pre-tokens never span white space.

    Such a file gives a text the ids of its white-space separated parts in order, so each part goes to the
    library once and its ids are kept in a bounded memo. ASCII white space separates; any other stays inside a
    part and is left to the library, as are special strings. A file that lower-cases and whose pattern ends a
    letter or digit at punctuation (`folds`) lets parts differ less: ASCII capitals are lowered and the
    punctuation at the end of a part is cut off first, unless the text has code points that may combine or the
    start of a special string.
    """

    _open: dict[str, WordEncoder] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        self.folds = '"Lowercase"' in self.tokenizer.to_str() and all(t.content.startswith("<|") for t in self.tokenizer.get_added_tokens_decoder().values())
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        marks = self._library(BETWEEN)
        self.marks = tuple(marks.tolist()) if len(marks) == 2 and self.folds else None

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """One encoder in each Python worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def forget(self) -> None:
        """Drop the memo, so that an idle worker leaves its memory to others."""
        self.memo, self.older = {}, {}
        pa.default_memory_pool().release_unused()

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _encode_parts(self, parts: list[bytes]) -> None:
        """Ids of new parts, many in one call: a sign between them, which they don't have, shows where each ends."""
        plain = [p for p in parts if b"<|" not in p and BETWEEN.encode() not in p] if self.marks is not None else []
        for k in range(0, len(plain), JOINED_PARTS):
            some = plain[k : k + JOINED_PARTS]
            ids = self._library(f" {BETWEEN} ".join(p.decode("utf-8") for p in some))
            first, second = self.marks
            ends = np.flatnonzero((ids[:-1] == first) & (ids[1:] == second)).tolist()
            starts = [0, *(e + 2 for e in ends)]
            self.memo.update(zip(some, (ids[a:b].tobytes() for a, b in zip(starts, [*ends, len(ids)], strict=True)), strict=True))
        done = set(plain)
        for p in parts:
            if p not in done:
                self.memo[p] = self._library(p.decode("utf-8")).tobytes()

    def _cut(self, text: bytes) -> list[bytes]:
        if self.folds and b"<|" not in text and not UNSAFE.search(text):
            text = TAIL.sub(rb" \g<0>", text.lower())
        return text.split()

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned integers of `dtype`."""
        cut = [self._cut(t) for t in texts]
        if len(self.memo) > MEMO_ENTRIES:
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        need = [p for p in set().union(*cut) if p not in memo]
        memo.update((p, older[p]) for p in need if p in older)
        new = [p for p in need if p not in memo]
        self._encode_parts(new)
        out = [b"".join(map(self.memo.__getitem__, parts)) for parts in cut]
        for p in new:
            if len(p) > MEMO_WORD_BYTES:
                del self.memo[p]
        return out


def word_tokens(docs: DataFrame, path: str, end_id: int | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, ids (binary, little-endian unsigned 32-bit) of every whole text and n_tokens; null text is empty."""
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def work(part: pa.RecordBatch) -> dict:
        encoder = WordEncoder.of(path)
        found = encoder.encode_all(part.column("text").to_pylist())
        wide = [np.frombuffer(ids, encoder.dtype).astype("<u4").tobytes() + tail for ids in found]
        made = {name: part.column(name) for name in keep}
        return made | {"ids": wide, "n_tokens": [len(b) // 4 for b in wide]}

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{name}` {kinds[name]}" for name in keep) + ", ids binary, n_tokens long"
    return batches(docs.select(*keep, text_column().cast("binary").alias("text")), work, schema)
