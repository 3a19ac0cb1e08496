"""Language identification with string kernels.

Kernel: the blended spectrum with presence values. A text is the set of its byte n-grams (n = 1, 2, 3 of the
lower-cased UTF-8 text, hashed into fixed columns); k(x, y) is the number of common n-grams over the geometric
mean of the two sets' sizes. Nystrom landmarks span the space, one ridge regression against 0/1 targets is fitted
for each language, and a text gets the language of the largest value. k(x, landmarks) times the coefficients is a
product of matrices, so a batch of texts is scored as presence matrix x (landmark matrix x coefficients).

Fitting uses at most `SAMPLE_ROWS` labelled rows, the same number for each language, chosen by a hash of doc_id; of
these, at most `LANDMARKS` are landmarks. The sample reaches the driver as bit rows of fixed size, not as texts.

A text that is null or has no letter gets `und` and score 0. The score is the largest value, held to 0..1. Ties go
to the first language in sort order. Texts are read whole; null labels are not learnt; without a labelled
row everything is `und`. Rows that repeat are scored each, further columns are kept by `with_language`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shopsight.llm.common import batches, text_column

SAMPLE_ROWS = 2400
LANDMARKS = 320
RIDGE = 1e-2
PAIR_COLUMNS, TRIPLE_COLUMNS = 1 << 13, 1 << 15
COLUMNS = 256 + PAIR_COLUMNS + TRIPLE_COLUMNS
PIECE_BYTES = 1 << 20
ROWS_AT_ONCE = 64
UNKNOWN = "und"


def mark_presence(text: bytes, row: np.ndarray) -> None:
    """Set the columns of all n-grams of the text in `row`."""
    whole = np.frombuffer(text, np.uint8)
    for at in range(0, len(whole), PIECE_BYTES):
        codes = whole[at : at + PIECE_BYTES + 2].astype(np.uint32)
        row[codes] = 1
        pairs = codes[:-1] << np.uint32(8) | codes[1:]
        row[256 + (pairs * np.uint32(2654435761) >> np.uint32(19))] = 1
        triples = pairs[:-1] << np.uint32(8) | codes[2:]
        row[256 + PAIR_COLUMNS + (triples * np.uint32(2654435761) >> np.uint32(17))] = 1


def presence(texts: list[str]) -> np.ndarray:
    """Presence matrix of texts, one row each."""
    out = np.zeros((len(texts), COLUMNS), np.uint8)
    for row, text in zip(out, texts, strict=True):
        mark_presence(text.lower().encode("utf-8"), row)
    return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    """languages and a (columns x languages) matrix: landmarks over their norms, times the coefficients."""

    languages: list[str]
    weights: np.ndarray

    def values(self, found: np.ndarray) -> np.ndarray:
        """One value for each row of a presence matrix and language."""
        dense = found.astype(np.float32)
        norms = np.sqrt(np.maximum(dense.sum(axis=1), 1))
        return dense @ self.weights / norms[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t is not None and has_letter(t)] if self.languages else []
        for k in range(0, len(known), ROWS_AT_ONCE):
            rows = known[k : k + ROWS_AT_ONCE]
            values = self.values(presence([texts[i] for i in rows]))
            best = values.argmax(axis=1)
            for i, b, score in zip(rows, best.tolist(), values.max(axis=1).clip(0, 1).tolist(), strict=True):
                names[i], scores[i] = self.languages[b], score
        return names, scores


def held_out(doc_id: Column) -> Column:
    """The quarter of the documents that is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """A model of the languages in the labelled rows of `docs` (doc_id, text, lang) that aren't held out."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    mark = F.xxhash64(F.col("text").cast("string"))
    marked = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", mark.alias("mark")).withColumn("h", F.xxhash64("doc_id", "mark"))
    sizes = marked.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    known = sizes.limit(sample_rows + 1).collect()
    if len(known) > sample_rows:
        raise ValueError(f"more than {sample_rows} languages: raise sample_rows")
    languages = sorted(row["lang"] for row in known)
    if not languages:
        return LanguageModel([], np.zeros((COLUMNS, 0), np.float32))
    quota = max(1, sample_rows // len(languages))
    # rows whose hash lies below a threshold that leaves some more than the quota of each language, so that few are ranked
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, (2 * quota + 100) / max(1, r["n"]))) for r in known], "lang string, share double")
    few = marked.join(F.broadcast(shares), "lang").where(F.shiftrightunsigned("h", 11) / 2.0**53 < F.col("share")).select("doc_id", "lang", "mark", "h").distinct()
    order = Window.partitionBy("lang").orderBy("h", "doc_id", "mark")
    chosen = few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= quota).drop("h")
    texts = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", mark.alias("mark"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(chosen), ["doc_id", "lang", "mark"]).dropDuplicates(["doc_id", "lang", "mark"])

    def work(part: pa.RecordBatch) -> dict:
        bits = np.packbits(presence(part.column("text").to_pylist()), axis=1)
        return {"doc_id": part.column("doc_id"), "lang": part.column("lang"), "place": part.column("place"), "bits": [b.tobytes() for b in bits]}

    rows = batches(texts.select("doc_id", "lang", "place", "text"), work, "doc_id long, lang string, place int, bits binary")
    sample = sorted(rows.collect(), key=lambda r: (r.place, r.lang, r.doc_id, r.bits))
    return _solve(sample, languages, landmarks, ridge)


def _solve(sample: list, languages: list[str], landmarks: int, ridge: float) -> LanguageModel:
    packed = np.frombuffer(b"".join(r.bits for r in sample), np.uint8).reshape(len(sample), -1)
    unpack = lambda rows: np.unpackbits(rows, axis=1, count=COLUMNS).astype(np.float32)

    def normed(rows: np.ndarray) -> np.ndarray:
        found = unpack(rows)
        return found / np.sqrt(np.maximum(found.sum(axis=1), 1))[:, None]

    base = normed(packed[:landmarks])
    kernel = np.concatenate([normed(packed[k : k + 256]) @ base.T for k in range(0, len(packed), 256)]).astype(np.float64)
    inner = kernel[: len(base)]
    targets = np.array([[r.lang == name for name in languages] for r in sample], np.float64)
    # the same weight for each language, so that frequent ones don't shift the others
    weight = 1 / np.maximum(targets.sum(axis=0), 1)[targets.argmax(axis=1)]
    left = kernel.T @ (kernel * weight[:, None]) + ridge / math.sqrt(len(sample)) * (inner + 1e-6 * np.eye(len(base)))
    coefficients = np.linalg.solve(left, kernel.T @ (targets * weight[:, None]))
    return LanguageModel(languages, (base.T @ coefficients).astype(np.float32))


def predicted(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, lang_pred and score of every row; only the text is read for them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # columns x languages, a bounded size

    def work(part: pa.RecordBatch) -> dict:
        names, scores = shared.value.predict(part.column("_text").to_pylist())
        return {name: part.column(name) for name in keep} | {"lang_pred": names, "score": scores}

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{name}` {kinds[name]}" for name in keep) + ", lang_pred string, score double"
    return batches(docs.select(*keep, F.col("text").cast("string").alias("_text")), work, schema)
