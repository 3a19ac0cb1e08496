"""Exact encoding of merge-type SentencePiece models by backtracking, and decoding.

The merge procedure of such a model (join the adjacent symbols whose piece has the best score, leftmost first)
gives a text the one sequence of pieces in which every two neighbours are compatible: their joined text, merged
again, falls into the same two pieces. The encoder looks for that sequence from the left. It takes the longest
piece at a place (an Aho-Corasick automaton over the pieces), then shorter ones; a piece must be compatible with
the one before it, and a bitfield remembers places from which no sequence reached the end.

A text is first cut where no piece of the model crosses: before a run of word marks that follows another sign,
and between letters and other signs. The cuts are checked against the model when it is opened, and are left
out if a piece crosses them. Parts go through a bounded memo.

Null text is empty (begin and end ids only). Code points that no piece has become their bytes. Texts of any length are
read whole. Rows repeat as they are, an empty table gives an empty result, further columns are ignored.
"""

from __future__ import annotations

import codecs
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopsight.llm.common import Memo, batches, text_column

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values: piece types of the model file
PAIRS_KEPT = 400_000
WORD_SIGN = re.compile(r"[^\W\d_]")


def _single_bytes(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("shopsight-single-bytes", _single_bytes)


class PieceModel:
    """Encoder and decoder of one model file."""

    _open: dict[str, PieceModel] = {}

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback:
            raise ValueError("a merge-type model with byte fallback is needed")
        if spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces:
            raise ValueError("only the identity normaliser with a leading mark is handled")
        self.begin, self.end = model.trainer_spec.bos_id, model.trainer_spec.eos_id
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte_ids = [0] * 256
        self.surface = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif p.type == CONTROL:
                self.surface.append(b"")
            else:
                self.surface.append((" ⁇ " if p.type == UNKNOWN else p.piece.replace(MARK, " ")).encode())
        self.bytes_first = set(self.byte_ids)
        self.fits: dict[tuple[str, str], bool] = {}
        self.whole = {p for p in self.ids if len(p) == 1 or self._merged(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p in self.whole:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.whole), None) for p in self.whole}
        self.parts = self._part_pattern()
        self.memo = Memo(self._part, longest=4 * 16)

    @classmethod
    def of(cls, path: str) -> PieceModel:
        """One model in each Python worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _part_pattern(self) -> re.Pattern:
        signs = {c for p in self.whole for c in p}
        numerals = "".join(sorted(c for c in signs if WORD_SIGN.match(c) and not c.isalpha()))
        letters = rf"[^\W\d_{MARK}{numerals}]"
        letter = re.compile(letters)
        kind = lambda c: "mark" if c == MARK else "letter" if letter.match(c) else "other"
        crossed = {(kind(a), kind(b)) for p in self.whole for a, b in zip(p, p[1:])}
        if crossed & {("letter", "mark"), ("other", "mark")}:
            return re.compile(r"(?s).+")
        if crossed & {("letter", "other"), ("other", "letter")}:
            return re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        return re.compile(rf"{MARK}*{letters}+|{MARK}*[\W\d_{numerals}](?<!{MARK})(?:[\W\d_{numerals}](?<!{MARK}))*|{MARK}+")

    def _merged(self, text: str) -> list[str]:
        """The merge procedure itself, for short texts: pieces and pairs of pieces."""
        symbols: list[str | None] = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        scores, heap = self.scores, []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (score := scores.get(both := symbols[i] + symbols[j])) is not None:
                heapq.heappush(heap, (-score, i, both))

        for i in range(n):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if symbols[i] is None or after[i] >= n or symbols[i] + symbols[after[i]] != both:
                continue
            j = after[i]
            symbols[i], symbols[j] = both, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s in symbols if s is not None]

    def _compatible(self, left: str, right: str) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= PAIRS_KEPT:
                self.fits.clear()
            known = self.fits[left, right] = self._merged(left + right) == [left, right]
        return known

    def _longest(self, part: str, at: int) -> str:
        n = self.automaton.longest_prefix(part[at : at + 64])
        found = part[at : at + n]
        while n and found not in self.whole:
            n -= 1
            found = part[at : at + n]
        return found or part[at]

    def pieces(self, part: str) -> list[str]:
        """The sequence of pieces, by backtracking; a code point that no piece has stands for itself."""
        n = len(part)
        open_places = bytearray(b"\1") * (n + 1)
        found: list[str] = []
        at, piece = 0, self._longest(part, 0) if n else None
        while piece is not None:
            end = at + len(piece)
            if open_places[end] and (not found or self._compatible(found[-1], piece)):
                found.append(piece)
                at = end
                piece = self._longest(part, at) if at < n else None
                continue
            piece = self.shorter.get(piece)
            if piece is None:
                open_places[at] = 0
                piece = found.pop()
                at -= len(piece)
        return found

    def _part(self, part: str) -> bytes:
        ids: list[int] = []
        for piece in self.pieces(part):
            known = self.ids.get(piece)
            ids.extend([known] if known is not None else [self.byte_ids[b] for b in piece.encode("utf-8")])
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids with begin and end as little-endian unsigned 32-bit integers."""
        marked = MARK + text.replace(" ", MARK) if text else ""
        inner = b"".join(map(self.memo.__getitem__, self.parts.findall(marked)))
        return self.begin.to_bytes(4, "little") + inner + self.end.to_bytes(4, "little")

    def decode(self, ids: list[int]) -> str:
        """Text of ids: marks become spaces, a leading one is dropped; bytes that are no UTF-8 become U+FFFD each."""
        joined = b"".join(map(self.surface.__getitem__, ids))
        if joined[:1] == b" " and next(i for i in ids if self.surface[i]) not in self.bytes_first:
            joined = joined[1:]
        return joined.decode("utf-8", "shopsight-single-bytes")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit, with begin and end) and decoded of every whole text."""

    def work(part: pa.RecordBatch) -> dict:
        model = PieceModel.of(path)
        ids = [model.encode(t) for t in part.column("text").to_pylist()]
        decoded = [model.decode(np.frombuffer(b, "<u4").tolist()) for b in ids]
        return {"doc_id": part.column("doc_id"), "n_tokens": [len(b) // 4 for b in ids], "ids": ids, "decoded": decoded}

    texts = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    return batches(texts, work, "doc_id long, n_tokens long, ids binary, decoded string")


def digests(tokens: DataFrame) -> DataFrame:
    """Hashes of ids and decoded text, as columns of `encoded`."""
    return tokens.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )

