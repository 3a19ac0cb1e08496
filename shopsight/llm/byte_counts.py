"""Token counts of a byte-level BPE file by heap-and-linked-list merging, without making identifiers.

A text is cut at the special strings of the file (each is one token) and then into pre-tokens by the file's
pattern. The bytes of a pre-token form a linked list; a heap holds adjacent pairs by merge rank and place, and
the lowest is popped until none is left. The count is the number of first symbols minus the merges. Counts of
short pre-tokens are kept in a bounded memo of the worker.

Null text is empty and has no token. Texts of any length are read whole: the heap holds one pre-token only.
Rows repeat as they are, an empty table gives an empty result, further columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopsight.llm.common import Memo, batches, text_column

# The white space of the pattern's \s class.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _ranges(points: list[int]) -> str:
    """Sorted code points as the inside of a character class."""
    out, first, last = [], None, None
    for p in [*points, None]:
        if p is not None and last is not None and p == last + 1:
            last = p
            continue
        if first is not None:
            out.append(f"\\U{first:08x}-\\U{last:08x}" if last > first else f"\\U{first:08x}")
        first = last = p
    return "".join(out)


def pre_token_pattern(below: int = sys.maxunicode + 1) -> tuple[re.Pattern, re.Pattern]:
    """The pattern with its Unicode classes spelt out, for texts of code points under `below`, and what finds others
    or code points without an assigned category. Short classes match several times as fast."""
    kinds: dict[str, list[int]] = {"L": [], "N": [], "C": []}
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point)) if point < below else "Cn"
        if kind[0] in "LN" or kind == "Cn":
            kinds[kind[0]].append(point)
    letters, numbers, other = (_ranges(kinds[k]) for k in "LNC")
    pattern = (
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACES}{letters}{numbers}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
    )
    return re.compile(pattern), re.compile(f"[{other}]")


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: itself where printable, else the next code point from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


NONE = -1
LATIN_END = 0x2B0
PLACE = (1 << 32) - 1


def pair_key(left: int, right: int) -> int:
    return left << 32 | right


class MergeCounter:
    """Counts tokens of texts as a byte-level BPE `tokenizers` file gives them."""

    _open: dict[str, MergeCounter] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"]
        self.first = [0] * 256
        for symbol, byte in byte_symbols().items():
            self.first[byte] = vocabulary[symbol]
        self.ranks, self.made = {}, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(pair_key(vocabulary[left], vocabulary[right]), rank)
            self.made.append(vocabulary[left + right])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pattern, self.unknown = pre_token_pattern()
        self.latin, self.not_latin = pre_token_pattern(LATIN_END)
        self.path, self.library = path, None
        self.memo = Memo(self._pre_token)

    @classmethod
    def of(cls, path: str) -> MergeCounter:
        """One counter in each Python worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _pre_token(self, word: str) -> int:
        first, ranks, made = self.first, self.ranks, self.made
        ids = [first[b] for b in word.encode("utf-8")]
        n = count = len(ids)
        if n < 2:
            return n
        # best[i]: rank of the pair that starts at i, or NONE; heap entries are rank and place in one integer.
        best = [ranks.get(pair, NONE) for pair in map(pair_key, ids, ids[1:])]
        best.append(NONE)
        heap = [rank << 32 | i for i, rank in enumerate(best) if rank != NONE]
        if not heap:
            return n
        heapq.heapify(heap)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            entry = pop(heap)
            i, rank = entry & PLACE, entry >> 32
            if best[i] != rank:
                continue  # one side was merged meanwhile
            j = after[i]
            k = after[i] = after[j]
            ids[i] = new = made[rank]
            best[j] = best[i] = NONE
            count -= 1
            if k < n:
                before[k] = i
                right = ranks.get(new << 32 | ids[k])
                if right is not None:
                    best[i] = right
                    push(heap, right << 32 | i)
            h = before[i]
            if h >= 0:
                left = best[h] = ranks.get(ids[h] << 32 | new, NONE)
                if left != NONE:
                    push(heap, left << 32 | h)
        return count

    def _plain(self, text: str) -> int:
        if text.isascii() or not self.not_latin.search(text):
            return sum(map(self.memo.__getitem__, self.latin.findall(text)))
        if self.unknown.search(text):
            # The library may know younger letters than this Python does: it cuts such rare texts itself.
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.path).pre_tokenizer
            return sum(self.memo[text[a:b]] for _, (a, b) in self.library.pre_tokenize_str(text))
        return sum(map(self.memo.__getitem__, self.pattern.findall(text)))

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1


def token_counts(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens above `limit`) of every row."""

    def work(part: pa.RecordBatch) -> dict:
        counter = MergeCounter.of(path)
        return {"doc_id": part.column("doc_id"), "n_bytes": part.column("n_bytes"), "n_tokens": list(map(counter.count, part.column("text").to_pylist()))}

    texts = docs.select(F.col("doc_id").cast("long"), text_column().alias("text"))
    texts = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counts = batches(texts, work, "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
