"""Tokenisers, token files and packing against the libraries and brute force."""

import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from shopsight.llm import byte_counts, packing, queries, spm, token_files
from shopsight.llm.common import WordEncoder

WORDS = queries.tokenizer_path("word_bpe_49k.json")
BYTES = queries.tokenizer_path("byte_bpe_50k.json")
PIECES = queries.tokenizer_path("piece_bpe_32k.model")
PARTS = [
    "a", "B", "'s", "'ll", " ", "  ", "    ", "\n", "\t", "\x1c", "\x85", "é", "é", "<|endoftext|>", "<|", "12", "½", "²", "中",
    "文", "՘", "\U0001f600", "ß", "...", "!!", "\x00", "'", "don't", "　", "_", "क", "्", "<", "̸", "Σ", "ΑΣ", "İ", "T̈",
    "<s>", "<unk>", "<0x0A>", "▁", "//", "();", "the", "ing", "Wor", "ld", "☃", "ﬁ",
]


def texts(seed: int, n: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(n)]


LONG = ["", " ", "a" * 5000, "ab" * 3000, "!" * 3000, " " * 700 + "x", "0" * 99, "word " * 3000]


def test_word_ids_equal_the_library():
    library, encoder, given_texts = Tokenizer.from_file(WORDS), WordEncoder.of(WORDS), texts(1) + LONG
    found = encoder.encode_all([t.encode() for t in given_texts])
    for text, ids in zip(given_texts, found, strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_byte_counts_equal_the_library():
    library, counter = Tokenizer.from_file(BYTES), byte_counts.MergeCounter.of(BYTES)
    for text in texts(2) + LONG:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_pieces_equal_the_library():
    import sentencepiece

    library, model = sentencepiece.SentencePieceProcessor(model_file=PIECES), spm.PieceModel.of(PIECES)
    for text in texts(3) + LONG + [" " * k for k in range(70)]:
        ids = np.frombuffer(model.encode(text), "<u4").tolist()
        assert ids == [1, *library.encode(text), 2], text
        assert model.decode(ids) == library.decode(ids), text


def test_decoding_of_arbitrary_ids_equals_the_library():
    import sentencepiece

    library, model, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), spm.PieceModel.of(PIECES), random.Random(4)
    for _ in range(3000):
        ids = [rng.randrange(1, 32000) if rng.random() < 0.5 else rng.randrange(3, 259) for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids), ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=3000), st.integers(0, 32))
def test_blocks_round_trip(values, bits):
    ids = np.array([v & ((1 << bits) - 1) if i % 17 else v for i, v in enumerate(values)], "<u4")
    blocks = token_files.pack_blocks(ids)
    sizes = [min(token_files.BLOCK, len(ids) - k) for k in range(0, len(ids), token_files.BLOCK)]
    back = [token_files.unpack_block(b, n) for b, n in zip(blocks, sizes, strict=True)]
    assert (np.concatenate(back) if back else ids).tolist() == ids.tolist()


EDGE = [(3, "b word", "x"), (1, None, "x"), (2, "", "y"), (None, "no id", "z"), (5, "long " * 9000, "x"), (3, "b word", "x"), (4, "Ünï ☃", None)]
SCHEMA = "doc_id long, text string, ids string"


def test_token_files_round_trip_with_edge_cases(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA)
    library = Tokenizer.from_file(WORDS)
    rows = token_files.read_token_files(token_files.write_token_files(docs.repartition(3), WORDS, 1)).collect()
    expected = sorted(((i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t, _ in EDGE), key=lambda r: (r[0] is not None, r[0] or 0))
    rows = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [i for i, _ in expected]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows] == [ids for _, ids in expected]
    assert [r.start for r in rows] == np.cumsum([0] + [len(ids) for _, ids in expected])[:-1].tolist()
    assert token_files.read_token_files(token_files.write_token_files(docs.limit(0), WORDS, 1)).count() == 0


def test_shard_reader_opens_any_document(tmp_path):
    writer, rng = token_files.ShardWriter(f"file://{tmp_path}", 0), np.random.default_rng(5)
    docs = [rng.integers(0, 50000, n).astype("<u4") for n in [0, 1, 5000, 3, 0, 1024, 2048, 7]]
    for k, ids in enumerate(docs):
        writer.add(k, ids)
    _, path, n_docs, n_ids = writer.close(f"file://{tmp_path}")
    reader = token_files.ShardReader(path)
    assert (n_docs, n_ids) == (len(docs), sum(map(len, docs)))
    for first in range(len(docs)):
        for last in range(first, len(docs) + 1):
            assert reader.ids(first, last).tolist() == [x for d in docs[first:last] for x in d.tolist()]


def check_packing(rows, size):
    bins: dict[int, list] = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert 0 < at <= size
    return len(bins)


def test_packing_keeps_every_piece_and_is_tight(spark, small):
    docs = queries.documents(spark, small)
    library = Tokenizer.from_file(WORDS)
    rows = packing.packed_pieces(docs, WORDS, 1, 4096).collect()
    assert check_packing(rows, 4096) == -(-sum(r.length for r in rows) // 4096)
    expected = {}
    for d in docs.collect():
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            expected[d.doc_id, piece] = (at, zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, zlib.crc32(r.ids)) for r in rows} == expected


def test_packing_in_small_windows_and_rounds(spark, small, monkeypatch):
    monkeypatch.setattr(packing, "WINDOW_TOKENS", 3000)
    docs = spark.createDataFrame(EDGE * 9, SCHEMA).repartition(5)
    rows = packing.packed_pieces(docs, WORDS, 1, 512).collect()
    assert len({(r.doc_id, r.piece, r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert sum(r.length for r in rows if r.doc_id == 5) == 9 * 9001
    check_packing(rows, 512)
    assert packing.packed_pieces(docs.limit(0), WORDS, 1, 512).count() == 0


def test_search_counts_the_room_of_all_bins():
    lengths = [10] * 99 * 200  # 200 bins lack 10 each, two sequences in all
    bins = [list(range(99 * b, 99 * b + 99)) for b in range(200)]
    found = packing.local_search(bins, lengths, 1000)
    assert sorted(i for b in found for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 1000 for b in found)
    assert len(found) == 198


@pytest.mark.parametrize("n,length", [(48_000, 17), (62_400, 17), (100_000, 1), (3_000, 2049)])
def test_packing_of_like_pieces_ends_soon(n, length):
    start = time.perf_counter()
    assert len(packing.pack([length] * n, 4096)) == -(-n // (4096 // length))
    assert time.perf_counter() - start < 5


def test_search_stops_at_its_bound_of_work():
    rng = random.Random(5)
    lengths = [rng.randint(1200, 1500) for _ in range(900)]
    before = packing.best_fit(lengths, 4096)
    sizes = [len(packing.local_search(before, lengths, 4096, work)) for work in (0, 100_000, packing.SEARCH_WORK)]
    assert sizes[0] == len(before) and sizes[0] >= sizes[1] >= sizes[2] and sizes[2] < sizes[0]


def test_local_search_empties_a_bin_that_best_fit_leaves():
    size = 100
    bins = [[0, 1], [2, 3], [4]]
    lengths = [40, 38, 41, 37, 40]  # 78 + 78 + 40 = 196: two bins are enough after exchanges
    assert packing.local_search(bins, lengths, size) != bins
    rng = random.Random(6)
    for _ in range(50):
        lengths = [rng.randint(1, 60) for _ in range(40)]
        found = packing.pack(lengths, size)
        assert sorted(i for b in found for i in b) == list(range(40))
        assert all(sum(lengths[i] for i in b) <= size for b in found)
        assert len(found) <= len(packing.best_fit(lengths, size))


@pytest.mark.parametrize("text,bytes_,tokens", [(None, 0, 0), ("", 0, 0), ("é", 2, 1), ("<|endoftext|>", 13, 1)])
def test_count_columns(spark, text, bytes_, tokens):
    row = byte_counts.token_counts(spark.createDataFrame([(1, text, 7)], "doc_id long, text string, n_tokens long"), BYTES, 0).first()
    assert (row.n_bytes, row.n_tokens, row.over_limit) == (bytes_, tokens, tokens > 0)


def test_piece_digests_of_edge_cases(spark):
    rows = spm.digests(spm.encoded(spark.createDataFrame(EDGE, SCHEMA), PIECES)).collect()
    assert len(rows) == len(EDGE) and {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {2}
