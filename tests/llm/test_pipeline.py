"""The whole pipeline against its stages in plain Python."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shopsight.llm import langid, near_dedup, quality_rules, queries
from tests.llm.test_documents import brute_similar, normal


def test_pipeline_against_brute_force(spark, small):
    docs = queries.documents(spark, small)
    given = {r.doc_id: r.text for r in docs.collect()}
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    names, scores = model.predict(list(given.values()))
    stay = [i for i, name, score in zip(given, names, scores, strict=True) if name != "und" and score >= corpus_pipeline.MIN_LANGUAGE_SCORE]
    known = docs.where(docs.doc_id.isin(stay))
    stay = sorted(r.doc_id for r in quality_rules.judged(known).where("kept").collect())
    first = {}
    for i in stay:
        first.setdefault(normal(given[i]), i)
    stay = sorted(first.values())
    groups = brute_similar([given[i] for i in stay], stay)
    stay = [i for i, g in zip(stay, groups, strict=True) if i == g]

    rows = corpus_pipeline.run(spark, small).collect()
    library = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    expected = {}
    for i in stay:
        ids = library.encode(given[i], add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            expected[i, piece] = (at, zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, zlib.crc32(r.ids)) for r in rows} == expected


def test_stages_keep_the_columns(spark, small):
    docs = queries.documents(spark, small)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, small).columns == docs.columns


def test_stages_take_empty_tables(spark, small):
    docs = queries.documents(spark, small).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() == 0


def test_no_hash_is_the_least_of_every_permutation():
    rng = np.random.default_rng(0)
    a, b = (np.unique(np.append(rng.integers(1, 2**64, 400, dtype=np.uint64), np.uint64(0))) for _ in range(2))
    assert not (near_dedup.band_keys(a) == near_dedup.band_keys(b)).any()


# Ten hashes each, found by trying three million: the sets of all but the last and of all but the last but one have a
# similarity of 0.8, and shared none of 40 keys from six minima each.
UNLIKELY = [
    [11342304124084959364, 11462509125439504010, 5311133080923778446, 9164293583848104503, 11745254374121739310, 7975082422532387951, 11307095695430305875, 8827268235706356436, 13305710549084081935, 5265284608710454910],
    [495798782233734703, 6593499101783737877, 18363768029197002281, 14636491450665931738, 9775031661337426697, 10861822706920101440, 8036898108851953581, 6887571735629659766, 818286770235985937, 18362666502770297592],
    [8167472579201165293, 7015444214769780474, 13301321331786725709, 16971841536140853648, 4981597816932346552, 16688474075383410790, 16756081985363343503, 15782357032328916193, 6980145033465093392, 14158985046539548866],
]


@pytest.mark.parametrize("hashes", UNLIKELY)
def test_pairs_that_shared_no_key_of_six_minima_share_one(hashes):
    both = np.array(hashes, np.uint64)
    a, b = np.sort(both[:9]), np.sort(np.append(both[:8], both[9]))
    assert near_dedup.similarity(a, b) == 0.8
    assert np.intersect1d(near_dedup.band_keys(a), near_dedup.band_keys(b)).size
    assert (1 - 0.8**near_dedup.ROWS) ** near_dedup.BANDS < 1e-13
