"""Streaming segmentation against the library on whole texts, and round trips."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from storyloom.llm.queries import tokenizer_file
from storyloom.llm.sentencepiece import Pieces, coded_digest, decode, encode

PATH = tokenizer_file("piece_bpe_32k.model")
LIB = SentencePieceProcessor(model_file=PATH)
BPE = Pieces(PATH)
PARTS = [" ", "  ", "a", "e", "t", "th", "er", "in", "1", "é", "漢", "\n", "\t", ".", "un", "ing", "́", "S", "😀"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60).map("".join))
def test_ids_equal_the_library(text):
    ids = BPE.encode(text)
    assert ids == LIB.encode(text)
    assert BPE.decode(ids) == text == LIB.decode(ids)


def test_documents_equal_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    coded = encode(docs, PATH)
    assert {r["doc_id"]: r["ids"] for r in coded.collect()} == {d: LIB.encode(t) for d, t in texts.items()}
    assert {r["doc_id"]: r["text"] for r in decode(coded, PATH).collect()} == texts


def test_window_is_bounded_and_commits_early():
    text = "there" * 20_000
    given_out, read = 0, 0

    def chars():
        nonlocal read
        for c in text:
            read += 1
            yield c
    late = 0
    for piece in BPE.segments(chars()):
        given_out += len(piece)
        late = max(late, read - given_out)
    assert given_out == len(text) and late <= 4 * BPE.longest


def test_unigram_takes_the_best_sum_of_scores():
    own = Pieces(PATH, "unigram")

    def best(text):  # over every segmentation
        if not text:
            return 0.0
        return max(own.score[text[:k]] + best(text[k:]) for k in range(1, len(text) + 1) if text[:k] in own.score)
    for text in ["hello world", "therein under", "a b c", "programming", "aaaa aaaa"]:
        ids = own.encode(text)
        assert sum(LIB.get_score(i) for i in ids) == best("▁" + text.replace(" ", "▁"))
        assert own.decode(ids) == text


def test_nulls_empty_and_repeats(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a b", "x"), (3, "a b", "x"), (None, "c", "x")],
                               "doc_id long, text string, ids string")
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["round_trip"]) for r in coded_digest(df, PATH).collect())
    assert got == [(0, 1, True), (1, 0, True), (2, 0, True), (3, 2, True), (3, 2, True)]
    assert coded_digest(df.limit(0), PATH).collect() == []
