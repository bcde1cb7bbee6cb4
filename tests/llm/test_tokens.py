"""Token counts and piece ids against the libraries of the vocabulary files."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from barwright.llm import sentence_pieces, token_counts
from samples import LONG, random_texts

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "abc 'stre  \n\t\x00éèñß漢字😀१２٣½ⅷ  ​́<|endoftext|>ABC.,;-_\x85\x1c▁᠎"
EXTREMES = ["", " ", "x" * 3000, "ab" * 2000, " " * 999, "a  b \n c ", "<|endoftext|>a<|endoftext|>",
            "a \x1c b", "a\x1f b \x1f", "\U00011de0a \U00012475 \U00016ff4", LONG]


@pytest.fixture(scope="module")
def bpe():
    return tokenizers.Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_counts_equal_the_library(bpe, sf_docs):
    texts = [*sf_docs.values(), *random_texts(1, 4000, ALPHABET), *EXTREMES]
    count = token_counts.vocabulary(BPE).count
    want = [len(e.ids) for e in bpe.encode_batch(texts, add_special_tokens=False)]
    assert [count(t) for t in texts] == want


def test_proven_strings_are_one_token(bpe):
    proven = sorted(token_counts.vocabulary(BPE).alone)
    assert len(proven) > 45_000
    assert all(len(e.ids) == 1 for e in bpe.encode_batch(proven, add_special_tokens=False))


def test_merging_long_pretokens_agrees_with_short_ones():
    vocabulary = token_counts.vocabulary(BPE)
    for word in [*random_texts(2, 300, "abcdeé"), "the" * 40, "a"]:
        if word:
            assert token_counts.merged_long(vocabulary, word) == vocabulary.merged(word)


def test_pretokens_agree_on_every_code_point(bpe):
    pretokens = token_counts.vocabulary(BPE).pretokens
    # Around the newest letters and numbers, and all of the basic plane.
    for code in [*range(0xD800), *range(0xE000, 0x10000), *range(0x11D00, 0x12700),
                 *range(0x16F00, 0x17000)]:
        text = f"a{chr(code)}1{chr(code)} {chr(code)}."
        assert len(pretokens(text)) == len(bpe.pre_tokenizer.pre_tokenize_str(text)), hex(code)


def test_token_counts_of_odd_rows(odd_docs, odd_texts, no_docs, bpe):
    rows = token_counts.token_counts(odd_docs, BPE, limit=10).collect()
    want = [(i, len((t or "").encode()), n := len(bpe.encode(t or "").ids), n > 10)
            for i, t in odd_texts]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert token_counts.token_counts(no_docs, BPE).collect() == []


def test_forgetting_does_not_change_counts(monkeypatch, sf_docs, bpe):
    monkeypatch.setattr(token_counts, "MEMORY", 40)
    count = token_counts.Vocabulary(BPE).count
    text = " ".join([*sf_docs.values()][:20])
    assert count(text) == len(bpe.encode(text).ids)


def test_ids_and_texts_equal_the_library(processor, sf_docs):
    model = sentence_pieces.piece_model(PIECES)
    some = [p for p in model.ids][::37]
    texts = [*sf_docs.values(), *random_texts(3, 4000, ALPHABET), *EXTREMES, "".join(some),
             " ".join(some).replace("▁", "")]
    for text in texts:
        ids = processor.encode(text)
        assert model.encode(text).tolist() == ids
        assert model.decode(np.array(ids, np.int32)) == processor.decode(ids)


def test_decoding_of_any_ids_equals_the_library(processor):
    model, draw = sentence_pieces.piece_model(PIECES), np.random.default_rng(4)
    for _ in range(2000):
        ids = draw.integers(3, 420, draw.integers(0, 14)).astype(np.int32)
        assert model.decode(ids) == processor.decode(ids.tolist())


def test_round_trips_of_odd_rows(odd_docs, odd_texts, no_docs, processor):
    rows = sentence_pieces.round_trips(odd_docs, PIECES).collect()
    want = []
    for i, text in odd_texts:
        ids = None if text is None else processor.encode(text)
        byte = None if ids is None else sum(processor.is_byte(x) for x in ids)
        digest = None if text is None else hashlib.sha256(text.encode()).hexdigest()
        want.append((i, None if ids is None else len(ids), byte, ids, digest))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert sentence_pieces.round_trips(no_docs, PIECES).collect() == []


def test_stored_ids_decode(spark, processor):
    rows = spark.createDataFrame([(1, processor.encode("Grüße 漢 x")), (2, []), (3, None)],
                                 "doc_id long, ids array<int>")
    assert {tuple(r) for r in sentence_pieces.decoded(rows, PIECES).collect()} == {
        (1, "Grüße 漢 x"), (2, ""), (3, None)}
