"""Encoding gives what the public library gives; decoding gives the bytes back."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgerline.llm import bpe
from ledgerline.llm.queries import op3_byte_bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokens():
    return bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def library(tokens):
    ranks = {token: i for i, token in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_and_long_texts(tokens, library):
    letters = [" ", "  ", "\n", "\t", "\x1c", "\x85", "᠎", " ", "　", "\xa0", "a", "B", "é", "1",
               "²", "_", "-", "'s", "'", "'ll", "中", "\U0001f600", "́", "\x00", "!!", "x" * 50]
    draw = random.Random(5)
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, " " * 5000, "x" * 300 + "yz" * 200, "<|endoftext|>", "", "word " * 300_000]
    encoder = bpe.rank_encoder(tokens, public_tokenizers.PATTERN)
    for text, packed in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(packed, "<i4").tolist() == library.encode_ordinary(text)


def test_heap_and_matrix_agree(tokens):
    engine = bpe.rank_bpe(tokens)
    draw = random.Random(6)
    words = [bytes(draw.choices(b"aehnt ", k=draw.randint(1, 60))) for _ in range(2000)]
    assert engine.encode(words) == [engine._heap(word) for word in words]


def test_nulls_other_columns_and_round_trip(rows, library):
    df = rows("ids string, text string, bytes int", ("a", None, 1), ("b", "", 2), (None, "Der Über test's", 3), ("b", "", 2))
    encoded = bpe.encode(df.withColumnRenamed("ids", "name"), RANKS, public_tokenizers.PATTERN)
    back = bpe.decode(encoded.drop("bytes"), RANKS).collect()
    assert sorted((r["name"] or "", bytes(r["bytes"]).decode()) for r in back) == [
        ("", "Der Über test's"), ("a", ""), ("b", ""), ("b", "")]
    clashing = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    assert clashing.columns == ["bytes", "ids"] and clashing.count() == 4
    assert bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_query_against_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op3_byte_bpe(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == set(texts)
    for row in got:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_memory_is_bounded_in_bytes():
    """Long texts without spaces are not held beyond the bound and one group."""
    from ledgerline.llm.shared import Memory
    from ledgerline.llm.viterbi import Counter

    encoder = bpe.Encoder(re.compile("[^ ]+"), lambda chunks: [c.encode() for c in chunks], known=Memory(1 << 20))
    counter = Counter([("a", -1.0), ("b", -1.5), ("ab", -2.0)])
    counter.known = Memory(1 << 20)
    for i in range(60):
        text = f"{i}" + "ab" * 20_000
        assert encoder.encode([text]) == [text.encode()] and counter.text(text) > 20_000
        assert encoder.known.held < (1 << 20) + 200_000 and counter.known.held < (1 << 20) + 200_000
