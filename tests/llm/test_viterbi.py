"""Counts are the public library's, ties included."""

from __future__ import annotations

import os
import random

import public_tokenizers
import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"

from tokenizers import Tokenizer, models, pre_tokenizers

from ledgerline.llm import viterbi
from ledgerline.llm.queries import op2_viterbi

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def library(pieces):
    tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0)] + pieces, 0, False))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement=viterbi.MARK, prepend_scheme="always", split=True)
    return lambda text: len(tokenizer.encode(text).ids)


def test_odd_texts():
    pieces = viterbi.vocabulary(MODEL)
    draw, count, counter = random.Random(2), library(pieces), viterbi.Counter(pieces)
    letters = [" ", "  ", "\n", "a", "the", " the", "ing", "ß", "中", "\U0001f600", "▁", "1", "x" * 30, "́", "\t"]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 30))) for _ in range(3000)]
    texts += ["", " ", "▁▁a", "中" * 50, "a " * 500_000]
    for text in texts:
        assert counter.text(text) == count(text), text[:80]


def test_ties():
    draw = random.Random(3)
    for _ in range(60):
        pieces = {"".join(draw.choices("ab▁", k=draw.randint(1, 4))): float(-draw.randint(1, 3)) for _ in range(9)}
        counter, count = viterbi.Counter(list(pieces.items())), library(list(pieces.items()))
        for _ in range(40):
            text = "".join(draw.choices("abc ", k=draw.randint(1, 12)))
            assert counter.text(text) == count(text), (text, pieces)


def test_nulls_repeats_and_clashing_columns(rows):
    df = rows("doc_id long, text string, n_tokens string", (1, None, "x"), (1, "", "x"), (None, "the", None), (1, "", "x"))
    got = viterbi.counted(df, MODEL)
    assert got.columns == ["doc_id", "text", "n_tokens"]
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == [
        (0, library(viterbi.vocabulary(MODEL))("the")), (1, 0), (1, 0), (1, 0)]
    assert viterbi.counted(df.limit(0), MODEL).count() == 0


def test_query_against_the_library(spark):
    sf_dir = "/root/testdata/sf0.001"
    count = library(viterbi.vocabulary(MODEL))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in op2_viterbi(spark, sf_dir).collect()} == {d: count(t) for d, t in texts.items()}
