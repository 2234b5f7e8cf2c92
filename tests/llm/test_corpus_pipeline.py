"""Each stage is held against a brute-force version or the labels, on its own input."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from ledgerline.llm import words
from ledgerline.llm.shared import stored
from test_neardup import brute
from test_packing import whole

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the result of every stage."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = (docs, docs := stored(stage(spark, docs, SF_DIR), "test"))
    return out


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns(stages):
    for name in ("quality", "toxicity", "near_duplicates"):
        before, after = stages[name]
        assert after.columns == before.columns and after.count() == len(ids(after)) and ids(after) < ids(before)


def test_quality_keeps_good_and_drops_bad(stages, labels):
    before, after = map(ids, stages["quality"])
    good = {d for d in before if d in labels and labels[d].quality == 1}
    bad = {d for d in before if d in labels and labels[d].quality == 0}
    assert len(good & after) >= 0.97 * len(good) and len(bad & after) <= 0.15 * len(bad)


def test_toxicity_keeps_clean(stages, labels):
    before, after = map(ids, stages["toxicity"])
    clean = {d for d in before if d in labels and labels[d].toxic == 0}
    toxic = {d for d in before if d in labels and labels[d].toxic == 1}
    assert len(clean & after) >= 0.97 * len(clean) and len(toxic & after) <= 0.4 * len(toxic)  # a tenth of these labels is noise


def test_near_duplicates_against_all_pairs(stages):
    before, after = stages["near_duplicates"]
    root = brute({r.doc_id: r.text for r in before.collect()}, 80)
    assert ids(after) == {d for d, r in root.items() if d == r}


def test_packing_covers_what_is_left(stages):
    before, after = stages["packing"]
    rows = before.collect()
    encoded = words.word_encoder(public_tokenizers.path("word_bpe_49k.json")).encode([r.text for r in rows])
    sizes = {r.doc_id: len(e) + 1 for r, e in zip(rows, encoded)}
    pieces = [(r.doc_id, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset) for r in after.collect()]
    windows = whole(pieces, 2048, sizes)
    assert windows <= sum(sizes.values()) / 2048 + after.rdd.getNumPartitions()


def test_run_is_the_stages(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(corpus_pipeline.run(spark, SF_DIR).select(columns).collect()) == sorted(stages["packing"][1].select(columns).collect())


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a b c d e f", "x"), (3, "a b c d e f", "x"), (None, "a b c d e f", "x"),
            (4, "A b c d e f", None), (5, "long " * 50_000, "y")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, s, 1) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, score string, number int")
    for name, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    left = corpus_pipeline.one_of_each(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 2, 3, 5]
    assert np.isin([r.doc_id or 0 for r in corpus_pipeline.packed(spark, left, SF_DIR).collect()], [0, 1, 2, 3, 5]).all()
    for _, stage in corpus_pipeline.STAGES[2:]:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_different_texts_of_one_id_are_different_documents(spark):
    texts = [" ".join(f"{word}{i}" for i in range(12)) for word in "abcd"]
    rows = [(1, texts[0]), (2, texts[0]), (2, texts[1]), (3, texts[2]), (3, texts[3]), (4, texts[3] + " more"), (3, texts[2]), (0, texts[1].upper())]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), n) for n, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, document int")
    left = corpus_pipeline.one_of_each(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == sorted([
        (0, texts[1].upper()), (1, texts[0]), (3, texts[2]), (3, texts[3])])
