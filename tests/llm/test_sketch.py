"""Fingerprints against a plain version; the order of rows against a sorted list."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import sketch
from ledgerline.llm.queries import op4_scaled_sketch


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    got = op4_scaled_sketch(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    errors, by_text = [], {}
    for r in got:
        text, other = texts[r.doc_id], texts[following[r.doc_id]]
        m = len(text) // 2
        edited = text[: len(text) - m] + other[:m]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert by_text.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        for near, against in ((r.near_edited, edited), (r.near_next, other)):
            a, b = shingles(text), shingles(against)
            if min(len(a), len(b)) >= 200:
                errors.append(abs(near - len(a & b) / min(len(a), len(b))))
    assert len(errors) > 50 and max(errors) < 0.3 and sum(errors) / len(errors) < 0.05


@pytest.mark.parametrize("keys", [[5], [1, 2, 3], [None, 4, 4, 4, 9, None], list(range(300)), [10**6 * i for i in range(50)]])
def test_next_row(rows, keys):
    random.Random(1).shuffle(keys)
    df = rows("k long, t string, bucket string, next int", *[(k, f"text {i}", "x", 0) for i, k in enumerate(keys)])
    got = sketch.with_next(df, "k", "t", "after").collect()
    assert sorted(r.t for r in got) == sorted(f"text {i}" for i in range(len(keys)))
    after = {r.t: r.after for r in got}
    key = {f"text {i}": k for i, k in enumerate(keys)}
    # Following the chain visits every row once, by descending key, and comes back to the start.
    first = max((t for t in after), key=lambda t: (key[t] is not None, key[t] or 0))
    starts = [t for t in after if key[t] == key[first]]
    start = next(t for t in starts if len(starts) == 1 or all(after[s] != t or s not in starts for s in starts))
    order, at = [start], after[start]
    while at != start:
        order.append(at)
        at = after[at]
    assert len(order) == len(keys)
    assert [key[t] for t in order] == sorted((k for k in keys if k is not None), reverse=True) + [None] * keys.count(None)


def test_odd_texts_and_repeats(rows):
    long = "many words " * 20_000
    df = rows("id int, text string, hash string",
              (1, None, ""), (2, "", ""), (3, " \n\t", ""), (4, "one", ""), (5, "a b c d e f g", ""), (6, long, ""), (5, "a b c d e f g", ""))
    got = {r.id: r.fingerprint for r in sketch.fingerprints(df).collect()}
    assert got[1] == got[2] == got[3] == [] and len(got[4]) == 1 and 1 <= len(got[5]) <= 3 and 1 <= len(got[6]) <= 2
    assert sketch.fingerprints(df).count() == 7
    empty = df.limit(0)
    assert sketch.fingerprints(empty).count() == 0 and sketch.with_next(empty, "id", "text", "n").count() == 0
    twice = sketch.with_next(df, "id", "text", "n")
    assert twice.count() == 7


def test_text_form_and_merging(rows):
    draw = random.Random(2)
    first, second = (" ".join(draw.choices("abcdefgh", k=300)) for _ in range(2))
    df = rows("a string, b string", (first, second))
    # A merged fingerprint is that of both texts' shingles; text and back keeps it.
    r = df.select(
        sketch.retained(sketch.hashes(F.col("a"))).alias("a"), sketch.retained(sketch.hashes(F.col("b"))).alias("b"),
        sketch.retained(F.concat(sketch.hashes(F.col("a")), sketch.hashes(F.col("b")))).alias("both"),
    ).select("both", sketch.merged(F.col("a"), F.col("b")).alias("merged"),
             sketch.from_text(sketch.as_text(F.col("a"))).alias("back"), "a").first()
    assert sorted(r.both) == sorted(r.merged) and list(r.back) == list(r.a)


def test_merged_fingerprints_of_short_and_long_texts(spark):
    """Also where one text has kept a hash for want of one below the threshold."""
    texts = [" ".join(f"w{i}x{j}" for j in range(n)) for i in range(40) for n in (1, 6, 7, 60)]
    rows = [(a, b) for a, b in zip(texts, texts[1:])]
    a, b = sketch.hashes(F.col("a")), sketch.hashes(F.col("b"))
    found = spark.createDataFrame(rows, "a string, b string").select(
        sketch.merged(sketch.retained(a), sketch.retained(b)).alias("merged"), sketch.retained(F.concat(a, b)).alias("together"),
        F.size(sketch.retained(a)).alias("n")).collect()
    assert all(r.merged == r.together for r in found) and {1} < {r.n for r in found}
