"""Gradients against differences, whole texts, held-out accuracy, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import quality
from ledgerline.llm.queries import op5_byte_network


def loss(network, data, halves, labels):
    chunk, first, _ = network._chunks(np.maximum(network.pooled(quality.windows(data, halves), network.tables()), 0), halves)
    unit = np.maximum(chunk @ network.hidden + network.hidden_bias, 0)
    z = np.maximum.reduceat(unit, first, axis=0) @ network.out + network.out_bias[0]
    return float(np.mean(np.log1p(np.exp(-np.where(labels == 1, z, -z)))))


def test_gradients():
    network = quality.Network.new(3, 0.1, filters=5, units=4)
    for part in network.parts():
        part[...] = part.astype(np.float64)
    texts = ["hello there " * 30, "AAAA!! BBBB!! " * 20, "", "x"]
    data, halves = quality.laid_out(texts)
    labels = np.array([1, 0, 1, 0], np.float32)
    draw = np.random.default_rng(4)
    for part, gradient in zip(network.parts(), network.gradients(data, halves, labels)):
        for _ in range(6):
            at = tuple(draw.integers(0, n) for n in part.shape)
            kept = part[at]
            part[at] = kept + 2e-3
            up = loss(network, data, halves, labels)
            part[at] = kept - 2e-3
            down = loss(network, data, halves, labels)
            part[at] = kept
            assert abs((up - down) / 4e-3 - gradient[at]) < 2e-3 + 0.05 * abs(gradient[at])


def test_texts_are_judged_alone_and_whole():
    network = quality.Network.new(5, 0.0)
    texts = ["", "a", "b" * 127, "c" * 128, "d e f " * 50_000, "g" * 300]
    tables = network.tables()
    together = network.score(texts, tables)
    assert np.allclose(together, [network.score([t], tables)[0] for t in texts], atol=1e-6)
    # The end of a long text counts as much as its start.
    first, last = "XYZ@@@" * 60 + "d e f " * 40_000, "d e f " * 40_000 + "XYZ@@@" * 60
    plain = network.score(["d e f " * 40_060], tables)[0]
    assert all(abs(s - plain) > 1e-6 for s in network.score([first, last], tables))


def test_query_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = op5_byte_network(spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p for p, y in held if y]) > 0.98 and np.mean([p for p, y in held if not y]) < 0.1


def test_odd_rows(rows):
    docs = rows("doc_id long, text string, score string", (1, None, "x"), (None, "", "x"), (2, "word " * 100_000, "x"), (2, "a", "x"))
    network = quality.fit(docs, rows("doc_id long, quality int", (9, 1), (None, 1), (1, None)), F.lit(True))
    scored = quality.scored(docs, network)
    got = scored.collect()
    assert scored.columns == docs.columns and len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert quality.scored(docs.limit(0), network).count() == 0
