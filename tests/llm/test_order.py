"""The permutation is one; every id is read back from the shards; reading can start at any slot."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

from ledgerline.llm import order
from ledgerline.llm.queries import QUERIES, op10_training_order
from ledgerline.llm.shared import new_folder


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000, 4097])
def test_permutation(size):
    one = order.Permutation(size, 5)
    slots = one(np.arange(size))
    assert sorted(slots.tolist()) == list(range(size))
    assert one(slots, back=True).tolist() == list(range(size))
    if size > 100:
        assert (slots != order.Permutation(size, 6)(np.arange(size))).mean() > 0.9
        assert abs(np.corrcoef(np.arange(size), slots)[0, 1]) < 0.2


def read(folder: str, slot: int, per_shard: int, stride: int) -> bytes:
    with open(f"{folder.removeprefix('file://')}/shard-{slot // per_shard:08d}.bin", "rb") as file:
        file.seek(slot % per_shard * stride)
        return file.read(stride)


def test_round_trip_with_wide_ids(spark):
    documents = [np.arange(i, i + n, dtype="<u4").tobytes() for i, n in enumerate([0, 5, 1, 40, 8, 8, 3, 200, 16])]
    df = spark.createDataFrame([(d, 1) for d in documents] + [(None, 2), (documents[1], 3)], "ids binary, slot int").repartition(3).cache()
    folder = new_folder(spark, "order")
    rows = order.materialise(df, folder, length=8, width=4, per_shard=5, key=3).collect()
    n = len(rows)
    assert sorted(r.slot for r in rows) == list(range(n)) == sorted(r.sequence for r in rows)
    assert len(list(Path(folder.removeprefix("file://")).glob("shard-*.bin"))) == -(-n // 5)
    whole = b""
    for r in sorted(rows, key=lambda r: r.sequence):
        data = read(folder, r.slot, 5, 32)
        assert r.position == r.slot % 5 * 32 and len(data) == 32 and set(data[4 * r.n_ids :]) <= {255}
        assert zlib.crc32(data[: 4 * r.n_ids]) == r.ids_crc32
        whole += data[: 4 * r.n_ids]
    assert sorted(np.frombuffer(whole, "<u4")) == sorted(np.frombuffer(b"".join(documents + [documents[1]]), "<u4"))
    assert order.materialise(df.limit(0), folder).count() == 0


def test_shards_are_there_after_the_call_and_written_once(spark):
    df = spark.createDataFrame([(bytes(range(200)),)], "ids binary").cache()
    folder = new_folder(spark, "order")
    manifest = order.materialise(df, folder, length=8, per_shard=5)
    shards = sorted(Path(folder.removeprefix("file://")).glob("*"))
    assert [s.name for s in shards] == [f"shard-{i:08d}.bin" for i in range(5)]
    times = [s.stat().st_mtime_ns for s in shards]
    assert manifest.limit(1).count() == 1 and manifest.count() == 25
    assert times == [s.stat().st_mtime_ns for s in shards]


def test_a_repeated_task_replaces_its_shard(tmp_path):
    filesystem, base = order.filesystem_of(str(tmp_path))
    for content in (b"first", b"second"):
        (tmp_path / "made").write_bytes(content)
        order.into_place(filesystem, f"{base}/made", f"{base}/shard")
        assert (tmp_path / "shard").read_bytes() == content and not (tmp_path / "made").exists()


def test_registered_query_writes_token_ids(spark):
    from tokenizers import Tokenizer

    sf_dir = "/root/testdata/sf0.001"
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = sorted(e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False))
    rows = QUERIES["op10_training_order"](spark, sf_dir).collect()
    by_slot = {r.slot: r for r in rows}
    read_back = dict(order.read_slots(rows[0].folder, len(rows), width=2))
    assert list(read_back) == list(range(len(rows)))
    whole = b"".join(read_back[r.slot][: 2 * r.n_ids] for r in sorted(rows, key=lambda r: r.sequence))
    ids = np.frombuffer(whole, "<u2")
    ends = np.flatnonzero(ids == 0xFFFF)
    assert ends[-1] == len(ids) - 1
    assert sorted(d[:-1].tolist() for d in np.split(ids, ends + 1)[:-1]) == wanted
    assert all(zlib.crc32(read_back[s][: 2 * r.n_ids]) == r.ids_crc32 for s, r in by_slot.items())


def test_reading_resumes_at_any_slot(spark):
    df = spark.createDataFrame([(np.arange(i, i + 30, dtype="<u2").tobytes(),) for i in range(9)], "ids binary").repartition(2).cache()
    folder = new_folder(spark, "order")
    total = order.materialise(df, folder, length=8, width=2, per_shard=5).count()
    whole = list(order.read_slots(folder, total, length=8, width=2, per_shard=5))
    assert [slot for slot, _ in whole] == list(range(total)) and total > 10
    for start in (0, 4, 5, 7, total - 1, total):
        assert list(order.read_slots(folder, total, start, length=8, width=2, per_shard=5)) == whole[start:]
    with pytest.raises(Exception):
        list(order.read_slots(folder, total + 1, length=8, width=2, per_shard=5))
