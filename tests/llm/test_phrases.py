"""Exact phrases against SQL and brute force, proximity against brute force."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import difference, duckdb_on
from ledgerline.llm import phrases, queries, shared

SCHEMA = "doc_id long, text string"
ITEMS = "item_id long, text string"


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_registered_query_matches_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    result = queries.op12_positional_index(spark, folder)
    assert difference(result, duckdb_on(folder), queries.OP12_SQL) is None
    assert result.filter("contaminated").count() > 0


def test_awkward_tables_match_sql(spark, tmp_path):
    """Short items, repeated ids and rows, phrases at both ends, over document borders, letters beyond ASCII, one long text."""
    words = [f"w{i}" for i in range(40)]
    phrase = " ".join(words[:12])
    docs = [
        (1, phrase), (1, "other " + phrase.upper()), (2, "; ".join(words[:10])), (3, " ".join(words[:9])), (4, None), (5, ""),
        (6, "the " * 3000 + "Été naïve STRASSE " + "the " * 9), (7, "été naïve strasse"), (8, " ".join(words[1:12]) + " w0 " + phrase),
        (9, " ".join(words[:5])), (10, " ".join(words[5:12])), (None, phrase), (11, "...!?"), (12, "Été é"),
        (13, "the " * 200), (14, "a b a b"), (15, "x_y x-y"), (16, "퟿ \U0001f600 w0"),
    ]
    items = [
        (1, phrase), (1, "Été naïve strasse"), (2, "the the the the the the the the the the the"), (3, None), (4, "!"),
        (10, phrase), (10, phrase), (None, "x y"), (5, "a b"), (6, "\U0001f600"), (7, "W39"),
    ]
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert difference(queries.op12_positional_index(spark, str(tmp_path)), duck, queries.OP12_SQL) is None


def brute(docs, items, length, reach):
    out = []
    for key, text in docs:
        words = phrases.words_of(text)
        covered, names = set(), set()
        for name, item in items:
            asked = phrases.words_of(item)
            for at in range(max(1, len(asked) - length + 1) if asked else 0):
                window = asked[at : at + length]
                if reach is None:
                    for i in range(len(words) - len(window) + 1):
                        if words[i : i + len(window)] == window:
                            covered |= set(range(i, i + len(window)))
                            names.add(str(name))
                elif set(window) <= set(words):
                    rarest = min(window, key=words.count)
                    assert sum(words.count(w) == words.count(rarest) for w in set(window)) == 1  # no tie in this fixture
                    for i, word in enumerate(words):
                        near = set(words[max(0, i - reach) : i + reach + 1])
                        if word == rarest and set(window) <= near:
                            covered.add(i)
                            names.add(str(name))
        out.append((key, len(words), sorted(covered), sorted(names)))
    return sorted(out, key=repr)


def found(df):
    return sorted((
        (r["doc_id"], r["n_words"], [i for span in r["spans"] for i in range(span["first"], span["last"] + 1)], r["items"])
        for r in df.collect()
    ), key=repr)


@pytest.mark.parametrize(("block", "part"), [(1, 1 << 20), (200, 40), (1 << 20, 1 << 20)])
def test_blocks_and_parts_do_not_show(spark, block, part):
    draw = random.Random(5)
    docs = [(i, " ".join(draw.choices("abcd", k=draw.randrange(60)))) for i in range(60)]
    items = [(i, " ".join(draw.choices("abcd", k=draw.randrange(1, 9)))) for i in range(12)]
    built = phrases.index(spark.createDataFrame(docs, SCHEMA).repartition(3), block_characters=block)
    result = phrases.search(built, spark.createDataFrame(items, ITEMS), length=4, part_bytes=part)
    assert found(result) == brute(docs, items, 4, None)


def test_proximity(spark):
    draw = random.Random(6)
    common = ["c1", "c1", "c1", "c2", "c2"] * 12
    docs = []
    for i in range(40):
        words = draw.sample(common, 50)
        for place in draw.sample(range(50), 2):
            words[place] = "rare"
        docs.append((i, " ".join(words)))
    items = [(1, "c1 rare c2 c2"), (2, "absent rare"), (3, "rare")]
    want = brute(docs, items, 4, 1)
    assert 0 < sum("1" in row[3] for row in want) < len(want)
    for characters in (1, 1 << 20):  # a block's rarest term is that of each document here
        built = phrases.index(spark.createDataFrame(docs, SCHEMA), block_characters=characters)
        assert found(phrases.search(built, spark.createDataFrame(items, ITEMS), length=4, reach=1)) == want


def test_empty_tables(rows):
    empty = phrases.index(rows(SCHEMA))
    assert phrases.search(empty, rows(ITEMS, (1, "a"))).collect() == []
    one = phrases.index(rows(SCHEMA + ", block string, keys int", (1, "a b", "x", 3)))
    assert found(phrases.search(one, rows(ITEMS))) == [(1, 2, [], [])]
    assert found(phrases.search(one, rows(ITEMS + ", part int", (7, "B", 1)))) == [(1, 2, [1], ["7"])]


def test_a_common_word_is_searched_in_groups(spark, monkeypatch):
    monkeypatch.setattr(phrases, "STARTS_AT_ONCE", 10)
    terms = shared.Numbered()
    codes = [terms[w] for w in (b"a", b"b") * 50]
    order = sorted(range(100), key=lambda i: (codes[i], i))
    import numpy as np

    block = phrases.Block([60, 40], b"a b", np.array([50, 50], "<u4").tobytes(), np.array(order, "<u4").tobytes())
    windows = np.array([[0, 1, 0], [1, 0, 1]])
    hits = [(int(w), int(p)) for ws, ps in block.search(windows, [b"a", b"b"]) for w, p in zip(ws, ps)]
    assert sorted(hits) == sorted((w, p) for p in range(98) for w in [p % 2] if p + 2 < 60 or p >= 60)


def test_a_long_text_in_its_own_block(spark):
    text = "lorem " * 200_000 + " ".join(f"q{i}" for i in range(10))
    built = phrases.index(spark.createDataFrame([(1, "x"), (2, text), (3, "y")], SCHEMA).coalesce(1), block_characters=1000)
    assert built.count() == 3
    result = phrases.search(built, spark.createDataFrame([(9, " ".join(f"q{i}" for i in range(1, 12)))], ITEMS))
    assert result.filter(F.size("spans") > 0).count() == 0
    result = phrases.search(built, spark.createDataFrame([(9, " ".join(f"q{i}" for i in range(10)))], ITEMS))
    assert result.filter(F.size("spans") > 0).select("doc_id").collect()[0][0] == 2
