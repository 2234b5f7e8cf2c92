"""The trie against SQL on the given tables and against a plain trie on awkward ones."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from compare import difference, duckdb_on
from ledgerline.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_registered_query_matches_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    assert difference(queries.op11_prefix_trie(spark, folder), duckdb_on(folder), queries.OP11_SQL) is None


def plain(paths: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    """Every node from the set of all prefixes."""
    members = defaultdict(list)
    for conv, path in sorted(paths.items()):
        for depth in range(len(path) + 1):
            members[tuple(path[:depth])].append(conv)
    out = []
    for path, convs in members.items():
        inside = [other for other in members if other[: len(path)] == path]
        children = [other for other in inside if len(other) == len(path) + 1]
        leaves = [a for a in inside if not any(len(b) == len(a) + 1 and b[: len(a)] == a for b in inside)]
        ends = ",".join(str(c) for c in convs if len(paths[c]) == len(path))
        out.append((
            convs[0], len(path), members[path[:-1]][0] if path else None, len(convs), len(children), len(leaves),
            sum((len(members[other]) - 1) * len(other[-1][1].encode()) for other in inside if other),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.select(*trie.NODES.names).collect()), key=repr)


@pytest.mark.parametrize("shard", [1, 7, 4096])
def test_shards_do_not_show(spark, shard):
    paths = {
        c - 30: [("user" if d % 2 else "bot", f"é{(c * 7 + d * c) % (2 + d % 3)}") for d in range(c * c % 6)] for c in range(60)
    }
    paths[100] = paths[101] = [("user", "x")] * 300  # long, equal, and the same turn over and over
    rows = [(c, d, *turn) for c, path in paths.items() for d, turn in enumerate(path)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(trie.prefix_trie(df, shard_conversations=shard)) == plain({c: path for c, path in paths.items() if path})


def test_nulls_ties_repeated_rows_and_further_columns(rows):
    df = rows(
        SCHEMA + ", block long, node string",
        (1, 5, "user", "b", 0, "x"), (1, None, None, "a", 0, "x"), (1, 5, "user", "b", 0, "y"), (1, 5, "bot", None, 0, "x"),
        (None, 1, "user", "lost", 0, "x"), (2, 0, "", "a", 0, "x"), (3, 0, "", "", 0, "x"),
    )
    want = {1: [("", "a"), ("bot", ""), ("user", "b"), ("user", "b")], 2: [("", "a")], 3: [("", "")]}
    assert found(trie.prefix_trie(df)) == plain(want)


def test_empty_table(rows):
    assert found(trie.prefix_trie(rows(SCHEMA))) == []


def test_rebuilt_conversations(spark, tmp_path):
    """Short openings, an absent first conversation, conversations that end up without a turn, negative ids."""
    turns = {5: 2, 6: 1, 7: 12, 8: 3, 11: 12, 12: 1, 13: 2, 14: 20, 25: 9, 26: 9, -3: 4, -5: 9, 0: 9}
    rows = [(c, d, "user", f"{c // 5}-{d}-{c % 2}") for c, n in turns.items() for d in range(n)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    import duckdb

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    result = queries.op11_prefix_trie(spark, str(tmp_path))
    assert difference(result, duck, queries.OP11_SQL) is None
    assert result.filter(F.col("depth") == 0).select("n_convs").collect()[0][0] == len(turns)
