"""Stored tables: partitions, schema changes, buckets."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import types as T

from ledgerline.plans.layout import Lakehouse
from ledgerline.sources.tables import SchemaChange, Table, fitted, merged_schema, touched_buckets, with_bucket


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, str(tmp_path / "a table"))


def state(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def schema(text):
    return T._parse_datatype_string(text)


def test_missing_table(table):
    assert not table.exists()


def test_partitions_are_replaced_whole_and_alone(table, rows):
    table.schema = schema("k string, p int")
    table.replace(rows("k string, p int", ("a", 1), ("b", 2), ("c", None)), "p")
    table.replace_parts(rows("k string, p int", ("d", 2), ("e", 3), ("f", None)), "p")
    assert state(table) == [("a", 1), ("d", 2), ("e", 3), ("f", None)]


def test_one_partition_may_become_empty(table, rows):
    table.schema = schema("k string, p int")
    table.put(rows("k string", ("a",)), "p", 1)
    table.put(rows("k string", ("b",)), "p", 2)
    table.put(rows("k string"), "p", 1)
    assert state(table) == [("b", 2)]


def test_an_empty_table_keeps_its_schema(table, rows):
    table.schema = schema("k string, p int")
    table.replace(rows("k string, p int", ("a", 1)).where("p > 1"), "p")
    assert table.exists() and state(table) == [] and table.read().columns == ["k", "p"]


def test_a_job_that_dies_leaves_the_partitions_as_they_were(table, rows):
    table.schema = schema("a double, p int")
    table.replace(rows("a double, p int", (1.0, 1), (2.0, 2)), "p")
    with pytest.raises(Exception):
        table.replace_parts(rows("a int, p int", (0, 1)).selectExpr("double(1 / a) AS a", "p"), "p")
    assert state(table) == [(1.0, 1), (2.0, 2)]


def test_older_files_are_read_with_added_and_widened_columns(table, rows):
    table.put(rows("a int, f float, d date", (1, 1.5, None)), "p", 1)
    later = schema("a bigint, f double, d date, p int, added string")
    assert merged_schema("t", schema("a int, f float, d date, p int"), later) == later
    table.schema = later
    table.put(fitted(rows("a bigint, f double, added string", (2**40, 0.1, "x")), later).drop("p"), "p", 2)
    assert state(table) == [(1, 1.5, None, 1, None), (2**40, 0.1, None, 2, "x")]


def test_columns_that_a_batch_lacks_stay(rows):
    stored = schema("a int, b string")
    assert merged_schema("t", stored, schema("a int")) == stored
    assert fitted(rows("a int", (1,)), stored).collect() == [(1, None)]


@pytest.mark.parametrize(("old", "new"), [("bigint", "int"), ("double", "float"), ("string", "int"), ("int", "string"), ("double", "bigint")])
def test_narrower_or_other_types_are_refused_by_name(old, new):
    with pytest.raises(SchemaChange, match=rf"cards\.a is {old}, the batch has {new}"):
        merged_schema("cards", schema(f"a {old}"), schema(f"a {new}"))


def test_buckets_follow_from_the_key(rows):
    df = with_bucket(rows("k string", ("a",), ("b",), ("a",), ("c",)), "k", 64)
    found = {r["k"]: r["bucket"] for r in df.collect()}
    assert touched_buckets(df) == sorted(set(found.values())) and all(0 <= b < 64 for b in found.values())


def test_the_number_of_buckets_holds_for_the_life_of_a_lakehouse(spark, tmp_path):
    Lakehouse(spark, str(tmp_path), buckets=4).start()
    Lakehouse(spark, str(tmp_path), buckets=4).start()
    with pytest.raises(ValueError, match="4 buckets"):
        Lakehouse(spark, str(tmp_path), buckets=8).start()


def test_scratch_follows_the_cluster_setting(tmp_path):
    def session(**conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: conf.get("folder", default)))

    alone, cluster = Lakehouse(session(), str(tmp_path)), Lakehouse(session(folder="/shared/place"), str(tmp_path))
    assert alone.scratch("x").startswith(str(tmp_path))
    assert cluster.scratch("x").startswith("/shared/place/")
    assert cluster.scratch("x") != Lakehouse(session(folder="/shared/place"), str(tmp_path)).scratch("x")
