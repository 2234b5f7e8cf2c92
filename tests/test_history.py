"""Histories made from all changes do not depend on the order in which these arrive."""

from __future__ import annotations

from datetime import datetime, timedelta
from itertools import permutations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.history import History, apply_changes, first_load, versions_of

SPEC = History("k", "t", ("status", "city"), ("name",))
SCHEMA = "k string, t timestamp, status string, city string, name string, joined int"
START = datetime(2024, 1, 1)


def row(key, day, status="a", city="x", name="n", joined=1):
    return (key, None if day is None else START + timedelta(days=day), status, city, name, joined)


def plain(changes):
    """The fold over each key's rows in order of time."""
    out = []
    for key in {c[0] for c in changes}:
        own, seen = [], set()
        for change in sorted((c for c in changes if c[0] == key), key=lambda c: (c[1] is not None, c[1] or START, repr_nulls_last(c))):
            if change[1] not in seen:
                own.append(change)
                seen.add(change[1])
        versions = []
        for change in own:
            if versions and versions[-1][2:4] == list(change[2:4]):
                versions[-1][4] = change[4]
            else:
                versions.append(list(change))
        for i, version in enumerate(versions):
            last = i + 1 == len(versions)
            out.append((*version, version[1], None if last else versions[i + 1][1], last))
    return sorted(out, key=repr)


def repr_nulls_last(change):
    return tuple((value is None, value if value is not None else "") for value in change[2:])


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_late_changes_and_corrections(rows):
    changes = [
        row("A", 1), row("A", 5, status="b"), row("A", 3, city="y"),               # a late change splits a version
        row("B", 1), row("B", 5, name="new"), row("B", 3, name="old"),             # a late correction does not win
        row("C", 2), row("C", 4), row("C", 3, status="b"),                         # back to the old state: three versions
        row("D", None), row("D", 1, status="b"), row("E", 1), row("E", 1, name="other"), row("F", 1, None, None), row("F", 2, None, None, "z"),
    ]
    result = found(versions_of(rows(SCHEMA, *changes), SPEC))
    assert result == plain(changes)
    assert [(r[2], r[6], r[7] is None, r[8]) for r in result if r[0] == "C"] == [
        ("a", START + timedelta(days=2), False, False), ("b", START + timedelta(days=3), False, False),
        ("a", START + timedelta(days=4), True, True)]
    assert [r[4] for r in result if r[0] == "B"] == ["new"]


CHANGE = st.builds(
    row, st.sampled_from("AB"), st.one_of(st.none(), st.integers(0, 5)), st.sampled_from(["a", "b", None]), st.sampled_from("xy"),
    st.sampled_from(["n", "m", None]), st.integers(0, 2),
)


@settings(max_examples=8, deadline=None)
@given(st.lists(CHANGE, min_size=1, max_size=12))
def test_any_order_gives_the_fold(spark, changes):
    want = plain(changes)
    for arrived in (changes, changes[::-1]):
        df = spark.createDataFrame([(*c, i) for i, c in enumerate(arrived)], SCHEMA + ", nr int").drop("nr")
        assert found(versions_of(df.repartition(3), SPEC)) == want


def test_in_order_it_is_what_applying_each_batch_gives(rows):
    batches = [[row("A", 1), row("B", 1)], [row("A", 2, status="b"), row("B", 2, name="m"), row("C", 2)], [row("A", 3, status="b", name="m"), row("C", 3, city="y")]]
    step = first_load(rows(SCHEMA, *batches[0]), SPEC)
    for batch in batches[1:]:
        step = apply_changes(step, rows(SCHEMA, *batch), SPEC)
    want = found(step)
    for order in permutations(batches):
        together = [change for batch in order for change in batch]
        assert found(versions_of(rows(SCHEMA, *together), SPEC)) == want


def test_one_shuffle(spark):
    df = spark.range(100).select(
        F.col("id").cast("string").alias("k"), F.current_timestamp().alias("t"), F.lit("a").alias("status"), F.lit("x").alias("city"),
        F.lit("n").alias("name"),
    )
    plan = versions_of(df, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
