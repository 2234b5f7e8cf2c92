"""Marts that are brought up to date equal marts made anew, and leave untouched buckets alone."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import gold, marts, pipeline
from ledgerline.plans.gold import RISK, SEGMENTS, SPEND
from ledgerline.plans.layout import Lakehouse
from ledgerline.sources.tables import Table, bucket_of
from test_loading import Died, writes_that_die
from test_pipeline import AS_OF, World, card, customer, transaction

NAMES = (SPEND, RISK, SEGMENTS)


def build(world, as_of=AS_OF):
    pipeline.silver_to_gold(world.lake, F.lit(as_of))


def state(df):
    return sorted(str(sorted(row.asDict().items())) for row in df.collect())


def stored(world):
    return [state(world.lake.gold(name).read()) for name in NAMES]


def anew(world, as_of=AS_OF):
    """The marts from whole Silver tables, by the plain functions."""
    lake = world.lake
    customers, cards = lake.silver("customers").read().drop("bucket"), lake.silver("cards").read()
    spend = marts.spend_summary(lake.silver("transactions").read(), lake.silver("merchants").read())
    return [state(df) for df in (
        spend, marts.risk_summary(customers, cards, spend),
        marts.segmentation_summary(customers, cards, spend, F.lit(as_of)),
    )]


def bucket(spark, key):
    return spark.range(1).select(bucket_of(F.lit(key), 4)).first()[0]


def files(world, layer, name):
    """Data files of each bucket."""
    found = {}
    for path in Path(world.warehouse, layer, name).rglob("*.parquet"):
        found.setdefault(int(path.parent.name.split("=")[1]), set()).add(path.name)
    return found


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Customers C0 to C11 over all four buckets, each with a card and a transaction in two months; marts built."""
    world = World(spark, tmp_path_factory.mktemp("built"))
    numbers = range(12)
    world.land("customers", *[customer(f"C{i}", "2024-01-01 00:00:00") for i in numbers])
    world.land("cards", *[card(f"K{i}", f"C{i}", "2024-01-02 00:00:00", credit_limit=100.0 * i) for i in numbers])
    world.land("transactions", *[
        transaction(f"T{i}-{month}", f"2024-0{month}-03 00:00:00", customer_id=f"C{i}", card_id=f"K{i}", amount=1.5 * i + 1,
                    merchant_id="M2" if i == 3 else "M1")
        for i in numbers for month in (1, 2)
    ])
    world.run_silver()
    build(world)
    return world


@pytest.fixture
def world(built, tmp_path):
    return built.copy(tmp_path)


def second_batch(world):
    """Changes of C1 only: a failed payment, a late one, a lost card, a new grade."""
    world.land("customers", customer("C1", "2024-03-01 00:00:00", risk_grade="high"))
    world.land("cards", card("K1", "C1", "2024-03-02 00:00:00", card_status="lost", credit_limit=9.0))
    world.land("transactions",
               transaction("T1-2", "2024-03-03 00:00:00", customer_id="C1", card_id="K1", amount=2.5, status="failed"),
               transaction("T1-3", "2024-03-04 00:00:00", customer_id="C1", card_id="K1", amount=70.0))
    world.run_silver()


def test_first_build(built):
    assert stored(built) == anew(built)
    assert set(files(built, "gold", SPEND)) == {0, 1, 2, 3}


def test_an_update_opens_and_rewrites_the_buckets_of_the_changed_customer(spark, world):
    mine, seen = bucket(spark, "C1"), {}
    for layer, name in [("gold", name) for name in NAMES] + [("by_customer", "transactions"), ("by_customer", "cards")]:
        seen[layer, name] = files(world, layer, name)
    second_batch(world)
    expected = anew(world)
    # whoever opens another bucket of these tables fails
    for layer, name in (("by_customer", "transactions"), ("by_customer", "cards"), ("silver", "customers")):
        for other, names in files(world, layer, name).items():
            for file in names if other != mine else ():
                Path(world.warehouse, layer, name, f"bucket={other}", file).write_bytes(b"not to be opened")
    build(world)
    assert stored(world) == expected
    for (layer, name), before in seen.items():
        after = files(world, layer, name)
        assert {n for n in after if after[n] != before[n]} == {mine}, name


def test_nothing_new_rewrites_nothing(world):
    before = [files(world, "gold", name) for name in NAMES]
    build(world)
    assert before == [files(world, "gold", name) for name in NAMES]


def test_customers_may_lose_their_last_row(spark, world):
    """Every payment of a bucket fails: its part of the spend mart becomes empty."""
    mine = bucket(spark, "C1")
    members = [i for i in range(12) if bucket(spark, f"C{i}") == mine]
    world.land("transactions", *[
        transaction(f"T{i}-{month}", "2024-04-01 00:00:00", customer_id=f"C{i}", card_id=f"K{i}", status="failed")
        for i in members for month in (1, 2)
    ])
    world.run_silver()
    build(world)
    assert stored(world) == anew(world)
    left = {row[0] for row in world.lake.gold(SPEND).read().select("customer_id").collect()}
    assert left == {f"C{i}" for i in range(12) if i not in members}


def test_merchants_that_change_their_category(spark, world):
    before, theirs = files(world, "gold", SPEND), bucket(spark, "C3")
    (world.landing / "merchants" / "merchants.csv").write_text(
        "merchant_id,merchant_name,merchant_category,country,mcc_code,merchant_city\n"
        "M1, big shop ,groceries,india,0742,pune\nM2,air co,travel,india,3000,delhi\n"
    )
    world.run_silver()
    build(world)
    assert stored(world) == anew(world)
    after = files(world, "gold", SPEND)
    assert {n for n in after if after[n] != before[n]} == {theirs}


def test_another_date_changes_every_tenure(world):
    later = AS_OF.replace(year=2025)
    build(world, later)
    assert stored(world) == anew(world, later)


def test_a_build_that_dies_after_any_write_is_made_good_by_the_next(world, tmp_path, monkeypatch):
    second_batch(world)
    expected = anew(world)
    for at in (0, 3, 4, 6, 9):
        twin = world.copy(tmp_path / f"at {at}")
        with monkeypatch.context() as patch:
            writes_that_die(patch, at)
            with pytest.raises(Died):
                build(twin)
        build(twin)
        assert stored(twin) == expected, at


def test_marts_of_an_older_layout_are_made_anew(spark, world):
    """A lakehouse whose marts were stored whole, without copies by customer."""
    lake = world.lake
    lake.start()
    whole = lake.gold(SPEND).read().collect()
    schema = lake.gold(SPEND).schema
    Table(spark, lake.gold(SPEND).root).replace(spark.createDataFrame(whole, schema))
    for row in ("transactions", "cards", *[f"{m}:{s}" for m in NAMES for s in ("customers", "cards", "transactions")]):
        lake.progress.save("marts", row, batch=0, table_schema=None)
    build(world)
    assert stored(world) == anew(world)
    assert Lakehouse(spark, world.warehouse, 4).gold(SPEND).read().columns == schema.names


@pytest.mark.parametrize("everywhere", [False, True])
def test_a_large_batch_that_touches_every_bucket_makes_the_copy_anew(spark, world, monkeypatch, everywhere):
    """Also after a run that died while writing it. A batch in some buckets still goes through the staging folder."""
    monkeypatch.setattr(pipeline, "SMALL_BYTES", -1)
    if everywhere:
        world.land("transactions", *[
            transaction(f"T{i}-{month}", f"2024-0{month}-20 00:00:00", customer_id=f"C{i}", card_id=f"K{i}", status="failed")
            for i in range(12) for month in (1, 3)
        ])
        world.run_silver()
    else:
        second_batch(world)
    expected = anew(world)
    with monkeypatch.context() as patch:
        writes_that_die(patch, 1)
        with pytest.raises(Died):
            build(world)
    build(world)
    assert stored(world) == expected
    assert world.lake.staging("by_customer_transactions").exists() != everywhere
    copy = gold.by_customer(world.lake, gold.TRANSACTIONS).read().select(*gold.TRANSACTIONS.columns)
    assert state(copy) == state(world.lake.silver("transactions").read().select(*gold.TRANSACTIONS.columns))
