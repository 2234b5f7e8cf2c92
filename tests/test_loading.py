"""Every landed record is in Silver, superseded by a newer row of its key, or in a quarantine, once, whatever is wrong with it."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.plans import ingestion
from ledgerline.plans.ingestion import BATCH, ENDPOINTS, ingest_batch, ingest_endpoint, ingest_merchants, ingest_to_bronze
from ledgerline.plans.pipeline import batches, bronze_to_silver, last_mark
from ledgerline.sources.landing import read_csv, read_pages
from ledgerline.sources.tables import SchemaChange, Table
from ledgerline.streaming.ingest import ingest_available, ingest_landing
from test_pipeline import World, card, customer, transaction


def ingest(world, streamed):
    lake = world.lake
    if streamed:
        ingest_landing(lake, str(world.landing))
        ingest_merchants(lake, f"{world.landing}/merchants")
    else:
        ingest_to_bronze(lake, str(world.landing))
    bronze_to_silver(lake)


def quarantined(world, name):
    return sorted(
        (r["transaction_id"], r["failed_reasons"][0]) for r in world.lake.quarantine(name).read().collect()
    )


@pytest.mark.parametrize("streamed", [False, True])
def test_nothing_is_lost(spark, tmp_path, streamed):
    world = World(spark, tmp_path)
    world.land("customers", customer("C1", "2024-01-01 00:00:00"))
    world.land("cards", card("K1", "C1", "2024-01-01 00:00:00"), card("K2", "C1", "2024-01-01 00:00:00", credit_limit="12.5"),
               card("K3", "C1", "2024-01-01 00:00:00", credit_limit="a lot"))
    world.land("transactions", transaction("T1", "2024-03-01 00:00:00"), transaction("T2", None),
               transaction("T3", "yesterday"), transaction("T4", "2099-01-01 00:00:00"))
    folder = world.landing / "transactions"
    (folder / "cut.json").write_text('{"data": [{"transaction_id": "T5", "amount": 1.0}, {"transac')
    (folder / "short.json").write_text(json.dumps({"data": [transaction("T6", "2024-03-01 00:00:00")], "count": 500}))
    (folder / "bare.json").write_text(json.dumps({"count": 3}))
    ingest(world, streamed)

    cards = world.silver("cards")
    assert set(cards) == {"K1", "K2"} and cards["K2"]["credit_limit"] == 12.5
    assert [(r["card_id"], r["credit_limit"], r["failed_reasons"]) for r in world.lake.quarantine("landed_cards").read().collect()] == [
        ("K3", None, ["unreadable credit_limit"])]
    assert set(world.silver("transactions")) == {"T1", "T2"}
    landed = [("T3", "unreadable transaction_timestamp"), ("T4", "updated_at after the start of the run")]
    assert quarantined(world, "landed_transactions") == landed
    pages = {r["page"].split("/")[-1]: (r["page_fault"], r["_corrupt_record"]) for r in world.lake.quarantine("pages_transactions").read().collect()}
    assert {name: fault for name, (fault, _) in pages.items()} == {
        "cut.json": "page unreadable", "short.json": "page holds another number of records than it declares",
        "bare.json": "page without data"}
    assert "T5" in pages["cut.json"][1]
    assert last_mark(world.lake, "bronze_to_silver", "silver_transactions") == datetime(2024, 3, 1)
    assert last_mark(world.lake, "ingest_to_bronze", "bronze_transactions") == datetime(2024, 3, 1)

    # Rows that arrive late are taken, and do not undo what is newer; a repeated run adds nothing.
    world.land("transactions", transaction("T7", "2024-02-01 00:00:00"), transaction("T1", "2024-02-01 00:00:00", status="failed"),
               transaction("T8", None), transaction("T2", "2024-02-02 00:00:00", status="failed"))
    for _ in range(2):
        ingest(world, streamed)
    silver = world.silver("transactions")
    assert set(silver) == {"T1", "T2", "T7", "T8"}
    assert silver["T1"]["transaction_status"] == "Successful" and silver["T2"]["transaction_status"] == "Failed"
    assert quarantined(world, "landed_transactions") == landed
    assert world.lake.quarantine("pages_transactions").read().count() == 3
    assert batches(world.lake, "transactions") == (2, 2)


def test_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("mcc_code, merchant_name,merchant_id,owner,country,merchant_category,merchant_city\n0742,shop,M1,x,india,misc,pune\n")
    row = read_csv(spark, str(tmp_path), schemas.MERCHANT_RECORD).first()
    assert (row["merchant_id"], row["merchant_name"], row["mcc_code"]) == ("M1", "shop", "0742")
    (tmp_path / "b.csv").write_text("merchant_name,mcc_code,merchant_id,owner,country,merchant_category,merchant_city\nshop,1,M2,x,india,misc,pune\n")
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path), schemas.MERCHANT_RECORD).collect()
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "c.csv").write_text("merchant_id,merchant_name\nM1,shop\n")
    with pytest.raises(ValueError, match="merchant_category"):
        read_csv(spark, str(tmp_path / "c"), schemas.MERCHANT_RECORD)


def test_a_report_read_later_is_still_the_run_s_own(spark, tmp_path):
    world = World(spark, tmp_path)
    world.land("customers", customer("C1", "2024-01-01 00:00:00"), customer("C2", "2024-01-01 00:00:00"))
    lake = world.lake
    ingest_to_bronze(lake, str(world.landing))
    first = bronze_to_silver(lake)["merchants"]
    world.land("customers", customer("C3", "2024-02-01 00:00:00"))
    ingest(world, False)
    assert first.first()["rows_loaded"] == 4


# -- exactly once, whatever dies ---------------------------------------------------------------------------------------

class Died(Exception):
    pass


def writes_that_die(monkeypatch, at):
    """Die after the at-th write of a stored table (or of progress), or before the first one where ``at`` is 0."""
    seen = []
    for name in ("replace", "replace_parts", "put"):
        real = getattr(Table, name)

        def write(self, *args, _real=real, **options):
            seen.append(self.root)
            if at == 0:
                raise Died
            _real(self, *args, **options)
            if len(seen) == at:
                raise Died

        monkeypatch.setattr(Table, name, write)


def bronze_ids(world, endpoint="customers", key="customer_id"):
    return sorted(r[0] for r in world.lake.bronze(endpoint).read().select(key).collect())


@pytest.mark.parametrize("streamed", [False, True])
def test_ingestion_that_dies_after_any_write_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, streamed):
    """Three loads of one page each, the second of which dies; once after every write it makes."""
    endpoint = ENDPOINTS[0]
    seed = World(spark, tmp_path / "seed")
    seed.land("customers", customer("C1", "2024-01-01 00:00:00"))

    def load(world):
        folder = f"{world.landing}/customers"
        if streamed:
            ingest_available(world.lake, endpoint, folder).awaitTermination()
        else:
            ingest_endpoint(world.lake, endpoint, folder)

    load(seed)
    at, died = 0, True
    while died:
        if streamed:  # a stream's checkpoint names its folder
            world = World(spark, tmp_path / f"at {at}")
            world.land("customers", customer("C1", "2024-01-01 00:00:00"))
            load(world)
        else:
            world = seed.copy(tmp_path / f"at {at}")
        world.land("customers", customer("C2", "2024-01-02 00:00:00"))
        (world.landing / "customers" / "cut[1] +a.json").write_text('{"data": [')
        with monkeypatch.context() as patch:
            writes_that_die(patch, at)
            try:
                load(world)
                died = False
            except (Died, StreamingQueryException):
                pass
        world.land("customers", customer("C3", "2024-01-03 00:00:00"))
        load(world)
        assert bronze_ids(world) == ["C1", "C2", "C3"], at
        assert world.lake.quarantine("pages_customers").read().count() == 1, at
        assert last_mark(world.lake, "ingest_to_bronze", "bronze_customers") == datetime(2024, 1, 3), at
        at += 1
    assert at == 6  # dies at first, after intent, quarantine, records and progress, then not at all


def test_all_ways_in_share_one_numbering(spark, tmp_path):
    world = World(spark, tmp_path)
    lake, endpoint, folder = world.lake, ENDPOINTS[0], f"{world.landing}/customers"
    page = [T.StructField("customer_id", T.StringType()), T.StructField("updated_at", T.TimestampType())]
    direct = spark.createDataFrame([("C1", datetime(2024, 1, 1))], T.StructType(page))
    assert ingest_batch(lake, "customers", direct) == 1
    world.land("customers", customer("C2", "2024-01-02 00:00:00"))
    assert ingest_endpoint(lake, endpoint, folder) == 1
    world.land("customers", customer("C3", "2024-01-03 00:00:00"))
    ingest_available(lake, endpoint, folder).awaitTermination()
    ingest_batch(lake, "customers", direct.replace("C1", "C4"))
    assert bronze_ids(world) == ["C1", "C2", "C3", "C4"]
    assert {(r[0], r[1]) for r in lake.bronze("customers").read().select("customer_id", BATCH).collect()} == {
        ("C1", 1), ("C2", 2), ("C3", 3), ("C4", 4)}


def test_many_pages_come_in_several_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingestion, "PAGES_PER_BATCH", 2)
    world = World(spark, tmp_path)
    for i in range(5):
        world.land("customers", customer(f"C{i}", "2024-01-01 00:00:00"))
    assert ingest_endpoint(world.lake, ENDPOINTS[0], f"{world.landing}/customers") == 3
    assert bronze_ids(world) == [f"C{i}" for i in range(5)]


def test_a_column_added_between_runs(spark, tmp_path):
    """Old and new batches are read together, an older one again after a crash; a narrower type is refused by name."""
    world = World(spark, tmp_path)
    lake = world.lake
    old = spark.createDataFrame([("K1", 1, datetime(2024, 1, 1))], "card_id string, points int, updated_at timestamp")
    new = spark.createDataFrame(
        [("K2", 2**40, datetime(2024, 1, 2), "gold")], "card_id string, points bigint, updated_at timestamp, tier string")
    ingest_batch(lake, "cards", old)
    ingest_batch(lake, "cards", new)
    ingest_batch(lake, "cards", old.drop("points").replace("K1", "K3").withColumn("points", F.lit(7).cast("bigint")))
    rows = {r["card_id"]: (r["points"], r["tier"]) for r in world.lake.bronze("cards").read().collect()}
    assert rows == {"K1": (1, None), "K2": (2**40, "gold"), "K3": (7, None)}
    with pytest.raises(SchemaChange, match="bronze_cards.points is bigint, the batch has int"):
        ingest_batch(lake, "cards", old)
    assert batches(world.lake, "cards") == (3, 0)


def test_csv_records_that_do_not_fit_their_header(spark, tmp_path):
    world = World(spark, tmp_path)
    (world.landing / "merchants" / "more.csv").write_text(
        "merchant_id,merchant_name,merchant_category,country,mcc_code,merchant_city\n"
        "M4,shop,two,food,IN,1,Pune\nM5,short\n"
        'M6,"two\nlines, one name",misc,india,7,pune\n"",blank,misc,india,1,delhi\n   ,blank,misc,india,1,delhi\n'
    )
    ingest_merchants(world.lake, f"{world.landing}/merchants")
    bronze_to_silver(world.lake)
    silver = world.silver("merchants")
    assert set(silver) == {"M1", "M2", "M6"} and silver["M6"]["merchant_name"] == "Two\nlines, One Name"
    faulty = {(r["page"], r["_corrupt_record"].strip()) for r in world.lake.quarantine("rows_merchants").read().collect()}
    assert faulty == {("more.csv", "M4,shop,two,food,IN,1,Pune"), ("more.csv", "M5,short")}
    bad = [r["failed_reason"] for r in world.lake.quarantine("merchants").read().collect()]
    assert sorted(bad) == ["merchant_id_missing", "merchant_id_missing", "merchant_name_missing"]


def test_blank_keys_are_no_keys(spark, tmp_path):
    world = World(spark, tmp_path)
    world.land("customers", *[customer(key, "2024-01-01 00:00:00") for key in ("", " ", "  ", None, "C1")])
    ingest(world, False)
    assert set(world.silver("customers")) == {"C1"}
    assert world.lake.quarantine("customers").read().where("customer_id IS NULL").count() == 4


def test_numbers_in_pages_keep_their_text_and_are_not_fetched_one_by_one(spark, tmp_path):
    """A page's bytes are read about once, however many numbers it holds."""
    record = T.StructType([T.StructField("a", T.StringType())])
    (tmp_path / "pages").mkdir()
    spellings = ["1.10", "1e5", "-0.0", "12345678901234567890.123456789", '{"b":  [1.0, 2]}', "007"]
    numbers = ",\n".join(f'{{"a": {i}.50}}' for i in range(3000))
    (tmp_path / "pages" / "many.json").write_text(f'{{"data": [{numbers}],\r\n "count": 3000}}')
    odd = ", ".join(f'{{"a": {text}}}' for text in spellings[:-1])
    (tmp_path / "pages" / "odd.json").write_text(f'{{"data": [{odd}], "count": {len(spellings) - 1}}}')
    (tmp_path / "pages" / "bad.json").write_text('{"data": [{"a": 007}],\n\n "count": 1}')
    (tmp_path / "pages" / "empty.json").write_text("")
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    before = statistics.getLong("bytesRead")
    pages = {r["page"]: r for r in read_pages(spark, str(tmp_path / "pages"), record).collect()}
    read = statistics.getLong("bytesRead") - before
    assert set(pages) == {"many.json", "odd.json", "bad.json"}
    assert [row["a"] for row in pages["odd.json"]["data"]] == spellings[:-1]
    assert [row["a"] for row in pages["many.json"]["data"]] == [f"{i}.50" for i in range(3000)]
    assert pages["bad.json"]["page_fault"] == "page unreadable"
    assert pages["bad.json"]["_corrupt_record"] == '{"data": [{"a": 007}],\n\n "count": 1}'
    assert 0 < read < 10 * sum(file.stat().st_size for file in (tmp_path / "pages").iterdir())
