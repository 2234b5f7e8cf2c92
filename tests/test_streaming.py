"""Landed pages as a file stream."""

from __future__ import annotations

from test_pipeline import World, card, customer, transaction

from ledgerline.plans.ingestion import ingest_merchants
from ledgerline.plans.layout import Lakehouse
from ledgerline.plans.pipeline import bronze_to_silver
from ledgerline.streaming.ingest import ingest_landing


def test_only_new_pages_are_read(spark, tmp_path):
    world = World(spark, tmp_path)
    lake = Lakehouse(spark, world.warehouse)
    world.land("customers", customer("C1", "2024-01-01 00:00:00"))
    world.land("cards", card("K1", "C1", "2024-01-01 00:00:00"))
    world.land("transactions", transaction("T1", "2024-01-01 00:00:00"))
    ingest_landing(lake, str(world.landing))
    world.land("transactions", transaction("T2", "2024-01-02 00:00:00"), transaction("T1", "2024-01-03 00:00:00"))
    ingest_landing(lake, str(world.landing))
    ingest_landing(lake, str(world.landing))
    assert lake.bronze("transactions").read().count() == 3
    assert lake.bronze("customers").read().count() == 1
    ingest_merchants(lake, f"{world.landing}/merchants")
    bronze_to_silver(lake)
    silver = {r["transaction_id"]: str(r["updated_at"]) for r in lake.silver("transactions").read().collect()}
    assert silver == {"T1": "2024-01-03 00:00:00", "T2": "2024-01-02 00:00:00"}
