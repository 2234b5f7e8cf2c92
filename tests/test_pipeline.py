"""Landed files -> Bronze -> Silver -> Gold over several runs."""

from __future__ import annotations

import json
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import references
from ledgerline.plans import pipeline
from ledgerline.plans.layout import Lakehouse
from ledgerline.plans.pipeline import last_mark, run_pipeline
from ledgerline.plans.progress import Progress

AS_OF = date(2024, 7, 1)


def customer(key, updated, **changes):
    record = {
        "customer_id": key, "customer_name": f" name {key} ", "customer_status": "active", "income": "10-20L",
        "total_cards_issued": 1, "joining_date": "2020-01-15", "city": "pune", "occupation": "engineer",
        "risk_grade": "low", "updated_at": updated,
    }
    return record | changes


def card(key, holder, updated, **changes):
    record = {
        "card_id": key, "card_name": "hdfc rupay select", "card_brand_type": "x", "card_holder_id": holder,
        "card_holder_type": "consumer", "card_rewards_category": "travel", "card_status": "active",
        "credit_limit": 1000.0, "expiry_date": "2030-01-01", "updated_at": updated,
    }
    return record | changes


def transaction(key, updated, **changes):
    record = {
        "transaction_id": key, "card_id": "K1", "customer_id": "C1", "merchant_id": "M1", "amount": 10.0,
        "currency": "inr", "device_channel": "pos", "status": "successful", "transaction_type": "purchase",
        "transaction_timestamp": updated, "updated_at": updated,
    }
    return record | changes


class World:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.landing, self.warehouse = folder / "landing", str(folder / "warehouse")
        for name in ("merchants", "customers", "cards", "transactions"):
            (self.landing / name).mkdir(parents=True)
        (self.landing / "merchants" / "merchants.csv").write_text(
            "merchant_id,merchant_name,merchant_category,country,mcc_code,merchant_city\n"
            "M1, big shop ,groceries,india,0742,pune\nM1, big shop ,groceries,india,0742,pune\n"
            "M2,air co,airlines,india,3000,delhi\nM3,,misc,india,1,delhi\n"
        )

    def land(self, endpoint, *records):
        page = json.dumps({"data": list(records), "count": len(records)}, indent=1)
        number = len(list((self.landing / endpoint).iterdir()))
        (self.landing / endpoint / f"page_{number}.json").write_text(page)

    def copy(self, folder):
        """The same files and tables elsewhere: no table names a folder."""
        shutil.copytree(self.folder, folder, dirs_exist_ok=True)
        twin = World.__new__(World)
        twin.spark, twin.folder = self.spark, folder
        twin.landing, twin.warehouse = folder / "landing", str(folder / "warehouse")
        return twin

    def run(self):
        reports = run_pipeline(self.spark, self.warehouse, str(self.landing), F.lit(AS_OF), buckets=4)
        return {name: report and report.first().asDict() for name, report in reports.items()}

    def run_silver(self):
        pipeline.ingest_to_bronze(self.lake, str(self.landing))
        pipeline.bronze_to_silver(self.lake)

    @property
    def lake(self):
        return Lakehouse(self.spark, self.warehouse, buckets=4)

    def silver(self, name):
        return {row[0]: row.asDict() for row in self.lake.silver(name).read().collect()}




@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A world after its first run, with the reports of that run."""
    world = World(spark, tmp_path_factory.mktemp("loaded"))
    return world, first_load(world)


@pytest.fixture
def world(loaded, tmp_path):
    return loaded[0].copy(tmp_path)


def first_load(world):
    world.land("customers", customer("C1", "2024-01-01 10:00:00"), customer(" C2", "2024-01-02 10:00:00"),
               customer("C2", "2024-01-03 10:00:00", city="delhi"), customer(None, "2024-01-01 00:00:00"),
               customer(None, "2024-01-01 00:00:00"), customer("C9", "2024-01-01 00:00:00", customer_name=None))
    world.land("cards", card("K1", "C1", "2024-01-04 00:00:00"), card("K2", "nobody", "2024-01-04 00:00:00"))
    world.land(
        "transactions",
        transaction("T1", "2024-01-10 00:00:00"),
        transaction("T1", "2024-01-11 00:00:00", amount=11.0),
        transaction("T2", "2024-02-10 00:00:00", amount=20.0, transaction_type="emi conversion"),
        transaction("T3", "2024-02-10 00:00:00", amount=-5.0, transaction_type=" refund "),
        transaction("T4", "2024-02-10 00:00:00", amount=-5.0, currency="xyz"),
        transaction("T5", "2024-02-10 00:00:00", currency=None),
        transaction("T6", "2024-02-10 00:00:00", merchant_id="M2", status="failed"),
        transaction(None, "2024-02-11 00:00:00", card_id="K2", merchant_id="M3", customer_id="C9"),
    )
    return world.run()


def test_first_load(loaded):
    world, reports = loaded
    assert reports["transactions"] == {
        "rows_loaded": 8, "rows_removed": 1, "rows_entered": 7, "rows_passed": 4, "rows_failed": 3,
        "success_pct": pytest.approx(400 / 7), "failure_pct": pytest.approx(300 / 7),
    }
    assert set(world.silver("merchants")) == {"M1", "M2"}
    assert world.silver("merchants")["M1"]["mcc_code"] == "0742"
    customers = world.silver("customers")
    assert set(customers) == {"C1", "C2"} and customers["C2"]["customer_city"] == "Delhi"
    assert all(c["is_current"] and c["valid_from"] == c["updated_at"] for c in customers.values())
    cards = world.silver("cards")
    assert set(cards) == {"K1"} and cards["K1"]["card_brand_type"] == "RuPay"
    assert set(world.silver("transactions")) == {"T1", "T2", "T3", "T6"}

    lake = world.lake
    bad_customers = lake.quarantine("customers").read()
    assert sorted(r[0] for r in bad_customers.select("failed_reason").collect()) == [
        "customer_id_missing", "customer_id_missing", "customer_name_missing"]
    bad = {r["transaction_id"]: r["failed_reasons"] for r in lake.quarantine("transactions").read().collect()}
    assert bad == {
        "T4": ["Invalid Negative Amount Flag", "Unsupported or Invalid Currency"],
        "T5": ["Unsupported or Invalid Currency"],
        None: ["Missing Transaction ID", "Missing or Inactive Customer Profile", "Card Reference Not Found",
               "Merchant Profile Not Found"],
    }
    spend = {r["month"]: r for r in lake.gold("customers_spend_summary").read().collect()}
    assert set(spend) == {date(2024, 1, 1), date(2024, 2, 1)}
    february = spend[date(2024, 2, 1)]
    assert (february["total_spend"], february["total_refunded"], february["prev_month_spend"]) == (20.0, 5.0, 11.0)
    risk = {r[0]: r.asDict() for r in lake.gold("portfolio_risk_summary").read().collect()}
    assert risk["C1"]["credit_utilization_pct"] == 2.0 and risk["C2"]["card_count"] == 0
    segments = {r[0]: r.asDict() for r in lake.gold("customer_segmentation_summary").read().collect()}
    assert segments["C1"]["spend_segment"] == "Low" and segments["C2"]["spend_segment"] == "Unknown"
    assert last_mark(lake, "bronze_to_silver", "silver_transactions") == datetime(2024, 2, 11)
    assert last_mark(lake, "silver_to_gold", "portfolio_risk_summary") is not None
    assert last_mark(lake, "bronze_to_silver", "silver_merchants") is None


def test_second_run_without_new_rows_changes_nothing(world):
    tables = ("customers", "cards", "transactions")
    before = {name: sorted(map(str, world.lake.silver(name).read().collect())) for name in tables}
    reports = world.run()
    assert reports["customers"] is None and reports["cards"] is None and reports["transactions"] is None
    assert before == {name: sorted(map(str, world.lake.silver(name).read().collect())) for name in tables}


def test_incremental_load(world):
    world.land("customers",
               customer("C1", "2024-03-01 00:00:00", risk_grade="high", customer_name="new name"),
               customer("C2", "2024-03-02 00:00:00", city="delhi", total_cards_issued=4),
               customer("C3", "2024-03-03 00:00:00"))
    world.land("cards", card("K1", "C3", "2024-03-05 00:00:00", card_status="lost", credit_limit=2000.0),
               card("K3", "C3", "2024-03-05 00:00:00"))
    world.land("transactions",
               transaction("T1", "2024-03-10 00:00:00", amount=99.0, status="failed"),   # moves to another month
               transaction("T7", "2024-03-11 00:00:00", amount=50.0))
    world.run()
    history = world.lake.silver("customers").read().orderBy("customer_id", "valid_from").collect()
    seen = [(r["customer_id"], r["risk_grade"], r["customer_name"], r["is_current"], r["valid_till"]) for r in history]
    assert seen == [
        ("C1", "Low", "Name C1", False, datetime(2024, 3, 1)),
        ("C1", "High", "New Name", True, None),
        ("C2", "Low", "Name C2", True, None),
        ("C3", "Low", "Name C3", True, None),
    ]
    assert history[2]["total_cards_issued"] == 4 and history[2]["updated_at"] == datetime(2024, 1, 3, 10)
    cards = world.silver("cards")
    assert set(cards) == {"K1", "K3"}
    assert (cards["K1"]["card_status"], cards["K1"]["card_holder_id"]) == ("Lost", "C1")
    transactions = world.silver("transactions")
    assert set(transactions) == {"T1", "T2", "T3", "T6", "T7"}
    assert transactions["T1"]["amount"] == 11.0 and transactions["T1"]["transaction_status"] == "Failed"
    months = {r["month"] for r in world.lake.gold("customers_spend_summary").read().collect()}
    assert months == {date(2024, 2, 1), date(2024, 3, 1)}


def test_rerun_after_a_crash_before_the_watermark_moved(world, monkeypatch):
    world.land("customers", customer("C1", "2024-03-01 00:00:00", risk_grade="high"),
               customer(None, "2024-03-01 00:00:00"))
    saved = Progress.save

    def die_on_customers(self, pipeline, table, mark=None, **changes):
        if table == "silver_customers" and "batch" in changes:
            raise RuntimeError("lost the driver")
        saved(self, pipeline, table, mark, **changes)

    monkeypatch.setattr(Progress, "save", die_on_customers)
    with pytest.raises(RuntimeError):
        world.run_silver()
    monkeypatch.setattr(Progress, "save", saved)
    world.run_silver()
    history = world.lake.silver("customers").read().where("customer_id = 'C1'").collect()
    assert sorted((r["is_current"], r["risk_grade"]) for r in history) == [(False, "Low"), (True, "High")]
    assert world.lake.quarantine("customers").read().count() == 4


def test_incremental_read_opens_new_batches_only(world):
    world.land("transactions", transaction("T9", "2024-02-01 00:00:00"))
    pipeline.ingest_to_bronze(world.lake, str(world.landing))
    assert pipeline.batches(world.lake, "transactions") == (2, 1)
    batch = pipeline.bronze_batches(world.lake, "transactions", 1, 2)
    assert [r["transaction_id"] for r in batch.collect()] == ["T9"]
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "ingest_batch" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]


def test_batch_of_bad_rows_only(world):
    before = sorted(map(str, world.lake.silver("cards").read().collect()))
    world.land("cards", card("K8", "nobody", "2024-05-01 00:00:00"))
    world.run_silver()
    assert sorted(map(str, world.lake.silver("cards").read().collect())) == before
    assert last_mark(world.lake, "bronze_to_silver", "silver_cards") == datetime(2024, 5, 1)
    world.run_silver()
    assert world.lake.quarantine("cards").read().count() == 2


def test_large_key_sets_take_the_other_plan(world, monkeypatch):
    chosen = []
    by_exception = references.flag_by_exception
    monkeypatch.setattr(pipeline, "SMALL_BYTES", -1)
    monkeypatch.setattr(
        references, "flag_by_exception", lambda df, refs, absent: chosen.append(refs) or by_exception(df, refs, absent)
    )
    test_incremental_load(world)
    assert [len(refs) for refs in chosen] == [1, 3]


def test_two_batches_equal_one_load(spark, tmp_path):
    rows = [transaction(f"T{i % 7}", f"2024-0{1 + i % 5}-0{1 + i % 9} 00:00:00", amount=1.0 * (i % 7))
            for i in range(30)]
    rows = [r | {"status": "successful"} for r in rows]
    together, apart = World(spark, tmp_path / "a"), World(spark, tmp_path / "b")
    for world in (together, apart):
        world.land("customers", customer("C1", "2024-01-01 00:00:00"))
        world.land("cards", card("K1", "C1", "2024-01-01 00:00:00"))
    together.land("transactions", *rows)
    together.run_silver()
    early = [r for r in rows if r["updated_at"] < "2024-03"]
    apart.land("transactions", *early)
    apart.run_silver()
    apart.land("transactions", *[r for r in rows if r not in early])
    apart.run_silver()

    def state(world):
        return sorted(
            (key, row["amount"], str(row["updated_at"]), row["bucket"])
            for key, row in world.silver("transactions").items()
        )

    assert state(together) == state(apart)
