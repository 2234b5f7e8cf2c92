"""Plans: what is read, what is shuffled, and what happens to a key that holds a third of all rows."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import quality, references
from ledgerline.operators.dedup import top_per_group, total_order
from ledgerline.plans import cleaning, marts, pipeline
from ledgerline.plans.layout import Lakehouse
from ledgerline.sources.tables import touched_buckets, with_bucket

HOT = 3


@contextmanager
def settings(spark, **conf):
    names = {name.replace("__", "."): value for name, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Transactions and merchants on disk; a third of the rows belongs to one customer and one merchant."""
    root = tmp_path_factory.mktemp("stored")
    i = F.col("id")
    hot = i % HOT == 0
    spark.range(60_000).select(
        F.concat(F.lit("t"), i).alias("transaction_id"),
        F.concat(F.lit("k"), i % 1000).alias("card_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), i % 5000)).alias("customer_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("m"), i % 700)).alias("merchant_id"),
        ((i % 997) / 4).alias("amount"),
        F.lit("INR").alias("currency"), F.lit("pos").alias("device_channel"),
        F.when(i % 10 < 9, "Successful").otherwise("Failed").alias("transaction_status"),
        F.when(i % 7 == 0, "Refund").otherwise("Purchase").alias("transaction_type"),
        F.timestamp_seconds(1_700_000_000 + i * 300).alias("transaction_timestamp"),
        F.timestamp_seconds(1_700_000_000 + i * 300).alias("updated_at"),
        F.current_timestamp().alias("silver_processed_at"), F.lit("bronze").alias("data_source"),
    ).repartition(8).write.parquet(f"{root}/transactions")
    names = spark.range(700).select(F.concat(F.lit("m"), F.col("id")).alias("merchant_id"))
    names.union(spark.range(1).select(F.lit("hot"))).select(
        "merchant_id", F.concat(F.lit("cat"), F.length("merchant_id")).alias("merchant_category"),
    ).write.parquet(f"{root}/merchants")
    return spark.read.parquet(f"{root}/transactions"), spark.read.parquet(f"{root}/merchants")


def test_spend_summary_reads_narrow_and_shuffles_twice(stored):
    plan = physical(marts.spend_summary(*stored))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "EqualTo(transaction_status,Successful)" in plan
    facts = next(line for line in plan.splitlines() if "FileScan" in line and "amount" in line)
    assert "transaction_id" not in facts and "currency" not in facts


def test_spend_summary_with_a_hot_customer_and_merchant(spark, stored):
    """AQE splits the hot merchant when the join shuffles; the result is that of the broadcast plan and of brute force."""
    def result():
        return sorted(map(tuple, marts.spend_summary(*stored).drop("is_anomalous_spend").collect()))

    usual = result()
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
    ):
        df = marts.spend_summary(*stored)
        shuffled = sorted(map(tuple, df.drop("is_anomalous_spend").collect()))
        enriched = marts.successful_with_category(*stored)
        enriched.collect()
        assert "skew=true" in physical(enriched)
    assert usual == shuffled

    transactions = stored[0].toPandas()
    spent = transactions[(transactions.transaction_status == "Successful") & (transactions.transaction_type != "Refund")]
    months = spent.transaction_timestamp.dt.strftime("%Y-%m-01")
    sums = spent.groupby([spent.customer_id, months]).amount.sum()
    assert {(row[0], str(row[1])): row[2] for row in usual} == pytest.approx(sums.to_dict())


def test_reference_check_through_missing_keys_moves_the_rows_once(spark, stored, tmp_path):
    transactions, merchants = stored
    refs = [
        references.Reference("merchant_id", merchants.where("merchant_id <> 'hot'").select("merchant_id"), "merchant_known"),
        references.Reference("card_id", spark.range(990).select(F.concat(F.lit("k"), F.col("id")).alias("card_id")),
                             "card_known"),
    ]
    newest = top_per_group(transactions, ["transaction_id"], total_order(transactions, "transaction_id", ["updated_at"]))
    absent = references.missing_keys(transactions, refs)
    assert sorted(map(tuple, absent.collect())) == sorted(
        [("card_id", f"k{i}") for i in range(990, 1000)] + [("merchant_id", "hot")])
    absent.write.partitionBy("reference_column").parquet(str(tmp_path / "absent"))
    kept = spark.read.schema(absent.schema).parquet(str(tmp_path / "absent"))
    checked = references.flag_by_exception(newest, refs, kept)
    assert physical(checked).count("Exchange hashpartitioning") == 1
    columns = ["transaction_id", "merchant_known", "card_known"]
    looked_up = references.flag_by_lookup(transactions, refs)
    assert sorted(map(tuple, checked.select(columns).collect())) == sorted(map(tuple, looked_up.select(columns).collect()))


def test_verdict_is_compiled_and_reasons_are_not_built_for_good_rows(stored):
    rows = stored[0].withColumns({name: F.lit(True) for name in cleaning.TRANSACTION_HELPERS}).withColumn(
        "is_negative_amount_valid", F.lit(True))
    plan = physical(quality.good_rows(quality.assess(rows, cleaning.transaction_rules())))
    assert "filter(" not in plan and "lambda" not in plan


def files(table):
    return {name.split("/bucket=")[1] for name in table.read().inputFiles()}


def test_a_two_row_batch_opens_and_rewrites_only_its_buckets(spark, stored, tmp_path):
    lake = Lakehouse(spark, str(tmp_path), buckets=16)
    lake.start()
    updates = cleaning.TRANSACTION_UPDATES

    def saved(rows, number):
        pipeline._save(lake, "transactions", "transaction_id", pipeline.Batch(rows, number - 1, number), rows, updates, None)

    saved(stored[0], 1)
    silver = lake.silver("transactions")
    first = files(silver)
    batch = stored[0].where("transaction_id IN ('t5', 't6')").withColumn("transaction_status", F.lit("Reversed"))
    batch = batch.withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAY"))
    buckets = {str(b) for b in touched_buckets(with_bucket(batch, "transaction_id", 16))}
    assert 0 < len(buckets) <= 2

    for small in (True, False):
        plan = physical(pipeline._upserted(lake, "transactions", "transaction_id", batch, updates, small))
        scans = [line for line in plan.splitlines() if "FileScan" in line and "bucket#" in line]
        assert scans and all("bucket" in line[line.index("PartitionFilters"):line.index("PushedFilters")] for line in scans)
        assert (plan.count("Exchange hashpartitioning") == 0) == small  # a small batch is brought to the stored rows
    saved(batch, 2)
    second = files(silver)
    assert {name.split("/")[0] for name in first ^ second} == buckets
    after = silver.read()
    assert after.count() == 60_000 and after.where("transaction_status = 'Reversed'").count() == 2


def test_upsert_gives_the_same_for_a_small_source(spark, stored):
    old, new = (stored[0].where(f"transaction_id LIKE 't{i}%'").select("transaction_id", "amount", "updated_at") for i in (1, 12))
    new = new.withColumn("amount", F.lit(-1.0)).union(spark.sql("SELECT 'new', 2.0D, TIMESTAMP'2024-01-01'"))
    new = new.withColumn("updated_at", F.expr("CASE WHEN transaction_id LIKE '%9' THEN NULL ELSE updated_at END"))
    from ledgerline.operators.upsert import upsert

    both = [sorted(map(tuple, upsert(old, new, ["transaction_id"], None, "updated_at", small).collect())) for small in (False, True)]
    assert both[0] == both[1] and any(row[0] == "new" for row in both[0])


def test_a_first_load_is_written_once_and_bronze_without_a_shuffle(spark, stored, tmp_path):
    """A batch is one partition, so its rows stay where they are; the first state of a table needs no staging."""
    lake = Lakehouse(spark, str(tmp_path), buckets=4)
    raw = stored[0].select(
        "transaction_id", "card_id", "customer_id", "merchant_id", "amount", "currency", "device_channel",
        F.col("transaction_status").alias("status"), "transaction_type", "transaction_timestamp", "updated_at",
    )
    pipeline.ingest_batch(lake, "transactions", raw.repartition(8))
    assert len(lake.bronze("transactions").read().inputFiles()) == 8

    rows = stored[0].limit(100)
    batch = pipeline.Batch(rows, 0, 1)
    pipeline._save(lake, "transactions", "transaction_id", batch, rows, cleaning.TRANSACTION_UPDATES, None)
    assert lake.silver("transactions").read().count() == 100
    assert not lake.staging("transactions").exists()
    again = rows.withColumn("transaction_status", F.lit("Reversed"))
    batch = pipeline.Batch(again, 1, 2)
    pipeline._save(lake, "transactions", "transaction_id", batch, again, cleaning.TRANSACTION_UPDATES, None)
    assert lake.silver("transactions").read().where("transaction_status = 'Reversed'").count() == 100


def test_reference_checks_of_the_registered_queries_do_not_move_the_wide_rows(spark):
    """Beyond the shuffles of the input join and of the deduplication, whatever Spark thinks of the key sets' sizes."""
    from workload.catalog import Layers

    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = physical(Layers(spark, "/root/testdata/sf0.001").transactions_cleaned())
    assert plan.count("Exchange hashpartitioning") == 3


def shuffle_files(spark):
    """Names of the shuffle files on disk just now."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_")}


def test_landed_pages_are_small_on_disk_and_leave_no_shuffle_files(spark, tmp_path):
    from ledgerline.schemas import TRANSACTION_RECORD
    from ledgerline.sources.landing import read_pages, records_of
    from workload.catalog import PAGE_ROWS, land_pages

    i = F.col("id")
    texts = spark.range(3 * PAGE_ROWS, numPartitions=2).select(*[
        F.concat(F.lit(f"{name} "), (i * 7919) % 100_003).alias(name) for name in TRANSACTION_RECORD.names[:4]
    ])
    before = shuffle_files(spark)
    land_pages(texts, str(tmp_path / "pages"))
    assert not shuffle_files(spark) - before
    size = sum(file.stat().st_size for file in (tmp_path / "pages").rglob("*part-*"))
    text = sum(len(row[0]) for row in texts.select(F.to_json(F.struct("*"))).collect())
    assert size < text / 3
    stored = records_of(read_pages(spark, str(tmp_path / "pages"), TRANSACTION_RECORD)).select(*texts.columns)
    assert sorted(stored.collect()) == sorted(texts.collect())


def test_broadcasts_are_measured_as_they_are_held_and_share_one_limit(spark, stored, tmp_path, monkeypatch):
    """5,000 keys of at most five characters are 25 KB of text, but 560 KB in the hash map that the driver makes of them."""
    from ledgerline.sources.tables import broadcast_bytes, fitting

    known = {
        "customer_id": spark.range(5000).select(F.concat(F.lit("c"), F.col("id")).alias("customer_id")),
        "card_id": spark.range(990).select(F.concat(F.lit("k"), F.col("id")).alias("card_id")),
        "merchant_id": spark.range(700).select(F.concat(F.lit("m"), F.col("id")).alias("merchant_id")),
    }
    sizes = {column: broadcast_bytes(keys) for column, keys in known.items()}
    assert sizes["customer_id"] >= 5000 * 100
    assert fitting(sizes, 200_000) == {"card_id", "merchant_id"} and fitting(sizes, sizes["merchant_id"]) == {"merchant_id"}
    assert fitting(sizes, -1) == set()

    rows = stored[0]
    lake = Lakehouse(spark, str(tmp_path), buckets=4)
    refs = cleaning.transaction_references(*known.values())
    columns = ["transaction_id", *cleaning.TRANSACTION_HELPERS]
    checked = []
    for limit in (64 * 1024 * 1024, 200_000, 79_000, -1):
        monkeypatch.setattr(pipeline, "SMALL_BYTES", limit)
        check = pipeline._reference_check(lake, f"transactions_{limit}", rows, sizes)
        result = check(rows, refs).select(columns)
        plan = physical(result)
        # the known keys that fit, and of the others the missing ones if there is room left
        assert plan.count("BroadcastHashJoin") == {79_000: 2, -1: 0}.get(limit, 3)
        assert ("SortMergeJoin" in plan) == (limit in (79_000, -1))
        checked.append(sorted(map(tuple, result.collect())))
    assert checked[0] == checked[1] == checked[2] == checked[3]
    assert {row[1:] for row in checked[0]} > {(True, True, True), (False, True, False)}


def test_a_run_gives_its_shuffles_and_scratch_folders_back(spark, tmp_path, monkeypatch):
    from test_pipeline import World, first_load, transaction

    monkeypatch.setattr(Lakehouse, "scratch", lambda lake, name: f"{lake.root}/scratch/{lake.run_id}/{name}")
    world = World(spark, tmp_path)
    before, setting = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    first_load(world)
    world.land("transactions", transaction("T1", "2024-03-10 00:00:00"), transaction("T7", "2024-03-11 00:00:00"))
    world.run()
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting
    folders = [*(tmp_path / "warehouse" / "scratch").glob("*/*"), *(tmp_path / "warehouse" / "staging").glob("*")]
    assert {"checked_transactions", "pages_transactions_2", "rows_merchants", "by_customer_transactions"} <= {f.name for f in folders}
    assert [f.name for f in folders if spark.read.parquet(str(f)).count()] == []
    assert {"T1", "T7"} <= set(world.silver("transactions"))


def test_rows_move_into_few_buckets_without_a_shuffle(spark, stored, tmp_path, monkeypatch):
    """Eight files of rows become eight of each bucket; where buckets are many, each is brought together first."""
    found = []
    for few in (16, 15):
        monkeypatch.setattr(pipeline, "FEW_BUCKETS", few)
        lake = Lakehouse(spark, str(tmp_path / str(few)), buckets=16)
        lake.start()
        batch = pipeline.Batch(stored[0], 0, 1)
        pipeline._save(lake, "transactions", "transaction_id", batch, stored[0], cleaning.TRANSACTION_UPDATES, None)
        rows = lake.silver("transactions").read()
        found.append((len(rows.inputFiles()), sorted(row[0] for row in rows.select("transaction_id").collect())))
    assert found[0][0] == 16 * 8 and found[1][0] < 16 * 4
    assert found[0][1] == found[1][1] and len(found[0][1]) == 60_000
