"""The registered queries. Each one runs the library on the given tables, whole, and returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.functions.text import card_network, currency_code, tidy_currency
from ledgerline.operators import history, quality, watermark
from ledgerline.operators.dedup import newest_per_key
from ledgerline.operators.references import flag_by_exception, flag_by_lookup, missing_keys
from ledgerline.operators.upsert import touched_partitions, upsert
from ledgerline.plans import cleaning, ingestion, marts, pipeline, reports
from ledgerline.plans.layout import GOLD, Lakehouse
from ledgerline.session import freed_shuffles
from ledgerline.sources.landing import read_csv, read_pages, records_of
from workload import inputs

Query = Callable[[SparkSession, str], DataFrame]

# The day on which tenure is measured.
AS_OF = "2002-01-01"


def comparable(df: DataFrame) -> DataFrame:
    """Plain column types for the comparison: no processing time, wall-clock timestamps, lists as text."""
    def plain(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.concat_ws("; ", field.name).alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(field) for field in df.schema.fields if field.name != "silver_processed_at"])


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Averages over many doubles vary in the last digits with the order of addition."""
    return df.withColumns({name: F.round(name, 6) for name in names})


class Layers:
    """Bronze and Silver derived from the tables of one folder, for one full load.

    Views and derived tables are built once per instance; Spark then recognises equal subplans and shares their shuffles.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.tables = inputs.tables(spark, sf_dir)

    @cache
    def view(self, text: str, where: str = inputs.EVERYTHING) -> DataFrame:
        return inputs.view(self.spark, self.tables, text, where)

    # Bronze
    def merchants_raw(self) -> DataFrame:
        return self.view(inputs.MERCHANTS)

    def customers_raw(self) -> DataFrame:
        return self.view(inputs.CUSTOMERS)

    def customer_updates(self, where: str = inputs.EVERYTHING) -> DataFrame:
        return self.view(inputs.CUSTOMER_UPDATES, where)

    def cards_raw(self, where: str = inputs.EVERYTHING) -> DataFrame:
        return self.view(inputs.CARDS, where)

    def card_updates(self) -> DataFrame:
        return self.view(inputs.CARD_UPDATES, inputs.UPDATED_CARDS)

    def transactions_raw(self, where: str = inputs.EVERYTHING) -> DataFrame:
        return self.view(inputs.TRANSACTIONS, where)

    # checked batches: everything for the quarantine, rows with a key for the good tables
    @cache
    def merchants_checked(self, keyless: bool = True) -> DataFrame:
        cleaned = cleaning.clean_merchants(self.merchants_raw(), keep_keyless=keyless)
        return quality.assess(cleaned, cleaning.merchant_rules())

    @cache
    def customers_checked(self, keyless: bool = True) -> DataFrame:
        cleaned = cleaning.clean_customers(self.customers_raw(), keep_keyless=keyless)
        return quality.assess(cleaned, cleaning.customer_rules())

    @cache
    def cards_cleaned(self, raw: DataFrame | None = None, keyless: bool = True) -> DataFrame:
        raw = self.cards_raw() if raw is None else raw
        return cleaning.clean_cards(raw, self.customer_keys(), flag_by_lookup, keep_keyless=keyless)

    @cache
    def cards_checked(self, raw: DataFrame | None = None, keyless: bool = True) -> DataFrame:
        return quality.assess(self.cards_cleaned(raw, keyless), cleaning.card_rules())

    @cache
    def transactions_cleaned(self, raw: DataFrame | None = None, keyless: bool = True) -> DataFrame:
        raw = self.transactions_raw() if raw is None else raw
        missing = self.missing_references()
        return cleaning.clean_transactions(
            raw, self.customer_keys(), self.card_keys(), self.merchant_keys(),
            lambda newest, refs: flag_by_exception(newest, refs, missing), keep_keyless=keyless,
        )

    @cache
    def missing_references(self) -> dict[str, DataFrame]:
        """The keys that transactions of any batch point to and that do not exist, found once and stored."""
        refs = cleaning.transaction_references(self.customer_keys(), self.card_keys(), self.merchant_keys())
        rows = cleaning.standardise_transactions(self.transactions_raw())
        with freed_shuffles(self.spark):
            return pipeline.stored_missing(scratch_lake(self.spark, "references"), "transactions", rows, refs)

    @cache
    def transactions_checked(self, raw: DataFrame | None = None, keyless: bool = True) -> DataFrame:
        return quality.assess(self.transactions_cleaned(raw, keyless), cleaning.transaction_rules())

    # Silver
    @cache
    def merchants(self) -> DataFrame:
        return quality.good_rows(self.merchants_checked(keyless=False))

    @cache
    def customers(self) -> DataFrame:
        good = quality.good_rows(self.customers_checked(keyless=False))
        return history.first_load(good, cleaning.CUSTOMER_HISTORY)

    @cache
    def cards(self, raw: DataFrame | None = None) -> DataFrame:
        return quality.good_rows(self.cards_checked(raw, keyless=False)).drop(*cleaning.CARD_HELPERS)

    @cache
    def transactions(self, raw: DataFrame | None = None) -> DataFrame:
        helpers = ("is_negative_amount_valid", *cleaning.TRANSACTION_HELPERS)
        return quality.good_rows(self.transactions_checked(raw, keyless=False)).drop(*helpers)

    @cache
    def merchant_keys(self) -> DataFrame:
        return self.merchants().select("merchant_id")

    @cache
    def customer_keys(self) -> DataFrame:
        return history.current(self.customers()).select("customer_id")

    @cache
    def card_keys(self) -> DataFrame:
        return self.cards().select("card_id")

    # two batches
    @cache
    def history_first(self) -> DataFrame:
        batch = cleaning.clean_customers(self.customer_updates(inputs.FIRST_BATCH), keep_keyless=False)
        return history.first_load(batch, cleaning.CUSTOMER_HISTORY)

    @cache
    def history_incoming(self) -> DataFrame:
        return cleaning.clean_customers(self.customer_updates(inputs.SECOND_BATCH), keep_keyless=False)

    # Gold
    @cache
    def enriched(self) -> DataFrame:
        return marts.successful_with_category(self.transactions(), self.merchants())

    @cache
    def spend(self) -> DataFrame:
        return marts.spend_summary(self.transactions(), self.merchants())

    @cache
    def risk(self) -> DataFrame:
        return marts.risk_summary(self.customers(), self.cards(), self.spend())

    @cache
    def segments(self) -> DataFrame:
        return marts.segmentation_summary(
            self.customers(), self.cards(), self.spend(), F.lit(AS_OF).cast("date")
        )


# -- scans, watermarks, writes -----------------------------------------------------------------------------------------

def incremental_scan(layers: Layers) -> DataFrame:
    return watermark.since(layers.transactions_raw(), datetime.fromisoformat(inputs.CUTOFF))


def _progress(layers: Layers) -> DataFrame:
    """Metadata after a first batch: marks for the three incremental Silver tables, taken from the data."""
    def marks(df: DataFrame, table: str) -> DataFrame:
        return watermark.newest(df, "bronze_to_silver", table)

    done = (
        marks(layers.cards_raw(inputs.FIRST_BATCH), "silver_cards")
        .unionByName(marks(layers.transactions_raw(inputs.FIRST_TRANSACTIONS), "silver_transactions"))
        .unionByName(marks(layers.customer_updates(inputs.FIRST_BATCH), "silver_customers"))
    )
    return watermark.advance(watermark.seed(layers.spark), done)


def watermark_read(layers: Layers) -> DataFrame:
    return watermark.read_mark(_progress(layers), "bronze_to_silver", "silver_cards")


def watermark_advance(layers: Layers) -> DataFrame:
    return watermark.newest(layers.transactions_checked(), "bronze_to_silver", "silver_transactions")


def watermark_upsert(layers: Layers) -> DataFrame:
    late = watermark.newest(layers.cards_raw(inputs.SECOND_BATCH), "bronze_to_silver", "silver_cards")
    back = watermark.newest(
        layers.transactions_raw(inputs.FIRST_TRANSACTIONS), "bronze_to_silver", "silver_transactions"
    )
    return watermark.advance(_progress(layers), late.unionByName(back))


def upsert_cards(layers: Layers) -> DataFrame:
    """The keyed write alone, on standardised rows."""
    stored = cleaning.standardise_cards(layers.cards_raw(inputs.FIRST_BATCH))
    incoming = cleaning.standardise_cards(layers.card_updates())
    return upsert(stored, incoming, ["card_id"], cleaning.CARD_UPDATES)


def silver_cards(layers: Layers) -> DataFrame:
    """Two batches, each cleaned and checked, the second one written over the first."""
    stored = layers.cards(layers.cards_raw(inputs.FIRST_BATCH))
    return upsert(stored, layers.cards(layers.card_updates()), ["card_id"], cleaning.CARD_UPDATES)


def _standard_transactions(layers: Layers) -> tuple[DataFrame, DataFrame]:
    first, second = (
        _newest(cleaning.standardise_transactions(layers.transactions_raw(where)), "transaction_id")
        for where in (inputs.FIRST_TRANSACTIONS, inputs.SECOND_TRANSACTIONS)
    )
    return first, second


def upsert_transactions(layers: Layers) -> DataFrame:
    """The keyed write alone, on standardised rows."""
    stored, incoming = _standard_transactions(layers)
    return upsert(stored, incoming, ["transaction_id"], cleaning.TRANSACTION_UPDATES)


def upsert_touched_months(layers: Layers) -> DataFrame:
    def with_month(df: DataFrame) -> DataFrame:
        return df.withColumn("month", marts.month_of(F.col("transaction_timestamp")))

    stored, incoming = _standard_transactions(layers)
    return touched_partitions(with_month(stored), with_month(incoming), ["transaction_id"], "month")


def silver_transactions(layers: Layers) -> DataFrame:
    """Two batches, each cleaned and checked, the second one written over the first."""
    stored = layers.transactions(layers.transactions_raw(inputs.FIRST_TRANSACTIONS))
    incoming = layers.transactions(layers.transactions_raw(inputs.SECOND_TRANSACTIONS))
    return upsert(stored, incoming, ["transaction_id"], cleaning.TRANSACTION_UPDATES)


# -- cleaning and quality ----------------------------------------------------------------------------------------------

def _newest(df: DataFrame, key: str, newest_first: Sequence[str] = ("updated_at",)) -> DataFrame:
    return newest_per_key(df, key, lambda rows: rows, newest_first)


def card_brand(layers: Layers) -> DataFrame:
    names = layers.cards_raw().select("card_id", "card_name", "card_brand_type")
    return names.withColumn("card_brand_type", card_network(F.lower("card_name"), F.col("card_brand_type")))


def amount_sign(layers: Layers) -> DataFrame:
    rows = cleaning.standardise_transactions(layers.transactions_raw())
    return rows.groupBy("transaction_type", "is_negative_amount_valid").agg(F.count(F.lit(1)).alias("row_count"))


def currency_normalise(layers: Layers) -> DataFrame:
    codes = layers.transactions_raw().select("currency", currency_code(tidy_currency("currency")).alias("currency_code"))
    return codes.groupBy("currency", "currency_code").agg(F.count(F.lit(1)).alias("row_count"))


def txn_ref_check_by_exception(layers: Layers) -> DataFrame:
    newest = _newest(cleaning.standardise_transactions(layers.transactions_raw()), "transaction_id")
    refs = cleaning.transaction_references(layers.customer_keys(), layers.card_keys(), layers.merchant_keys())
    checked = flag_by_exception(newest, refs, missing_keys(newest, refs))
    return checked.select("transaction_id", *cleaning.TRANSACTION_HELPERS)


def first_reasons(layers: Layers) -> DataFrame:
    def keyed(checked: DataFrame, table: str, key: str) -> DataFrame:
        bad = quality.bad_rows_first_reason(checked)
        return bad.select(F.lit(table).alias("table_name"), F.col(key).alias("row_key"), "failed_reason")

    return (
        keyed(layers.merchants_checked(), "merchants", "merchant_id")
        .unionByName(keyed(layers.customers_checked(), "customers", "customer_id"))
        .unionByName(keyed(layers.cards_checked(), "cards", "card_id"))
    )


def bad_transactions(layers: Layers) -> DataFrame:
    return quality.bad_rows(layers.transactions_checked()).drop(*cleaning.TRANSACTION_HELPERS)


def bad_cards(layers: Layers) -> DataFrame:
    return quality.bad_rows_first_reason(layers.cards_checked()).drop(*cleaning.CARD_HELPERS)


# -- history -----------------------------------------------------------------------------------------------------------

def scd_classify(layers: Layers) -> DataFrame:
    changes = history.classify(layers.history_first(), layers.history_incoming(), cleaning.CUSTOMER_HISTORY)
    return changes.select("customer_id", "updated_at", "change_type")


def scd_history(layers: Layers) -> DataFrame:
    return history.apply_changes(layers.history_first(), layers.history_incoming(), cleaning.CUSTOMER_HISTORY)


def scd2_apply(layers: Layers) -> DataFrame:
    """Customers with more than one version: what each change closed and opened."""
    versions = scd_history(layers)
    closed = versions.where(~F.col("is_current")).select("customer_id").distinct()
    return versions.join(closed, "customer_id", "left_semi")


def scd1_apply(layers: Layers) -> DataFrame:
    """Current versions corrected in place."""
    incoming = history.classify(layers.history_first(), layers.history_incoming(), cleaning.CUSTOMER_HISTORY)
    corrected = incoming.where(F.col("change_type") == history.TYPE_1).select("customer_id")
    return scd_history(layers).join(corrected, "customer_id", "left_semi")


def scd_report(layers: Layers) -> DataFrame:
    return history.change_report(scd_classify(layers))


def scd_any_order(layers: Layers) -> DataFrame:
    """The history that the rows of both batches make up, the second one read first."""
    first = cleaning.clean_customers(layers.customer_updates(inputs.FIRST_BATCH), keep_keyless=False)
    return history.versions_of(layers.history_incoming().unionByName(first), cleaning.CUSTOMER_HISTORY)


# -- the stored pipeline -----------------------------------------------------------------------------------------------

def scratch_lake(spark: SparkSession, name: str) -> Lakehouse:
    """A lakehouse of its own in the shared folder of the cluster, or in the warehouse where none is set."""
    return Lakehouse(spark, Lakehouse(spark, spark.conf.get("spark.sql.warehouse.dir")).scratch(name))


def _two_runs(layers: Layers, name: str, spend_after_first: bool) -> DataFrame:
    lake = scratch_lake(layers.spark, name)
    pipeline.ingest_batch(lake, "merchants", layers.merchants_raw())
    for endpoint, raw in (
        ("customers", layers.customers_raw()),
        ("cards", layers.cards_raw()),
        ("transactions", layers.transactions_raw(inputs.FIRST_TRANSACTIONS)),
    ):
        pipeline.ingest_batch(lake, endpoint, raw)
    pipeline.bronze_to_silver(lake)
    if spend_after_first:
        pipeline.build_spend_summary(lake)
    later = layers.transactions_raw(inputs.SECOND_TRANSACTIONS)
    pipeline.ingest_batch(lake, "transactions", later)
    pipeline.process_transactions(lake)
    pipeline.build_spend_summary(lake)
    return lake.gold("customers_spend_summary").read()


def pipeline_two_runs(layers: Layers) -> DataFrame:
    """Bronze, Silver and the spend mart as stored tables: a first load, then a run over the later transactions."""
    return _two_runs(layers, "two_runs", spend_after_first=False)


def gold_spend_update(layers: Layers) -> DataFrame:
    """The spend mart built after a first load and brought up to date after a second one."""
    return _two_runs(layers, "spend_update", spend_after_first=True)


def change_counts(layers: Layers) -> DataFrame:
    """What the second of two loads of customers changed, as the stored pipeline reports it."""
    lake = scratch_lake(layers.spark, "change_counts")
    for where in (inputs.FIRST_BATCH, inputs.SECOND_BATCH):
        pipeline.ingest_batch(lake, "customers", layers.customer_updates(where))
        pipeline.process_customers(lake)
    run = lake.reports("customer_changes").read().where(F.col("run_id") == lake.run_id)
    return run.select("change_type", "row_count")


# -- landing -----------------------------------------------------------------------------------------------------------

PAGE_ROWS = 5_000


def land_csv(df: DataFrame, folder: str) -> None:
    """CSV files with their columns in alphabetical order, some records of which lack fields or have too many."""
    df = df.select(*sorted(df.columns))
    df.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(folder)
    ragged = df.select(F.format_string("%s,%s", *[F.coalesce(name, F.lit("x")) for name in df.columns[:2]]).alias("value"))
    longer = df.select(F.concat_ws(",", F.lit("a"), *[F.lit("b")] * len(df.columns)).alias("value"))
    header = df.sparkSession.range(1, numPartitions=1).select(F.lit(",".join(df.columns)).alias("value"))
    header.union(ragged.unionByName(longer)).coalesce(1).write.mode("append").text(folder)


def land_pages(df: DataFrame, folder: str) -> None:
    """API pages of at most PAGE_ROWS records, one compressed file each."""
    numbered = df.withColumn("sheet", F.floor(F.monotonically_increasing_id() / PAGE_ROWS))
    pages = numbered.groupBy("sheet").agg(F.collect_list(F.struct(*df.columns)).alias("data"))
    text = F.to_json(F.struct("data", F.size("data").alias("count")))
    with freed_shuffles(df.sparkSession):
        written = pages.select("sheet", text.alias("value")).write.mode("append").option("compression", "gzip")
        written.partitionBy("sheet").text(folder)


def landing_folder(layers: Layers, name: str) -> str:
    return Lakehouse(layers.spark, layers.spark.conf.get("spark.sql.warehouse.dir")).scratch(name)


def landed_csv(layers: Layers) -> DataFrame:
    """The merchants written as CSV and read back by name, without the records that do not fit the header."""
    folder = landing_folder(layers, "landed_csv")
    land_csv(layers.merchants_raw(), folder)
    return read_csv(layers.spark, folder, schemas.MERCHANT_RECORD)


def _as_given(records: DataFrame) -> DataFrame:
    return records.withColumn("transaction_timestamp", F.col("transaction_timestamp").try_cast("timestamp"))


def landed_pages(layers: Layers) -> DataFrame:
    """The transactions written as API pages and read back as typed records."""
    folder = landing_folder(layers, "landed_pages")
    land_pages(layers.transactions_raw(), folder)
    records = records_of(read_pages(layers.spark, folder, schemas.TRANSACTION_RECORD))
    return _as_given(records.select(*schemas.TRANSACTION_RECORD.names))


def ingest_two_runs(layers: Layers) -> DataFrame:
    """Bronze after two ingestions, the second of which finds the pages of the first still there."""
    lake, folder = scratch_lake(layers.spark, "ingest"), landing_folder(layers, "ingest_pages")
    endpoint = next(e for e in ingestion.ENDPOINTS if e.name == "transactions")
    for run, where in enumerate((inputs.FIRST_TRANSACTIONS, inputs.SECOND_TRANSACTIONS)):
        land_pages(layers.transactions_raw(where), f"{folder}/transactions/run{run}")
        ingestion.ingest_endpoint(lake, endpoint, f"{folder}/transactions")
    stored = lake.bronze("transactions").read()
    return _as_given(stored.select(*schemas.TRANSACTION_RECORD.names, F.col(ingestion.BATCH).cast("int")))


def _full_run(layers: Layers, name: str) -> Lakehouse:
    """Everything landed as files, then one run of the whole pipeline."""
    lake, folder = scratch_lake(layers.spark, name), landing_folder(layers, f"{name}_landing")
    land_csv(layers.merchants_raw(), f"{folder}/merchants")
    land_pages(layers.customers_raw(), f"{folder}/customers")
    land_pages(layers.cards_raw(), f"{folder}/cards")
    land_pages(layers.transactions_raw(), f"{folder}/transactions")
    pipeline.run_pipeline(layers.spark, lake.root, folder, F.lit(AS_OF).cast("date"), lake.buckets)
    return lake


def pipeline_full(layers: Layers) -> DataFrame:
    """The risk mart, which rests on all tables, from landed files."""
    return _full_run(layers, "pipeline_full").gold("portfolio_risk_summary").read()


def gold_run_marks(layers: Layers) -> DataFrame:
    """What the marts' runs have noted: that they ran, and the rows they wrote."""
    rows = _full_run(layers, "gold_run_marks").progress.table.read().where(F.col("pipeline_name") == GOLD)
    return rows.select("table_name", "row_count", F.col(watermark.MARK).isNotNull().alias("has_run"))


def stored_quarantine(layers: Layers) -> DataFrame:
    """What one stored run has put into the quarantine tables."""
    lake = scratch_lake(layers.spark, "quarantine")
    pipeline.ingest_batch(lake, "merchants", layers.merchants_raw())
    for endpoint, raw in (
        ("customers", layers.customers_raw()), ("cards", layers.cards_raw()), ("transactions", layers.transactions_raw()),
    ):
        pipeline.ingest_batch(lake, endpoint, raw)
    pipeline.bronze_to_silver(lake)

    def stored(name: str, key: str, reason: Column) -> DataFrame:
        return lake.quarantine(name).read().select(
            F.lit(name).alias("table_name"), F.col(key).alias("row_key"), reason.alias("failed_reason")
        )

    first = F.col("failed_reason")
    return (
        stored("merchants", "merchant_id", first).unionByName(stored("customers", "customer_id", first))
        .unionByName(stored("cards", "card_id", first))
        .unionByName(stored("transactions", "transaction_id", F.concat_ws("; ", quality.REASONS)))
    )


# -- registration ------------------------------------------------------------------------------------------------------

PLANS: dict[str, Callable[[Layers], DataFrame]] = {
    # scans, watermarks, writes
    "scan_transactions": lambda x: x.transactions_raw(),
    "incremental_scan": incremental_scan,
    "watermark_read": watermark_read,
    "watermark_advance": watermark_advance,
    "watermark_upsert": watermark_upsert,
    "upsert_cards": upsert_cards,
    "upsert_transactions": upsert_transactions,
    "upsert_touched_months": upsert_touched_months,
    "landed_csv": landed_csv,
    "landed_pages": landed_pages,
    "ingest_two_runs": ingest_two_runs,
    "pipeline_full": pipeline_full,
    "gold_run_marks": gold_run_marks,
    "stored_quarantine": stored_quarantine,
    # cleaning
    "dedup_merchants": lambda x: _newest(x.merchants_raw(), "merchant_id", []),
    "dedup_customers": lambda x: _newest(x.customer_updates(), "customer_id"),
    "dedup_cards": lambda x: _newest(x.cards_raw().unionByName(x.card_updates()), "card_id"),
    "dedup_transactions": lambda x: _newest(x.transactions_raw(), "transaction_id"),
    "clean_merchants": lambda x: cleaning.clean_merchants(x.merchants_raw()),
    "clean_customers": lambda x: cleaning.clean_customers(x.customers_raw()),
    "clean_cards": lambda x: x.cards_cleaned(),
    "clean_transactions": lambda x: x.transactions_cleaned(),
    "card_brand": card_brand,
    "amount_sign": amount_sign,
    "currency_normalise": currency_normalise,
    "cards_ref_check": lambda x: x.cards_cleaned().select("card_id", "card_holder_id", "holder_known"),
    "txn_ref_check": lambda x: x.transactions_cleaned().select("transaction_id", *cleaning.TRANSACTION_HELPERS),
    "txn_ref_check_by_exception": txn_ref_check_by_exception,
    # quality
    "dq_good_rows": lambda x: x.transactions(),
    "dq_bad_rows": bad_cards,
    "dq_first_reason": first_reasons,
    "dq_all_reasons": bad_transactions,
    "dq_report": lambda x: quality.report(x.transactions_raw(), x.transactions_checked()),
    # history
    "scd_initial": lambda x: history.first_load(
        cleaning.clean_customers(x.customer_updates(), keep_keyless=False), cleaning.CUSTOMER_HISTORY
    ),
    "scd_classify": scd_classify,
    "scd2_apply": scd2_apply,
    "scd1_apply": scd1_apply,
    "scd_report": scd_report,
    "scd_any_order": scd_any_order,
    "change_counts": change_counts,
    # Silver tables
    "silver_merchants": lambda x: x.merchants(),
    "silver_customers": scd_history,
    "silver_cards": silver_cards,
    "silver_transactions": silver_transactions,
    # Gold
    "txn_enrich": lambda x: x.enriched(),
    "monthly_spend": lambda x: marts.monthly_spend(x.enriched()),
    "monthly_refunds": lambda x: marts.monthly_refunds(x.enriched()),
    "category_spend": lambda x: marts.category_spend(x.enriched()),
    "top_category": lambda x: marts.top_category(marts.category_spend(x.enriched())),
    "mom_change": lambda x: marts.with_month_over_month(marts.monthly_spend(x.enriched())),
    "spend_anomaly": lambda x: marts.with_anomaly_flag(marts.monthly_spend(x.enriched())),
    "card_rollup": lambda x: marts.card_rollup(x.cards()),
    "current_month_spend": lambda x: marts.current_month_spend(x.spend()),
    "primary_card_type": lambda x: marts.most_common(x.cards(), "card_holder_type", "primary_card_type"),
    "preferred_rewards": lambda x: marts.most_common(
        x.cards(), "card_rewards_category", "preferred_rewards_category"
    ),
    "card_preferences": lambda x: marts.card_preferences(x.cards()),
    "avg_monthly_spend": lambda x: marts.avg_monthly_spend(x.spend()),
    "gold_spend_summary": lambda x: x.spend(),
    "gold_risk_summary": lambda x: x.risk(),
    "gold_segmentation": lambda x: x.segments(),
    "pipeline_two_runs": pipeline_two_runs,
    "gold_spend_update": gold_spend_update,
    # dashboards
    "kpi_spend": lambda x: rounded(
        reports.spend_headline(x.spend()),
        "total_transaction_volume_cr", "average_monthly_spend", "total_refunded_cr", "mom_growth_rate",
    ),
    "kpi_monthly_trend": lambda x: reports.monthly_trend(x.spend()),
    "kpi_category_revenue": lambda x: reports.revenue_by_category(x.spend()),
    "kpi_category_refunds": lambda x: reports.refunds_by_category(x.spend()),
    "kpi_top10_customers": lambda x: reports.top_customers(x.spend()),
    "kpi_risk": lambda x: rounded(
        reports.risk_headline(x.risk()), "total_credit_exposure_cr", "average_utilization_pct"
    ),
    "kpi_utilization_buckets": lambda x: reports.utilization_distribution(x.risk()),
    "kpi_cards_by_status": lambda x: reports.cards_by_customer_status(x.risk()),
    "kpi_risk_grades": lambda x: reports.risk_grade_distribution(x.risk()),
    "kpi_risk_exposure": lambda x: rounded(reports.exposure_by_risk_grade(x.risk()), "total_credit_limit_cr"),
    "kpi_segments": lambda x: rounded(reports.segment_headline(x.segments()), "average_tenure_months"),
    "kpi_premium_by_income": lambda x: reports.premium_by_income(x.segments()),
    "kpi_spend_segments": lambda x: reports.spend_segment_distribution(x.segments()),
    "kpi_card_types": lambda x: reports.card_type_distribution(x.segments()),
    "kpi_rewards": lambda x: reports.rewards_preference(x.segments()),
    "kpi_top_reward": lambda x: reports.most_popular_reward(x.segments()),
}


def _query(plan: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(plan(Layers(spark, sf_dir)))


def queries() -> dict[str, Query]:
    return {name: _query(plan) for name, plan in PLANS.items()}
