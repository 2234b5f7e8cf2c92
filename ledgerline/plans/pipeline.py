"""The stage drivers: landed files -> Bronze -> Silver -> Gold.

A Silver stage first fixes the Bronze batches it takes, writes its checked rows once to a scratch table and reads everything
else (good rows, quarantine, report, watermark) from there. Keyed tables are stored by a hash bucket of their key:
the buckets an update touches follow from its rows, only these are read, joined and rewritten, and the next state stands
complete in the staging folder before the table is touched. A stage that dies is simply run again: it takes the same
batches, replaces what it had written, or finishes moving what was staged.

Nothing that has landed is left out for its date. Silver takes the batches it has not taken yet, whenever their rows are
dated; watermarks say how new the data is. A page that is unreadable or incomplete, and a row with an unreadable value or
dated after the start of the run, goes to quarantine with its reason.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import history, quality, references, watermark
from ledgerline.operators.references import Reference
from ledgerline.operators.upsert import upsert
from ledgerline.plans import cleaning, gold
from ledgerline.plans.ingestion import BATCH, ENDPOINTS, bronze_batches, ingest_batch, ingest_to_bronze, stored_batches
from ledgerline.plans.layout import FEW_BUCKETS, SILVER, Lakehouse, stage
from ledgerline.sources.landing import PAGE, UNREADABLE
from ledgerline.sources.tables import (
    BUCKET, broadcast_bytes, compact, emptied, fitted, fitting, merged_schema, touched_buckets, with_bucket,
)

# What is broadcast for one query takes up to this many bytes as it is held in memory, measured before use. Beyond it, references
# are checked through their missing keys, and missing keys and merchant categories are joined by a shuffle.
SMALL_BYTES = 64 * 1024 * 1024

# The label of what a Silver run writes: the first Bronze batch it took.
TAKEN_FROM = "taken_from"

__all__ = ["BATCH", "ENDPOINTS", "ingest_batch", "ingest_to_bronze", "run_pipeline"]


# -- progress ----------------------------------------------------------------------------------------------------------

def last_mark(lake: Lakehouse, pipeline: str, table: str) -> datetime | None:
    lake.progress.refresh()
    return lake.progress.of(pipeline, table).last_processed_timestamp


def batches(lake: Lakehouse, endpoint: str) -> tuple[int, int]:
    """(batches stored in Bronze, batches taken by Silver)."""
    lake.progress.refresh()
    return stored_batches(lake, endpoint), lake.progress.of(SILVER, f"silver_{endpoint}").batch


# -- Silver ------------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Batch:
    """What Silver takes in one run: the sound rows, and the Bronze batches (after, upto] they come from."""

    rows: DataFrame
    after: int
    upto: int


def _take(lake: Lakehouse, name: str) -> Batch | None:
    """Fix the batches this run takes; their rows that cannot be trusted go to quarantine as they landed."""
    lake.start()
    _finish(lake, name)
    state = lake.progress.of(SILVER, f"silver_{name}")
    upto = state.pending or stored_batches(lake, name)
    if upto <= state.batch:
        return None
    lake.progress.save(SILVER, f"silver_{name}", pending=upto)
    if not lake.bronze(name).exists():  # batches without a single record
        lake.progress.save(SILVER, f"silver_{name}", batch=upto, pending=None)
        return None
    batch = bronze_batches(lake, name, state.batch, upto)
    unread = F.transform(UNREADABLE, lambda field: F.concat(F.lit("unreadable "), field))
    ahead = F.when(F.col("updated_at") > F.lit(lake.started_at), F.lit("updated_at after the start of the run"))
    reasons = F.array_compact(F.concat(F.coalesce(unread, F.array().cast("array<string>")), F.array(ahead)))
    judged = batch.withColumn(quality.REASONS, reasons)
    lake.quarantine(f"landed_{name}").put(
        judged.where(F.size(quality.REASONS) > 0), TAKEN_FROM, state.batch + 1
    )
    sound = judged.where(F.size(quality.REASONS) == 0).drop(quality.REASONS, UNREADABLE, PAGE, BATCH)
    return Batch(sound, state.batch, upto)


def _mark(lake: Lakehouse, name: str, checked: DataFrame) -> datetime | None:
    newest = watermark.newest(checked, SILVER, f"silver_{name}", not_after=lake.started_at)
    return newest.first()[watermark.MARK]


def _checked(lake: Lakehouse, name: str, cleaned: DataFrame, rules: list[quality.Rule]) -> DataFrame:
    """Write the assessed batch once, split by verdict, and return it read back from there, until ``_done``."""
    folder = lake.scratch(f"checked_{name}")
    assessed = quality.assess(cleaned, rules)
    compact(assessed).mode("overwrite").partitionBy(quality.VALID).parquet(folder)
    return lake.spark.read.schema(assessed.schema).parquet(folder)


def stored_missing(
    lake: Lakehouse, name: str, rows: DataFrame, refs: list[Reference], most: int | None = None
) -> dict[str, DataFrame]:
    """The missing keys, by reference, among all that standardised rows point to, found once and stored, so that the joins
    with them are planned by their measured size: the wide rows do not move for up to ``most`` bytes (SMALL_BYTES) of them."""
    folder = lake.scratch(f"missing_{name}")
    absent = references.missing_keys(rows, refs)
    compact(absent).mode("overwrite").partitionBy("reference_column").parquet(folder)
    stored = lake.spark.read.schema(absent.schema).parquet(folder)
    parts = {ref.column: references.missing_of(stored, ref.column) for ref in refs}
    sizes = {column: broadcast_bytes(part) for column, part in parts.items()}
    small = fitting(sizes, SMALL_BYTES if most is None else most)
    return {column: F.broadcast(part) if column in small else part.hint("merge") for column, part in parts.items()}


def _reference_check(
    lake: Lakehouse, name: str, rows: DataFrame, key_bytes: Mapping[str, int]
) -> Callable[[DataFrame, list[Reference]], DataFrame]:
    """Choose the plan of the referential checks by the measured size of each key set. ``rows`` are the standardised rows
    before duplicates are left out: what they point to beyond the checked ones does no harm, and only keys are read."""

    def check(newest: DataFrame, refs: list[Reference]) -> DataFrame:
        fit = fitting({ref.column: key_bytes[ref.column] for ref in refs}, SMALL_BYTES)
        small = [ref._replace(keys=F.broadcast(ref.keys)) for ref in refs if ref.column in fit]
        large = [ref for ref in refs if ref.column not in fit]
        if large:
            left = SMALL_BYTES - sum(key_bytes[column] for column in fit)
            newest = references.flag_by_exception(newest, large, stored_missing(lake, name, rows, large, left))
        return references.flag_by_lookup(newest, small)

    return check


def _keys_of(lake: Lakehouse, name: str, key: str) -> DataFrame:
    """The keys of a Silver table; none while it is not there."""
    if not lake.progress.of(SILVER, f"silver_{name}").batch:
        return lake.spark.createDataFrame([], f"{key} string")
    rows = lake.silver(name).read()
    return (history.current(rows) if name == "customers" else rows).select(key)


def _done(lake: Lakehouse, name: str, loaded: DataFrame, checked: DataFrame) -> DataFrame:
    """The report of a stage whose rows are all stored; what it has written for itself is given back."""
    report = _stored_report(lake, name, quality.report(loaded, checked))
    lake.release(f"checked_{name}", f"missing_{name}")
    return report


def _stored_report(lake: Lakehouse, name: str, report: DataFrame) -> DataFrame:
    """The report, kept under the run: later runs neither change nor lose it."""
    lake.reports(name).put(report, "run_id", lake.run_id)
    return lake.reports(name).read().where(F.col("run_id") == lake.run_id).select(*report.columns)


# -- moving the next state into a table --------------------------------------------------------------------------------

def _stage(
    lake: Lakehouse, name: str, batch: Batch, rows: DataFrame, mark: datetime | None, in_place: bool = False
) -> None:
    """Write the next state of the touched buckets (or of the whole table) beside the table, then move it in.

    A first load has no rows to keep, so it goes into the table at once: a run that dies takes the same batches again.
    """
    stored = lake.silver(name).schema
    schema = merged_schema(f"silver_{name}", stored, rows.schema)
    partition = [BUCKET] if BUCKET in rows.columns else []
    if not lake.progress.of(SILVER, f"silver_{name}").batch:
        lake.silver(name).replace(fitted(rows, schema), *partition, in_place=in_place)
        lake.progress.save(SILVER, f"silver_{name}", mark, batch=batch.upto, pending=None, table_schema=schema.json())
        return
    lake.staging(name).replace(fitted(rows, schema), *partition, in_place=in_place)
    lake.progress.save(
        SILVER, f"silver_{name}", mark, pending=batch.upto, staged=True, table_schema=schema.json()
    )
    _finish(lake, name)


def _finish(lake: Lakehouse, name: str) -> None:
    """Move what is staged, if anything is, into the table."""
    state = lake.progress.of(SILVER, f"silver_{name}")
    if not state.staged:
        return
    staged, table = lake.staging(name, state.schema).read(), lake.silver(name)
    if BUCKET in state.schema.names and state.batch:
        table.replace_parts(staged, BUCKET, in_place=True)
    else:  # a table without buckets
        table.replace(staged, *([BUCKET] if BUCKET in state.schema.names else []), in_place=True)
    lake.progress.save(SILVER, f"silver_{name}", batch=state.pending, pending=None, staged=False)
    emptied(lake.spark, lake.staging(name).root)


def _upserted(
    lake: Lakehouse, name: str, key: str, good: DataFrame, updates: tuple[str, ...], small: bool = False
) -> DataFrame:
    """The next state of the buckets that hold keys of ``good``; no other bucket is opened. For a batch that is ``small``
    the stored rows are not moved either."""
    incoming = with_bucket(good, key, lake.buckets)
    if not lake.progress.of(SILVER, f"silver_{name}").batch:
        return incoming
    stored = lake.silver(name).buckets(touched_buckets(incoming))
    return upsert(stored, incoming, [key], updates, "updated_at", source_is_small=small)


def _save(
    lake: Lakehouse, name: str, key: str, batch: Batch, good: DataFrame, updates: tuple[str, ...], mark: datetime | None
) -> None:
    small = bool(batch.after) and broadcast_bytes(good) <= SMALL_BYTES
    in_place = small or lake.buckets <= FEW_BUCKETS
    _stage(lake, name, batch, _upserted(lake, name, key, good, updates, small), mark, in_place)


# -- the four stages ---------------------------------------------------------------------------------------------------

@stage
def process_merchants(lake: Lakehouse) -> DataFrame | None:
    """The last load of the merchants, whole."""
    lake.start()
    _finish(lake, "merchants")
    upto = stored_batches(lake, "merchants")
    if not upto:
        return None
    raw = bronze_batches(lake, "merchants", upto - 1, upto)
    checked = _checked(lake, "merchants", cleaning.clean_merchants(raw), cleaning.merchant_rules())
    lake.quarantine("merchants").replace(quality.bad_rows_first_reason(checked))
    _stage(lake, "merchants", Batch(raw, upto - 1, upto), quality.good_rows(checked), None)
    return _done(lake, "merchants", raw, checked)


@stage
def process_customers(lake: Lakehouse) -> DataFrame | None:
    """Historised customers. Every accepted row is kept as a change, by key bucket and run; the versions of the touched buckets
    are made from all their changes, so rows that arrive late open or correct the version they belong to."""
    batch = _take(lake, "customers")
    if batch is None:
        return None
    checked = _checked(lake, "customers", cleaning.clean_customers(batch.rows), cleaning.customer_rules())
    lake.quarantine("customers").put(quality.bad_rows_first_reason(checked), TAKEN_FROM, batch.after + 1)
    good = with_bucket(quality.good_rows(checked), "customer_id", lake.buckets)
    spec = cleaning.CUSTOMER_HISTORY
    buckets = touched_buckets(good)
    first = not batch.after
    if first:
        kinds = good.select(F.lit(history.NEW).alias("change_type"))
    else:
        kinds = history.classify(lake.silver("customers").buckets(buckets), good.drop(BUCKET), spec)
    _stored_report(lake, "customer_changes", history.change_report(kinds))
    changes = lake.table("silver", "customer_changes", customer_changes_schema(good))
    changes.replace_parts(good.withColumn(TAKEN_FROM, F.lit(batch.after + 1).cast("long")), BUCKET, TAKEN_FROM)
    versions = history.versions_of(changes.buckets(buckets).drop(BUCKET, TAKEN_FROM), spec)
    versions = with_bucket(versions, "customer_id", lake.buckets)
    schema = merged_schema("silver_customers", lake.silver("customers").schema, versions.schema)
    table = lake.table("silver", "customers", schema)
    # made from the changes alone: a run that dies here makes them again
    (table.replace if first else table.replace_parts)(fitted(versions, schema), BUCKET)
    lake.progress.save(
        SILVER, "silver_customers", _mark(lake, "customers", checked), batch=batch.upto, pending=None,
        table_schema=schema.json(),
    )
    return _done(lake, "customers", batch.rows, checked)


def customer_changes_schema(good: DataFrame):
    return good.withColumn(TAKEN_FROM, F.lit(0).cast("long")).schema


@stage
def process_cards(lake: Lakehouse) -> DataFrame | None:
    batch = _take(lake, "cards")
    if batch is None:
        return None
    customer_keys = _keys_of(lake, "customers", "customer_id")
    rows = cleaning.standardise_cards(batch.rows)
    check = _reference_check(lake, "cards", rows, {"card_holder_id": broadcast_bytes(customer_keys)})
    cleaned = cleaning.clean_cards(batch.rows, customer_keys, check)
    checked = _checked(lake, "cards", cleaned, cleaning.card_rules())
    bad = quality.bad_rows_first_reason(checked).drop(*cleaning.CARD_HELPERS)
    lake.quarantine("cards").put(bad, TAKEN_FROM, batch.after + 1)
    good = quality.good_rows(checked).drop(*cleaning.CARD_HELPERS)
    _save(lake, "cards", "card_id", batch, good, cleaning.CARD_UPDATES, _mark(lake, "cards", checked))
    return _done(lake, "cards", batch.rows, checked)


@stage
def process_transactions(lake: Lakehouse) -> DataFrame | None:
    batch = _take(lake, "transactions")
    if batch is None:
        return None
    keys = {
        "customer_id": _keys_of(lake, "customers", "customer_id"), "card_id": _keys_of(lake, "cards", "card_id"),
        "merchant_id": _keys_of(lake, "merchants", "merchant_id"),
    }
    rows = cleaning.standardise_transactions(batch.rows)
    sizes = {column: broadcast_bytes(known) for column, known in keys.items()}
    check = _reference_check(lake, "transactions", rows, sizes)
    cleaned = cleaning.clean_transactions(batch.rows, *keys.values(), check)
    checked = _checked(lake, "transactions", cleaned, cleaning.transaction_rules())
    bad = quality.bad_rows(checked).drop(*cleaning.TRANSACTION_HELPERS)
    lake.quarantine("transactions").put(bad, TAKEN_FROM, batch.after + 1)
    good = quality.good_rows(checked).drop("is_negative_amount_valid", *cleaning.TRANSACTION_HELPERS)
    mark = _mark(lake, "transactions", checked)
    _save(lake, "transactions", "transaction_id", batch, good, cleaning.TRANSACTION_UPDATES, mark)
    return _done(lake, "transactions", batch.rows, checked)


def bronze_to_silver(lake: Lakehouse) -> dict[str, DataFrame | None]:
    """Run all four stages in the order their references need; returns the data-quality reports."""
    return {
        "merchants": process_merchants(lake),
        "customers": process_customers(lake),
        "cards": process_cards(lake),
        "transactions": process_transactions(lake),
    }


# -- Gold --------------------------------------------------------------------------------------------------------------

def build_spend_summary(lake: Lakehouse) -> None:
    gold.build_spend(lake, SMALL_BYTES)


def build_risk_summary(lake: Lakehouse) -> None:
    gold.build_risk(lake, SMALL_BYTES)


def build_segmentation_summary(lake: Lakehouse, as_of: Column | None = None) -> None:
    gold.build_segmentation(lake, SMALL_BYTES, as_of)


def silver_to_gold(lake: Lakehouse, as_of: Column | None = None) -> None:
    """Spend comes first: the other two marts read it."""
    build_spend_summary(lake)
    build_risk_summary(lake)
    build_segmentation_summary(lake, as_of)


def run_pipeline(
    spark: SparkSession, warehouse: str, landing: str, as_of: Column | None = None, buckets: int = 16
) -> dict[str, DataFrame | None]:
    """One complete run over whatever has landed since the last one."""
    lake = Lakehouse(spark, warehouse, buckets)
    ingest_to_bronze(lake, landing)
    reports = bronze_to_silver(lake)
    silver_to_gold(lake, as_of)
    return reports
