"""Operators on hand-made rows: the awkward cases that the given tables do not hold."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.business import amount_sign_ok, spend_segment, utilization_bucket
from ledgerline.functions.text import accepted_currency, card_network, currency_code, tidy_currency
from ledgerline.operators import history, quality, references, watermark
from ledgerline.operators.dedup import newest_per_key, top_per_group, total_order
from ledgerline.operators.history import History
from ledgerline.operators.quality import Rule
from ledgerline.operators.ranking import best
from ledgerline.operators.references import Reference
from ledgerline.operators.upsert import touched_partitions, upsert
from ledgerline.plans import cleaning, marts

DAY = datetime(2024, 1, 1)


def values(df):
    return [tuple(row) for row in df.collect()]


# -- functions ---------------------------------------------------------------------------------------------------------

def test_currency(rows):
    df = rows("c string", ("A$",), (" yen",), ("₹",), ("THB",), ("xyz",), ("USDT",), ("£5",), (None,))
    code = currency_code(tidy_currency("c"))
    assert values(df.select(code, F.coalesce(accepted_currency(code), F.lit(False)))) == [
        ("USD", True), ("JPY", True), ("INR", True), ("THB", True), ("XYZ", False), ("USD", True), ("GBP", True),
        (None, False),
    ]


def test_card_network(rows):
    df = rows("name string, brand string", ("Hdfc Rupay Select", "X"), ("VISA gold", "X"), ("plain", "Amex"))
    assert values(df.select(card_network(F.lower("name"), F.col("brand")))) == [("RuPay",), ("Visa",), ("Amex",)]


def test_amount_sign(rows):
    df = rows("kind string, amount double", ("Refund", -5.0), ("Refund", 0.0), ("Purchase", 0.0), (None, 5.0),
              ("Purchase", -1.0), ("Purchase", None))
    assert [r[0] for r in values(df.select(amount_sign_ok(F.col("kind"), F.col("amount"))))] == [
        True, False, True, False, False, False]


def test_buckets(rows):
    df = rows("v double", (10.0,), (10.01,), (120.0,), (None,))
    assert [r[0] for r in values(df.select(utilization_bucket(F.col("v"))))] == ["0-10%", "10-30%", "70-100%", "70-100%"]
    df = rows("v double", (5000.0,), (5000.01,), (60000.0,), (60000.5,), (None,))
    assert [r[0] for r in values(df.select(spend_segment(F.col("v"))))] == [
        "Low", "Medium", "High", "Very High", "Unknown"]


# -- dedup -------------------------------------------------------------------------------------------------------------

def test_keys_are_compared_after_standardising_and_keyless_rows_stay(rows):
    raw = rows("id string, v int, updated_at timestamp", ("C1", 1, DAY), (" C1", 2, DAY.replace(day=2)),
               (None, 3, DAY), (None, 3, DAY))

    def trim(df):
        return df.withColumn("id", F.trim("id"))

    kept = newest_per_key(raw, "id", trim, ["updated_at"])
    assert sorted(values(kept.select("id", "v")), key=str) == [("C1", 2), (None, 3), (None, 3)]
    assert values(newest_per_key(raw, "id", trim, ["updated_at"], keep_keyless=False).select("v")) == [(2,)]


def test_ties_do_not_depend_on_partitioning(rows):
    data = [("k", DAY, f"v{i:02d}") for i in range(40)]
    for parts in (1, 7):
        df = rows("id string, updated_at timestamp, v string", *data).repartition(parts)
        assert values(top_per_group(df, ["id"], total_order(df, "id", ["updated_at"])).select("v")) == [("v00",)]


def test_a_hot_key_is_cut_down_before_the_shuffle(rows):
    df = rows("id string, updated_at timestamp", ("a", DAY))
    plan = top_per_group(df, ["id"], total_order(df, "id", ["updated_at"]))._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[shuffle:]


# -- quality -----------------------------------------------------------------------------------------------------------

def test_a_rule_that_is_null_fails(rows):
    df = rows("a int, b string", (1, "x"), (None, "x"), (1, None), (None, None))
    checked = quality.assess(df, [Rule("no a", F.col("a").isNotNull()), Rule("bad b", F.col("b").rlike("x"))])
    assert values(quality.good_rows(checked)) == [(1, "x")]
    assert values(quality.bad_rows(checked).select("failed_reasons")) == [(["no a"],), (["bad b"],), (["no a", "bad b"],)]
    assert [r[-1] for r in values(quality.bad_rows_first_reason(checked))] == ["no a", "bad b", "no a"]


def test_report_of_nothing(rows):
    empty = quality.assess(rows("a int", (1,)).where("a > 1"), [Rule("r", F.col("a") > 0)])
    assert values(quality.report(empty, empty)) == [(0, 0, 0, 0, 0, 0.0, 0.0)]


# -- references --------------------------------------------------------------------------------------------------------

def test_both_reference_plans_agree_on_a_hot_key(spark, rows):
    hot = [(i, "hot" if i % 3 else f"c{i}", "m1" if i % 2 else None) for i in range(300)]
    df = rows("id int, c string, m string", *hot)
    refs = [
        Reference("c", rows("k string", ("hot",), *[(f"c{i}",) for i in range(0, 150, 3)]), "c_known"),
        Reference("m", rows("k string", ("m2",)), "m_known"),
    ]
    looked_up = references.flag_by_lookup(df, refs)
    excepted = references.flag_by_exception(df, refs, references.missing_keys(df, refs))
    assert sorted(values(looked_up)) == sorted(values(excepted)) != []
    expected = [(i, c == "hot" or i < 150, False) for i, c, _ in hot]
    assert sorted(values(looked_up.select("id", "c_known", "m_known"))) == expected


# -- upsert ------------------------------------------------------------------------------------------------------------

def test_upsert(rows):
    target = rows("k string, fixed string, free string", ("a", "f1", "v1"), ("b", "f2", "v2"))
    source = rows("k string, fixed string, free string", ("b", "f9", None), ("c", "f3", "v3"))
    assert sorted(values(upsert(target, source, ["k"], ["free"]))) == [
        ("a", "f1", "v1"), ("b", "f2", None), ("c", "f3", "v3")]
    once = upsert(target, source, ["k"])
    assert sorted(values(once)) == sorted(values(upsert(once, source, ["k"])))


def test_touched_partitions(rows):
    target = rows("k string, p int", ("a", 1), ("b", 2), ("c", 3))
    source = rows("k string, p int", ("b", 7), ("d", 8), ("e", None))
    assert sorted(values(touched_partitions(target, source, ["k"], "p")), key=str) == [(2,), (7,), (8,), (None,)]


# -- history -----------------------------------------------------------------------------------------------------------

SPEC = History("id", "updated_at", tracked=["city"], overwritten=["name"])
SCHEMA = "id string, city string, name string, updated_at timestamp"


def later(days):
    return DAY.replace(day=1 + days)


@pytest.fixture
def past(rows):
    return history.first_load(rows(SCHEMA, *[(k, "pune", "n", later(5)) for k in "abcdef"]), SPEC)


def test_every_kind_of_change(rows, past):
    incoming = rows(
        SCHEMA, ("a", "pune", "n2", later(6)), ("b", "delhi", "n", later(6)), ("c", "delhi", "n2", later(6)),
        ("d", "pune", "n", later(6)), ("e", "delhi", "n", later(4)), ("z", "agra", "n", later(6)),
    )
    kinds = dict(values(history.classify(past, incoming, SPEC).select("id", "change_type")))
    assert kinds == {"a": "type1", "b": "type2", "c": "type2", "d": "unchanged", "e": "stale", "z": "new"}
    after = history.apply_changes(past, incoming, SPEC)
    got = sorted(values(after.select("id", "city", "name", "updated_at", "valid_from", "valid_till", "is_current")), key=str)
    five, six = later(5), later(6)
    assert got == sorted([
        ("a", "pune", "n2", five, five, None, True),
        ("b", "pune", "n", five, five, six, False), ("b", "delhi", "n", six, six, None, True),
        ("c", "pune", "n", five, five, six, False), ("c", "delhi", "n2", six, six, None, True),
        ("d", "pune", "n", five, five, None, True), ("e", "pune", "n", five, five, None, True),
        ("f", "pune", "n", five, five, None, True), ("z", "agra", "n", six, six, None, True),
    ], key=str)
    again = history.apply_changes(after, incoming, SPEC)
    assert sorted(values(again), key=str) == sorted(values(after), key=str)


def test_null_to_value_is_a_change_and_null_to_null_is_not(rows):
    past = history.first_load(rows(SCHEMA, ("a", None, "n", DAY), ("b", None, "n", DAY)), SPEC)
    incoming = rows(SCHEMA, ("a", "pune", "n", later(3)), ("b", None, "n", later(3)))
    assert dict(values(history.classify(past, incoming, SPEC).select("id", "change_type"))) == {
        "a": "type2", "b": "unchanged"}


def test_history_invariants_over_many_batches(rows):
    table = None
    for batch in range(6):
        incoming = rows(SCHEMA, *[(f"k{i}", f"city{(i * batch) % 3}", f"n{(i + batch) % 2}", later(batch + 1))
                                  for i in range(batch, 8)])
        table = history.first_load(incoming, SPEC) if table is None else history.apply_changes(table, incoming, SPEC)
    state = values(table.select("id", "valid_from", "valid_till", "is_current"))
    for key in {row[0] for row in state}:
        versions = sorted(row[1:] for row in state if row[0] == key)
        assert [current for _, _, current in versions] == [False] * (len(versions) - 1) + [True]
        for (_, till, _), (following, _, _) in zip(versions, versions[1:]):
            assert till == following
        assert versions[-1][1] is None


# -- watermarks --------------------------------------------------------------------------------------------------------

def test_marks_never_move_back(spark, rows):
    meta = watermark.seed(spark)
    assert meta.count() == 11 and watermark.mark_value(meta, "bronze_to_silver", "silver_cards") is None
    assert watermark.mark_value(meta, "no", "such") is None
    for stamp in (later(3), later(1), None):
        batch = rows("updated_at timestamp", (stamp,))
        meta = watermark.advance(meta, watermark.newest(batch, "bronze_to_silver", "silver_cards"))
    assert watermark.mark_value(meta, "bronze_to_silver", "silver_cards") == later(3)
    assert meta.count() == 11


def test_since_is_strict(rows):
    df = rows("updated_at timestamp", (later(1),), (later(2),), (None,))
    assert values(watermark.since(df, later(1))) == [(later(2),)]
    assert watermark.since(df, None).count() == 3


# -- marts -------------------------------------------------------------------------------------------------------------

def test_best_breaks_ties_by_name_with_nulls_last(rows):
    df = rows("g int, v string, n int", (1, "b", 2), (1, "a", 2), (1, "c", 1), (2, None, 5), (2, "x", 5), (3, None, 5),
              (3, "x", 1))
    assert sorted(values(df.groupBy("g").agg(best(F.col("v"), F.col("n"))))) == [(1, "a"), (2, "x"), (3, None)]


def transactions(rows, *entries):
    schema = ("transaction_id string, customer_id string, merchant_id string, amount double, transaction_type string, "
              "transaction_timestamp timestamp, transaction_status string")
    return rows(schema, *[(f"t{i}", "c", *entry, "Successful") for i, entry in enumerate(entries)])


def test_trend_counts_rows_and_flags_anomalies(rows):
    merchants = rows("merchant_id string, merchant_category string", ("m", "Food"), ("n", "Air"))
    df = transactions(
        rows,
        ("m", 10.0, "Purchase", datetime(2024, 1, 5)),
        ("m", 20.0, "Emi Conversion", datetime(2024, 2, 5)),
        ("n", 50.0, "Purchase", datetime(2024, 5, 5)), ("m", 50.0, "Purchase", datetime(2024, 5, 6)),
        ("m", -3.0, "Refund", datetime(2024, 5, 7)), ("unknown", -4.0, "Refund", datetime(2024, 6, 7)),
    )
    got = {r["month"].month: r for r in marts.spend_summary(df, merchants).collect()}
    assert set(got) == {1, 2, 5}                                  # June holds a refund only
    may = got[5]
    assert (may["total_spend"], may["transaction_count"], may["avg_transaction_amount"]) == (100.0, 2, 50.0)
    assert (may["prev_month_spend"], may["mom_spend_change_pct"], may["trailing_3mo_avg_spend"]) == (20.0, 400.0, 15.0)
    assert may["is_anomalous_spend"] and may["top_merchant_category"] == "Air" and may["total_refunded"] == 3.0
    january = got[1]
    assert (january["prev_month_spend"], january["trailing_3mo_avg_spend"], january["is_anomalous_spend"]) == (
        None, None, False)


def test_risk_flag_is_unknown_without_a_grade(rows):
    customers = rows("customer_id string, risk_grade string, customer_status string, is_current boolean",
                     ("c", None, "Active", True), ("d", None, "Dormant", True), ("e", "Low", "Active", False))
    cards = rows("card_holder_id string, card_id string, credit_limit double, card_status string",
                 ("c", "k", 100.0, "Lost"))
    spend = rows("customer_id string, month date, total_spend double", ("c", date(2024, 1, 1), 90.0),
                 ("c", date(2024, 2, 1), 5.0))
    got = {r["customer_id"]: r for r in marts.risk_summary(customers, cards, spend).collect()}
    assert set(got) == {"c", "d"}
    assert (got["c"]["credit_utilization_pct"], got["c"]["is_high_risk_flag"]) == (5.0, None)
    assert (got["d"]["credit_utilization_pct"], got["d"]["is_high_risk_flag"]) == (0.0, True)


def test_card_preferences_equal_the_single_counts(rows):
    cards = rows("card_holder_id string, card_id string, card_holder_type string, card_rewards_category string",
                 *[(f"h{i % 5}", f"k{i}", ["A", "B", None][i % 3], ["x", "y"][i * i % 2]) for i in range(60)],
                 *[("hot", f"q{i}", "A" if i % 4 else "B", f"r{i % 7}") for i in range(400)])
    both = marts.card_preferences(cards)
    single = marts.most_common(cards, "card_holder_type", "primary_card_type").join(
        marts.most_common(cards, "card_rewards_category", "preferred_rewards_category"), "customer_id")
    assert sorted(values(both), key=str) == sorted(values(single.select(both.columns)), key=str)


def test_unparsable_dates_become_null(rows):
    names = [f.name for f in cleaning_record().fields]
    record = {name: "x" for name in names} | {"total_cards_issued": 1, "joining_date": "soon", "updated_at": "never"}
    raw = rows(cleaning_record(), tuple(record[name] for name in names))
    got = cleaning.clean_customers(raw).first()
    assert got["joining_date"] is None and got["updated_at"] is None and got["customer_name"] == "X"


def cleaning_record():
    from ledgerline.schemas import CUSTOMER_RECORD

    return CUSTOMER_RECORD
