"""Cleaning, validation, upsert and balance operators on small frames."""

from datetime import datetime
from decimal import Decimal

import pytest

from ledger_sync import DAG, SCRIPT, SCRIPT_CAPPED, Limits, Preset
from ledger_sync.functions.rules import amount_in_range, is_contact
from ledger_sync.operators.balance import (
    advance_watermark, credit_debit_totals, net_changes, refresh_balances, transaction_summaries,
)
from ledger_sync.operators.clean import clean_transactions, clean_users
from ledger_sync.operators.merge import change_classes, matched, upsert
from ledger_sync.operators.validate import (
    accepted, check_transactions, check_users, orphan_userids, orphans, without_orphans,
)
from ledger_sync.schemas import REASON
from pyspark.sql import functions as F

USER = "userid bigint, name string, contact string, balance double"
TXN = (
    "transactionid bigint, userid bigint, amount double, type string, date timestamp_ntz, "
    "status string, method string"
)
STORED = (
    "transactionid int, userid int, amount decimal(10,2), type string, date timestamp_ntz, "
    "status string, method string"
)
DATE = datetime(2024, 3, 5, 6, 7, 8)


def test_clean_users(spark):
    df = spark.createDataFrame(
        [(71, "Greta", "5550100471", 8.25), (72, None, "none given", None)], USER
    )
    out = clean_users(df, SCRIPT, ["userid"]).orderBy("userid").collect()
    assert [r["name"] for r in out] == ["Greta", "unknown"]
    assert [r["contact"] for r in out] == ["5550100471", "not provided"]
    assert [r["balance"] for r in out] == [8.25, 0.0]
    dropped = clean_users(df, DAG, ["userid"]).collect()
    assert [r["userid"] for r in dropped] == [71]


def test_clean_transactions(spark):
    """T1: the negative first row of id 2 hides its second row."""
    df = spark.createDataFrame(
        [
            (15, 71, 3.75, "debit", DATE, "pending", "cheque"),
            (16, 72, -0.5, "credit", datetime(2024, 5, 2), "failed", None),
            (16, 73, 9.0, None, None, "completed", "voucher"),
        ],
        TXN,
    )
    out = clean_transactions(df, SCRIPT, ["userid"]).collect()
    assert [tuple(r) for r in out] == [(15, 71, 3.75, "debit", DATE, "pending", "cheque")]


def test_a_bad_first_row_hides_a_good_later_one(spark):
    df = spark.createDataFrame(
        [(1, n, a, "credit", None, None, None) for n, a in enumerate([-5.0, 5.0])], TXN
    )
    assert clean_transactions(df, SCRIPT, ["userid"]).isEmpty()


def test_amounts(spark):
    """T2 and T3: NaN and null are no amounts, although NaN >= 0 holds in Spark."""
    values = [float("nan"), None, -0.01, 0.0, 10000.0, 10000.01, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "amount double")
    kept = [r[0] for r in df.where(amount_in_range(F.col("amount"))).collect()]
    assert kept == [0.0, 10000.0, 10000.01, float("inf")]
    capped = [r[0] for r in df.where(amount_in_range(F.col("amount"), 10000.0)).collect()]
    assert capped == [0.0, 10000.0]


@pytest.mark.parametrize(("preset", "kept"), [(SCRIPT, 3), (SCRIPT_CAPPED, 2), (DAG, 2)])
def test_presets_cap_amounts(spark, preset, kept):
    df = spark.createDataFrame(
        [(i, 1, a, None, None, None, None) for i, a in enumerate([0.0, 10000.0, 10001.0])], TXN
    )
    out = clean_transactions(df, preset, ["userid"])
    assert out.count() == kept
    assert {(r["type"], r["status"], r["method"]) for r in out.collect()} == {
        ("unknown", "unknown", "not specified")
    }


def test_contacts(spark):
    cases = {
        "1234567890": True, "0123456789": True, "123456789": False, "12345678901": False,
        "1234567890 ": False, "1234567890\n": True, "1234567890\r": False, "12345-6789": False,
        "٠١٢٣٤٥٦٧٨٩": True, "𝟎𝟏𝟐𝟑𝟒𝟓𝟔𝟕𝟖𝟗": True, None: False,
    }
    df = spark.createDataFrame([(c,) for c in cases], "contact string")
    out = df.select("contact", is_contact(F.col("contact")).alias("ok")).collect()
    assert {r["contact"]: r["ok"] for r in out} == cases


def test_unknown_policy():
    with pytest.raises(ValueError, match="contact_policy"):
        Preset("odd", contact_policy="keep")


def test_user_constraints(spark):
    df = spark.createDataFrame(
        [
            (1, "n" * 100, "c" * 50, 99999999.994),
            (None, "a", "b", 0.0),
            (2**31, "a", "b", 0.0),
            (2, "n" * 101, "b", 0.0),
            (3, "a", "c" * 51, 0.0),
            (4, "a", "b", 99999999.995),
            (5, "a", "b", float("inf")),
            (6, None, None, None),
        ],
        USER,
    )
    out = check_users(df).collect()
    assert [r[REASON] for r in out] == [
        None, "userid is null", "userid is out of range", "name is too long",
        "contact is too long", "balance is out of range", "balance is out of range", None,
    ]
    assert out[0]["balance"] == Decimal("99999999.99")
    assert accepted(check_users(df, Limits(key_type="bigint"))).count() == 3


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, "a", "b", 2.675), (2, "a", "b", -2.675)], USER)
    out = accepted(check_users(df)).orderBy("userid").collect()
    assert [r["balance"] for r in out] == [Decimal("2.68"), Decimal("-2.68")]


def test_transaction_constraints(spark):
    ok = (1, 1, 1.0, "t", None, "s", "m")
    bad = [
        (None, 1, 1.0, "t", None, "s", "m"), (2**31, 1, 1.0, "t", None, "s", "m"),
        (2, -(2**31) - 1, 1.0, "t", None, "s", "m"), (3, 1, 1e8, "t", None, "s", "m"),
        (4, 1, 1.0, "t" * 51, None, "s", "m"), (5, 1, 1.0, "t", None, "s" * 51, "m"),
        (6, 1, 1.0, "t", None, "s", "m" * 51), (7, None, 1.0, "t", None, "s", "m"),
    ]
    out = check_transactions(spark.createDataFrame([ok, *bad], TXN)).collect()
    assert [r[REASON] for r in out] == [
        None, "transactionid is null", "transactionid is out of range", "userid is out of range",
        "amount is out of range", "type is too long", "status is too long", "method is too long",
        None,
    ]
    assert out[0].asDict().keys() >= {"transactionid", "amount", "userid"}


def test_orphans(spark):
    """A third and more of the rows belong to one unknown user; null refers to nobody."""
    txns = spark.createDataFrame(
        [(i, 9 if i % 2 else i % 3) for i in range(60)] + [(60, None)],
        "transactionid int, userid int",
    )
    users = spark.createDataFrame([(0,), (1,)], "userid int")
    more = spark.createDataFrame([(2,)], "userid int")
    ids = orphan_userids(txns, users, more)
    assert [r[0] for r in ids.collect()] == [9]
    assert orphans(txns, ids).count() == 30
    left = without_orphans(txns, ids)
    assert left.count() == 31 and left.where("userid is null").count() == 1


def test_upsert_stores_null_over_a_value(spark):
    """T4: the incoming row wins whole."""
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, name string, n int")
    batch = spark.createDataFrame([(2, None, None), (3, "c", 3)], "k int, name string, n int")
    out = {tuple(r) for r in upsert(target, batch, "k").collect()}
    assert out == {(1, "a", 1), (2, None, None), (3, "c", 3)}


def test_change_classes(spark):
    schema = "k int, name string"
    target = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d"), (5, None)], schema)
    batch = spark.createDataFrame([(2, None), (3, "x"), (4, None), (5, "e"), (6, None)], schema)
    out = {r["k"]: r["change"] for r in change_classes(target, batch, "k").collect()}
    assert out == {
        1: "absent", 2: "unchanged", 3: "update", 4: "update", 5: "update", 6: "insert",
    }
    pairs = {(r["k"], r["name"], r["changed"]) for r in matched(target, batch, "k").collect()}
    assert pairs == {(2, None, False), (3, "c", True), (4, "d", True), (5, None, True)}


def test_only_completed_credits_and_debits_after_the_mark_count(spark):
    day, mark = datetime(2024, 8, 21), datetime(2024, 8, 20)
    cases = [
        (1, 1, 10, "credit", day, "completed"), (2, 1, 4, "debit", day, "completed"),
        (3, 1, 99, "CREDIT", day, "completed"), (4, 1, 99, "refund", day, "completed"),
        (5, 1, 99, "credit", day, "pending"), (6, 1, 99, "credit", mark, "completed"),
        (7, 1, 99, "credit", None, "completed"), (8, None, 99, "credit", day, "completed"),
        (9, 3, 5, "refund", day, "completed"),
    ]
    txns = spark.createDataFrame(
        [(i, u, Decimal(a), t, d, s, None) for i, u, a, t, d, s in cases], STORED
    )
    users = spark.createDataFrame(
        [(1, Decimal(1)), (2, Decimal(2)), (3, Decimal(3))], "userid int, balance decimal(10,2)"
    )
    out = {r["userid"]: r["balance"] for r in refresh_balances(users, txns, mark).collect()}
    assert out == {1: Decimal(7), 2: Decimal(2), 3: Decimal(3)}
    totals = transaction_summaries(txns, mark).where("userid = 3").collect()
    assert [(r["total_credits"], r["total_debits"]) for r in totals] == [(0, 0)]
    unmarked = refresh_balances(users, txns, None)
    assert {r["balance"] for r in unmarked.collect()} == {1, 2, 3}


def test_summaries_add_exactly(spark):
    df = spark.createDataFrame([(1, Decimal("0.10"))] * 30, "userid int, amount decimal(10,2)")
    (row,) = credit_debit_totals(df, "userid", F.lit("credit"), F.col("amount")).collect()
    assert row["total_credits"] == Decimal("3.00")


def test_a_transaction_that_moves_to_another_user(spark):
    old = [(1, 1, Decimal(5), "credit", None, "completed", None)]
    new = [(1, 2, Decimal(7), "credit", None, "completed", None)]
    changes = net_changes(spark.createDataFrame(new, STORED), spark.createDataFrame(old, STORED))
    assert {r["userid"]: r["net"] for r in changes.collect()} == {1: -5, 2: 7}


def test_watermark_advances_on_the_control_row_only(spark):
    old, run = datetime(2024, 8, 20), datetime(2024, 9, 1)
    control = spark.createDataFrame([(1, old), (2, old)], "id int, last_update_date timestamp_ntz")
    out = {r["id"]: r["last_update_date"] for r in advance_watermark(control, run).collect()}
    assert out == {1: run, 2: old}
    now = advance_watermark(control, None).where("id = 1").first()["last_update_date"]
    assert now > run
