"""Properties that hold for any input."""

from datetime import datetime, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings, strategies as st

from ledger_sync.operators.balance import (
    apply_net_changes, credit_debit_totals, net_changes, refresh_balances,
)
from ledger_sync.operators.dedup import keep_first
from ledger_sync.operators.merge import matched, upsert
from ledger_sync.operators.validate import repeated_keys
from pyspark.sql import functions as F

SCHEMA = (
    "transactionid int, userid int, amount decimal(10,2), type string, date timestamp_ntz, "
    "status string"
)
cents = st.integers(0, 10**7).map(lambda n: Decimal(n).scaleb(-2))
transaction = st.tuples(
    st.integers(0, 30),
    st.one_of(st.none(), st.integers(0, 4)),
    cents,
    st.sampled_from(["credit", "debit", "refund", None]),
    st.one_of(st.none(), st.integers(0, 9).map(lambda d: datetime(2024, 8, 16) + timedelta(d))),
    st.sampled_from(["completed", "pending", None]),
)
tables = st.lists(transaction, max_size=25, unique_by=lambda r: r[0])
few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def net(rows, mark=None):
    total = {}
    for _, user, amount, kind, date, status in rows:
        if status == "completed" and user is not None:
            if mark is None or (date is not None and date > mark):
                sign = {"credit": 1, "debit": -1}.get(kind, 0)
                total[user] = total.get(user, 0) + sign * amount
    return total


@few
@given(tables, tables)
def test_upsert(spark, old, new):
    target, batch = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    once = upsert(target, batch, "transactionid")
    expected = {r[0]: r for r in old} | {r[0]: r for r in new}
    assert {tuple(r) for r in once.collect()} == set(expected.values())
    assert repeated_keys(once, "transactionid").isEmpty()
    twice = upsert(once, batch, "transactionid", batch_rows=len(new))
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


@few
@given(tables)
def test_refresh_adds_credits_and_takes_debits(spark, rows):
    mark = datetime(2024, 8, 20)
    users = spark.createDataFrame(
        [(u, Decimal(100)) for u in range(6)], "userid int, balance decimal(12,2)"
    )
    txns = spark.createDataFrame(rows, SCHEMA)
    out = {r["userid"]: r["balance"] for r in
           refresh_balances(users, txns, mark, "decimal(22,2)").collect()}
    expected = net(rows, mark)
    assert out == {u: 100 + expected.get(u, 0) for u in range(6)}
    totals = credit_debit_totals(txns, "userid", F.col("type"), F.col("amount")).collect()
    moved = sum(r["total_credits"] - r["total_debits"] for r in totals)
    signs = {"credit": 1, "debit": -1}
    assert moved == sum(r[2] * signs.get(r[3], 0) for r in rows)


@few
@given(tables, tables)
def test_net_changes_equal_a_recompute(spark, old, new):
    users = spark.createDataFrame([(u, Decimal(0)) for u in range(5)], "userid int, balance decimal(22,2)")
    stored, batch = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    before = apply_net_changes(users, net_changes(stored), "decimal(22,2)")
    changes = net_changes(batch, matched(stored, batch, "transactionid"))
    after = apply_net_changes(before, changes, "decimal(22,2)")
    merged = ({r[0]: r for r in old} | {r[0]: r for r in new}).values()
    expected = net(merged)
    assert {r["userid"]: r["balance"] for r in after.collect()} == {
        u: expected.get(u, 0) for u in range(5)
    }


@few
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 9))
def test_first_row_at_any_partition_count(spark, keys, parts):
    df = spark.createDataFrame(list(enumerate(keys)), "n int, k int").repartition(parts)
    first = {}
    for n, k in enumerate(keys):
        first.setdefault(k, n)
    assert {r["k"]: r["n"] for r in keep_first(df, ["k"], ["n"]).collect()} == first
