"""Random extracts loaded by the engine and by a plain model of the rules, side by side."""

from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, Phase, given, settings, strategies as st

from ledger_sync import PRESETS
from ledger_sync.plans.load import run_batch
from ledger_sync.plans.warehouse import Warehouse
from tests.conftest import TXN_HEADER, USERS_HEADER

MISSING = ("", "NA", "null")
MARKS = [datetime(2024, 8, 20), datetime(2024, 8, 23), datetime(2024, 8, 26)]

ids = st.integers(0, 6).map(str)
name = st.sampled_from(["Ann", "Ben", *MISSING])
contact = st.sampled_from(["1234567890", "0123456789", "123", "12345678901", *MISSING])
amount = st.sampled_from(["0", "1.005", "10", "9999.99", "10000", "10000.01", "-5", *MISSING, "NaN"])
kind = st.sampled_from(["credit", "debit", "CREDIT", *MISSING])
date = st.one_of(
    st.integers(18, 27).map(lambda d: f"2024-08-{d} 00:00:00"),
    st.sampled_from(["2024-08-21", "bad", *MISSING]),
)
status = st.sampled_from(["completed", "completed", "pending", *MISSING])
method = st.sampled_from(["card", "UPI", *MISSING])
users = st.lists(st.tuples(ids, name, contact, amount), max_size=8)
txns = st.lists(
    st.tuples(st.integers(0, 9).map(str), ids, amount, kind, date, status, method), max_size=12
)


def cents(text):
    return Decimal(text).quantize(Decimal("0.01"), ROUND_HALF_UP)


def value(text):
    return None if text in (*MISSING, "NaN") else text


def first_by_id(rows):
    first = {}
    for row in rows:
        first.setdefault(int(row[0]), [value(f) for f in row[1:]])
    return first


def form_of(txn_rows):
    """The form of an extract is that of its first date."""
    first = next((row[4] for row in txn_rows if value(row[4])), "")
    return "%Y-%m-%d" if first == "2024-08-21" else "%Y-%m-%d %H:%M:%S"


def moment(text, form):
    try:
        return datetime.strptime(text or "", form)
    except ValueError:
        return None


class Model:
    """Dictionaries in place of tables."""

    def __init__(self, preset):
        self.preset, self.mark = preset, MARKS[0]
        self.users, self.txns, self.waiting = {}, {}, {}

    def load(self, user_rows, txn_rows, run_ts):
        for key, (name, contact, balance) in first_by_id(user_rows).items():
            valid = contact is not None and len(contact) == 10
            if valid or self.preset.contact_policy == "replace":
                self.users[key] = [
                    name or "unknown", contact if valid else "not provided", cents(balance or "0"),
                ]
        for key, (user, amount, kind, date, status, method) in first_by_id(txn_rows).items():
            cap = self.preset.max_amount
            if amount is None or float(amount) < 0 or (cap and float(amount) > cap):
                continue
            self.waiting[key] = (
                cents(amount), kind or "unknown", moment(date, form_of(txn_rows)), status or "unknown",
                method or "not specified", int(user),
            )
        for key, row in list(self.waiting.items()):  # the others wait on, for a load with their user
            if row[-1] in self.users:
                self.txns[key] = self.waiting.pop(key)
        for amount, kind, date, status, _, user in self.txns.values():
            if status == "completed" and date is not None and date > self.mark:
                self.users[user][2] += {"credit": amount, "debit": -amount}.get(kind, 0)
        self.mark = run_ts


@pytest.mark.parametrize("preset", PRESETS.values(), ids=PRESETS)
def test_two_loads(spark, tmp_path_factory, preset):
    @settings(
        max_examples=3, deadline=None, suppress_health_check=list(HealthCheck),
        phases=[Phase.explicit, Phase.reuse, Phase.generate],  # a load takes seconds: no shrinking
    )
    @given(st.lists(st.tuples(users, txns), min_size=2, max_size=2))
    def check(loads):
        folder = tmp_path_factory.mktemp("model")
        warehouse, model = Warehouse(spark, str(folder / "wh")).init(), Model(preset)
        for i, (user_rows, txn_rows) in enumerate(loads):
            paths = []
            for label, header, rows in (("u", USERS_HEADER, user_rows), ("t", TXN_HEADER, txn_rows)):
                path = folder / f"{label}{i}.csv"
                path.write_text("\n".join([header, *map(",".join, rows)]) + "\n")
                paths.append(str(path))
            run_batch(spark, *paths, warehouse, preset=preset, run_ts=MARKS[i + 1])
            model.load(user_rows, txn_rows, MARKS[i + 1])
        stored = {r[0]: list(r[1:]) for r in warehouse.users().collect()}
        assert stored == model.users
        assert {r[0]: tuple(r[1:]) for r in warehouse.transactions().collect()} == model.txns

    check()
