"""Loads of whole batches: golden balances, versions, policies and traps."""

from datetime import datetime
from decimal import Decimal

import pytest

from ledger_sync import DAG, SCRIPT
from ledger_sync.operators.validate import ORPHAN, repeated_keys
from ledger_sync.plans import load, warehouse as warehouse_module
from ledger_sync.plans.load import BatchRejected, run_batch
from ledger_sync.plans.warehouse import Conflict, Warehouse, create_file, list_names
from tests import golden
from tests.golden import balances, money

RUN_1, RUN_2 = datetime(2024, 9, 1), datetime(2024, 9, 2)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh")).init()


@pytest.fixture
def full(users_csv, txns_csv):
    return users_csv(*golden.FULL_USERS), txns_csv(*golden.FULL_TXNS)


@pytest.fixture
def increment(users_csv, txns_csv):
    return users_csv(*golden.INCREMENT_USERS), txns_csv(*golden.INCREMENT_TXNS)


def test_full_extract(spark, warehouse, full):
    report = run_batch(spark, *full, warehouse, run_ts=RUN_1, policy="fail")
    assert balances(warehouse) == money(golden.FULL_BALANCES)
    assert warehouse.transactions().count() == 8
    assert warehouse.watermark() == RUN_1
    assert (report.users.read, report.users.deduped, report.users.inserted) == (8, 7, 7)
    assert (report.transactions.read, report.transactions.accepted) == (8, 8)


def test_second_run_of_the_same_files_resets_balances(spark, warehouse, full):
    """T5: the sent balance replaces the stored one and no date is newer than the mark."""
    run_batch(spark, *full, warehouse, run_ts=RUN_1)
    report = run_batch(spark, *full, warehouse, run_ts=RUN_2)
    assert balances(warehouse) == money(golden.FILE_BALANCES)
    assert (report.transactions.updated, report.transactions.inserted) == (8, 0)
    assert (report.users.updated, report.users.inserted) == (7, 0)
    assert warehouse.transactions().count() == 8


def test_second_run_with_net_changes_is_harmless(spark, warehouse, full):
    options = {"balances": "net_changes"}
    run_batch(spark, *full, warehouse, run_ts=RUN_1, **options)
    run_batch(spark, *full, warehouse, run_ts=RUN_2, **options)
    assert balances(warehouse) == money(golden.FULL_BALANCES)


def test_increment_with_an_orphan_fails_whole(spark, warehouse, increment):
    with pytest.raises(BatchRejected, match=ORPHAN):
        run_batch(spark, *increment, warehouse, run_ts=RUN_1, policy="fail")
    assert warehouse.version() == 0
    assert warehouse.users().count() == 0


def test_increment_with_an_orphan_quarantined(spark, warehouse, increment):
    report = run_batch(spark, *increment, warehouse, run_ts=RUN_1)
    assert balances(warehouse) == money(golden.INCREMENT_BALANCES)
    assert report.transactions.rejected == {ORPHAN: 1}
    assert report.transactions.accepted == 6
    (row,) = warehouse.rejects().collect()
    assert (row["table"], row["reject_reason"], row["v"]) == ("transactions", ORPHAN, 1)
    assert '"transactionid":816' in row["reject_record"]


def test_increment_after_a_later_full_load_moves_no_balance(spark, warehouse, full, increment):
    """T6: old dates never reach a balance once the mark has passed them."""
    run_batch(spark, *full, warehouse, run_ts=RUN_1)
    run_batch(spark, *increment, warehouse, run_ts=RUN_2)
    stored = balances(warehouse)
    assert stored[41] == Decimal("500.00") and stored[43] == Decimal("0.80")
    assert stored[31] == Decimal("160.50")


def test_late_correction(spark, warehouse, full, users_csv, txns_csv):
    run_batch(spark, *full, warehouse, run_ts=RUN_1, balances="net_changes")
    late = txns_csv(
        "702,32,19.99,credit,2024-08-22 09:00:00,completed,voucher",
        "703,35,25.25,debit,2024-08-27 07:45:10,completed,direct debit",
        "708,37,33.34,credit,2024-08-26 23:59:59,failed,voucher",
        golden.FULL_TXNS[0],
    )
    report = run_batch(
        spark, users_csv(), late, warehouse, run_ts=RUN_2, balances="net_changes", classify=True
    )
    expected = golden.FULL_BALANCES | {
        32: "19.99", 33: "75.25", 35: "-37.75", 37: "66.66",
    }
    assert balances(warehouse) == money(expected)
    counts = report.transactions
    assert (counts.updated, counts.unchanged, counts.inserted) == (3, 1, 0)
    assert warehouse.transactions().count() == 8
    assert repeated_keys(warehouse.transactions(), "transactionid").isEmpty()


def test_date_equal_to_the_mark_is_not_counted(spark, warehouse, users_csv, txns_csv):
    users = users_csv("4,Kim Dale,5550100404,12.5")
    txns = txns_csv("61,4,2.25,credit,2024-08-20 00:00:00,completed,cash")
    run_batch(spark, users, txns, warehouse, run_ts=RUN_1)
    assert balances(warehouse) == {4: Decimal("12.50")}


def test_tables_can_be_queried_with_sql(spark, warehouse, full):
    run_batch(spark, *full, warehouse, run_ts=RUN_1)
    warehouse.create_views()
    (row,) = spark.sql("""
        SELECT u.name, sum(t.amount) AS total, max(m.last_update_date) AS mark
        FROM users u JOIN transactions t ON u.userid = t.userid CROSS JOIN updatemetadata m
        WHERE t.type = 'debit' AND t.status = 'completed' AND u.userid = 36
        GROUP BY u.name""").collect()
    assert tuple(row) == ("Pia Lund", Decimal("15.10"), RUN_1)


def test_missing_control_row(spark, tmp_path, full):
    warehouse = Warehouse(spark, str(tmp_path / "unmarked")).init(watermark=None)
    run_batch(spark, *full, warehouse, run_ts=RUN_1)
    assert balances(warehouse) == money(golden.FILE_BALANCES)
    assert warehouse.watermark() is None


def test_only_touched_periods_are_rewritten(spark, warehouse, users_csv, txns_csv):
    users = users_csv("1,Ann,1234567890,0")
    first = txns_csv(
        "1,1,1,credit,2024-08-21 10:00:00,completed,card",
        "2,1,2,credit,2024-08-22 10:00:00,completed,card",
        "3,1,3,credit,2024-08-23 10:00:00,completed,card",
        "4,1,4,credit,,completed,card",
    )
    run_batch(spark, users, first, warehouse, run_ts=RUN_1)
    moved = txns_csv(
        "1,1,10,credit,2024-08-25 10:00:00,completed,card",
        "4,1,40,credit,2024-08-23 11:00:00,completed,card",
    )
    run_batch(spark, users, moved, warehouse, run_ts=RUN_2)
    paths = {e.period: e.path for e in warehouse.periods(warehouse.entries())}
    # The moved rows were the only ones of their old periods: those folders are gone.
    assert paths == {
        "2024-08-22": "transactions/v=1/period=2024-08-22",
        "2024-08-23": "transactions/v=2/period=2024-08-23",
        "2024-08-25": "transactions/v=2/period=2024-08-25",
    }
    rows = {r["transactionid"]: r["amount"] for r in warehouse.transactions().collect()}
    assert rows == {1: Decimal(10), 2: Decimal(2), 3: Decimal(3), 4: Decimal(40)}
    since = warehouse.transactions(since=datetime(2024, 8, 23).date())
    assert sorted(r[0] for r in since.select("transactionid").collect()) == [1, 3, 4]


@pytest.mark.parametrize("way", ["since_watermark", "net_changes"])
def test_large_batches_take_the_shuffling_way(
    spark, warehouse, full, increment, monkeypatch, way
):
    monkeypatch.setattr(load, "BROADCAST_KEYS", -1)
    monkeypatch.setattr("ledger_sync.operators.merge.BROADCAST_KEYS", -1)
    monkeypatch.setattr("ledger_sync.operators.merge.BROADCAST_ROWS", -1)
    options = {"balances": way, "classify": True}
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        run_batch(spark, *full, warehouse, run_ts=RUN_1, **options)
        report = run_batch(spark, *increment, warehouse, run_ts=RUN_2, **options)
        again = run_batch(spark, *full, warehouse, run_ts=RUN_2, **options)
    finally:
        spark.conf.unset(threshold)
    assert (again.transactions.unchanged, again.transactions.accepted) == (8, 8)
    assert report.transactions.rejected == {ORPHAN: 1}
    assert warehouse.transactions().count() == 14
    expected = golden.FULL_BALANCES if way == "net_changes" else golden.FILE_BALANCES
    stored = balances(warehouse)
    assert {u: stored[u] for u in expected} == money(expected)


def test_failure_midway_publishes_nothing(spark, warehouse, full, monkeypatch):
    run_batch(spark, *full, warehouse, run_ts=RUN_1)
    before = balances(warehouse)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(load, "advance_watermark", fail)
    with pytest.raises(RuntimeError, match="lost"):
        run_batch(spark, *full, warehouse, run_ts=RUN_2)
    assert (warehouse.version(), balances(warehouse)) == (1, before)
    assert warehouse.transactions().count() == 8

    monkeypatch.undo()
    # The failed load left folders of version 2 behind, so that number is not used again.
    assert run_batch(spark, *full, warehouse, run_ts=RUN_2).version == 3
    assert balances(warehouse) == money(golden.FILE_BALANCES)


def test_incomplete_manifest_does_not_count(spark, warehouse, increment, tmp_path):
    run_batch(spark, *increment, warehouse, run_ts=RUN_1, batch="a")
    (manifest,) = (tmp_path / "wh/manifest").glob("v=1-*")
    (manifest / "_SUCCESS").rename(tmp_path / "taken away")
    assert warehouse.version() == 0
    assert not warehouse.has_batch("a") and warehouse.rejects().isEmpty()
    assert run_batch(spark, *increment, warehouse, run_ts=RUN_1, batch="a").version == 2
    assert warehouse.has_batch("a") and not warehouse.has_batch("b")
    assert [r["v"] for r in warehouse.rejects().collect()] == [2]


def test_warehouse_keeps_its_layout(spark, warehouse):
    monthly = Warehouse(spark, warehouse.root, period="month")
    with pytest.raises(ValueError, match="layout"):
        monthly.users()
    with pytest.raises(ValueError, match="period"):
        Warehouse(spark, warehouse.root, period="hour")
    with pytest.raises(RuntimeError, match="init"):
        Warehouse(spark, warehouse.root + "-none").users()


def test_balance_overflow_publishes_nothing(spark, warehouse, users_csv, txns_csv):
    users = users_csv("1,Ann,1234567890,99999999.99")
    txns = txns_csv("1,1,0.01,credit,2024-08-21 10:00:00,completed,card")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        run_batch(spark, users, txns, warehouse, run_ts=RUN_1)
    assert warehouse.version() == 0


@pytest.mark.parametrize("bad", ["x,Bad,1,1", ",Bad,1,1", "2,Bad,1,much", "2,Bad,1,1,1"])
def test_rows_that_cannot_be_read_fail_the_load(spark, warehouse, users_csv, txns_csv, bad):
    with pytest.raises(BatchRejected):
        run_batch(spark, users_csv("1,Ann,1,1", bad), txns_csv(), warehouse, policy="fail")
    assert warehouse.version() == 0


def test_options_are_checked(spark, warehouse, full):
    for option in ({"policy": "ignore"}, {"balances": "none"}):
        with pytest.raises(ValueError, match="must be"):
            run_batch(spark, *full, warehouse, **option)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            run_batch(spark, *full, warehouse)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_a_published_batch_is_skipped(spark, warehouse, full):
    run_batch(spark, *full, warehouse, run_ts=RUN_1, batch="day-1")
    report = run_batch(spark, *full, warehouse, run_ts=RUN_2, batch="day-1")
    assert report.skipped and warehouse.version() == 1
    assert balances(warehouse) == money(golden.FULL_BALANCES)


def test_dag_preset_drops_contacts_and_large_amounts(spark, warehouse, users_csv, txns_csv):
    users = users_csv("1,Ann,1234567890,0", "2,Ben,123,0", "3,Cat,,0")
    txns = txns_csv(
        "1,1,10000,credit,2024-08-21 10:00:00,completed,card",
        "2,1,10000.01,credit,2024-08-21 10:00:00,completed,card",
        "3,2,5,credit,2024-08-21 10:00:00,completed,card",
        "4,1,inf,credit,2024-08-21 10:00:00,completed,card",
    )
    report = run_batch(spark, users, txns, warehouse, run_ts=RUN_1, preset=DAG)
    assert balances(warehouse) == {1: Decimal("10000.00")}
    assert report.transactions.rejected == {ORPHAN: 1}


def test_rejects_keep_the_record_and_the_reason(spark, warehouse, users_csv, txns_csv):
    users = users_csv(
        "1,Ann,1234567890,0", "x,Bad,1,1", ",Bad,1,1", "2,Bad,1,much", "3000000000,Bad,1,1",
        f"4,{'n' * 101},1,1", "5,Bad,1,100000000", "6,long,1,1,1", "7,short",
    )
    txns = txns_csv(
        "1,1,1,credit,bad,completed,card",
        "2,one,1,credit,2024-08-21 10:00:00,completed,card",
        "3,1,abc,credit,2024-08-21 10:00:00,completed,card",
        "4,1,1,credit,2024-08-21 10:00:00,completed,card,extra",
        "5,1,1,credit,2024-08-21 10:00:00,completed,card,",
        f"6,1,1,{'t' * 51},2024-08-21 10:00:00,completed,card",
        "7,1,inf,credit,2024-08-21 10:00:00,completed,card",
        "8,1,3",
    )
    report = run_batch(spark, users, txns, warehouse, run_ts=RUN_1, preset=SCRIPT)
    assert sorted(balances(warehouse)) == [1, 7]
    assert report.users.rejected == {
        "userid is missing or no whole number": 2, "balance is no number": 1,
        "userid is out of range": 1, "name is too long": 1, "balance is out of range": 1,
        "too many fields": 1,
    }
    assert report.transactions.rejected == {
        "userid is no whole number": 1, "amount is no number": 1, "too many fields": 2,
        "type is too long": 1, "amount is out of range": 1,
    }
    stored = {r["transactionid"]: r for r in warehouse.transactions().collect()}
    assert sorted(stored) == [1, 8]
    assert stored[1]["date"] is None
    assert (stored[8]["type"], stored[8]["method"]) == ("unknown", "not specified")
    records = {r["reject_record"] for r in warehouse.rejects().collect()}
    assert "6,long,1,1,1" in records
    assert '{"userid":"x","name":"Bad","contact":"1","balance":"1"}' in records
    assert warehouse.rejects().count() == 13


def test_only_touched_buckets_of_users_are_rewritten(spark, tmp_path, users_csv, txns_csv):
    warehouse = Warehouse(spark, str(tmp_path / "buckets"), user_buckets=8).init()
    people = [f"{i},user {i},55501{i:05d},{i}" for i in range(40)]
    run_batch(spark, users_csv(*people), txns_csv(), warehouse, run_ts="2024-08-20 00:00:00")
    before = {e.period: e.path for e in warehouse.buckets(warehouse.entries())}
    for way in ("since_watermark", "net_changes"):
        row = f"{len(way)},7,2.50,credit,2024-08-30 10:00:00,completed,cash"
        run_batch(spark, users_csv("9,nine,5550100009,90"), txns_csv(row), warehouse,
                  run_ts="2024-08-21 00:00:00", balances=way)
    after = {e.period: e.path for e in warehouse.buckets(warehouse.entries())}
    buckets = spark.createDataFrame([(7,), (9,)], "userid int")
    touched = {str(r[0]) for r in buckets.select(warehouse.bucket_of(buckets.userid)).collect()}
    assert {b for b in before if before[b] != after[b]} == touched
    stored = balances(warehouse)
    assert len(stored) == 40 and stored[9] == Decimal(90) and stored[7] == Decimal("12.00")


def test_one_old_id_opens_few_periods(spark, warehouse, users_csv, txns_csv, monkeypatch):
    users = users_csv("1,Ann,5550100001,0")
    rows = [f"{d * 100 + i},1,1,credit,2024-09-{d:02d} 10:00:00,completed,cash" for d in range(1, 21) for i in range(3)]
    run_batch(spark, users, txns_csv(*rows), warehouse, run_ts=RUN_1)
    read = []
    late = txns_csv("301,1,5,credit,2024-09-03 10:00:00,completed,cash",
                    "2002,1,5,credit,2024-09-20 10:00:00,completed,cash")
    monkeypatch.setattr(load, "_periods_of_known_keys", lambda stored, batch, f=load._periods_of_known_keys: (
        read.append(len(stored.inputFiles())), f(stored, batch))[1])
    run_batch(spark, users, late, warehouse, run_ts=RUN_2)
    assert read == [2]
    amounts = {r["transactionid"]: r["amount"] for r in warehouse.transactions().collect()}
    assert len(amounts) == 60 and amounts[301] == amounts[2002] == 5


def test_first_date_sets_the_form(spark, warehouse, users_csv, txns_csv):
    users = users_csv("1,Ann,5550100001,0")
    txns = txns_csv(
        "1,1,1,credit,,completed,cash", "2,1,2,credit,2024-08-21T10:00:00,completed,cash",
        "3,1,4,credit,2024-08-22 10:00:00,completed,cash", "4,1,8,credit,2024-08-23,completed,cash",
    )
    report = run_batch(spark, users, txns, warehouse, run_ts=RUN_1)
    assert balances(warehouse) == {1: Decimal(2)} and report.transactions.undated == 2
    for form, total in (("yyyy-MM-dd", 8), ("yyyy-MM-dd HH:mm:ss", 4)):
        other = Warehouse(spark, f"{warehouse.root}-{total}").init()
        run_batch(spark, users, txns, other, run_ts=RUN_1, date_form=form)
        assert balances(other) == {1: Decimal(total)}
    with pytest.raises(BatchRejected, match="another form: 2"):
        run_batch(spark, users, txns, warehouse, undated="reject", policy="fail")


def test_typed_rows_keep_their_fractions(spark, warehouse, users_csv):
    from ledger_sync.plans.load import load_batch
    from ledger_sync.schemas import TRANSACTION_COLUMNS, USER_COLUMNS
    from ledger_sync.sources.extracts import land_rows, read_csv_extract

    users = read_csv_extract(spark, users_csv("1,Ann,5550100001,0"), USER_COLUMNS)
    moment = datetime(2024, 8, 21, 10, 0, 0, 250000)
    kinds = "transactionid bigint, userid double, amount decimal(8,3), type string, date timestamp_ntz, status string, method int"
    rows = [(1, 1.0, Decimal("1.25"), "credit", moment, "completed", 7), (2, 1.5, Decimal(1), None, None, "completed", None)]
    report = load_batch(warehouse, users, land_rows(spark.createDataFrame(rows, kinds), TRANSACTION_COLUMNS), run_ts=RUN_1)
    (row,) = warehouse.transactions().collect()
    assert (row["date"], row["method"]) == (moment, "7")
    assert report.transactions.rejected == {"userid is no whole number": 1} and report.transactions.undated == 0


def test_a_transaction_waits_for_its_user(spark, warehouse, users_csv, txns_csv):
    options = {"balances": "net_changes"}
    early = txns_csv("1,5,1.00,credit,2024-08-21 10:00:00,completed,cash",
                     "2,6,2.00,credit,2024-08-22 10:00:00,completed,cash",
                     "3,5,4.00,credit,2024-08-23 10:00:00,completed,cash")
    first = run_batch(spark, users_csv(), early, warehouse, run_ts=RUN_1, **options)
    assert first.transactions.rejected == {ORPHAN: 3} and warehouse.waiting().count() == 3
    again = txns_csv("3,5,8.00,credit,2024-08-23 10:00:00,completed,cash")
    second = run_batch(spark, users_csv("5,Eve,5550100005,0"), again, warehouse, run_ts=RUN_2, **options)
    assert balances(warehouse) == {5: Decimal("9.00")} and second.transactions.taken_up == 1
    assert [r["transactionid"] for r in warehouse.waiting().collect()] == [2]
    run_batch(spark, users_csv("6,Fay,5550100006,0"), txns_csv(), warehouse, run_ts=RUN_2, **options)
    assert balances(warehouse)[6] == Decimal("2.00") and warehouse.waiting().isEmpty()
    assert warehouse.transactions().count() == 3


def test_a_rejected_row_hides_a_later_one(spark, warehouse, users_csv, txns_csv):
    txns = txns_csv("1,1,abc,credit,2024-08-21 10:00:00,completed,cash",
                    "1,1,5,credit,2024-08-21 10:00:00,completed,cash")
    run_batch(spark, users_csv("1,Ann,5550100001,0"), txns, warehouse, run_ts=RUN_1)
    assert warehouse.transactions().isEmpty() and warehouse.rejects().count() == 1


def test_quoted_line_breaks_are_noticed(spark, warehouse, users_csv, txns_csv):
    users = users_csv("1,Ann,5550100001,0")
    row = "{},1,{},credit,2024-08-21 10:00:00,completed,{}"
    txns = txns_csv(row.format(1, 5, '"ca\nrd"'), row.format(2, 3, '"a ""b"" c"'), row.format(3, 1, 'x"y'))
    run_batch(spark, users, txns, warehouse, run_ts=RUN_1, policy="fail")
    methods = {r["transactionid"]: r["method"] for r in warehouse.transactions().collect()}
    assert methods == {1: "ca\nrd", 2: 'a "b" c', 3: 'x"y'}


def test_a_short_staged_table_stops_the_load(spark, warehouse, full, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    count = DataFrame.count
    monkeypatch.setattr(DataFrame, "count", lambda self: max(0, count(self) - 1))
    with pytest.raises(RuntimeError, match="shared folder"):
        run_batch(spark, *full, warehouse, run_ts=RUN_1)
    monkeypatch.undo()
    assert warehouse.version() == 0


def test_staging_lies_below_the_root_and_goes(spark, warehouse, full, tmp_path):
    run_batch(spark, *full, warehouse, run_ts=RUN_1)
    assert (tmp_path / "wh/_staging").exists() and not list((tmp_path / "wh/_staging").iterdir())


def test_vacuum_keeps_what_the_newest_versions_name(spark, warehouse, full, increment, tmp_path):
    run_batch(spark, *full, warehouse, run_ts=RUN_1, batch="a")
    for turn in range(3):
        run_batch(spark, *increment, warehouse, run_ts=RUN_2)
    stored, count = balances(warehouse), warehouse.transactions().count()
    gone = warehouse.vacuum(keep=1)
    assert "updatemetadata/v=1" in gone and not any("v=4" in p for p in gone)
    assert not (tmp_path / "wh/updatemetadata/v=3").exists()
    assert balances(warehouse) == stored and warehouse.transactions().count() == count
    assert sorted({r["v"] for r in warehouse.rejects().collect()}) == [2, 3, 4]
    assert warehouse.has_batch("a") and warehouse.vacuum(keep=1) == []


def test_of_two_loads_at_a_time_one_is_published(spark, warehouse, full, users_csv, txns_csv, monkeypatch):
    """The other one has read what is no longer current; it changes nothing, and can be run again."""
    run_batch(spark, *full, warehouse, run_ts=RUN_1)
    late = users_csv("900,Late,5550100900,1"), txns_csv()
    early = users_csv("901,Early,5550100901,1"), txns_csv()
    advance = load.advance_watermark

    def meanwhile(*args):
        monkeypatch.setattr(load, "advance_watermark", advance)
        other = Warehouse(spark, warehouse.root)
        assert run_batch(spark, *early, other, run_ts=RUN_2).version == 3
        return advance(*args)

    monkeypatch.setattr(load, "advance_watermark", meanwhile)
    with pytest.raises(Conflict):
        run_batch(spark, *late, warehouse, run_ts=RUN_2)
    assert warehouse.version() == 3 and warehouse.watermark() == RUN_2
    assert set(balances(warehouse)) == {*golden.FILE_BALANCES, 901}
    assert run_batch(spark, *late, warehouse, run_ts=RUN_2).version == 4
    assert set(balances(warehouse)) == {*golden.FILE_BALANCES, 900, 901}


def test_a_claim_that_was_left_behind_is_passed_over_in_time(spark, warehouse, full, monkeypatch):
    assert create_file(spark, f"{warehouse.root}/claims/after=0-0")
    with pytest.raises(Conflict):
        run_batch(spark, *full, warehouse, run_ts=RUN_1)
    assert warehouse.version() == 0
    monkeypatch.setattr(warehouse_module, "CLAIM_SECONDS", 0)
    run_batch(spark, *full, warehouse, run_ts=RUN_1)
    assert balances(warehouse) == money(golden.FULL_BALANCES)
    names = list_names(spark, f"{warehouse.root}/claims")
    assert sorted(names) == ["after=0-0", "v=0", "v=1", "v=2"]
    assert not create_file(spark, f"{warehouse.root}/claims/v=2")
    warehouse.vacuum(keep=1)
    assert list_names(spark, f"{warehouse.root}/claims") == ["v=2"]


def test_older_versions_can_be_read(spark, warehouse, full, increment):
    run_batch(spark, *full, warehouse, run_ts=RUN_1)
    before = warehouse.at()
    run_batch(spark, *increment, warehouse, run_ts=RUN_2)
    assert balances(before) == balances(warehouse.at(1)) == money(golden.FULL_BALANCES)
    assert before.watermark() == RUN_1 and before.transactions().count() == 8
    assert warehouse.at(0).users().isEmpty() and len(balances(warehouse)) > len(golden.FULL_BALANCES)
    with pytest.raises(ValueError, match="no version 9"):
        warehouse.at(9)
