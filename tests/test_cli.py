"""The command line."""

import pytest

from ledger_sync.__main__ import main
from ledger_sync.plans.warehouse import Warehouse
from tests import golden
from tests.conftest import TXN_HEADER
from tests.golden import balances, money


def test_load(spark, tmp_path, users_csv, txns_csv, capsys):
    main([
        "load", "--warehouse", str(tmp_path / "wh"), "--users", users_csv(*golden.FULL_USERS),
        "--transactions", txns_csv(*golden.FULL_TXNS, "709,999,1,credit,,completed,card"),
        "--run-ts", "2024-09-01 00:00:00",
    ])
    out = capsys.readouterr().out
    assert "version 1, watermark 2024-09-01 00:00:00" in out
    assert "users: read 8, deduped 7, filtered 7, inserted 7, updated 0, unchanged 0" in out
    assert "rejected: userid is not in users: 1" in out
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    assert balances(warehouse) == money(golden.FULL_BALANCES)


def test_ingest(spark, tmp_path, write_csv, users_csv, capsys):
    users_csv(*golden.FULL_USERS, name="users/1.csv")
    write_csv(TXN_HEADER, *golden.FULL_TXNS, name="txns/1.csv", end="\r\n")
    main([
        "ingest", "--warehouse", str(tmp_path / "wh"), "--users", str(tmp_path / "users"),
        "--transactions", str(tmp_path / "txns"), "--checkpoint", str(tmp_path / "checkpoint"),
        "--run-ts", "2024-09-01 00:00:00", "--period", "month",
    ])
    assert "version 1" in capsys.readouterr().out
    warehouse = Warehouse(spark, str(tmp_path / "wh"), period="month")
    assert balances(warehouse) == money(golden.FULL_BALANCES)


def test_options(spark, tmp_path, users_csv, txns_csv, capsys):
    arguments = [
        "load", "--warehouse", str(tmp_path / "wh"), "--users", users_csv('1,"A\nb",5550100001,3'),
        "--transactions", txns_csv(), "--batch", "day-1", "--multiline", "--classify",
    ]
    main(arguments)
    main(arguments)
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    assert warehouse.version() == 1 and warehouse.has_batch("day-1")
    assert [r["name"] for r in warehouse.users().collect()] == ["A\nb"]


def test_check_and_vacuum(spark, tmp_path, users_csv, txns_csv, capsys):
    folder = ["--warehouse", str(tmp_path / "wh"), "--period", "month", "--user-buckets", "2"]
    files = ["--users", users_csv(*golden.FULL_USERS), "--transactions", txns_csv(*golden.FULL_TXNS)]
    for _ in range(3):
        main(["load", *folder, *files, "--date-form", "yyyy-MM-dd HH:mm:ss", "--undated", "reject"])
    main(["check", *folder])
    assert "no constraint is broken" in capsys.readouterr().out
    main(["vacuum", *folder, "--keep", "1"])
    assert "users/v=1" in capsys.readouterr().out.split()
    warehouse = Warehouse(spark, str(tmp_path / "wh"), period="month", user_buckets=2)
    assert len(balances(warehouse)) == len(golden.FULL_BALANCES) and warehouse.version() == 3
    rows = warehouse.transactions().unionByName(warehouse.transactions().limit(1))
    version = warehouse.next_version()
    entries = [e for e in warehouse.entries() if e.table != "transactions"]
    rows = rows.withColumn("period", warehouse.period_of(rows["date"]))
    warehouse.publish(version, entries + warehouse.write_periods(rows, version))
    with pytest.raises(SystemExit):
        main(["check", *folder])
    assert "transactions: transactionid is repeated: 1" in capsys.readouterr().out


def test_json_extracts(spark, tmp_path, write_csv, capsys):
    users = write_csv('{"userid": 1, "name": "Ann", "contact": "5550100001", "balance": 2.5}', name="u.json")
    txns = write_csv(
        '{"transactionid": 5, "userid": 1, "amount": 1, "type": "debit", "date": "2024-08-22 10:00:00", "status": "completed"}',
        "no object", name="t.json",
    )
    main(["load", "--warehouse", str(tmp_path / "wh"), "--format", "json", "--users", users, "--transactions", txns])
    assert "rejected: no JSON object: 1" in capsys.readouterr().out
    assert balances(Warehouse(spark, str(tmp_path / "wh"))) == money({1: "1.50"})
