"""What the planner makes of the operators."""

import re
import shutil
from datetime import date

import pytest

from ledger_sync.operators.balance import refresh_balances
from ledger_sync.operators.clean import first_per_key
from ledger_sync.operators.merge import upsert
from ledger_sync.operators.parse import parse_transactions
from ledger_sync.plans.load import run_batch
from ledger_sync.plans.warehouse import Warehouse
from ledger_sync.queries import (
    QUERIES, balance_refresh, credit_debit_summary, transactions_of, transaction_batch_of,
)
from ledger_sync.schemas import TRANSACTION_COLUMNS
from ledger_sync.sources.extracts import read_csv_extract
from pyspark.sql import functions as F
from tests import golden

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_mark_and_status_are_filtered_by_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(balance_refresh(spark, DATA))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", text)
    ((filters, schema),) = [p for p in pushed if "o_orderdate" in p[1]]
    assert "EqualTo(o_orderstatus,F)" in filters
    assert "GreaterThan(o_orderdate,1998-01-01T00:00)" in filters
    assert schema.count(":") == 5


def test_sums_are_combined_before_the_shuffle(spark):
    text = plan(credit_debit_summary(spark, DATA))
    assert text.index("functions=[sum(") < text.index("Exchange") < text.index("partial_sum")


def test_duplicates_are_cut_before_the_shuffle(spark, txns_csv):
    path = txns_csv(*golden.FULL_TXNS)
    landed = read_csv_extract(spark, path, TRANSACTION_COLUMNS)
    text = plan(first_per_key(parse_transactions(landed), "transactionid"))
    final, exchange, partial = (text.index(s) for s in ("1, Final", "Exchange", "1, Partial"))
    assert final < exchange < partial
    assert text.count("Exchange") == 1


def test_refresh_after_an_upsert_shuffles_the_users_once(spark, tmp_path, no_broadcast):
    for name in ("users", "batch", "txns"):
        spark.createDataFrame(
            [(i, 1, "completed", None, "credit") for i in range(9)],
            "userid int, amount int, status string, date timestamp_ntz, type string",
        ).write.parquet(str(tmp_path / name))

    def read(name):
        return spark.read.parquet(str(tmp_path / name))

    users = read("users").selectExpr("userid", "cast(amount as decimal(10,2)) as balance")
    batch = read("batch").selectExpr("userid", "cast(amount as decimal(10,2)) as balance")
    merged = upsert(users, batch.repartition("userid"), "userid")
    text = plan(refresh_balances(merged, read("txns"), "2024-01-01 00:00:00"))
    # Stored users, the batch's keys, the batch, and the summaries; not the merged users again.
    assert text.count("Exchange hashpartitioning") == 4


def test_small_batch_spares_the_stored_rows_their_shuffle(spark):
    stored, batch = transactions_of(spark, DATA), transaction_batch_of(spark, DATA)
    text = plan(upsert(stored, batch, "transactionid", batch_rows=1000))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_large_batch_is_never_broadcast(spark):
    stored, batch = transactions_of(spark, DATA), transaction_batch_of(spark, DATA)
    text = plan(upsert(stored, batch, "transactionid", batch_rows=2_000_001))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_periods_are_written_in_the_order_of_ids(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    rows = transactions_of(spark, DATA).withColumn("period", F.to_date("date"))
    warehouse.write_periods(rows.where("date < timestamp_ntz '1995-01-10 00:00:00'"), 0)
    (first, *_) = sorted((tmp_path / "wh/transactions/v=0").glob("period=*/*.parquet"))
    ids = [r[0] for r in spark.read.parquet(str(first)).select("transactionid").collect()]
    assert ids == sorted(ids)


def test_untouched_periods_are_not_read(spark, tmp_path, users_csv, txns_csv):
    """The folder of a day that a later load does not touch can be gone."""
    warehouse = Warehouse(spark, str(tmp_path / "wh")).init()
    users = users_csv("1,Ann,1234567890,0")
    row = "{0},1,1,credit,2024-08-2{0} 10:00:00,completed,card"
    run_batch(spark, users, txns_csv(*[row.format(i) for i in range(1, 5)]), warehouse,
              run_ts="2024-09-01 00:00:00")
    df = warehouse.read_periods(warehouse.periods(warehouse.entries()))
    text = plan(df.where("period in (date '2024-08-23')"))
    assert re.search(r"PartitionFilters: \[[^\]]*period", text)
    since = warehouse.transactions(since=date(2024, 8, 23))
    shutil.rmtree(tmp_path / "wh/transactions/v=1/period=2024-08-21")
    assert since.count() == 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_needs_python_for_its_rows(spark, name):
    if name.startswith(("load_", "stream_")):
        pytest.skip("returns a written table")
    text = plan(QUERIES[name](spark, DATA))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text
