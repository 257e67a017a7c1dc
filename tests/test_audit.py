"""Constraints of stored tables."""

from pyspark.sql import functions as F

from ledger_sync.plans.audit import violations
from ledger_sync.plans.load import run_batch
from ledger_sync.plans.warehouse import Entry, Warehouse
from tests import golden


def broken(warehouse):
    return {(r["table"], r["rule"]): r["n"] for r in violations(warehouse).collect() if r["n"]}


def test_loads_break_no_rule(spark, tmp_path, users_csv, txns_csv):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), user_buckets=3).init()
    rows = violations(warehouse).collect()
    assert len(rows) == 14 and not any(r["n"] for r in rows)
    run_batch(spark, users_csv(*golden.FULL_USERS), txns_csv(*golden.FULL_TXNS), warehouse)
    run_batch(spark, users_csv(*golden.INCREMENT_USERS), txns_csv(*golden.INCREMENT_TXNS), warehouse)
    assert broken(warehouse) == {}


def test_null_references_and_negative_balances_are_allowed(spark, tmp_path, users_csv, txns_csv):
    warehouse = Warehouse(spark, str(tmp_path / "wh")).init()
    run_batch(spark, users_csv("1,Ann,5550100001,-5"), txns_csv("1,,5,debit,,completed,card"), warehouse)
    assert warehouse.transactions().count() == 1 and broken(warehouse) == {}


def test_each_rule_is_counted(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), period="month", user_buckets=2)
    users = spark.createDataFrame(
        [(1, "a" * 101, "5", 1), (1, "b", "c" * 51, 1), (1, "b", None, 1), (None, "b", "c", 1), (None, None, "c", 1)],
        "userid int, name string, contact string, balance int",
    )
    columns = "transactionid int, amount int, type string, date string, status string, method string, userid int"
    txns = spark.createDataFrame([
        (1, 1, "x" * 51, "2024-08-01", "s", "m", 1), (2, 1, "t", "2024-08-01", "s" * 51, "m" * 51, 7),
        (2, 1, "t", "2024-08-01", "s", "m", 7), (2, 1, "t", None, "s", "m", None), (None, 1, "t", None, "s", "m", 1),
    ], columns)
    txns = txns.withColumn("date", F.col("date").cast("timestamp_ntz")).withColumn("period", F.lit("2024-09-01").cast("date"))
    entries = warehouse.write_users(users, 0) + warehouse.write_periods(txns, 0)
    marks = spark.createDataFrame([(1, None), (1, None), (2, None)], "id int, last_update_date timestamp_ntz")
    entries.append(warehouse.write_whole("updatemetadata", marks, 0))
    # The bucket of user 1 under the name of the other one.
    other = spark.createDataFrame([(1, "b", "c", 1)], users.schema)
    name = {e.period for e in entries if e.table == "users"}
    (bucket,) = other.select(warehouse.bucket_of(F.col("userid"))).first()
    path = f"users/v=1/bucket={1 - bucket}"
    other.select("userid", "name", "contact", F.col("balance").cast("decimal(10,2)")).write.parquet(f"{warehouse.root}/{path}")
    warehouse.publish(2, [*entries, Entry("users", path, str(1 - bucket))])
    assert str(bucket) in name
    assert broken(warehouse) == {
        ("users", "userid is null"): 2, ("users", "name is too long"): 1, ("users", "contact is too long"): 1,
        ("users", "userid is repeated"): 3, ("users", "userid is in another bucket"): 1,
        ("transactions", "transactionid is null"): 1, ("transactions", "transactionid is repeated"): 2,
        ("transactions", "type is too long"): 1, ("transactions", "status is too long"): 1,
        ("transactions", "method is too long"): 1, ("transactions", "userid is not in users"): 2,
        ("transactions", "date is in another period"): 5,
        ("updatemetadata", "the control row is not there once"): 1,
        ("updatemetadata", "last_update_date is null"): 2,
    }


def test_a_hot_reference_is_counted_before_it_is_compared(spark, tmp_path, users_csv, txns_csv):
    warehouse = Warehouse(spark, str(tmp_path / "wh")).init()
    run_batch(spark, users_csv(*golden.FULL_USERS), txns_csv(*golden.FULL_TXNS), warehouse)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = violations(warehouse)._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = text[text.index("Join LeftAnti") :]
    assert "Aggregate [userid#" in below.splitlines()[1]
