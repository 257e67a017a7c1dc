"""One key or period that holds a third of all rows, and more, must not end in one task."""

from collections import Counter
from contextlib import contextmanager

from ledger_sync.operators.clean import first_per_key
from ledger_sync.operators.merge import upsert
from ledger_sync.operators.validate import orphan_userids, orphans
from ledger_sync.plans.warehouse import Warehouse
from ledger_sync.schemas import BLOCK, FILE, REASON, ROW
from pyspark.sql import functions as F

ROWS = 300_000


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def rows_of_each_task(df):
    return [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]


def test_transactions_of_a_hot_unknown_user_are_split(spark, tmp_path):
    """The orphan ids lie in a file, so both sides of the join are plain shuffles."""
    hot = F.when(F.col("id") % 3 == 0, 7_000_000).otherwise(F.col("id"))
    text = F.sha2(F.col("id").cast("string"), 256).alias("method")
    spark.range(ROWS).select(hot.alias("userid"), text).write.parquet(str(tmp_path / "t"))
    users = spark.range(ROWS).select(F.col("id").alias("userid")).where("userid % 3 = 1")
    transactions = spark.read.parquet(str(tmp_path / "t"))
    orphan_userids(transactions, users).write.parquet(str(tmp_path / "o"))
    ids = spark.read.parquet(str(tmp_path / "o"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1MB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        found = orphans(transactions, ids.hint("merge"))
        placed = found.withColumn("task", F.spark_partition_id())
        tasks = Counter(r["task"] for r in placed.collect())
        plan = final_plan(placed)
    assert sum(tasks.values()) == 200_000
    assert "skew=true" in plan
    assert max(tasks.values()) < 50_000


def test_a_hot_id_leaves_each_task_once(spark):
    """Only one row of the hot id per input task enters the shuffle."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    df = spark.range(0, ROWS, 1, 16).select(key.alias("k"), F.col("id").alias("n"))
    kept = first_per_key(df, "k", ["n"])
    assert kept.count() == 200_000  # the hot 7 is also an id that is no multiple of three
    (window,) = [s for s in final_plan(kept).split("\n") if "1, Partial" in s]
    assert "WindowGroupLimit" in window


def test_rows_without_an_id_spread(spark):
    """A third of the rows is rejected for its missing id; each is a group of its own."""
    bad = F.col("id") % 3 == 0
    df = spark.range(0, ROWS, 1, 16).select(
        F.when(~bad, F.col("id")).alias("k"),
        F.lit("f").alias(FILE),
        F.lit(0).alias(BLOCK),
        F.col("id").alias(ROW),
        F.when(bad, F.lit("no id")).alias(REASON),
    )
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        tasks = rows_of_each_task(first_per_key(df, "k"))
    assert sum(tasks) == ROWS and max(tasks) < 2 * min(tasks)


def test_a_hot_period_is_written_by_several_tasks(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    day = F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 30)
    batch = spark.range(ROWS).select(
        F.col("id").cast("int").alias("transactionid"),
        F.sha2(F.col("id").cast("string"), 256).alias("method"),
        F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).alias("period"),
    )
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="2MB"):
        rebalanced = batch.hint("rebalance", F.col("period"))
        warehouse.write_periods(upsert(batch.limit(0), rebalanced, "transactionid", ROWS), 0)
    files = {
        folder.name: len(list(folder.glob("*.parquet")))
        for folder in (tmp_path / "wh/transactions/v=0").glob("period=*")
    }
    assert files.pop("period=2024-01-01") > 3
    # Small periods keep one file, except those that share a shuffle partition with the hot one.
    assert list(files.values()).count(1) > len(files) // 2
