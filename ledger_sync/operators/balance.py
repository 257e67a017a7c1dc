"""Balance refresh from completed credits and debits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledger_sync.functions.rules import contribution, credited, debited
from ledger_sync.schemas import CONTROL_ID, DEFAULT_LIMITS


def moment(value: datetime | str | None) -> Column:
    """A zoneless timestamp literal, which the scan can be given as a filter."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def completed_since(
    transactions: DataFrame, watermark: datetime | str | None, completed: str = "completed"
) -> DataFrame:
    """Completed transactions dated strictly after the mark; no mark selects nothing."""
    return transactions.where((F.col("status") == completed) & (F.col("date") > moment(watermark)))


def transaction_summaries(
    transactions: DataFrame, watermark: datetime | str | None, completed: str = "completed"
) -> DataFrame:
    """Credits and debits of each user that has a qualifying transaction."""
    recent = completed_since(transactions, watermark, completed)
    return credit_debit_totals(recent, "userid", F.col("type"), F.col("amount"))


def credit_debit_totals(df: DataFrame, user: str, kind: Column, amount: Column) -> DataFrame:
    return df.groupBy(user).agg(
        F.sum(credited(kind, amount)).alias("total_credits"),
        F.sum(debited(kind, amount)).alias("total_debits"),
    )


def apply_summaries(
    users: DataFrame, summaries: DataFrame, money: str = DEFAULT_LIMITS.money
) -> DataFrame:
    """Add credits and take off debits; users without a summary keep their balance."""
    credits = F.coalesce(F.col("total_credits"), F.lit(0))
    debits = F.coalesce(F.col("total_debits"), F.lit(0))
    balance = (F.col("balance") + credits - debits).cast(money)
    joined = users.join(summaries, "userid", "left")
    return joined.withColumn("balance", balance).select(*users.columns)


def refresh_balances(
    users: DataFrame,
    transactions: DataFrame,
    watermark: datetime | str | None,
    money: str = DEFAULT_LIMITS.money,
    completed: str = "completed",
) -> DataFrame:
    summaries = transaction_summaries(transactions, watermark, completed)
    return apply_summaries(users, summaries, money)


def net_changes(batch: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """Per user, what a batch of new versions adds and the versions it replaces take back.

    A transaction that moves to another user takes from the one and gives to the other.
    """
    value = contribution(F.col("status"), F.col("type"), F.col("amount"))
    parts = batch.select("userid", value.alias("net"))
    if replaced is not None:
        parts = parts.unionByName(replaced.select("userid", (-value).alias("net")))
    known = parts.where(F.col("userid").isNotNull() & F.col("net").isNotNull())
    return known.groupBy("userid").agg(F.sum("net").alias("net"))


def apply_net_changes(
    users: DataFrame, changes: DataFrame, money: str = DEFAULT_LIMITS.money
) -> DataFrame:
    balance = (F.col("balance") + F.coalesce(F.col("net"), F.lit(0))).cast(money)
    joined = users.join(changes, "userid", "left")
    return joined.withColumn("balance", balance).select(*users.columns)


def merge_users_keeping_balance(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert users, but a known user's balance stays as it is stored."""
    old = stored.select("userid", F.struct("name", "contact", "balance").alias("_old"))
    new = batch.select("userid", F.struct("name", "contact", "balance").alias("_new"))
    is_known, is_sent = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    merged = {
        "name": F.when(is_sent, F.col("_new.name")).otherwise(F.col("_old.name")),
        "contact": F.when(is_sent, F.col("_new.contact")).otherwise(F.col("_old.contact")),
        "balance": F.when(is_known, F.col("_old.balance")).otherwise(F.col("_new.balance")),
    }
    joined = old.join(new, "userid", "full_outer")
    return joined.select("userid", *[value.alias(name) for name, value in merged.items()])


def advance_watermark(metadata: DataFrame, run_ts: datetime | str | None) -> DataFrame:
    """Set the control row to the run time; nothing happens where that row is missing."""
    now = F.localtimestamp() if run_ts is None else moment(run_ts)
    mark = F.when(F.col("id") == CONTROL_ID, now).otherwise(F.col("last_update_date"))
    return metadata.withColumn("last_update_date", mark)


def control_row(metadata: DataFrame) -> DataFrame:
    return metadata.where(F.col("id") == CONTROL_ID).select("last_update_date")
