"""Table constraints: key, range, length and reference checks."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ledger_sync.operators.parse import first_failure
from ledger_sync.schemas import (
    DEFAULT_LIMITS, RECORD, REASON, TRANSACTION_SINK_COLUMNS, USER_COLUMNS, Limits,
)

ORPHAN = "userid is not in users"
_INTEGER_BITS = {"smallint": 16, "int": 32, "bigint": 64}


def check_users(users: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Cast to the warehouse types; rows that break a constraint get a reason."""
    return _typed(
        users,
        USER_COLUMNS,
        {"userid": limits.key_type, "balance": limits.money},
        ("userid is null", F.col("userid").isNull()),
        ("userid is out of range", _overflow(users, "userid", limits.key_type)),
        ("name is too long", F.length("name") > limits.name_length),
        ("contact is too long", F.length("contact") > limits.text_length),
        ("balance is out of range", _overflow(users, "balance", limits.money)),
    )


def check_transactions(transactions: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    key_type = limits.key_type
    types = {"transactionid": key_type, "userid": key_type, "amount": limits.money}
    return _typed(
        transactions,
        TRANSACTION_SINK_COLUMNS,
        types,
        ("transactionid is null", F.col("transactionid").isNull()),
        ("transactionid is out of range", _overflow(transactions, "transactionid", key_type)),
        ("userid is out of range", _overflow(transactions, "userid", key_type)),
        ("amount is out of range", _overflow(transactions, "amount", limits.money)),
        ("type is too long", F.length("type") > limits.text_length),
        ("status is too long", F.length("status") > limits.text_length),
        ("method is too long", F.length("method") > limits.text_length),
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNull()).drop(REASON, RECORD)


def rejected(checked: DataFrame, table: str) -> DataFrame:
    bad = checked.where(F.col(REASON).isNotNull())
    return bad.select(F.lit(table).alias("table"), REASON, RECORD)


def orphan_userids(transactions: DataFrame, *users: DataFrame) -> DataFrame:
    """User ids that transactions refer to and none of the ``users`` frames holds.

    The ids are made distinct first, so a user with very many transactions is one
    row in the joins. A null reference passes.
    """
    ids = transactions.select("userid").where(F.col("userid").isNotNull()).distinct()
    for frame in users:
        ids = ids.join(frame.select("userid"), "userid", "left_anti")
    return ids


def orphans(transactions: DataFrame, orphan_ids: DataFrame) -> DataFrame:
    return transactions.join(orphan_ids, "userid", "left_semi").select(*transactions.columns)


def without_orphans(transactions: DataFrame, orphan_ids: DataFrame) -> DataFrame:
    """Rows without a reference pass; they are kept out of the join, where they would meet in a task."""
    referring = transactions.where(F.col("userid").isNotNull())
    found = referring.join(orphan_ids, "userid", "left_anti").select(*transactions.columns)
    return found.unionByName(transactions.where(F.col("userid").isNull()))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once: empty for every published table."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def as_record(columns: tuple[str, ...]) -> Column:
    return F.to_json(F.struct(*columns))


def _overflow(df: DataFrame, column: str, target: str) -> Column:
    return F.col(column).isNotNull() & ~_fits(df, column, target)


def _fits(df: DataFrame, column: str, target: str) -> Column:
    """Whether a value survives its cast. Bounds are compared where they can be, as a
    failing cast costs an exception per row."""
    value = F.col(column)
    if target in _INTEGER_BITS:
        bound = 2 ** (_INTEGER_BITS[target] - 1)
        return value.between(-bound, bound - 1)
    digits = re.fullmatch(r"decimal\((\d+),(\d+)\)", target)
    if digits and dict(df.dtypes)[column] == "double":
        precision, scale = map(int, digits.groups())
        # From half a unit below the next power of ten on, a value is rounded up to it.
        bound = Decimal(10) ** (precision - scale) - Decimal(5).scaleb(-scale - 1)
        return F.abs(value) < float(bound)
    return value.try_cast(target).isNotNull()


def _typed(
    df: DataFrame, columns: tuple[str, ...], types: dict[str, str], *checks: tuple[str, Column]
) -> DataFrame:
    earlier = F.col(REASON) if REASON in df.columns else F.lit(None).cast("string")
    record = F.col(RECORD) if RECORD in df.columns else F.lit(None).cast("string")
    checked = df.withColumn(REASON, first_failure(earlier, *checks))
    as_typed = {c: F.when(_fits(df, c, t), F.col(c)).cast(t).alias(c) for c, t in types.items()}
    new_record = F.when(F.col(REASON).isNotNull(), as_record(columns))
    return checked.select(
        *[as_typed.get(c, c) for c in columns], REASON, F.coalesce(record, new_record).alias(RECORD)
    )
