"""Cleaning of parsed users and transactions.

Frames from ``parse_*`` carry rejected rows along: those skip every rule here, so
that one pass over the files yields both the clean and the rejected rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledger_sync.functions.rules import amount_in_range, is_contact, replace_contact
from ledger_sync.operators.dedup import keep_first
from ledger_sync.schemas import (
    FILE_ORDER, REASON, ROW, SCRIPT, TRANSACTION_FILLS, USER_FILLS, Preset,
)


def clean_users(
    users: DataFrame, preset: Preset = SCRIPT, order: Sequence[str | Column] = FILE_ORDER
) -> DataFrame:
    return user_rules(first_per_key(users, "userid", order), preset)


def clean_transactions(
    transactions: DataFrame, preset: Preset = SCRIPT, order: Sequence[str | Column] = FILE_ORDER
) -> DataFrame:
    return transaction_rules(first_per_key(transactions, "transactionid", order), preset)


def first_per_key(
    df: DataFrame, key: str, order: Sequence[str | Column] = FILE_ORDER
) -> DataFrame:
    """Deduplicate before any rule, so a bad first row also hides a good later one, be it rejected.

    Rejected rows that have no key all stay.
    """
    if REASON in df.columns:
        keyless = F.col(REASON).isNotNull() & F.col(key).isNull()
        return keep_first(df, [key], order, keyless, ROW)
    return keep_first(df, [key], order)


def user_rules(users: DataFrame, preset: Preset = SCRIPT) -> DataFrame:
    """Fill missing values, then replace or drop invalid contacts."""
    filled = users.na.fill(USER_FILLS)
    if preset.contact_policy == "drop":
        return filled.where(_rejected(users) | is_contact(F.col("contact")))
    return filled.withColumn("contact", replace_contact(F.col("contact")))


def transaction_rules(transactions: DataFrame, preset: Preset = SCRIPT) -> DataFrame:
    """Keep amounts in range, then fill what is missing; dates and users are not filled.

    No amount is missing after the range check, so its fill never applies.
    """
    valid = amount_in_range(F.col("amount"), preset.max_amount)
    return transactions.where(_rejected(transactions) | valid).na.fill(TRANSACTION_FILLS)


def _rejected(df: DataFrame) -> Column:
    return F.col(REASON).isNotNull() if REASON in df.columns else F.lit(False)
