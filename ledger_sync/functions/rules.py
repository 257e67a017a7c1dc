"""Business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledger_sync.schemas import CONTACT_PATTERN, INVALID_CONTACT


def is_contact(contact: Column) -> Column:
    return F.coalesce(contact.rlike(CONTACT_PATTERN), F.lit(False))


def replace_contact(contact: Column) -> Column:
    return F.when(is_contact(contact), contact).otherwise(F.lit(INVALID_CONTACT))


def amount_in_range(amount: Column, maximum: float | None = None) -> Column:
    """At least zero and, where a cap is set, at most the cap; null and NaN fail."""
    fits = (amount >= 0) & ~F.isnan(amount)
    return fits if maximum is None else fits & (amount <= maximum)


def credited(kind: Column, amount: Column) -> Column:
    return F.when(kind == "credit", amount).otherwise(0)


def debited(kind: Column, amount: Column) -> Column:
    return F.when(kind == "debit", amount).otherwise(0)


def contribution(status: Column, kind: Column, amount: Column) -> Column:
    """What one transaction adds to its user's balance."""
    signed = F.when(kind == "credit", amount).when(kind == "debit", -amount)
    return F.when(status == "completed", signed)
