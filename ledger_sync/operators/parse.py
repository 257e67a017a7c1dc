"""Typed projection of landed text extracts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledger_sync.functions.parsing import (
    countable, null_if_token, to_moment, to_number, to_whole,
)
from ledger_sync.schemas import (
    DATE_FORM, FILE_ORDER, RECORD, REASON, TRANSACTION_COLUMNS, UNDATED, USER_COLUMNS,
)


def null_tokens(df: DataFrame, columns: Sequence[str], **tokens) -> DataFrame:
    """Null the texts, and the numbers NaN, that stand for a missing value in ``columns``."""
    kinds = {f.name: f.dataType for f in df.schema}
    present = {}
    for c in columns:
        if isinstance(kinds[c], T.StringType):
            present[c] = null_if_token(F.col(c), **tokens)
        elif isinstance(kinds[c], T.FractionalType) and not isinstance(kinds[c], T.DecimalType):
            present[c] = F.when(~F.isnan(c), F.col(c))
    return df.withColumns(present)


def parse_users(landed: DataFrame) -> DataFrame:
    return _parse(
        landed,
        USER_COLUMNS,
        {"userid": to_whole, "balance": to_number},
        ("userid is missing or no whole number", _missing("userid")),
        ("balance is no number", _unparsed("balance")),
    )


def parse_transactions(
    landed: DataFrame, date_form: str = DATE_FORM, reject_undated: bool = False
) -> DataFrame:
    """``_undated`` marks rows whose date is not in the form, or beyond what is kept; those lose
    the date, or are rejected for it."""

    def to_date(text: Column) -> Column:
        return countable(to_moment(text, date_form))

    undated = _unparsed("date")
    refused = [("date is in another form", undated)] if reject_undated else []
    return _parse(
        landed,
        TRANSACTION_COLUMNS,
        {"transactionid": to_whole, "userid": to_whole, "amount": to_number, "date": to_date},
        ("transactionid is missing or no whole number", _missing("transactionid")),
        ("userid is no whole number", _unparsed("userid")),
        ("amount is no number", _unparsed("amount")),
        *refused,
        extra={UNDATED: undated},
    )


def _parse(
    landed: DataFrame,
    columns: Sequence[str],
    parsers: dict[str, Callable[[Column], Column]],
    *checks: tuple[str, Column],
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Values beside their texts, then the first failed check, then the record as it came for
    rows that fail one. Each step uses the one before more than once, hence the steps. Columns
    that come typed are taken as they are."""
    text = null_tokens(landed, columns)
    kinds = {f.name: f.dataType for f in landed.schema}
    values = text.withColumns(
        {_value(c): _parsed(c, kinds[c], parse) for c, parse in parsers.items()}
    )
    checked = values.withColumn(REASON, first_failure(F.col(REASON), *checks))
    as_json = F.when(F.col(REASON).isNotNull(), F.to_json(F.struct(*columns)))
    return checked.select(
        *[F.col(_value(c)).alias(c) if c in parsers else F.col(c).cast("string") for c in columns],
        *FILE_ORDER,
        *[value.alias(name) for name, value in (extra or {}).items()],
        REASON,
        F.coalesce(F.col(RECORD), as_json).alias(RECORD),
    )


def _parsed(column: str, kind: T.DataType, parse: Callable[[Column], Column]) -> Column:
    value = F.col(column)
    if parse is to_whole and isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    if parse is to_whole and isinstance(kind, T.NumericType):
        return F.when(value == F.floor(value), value.try_cast("bigint"))
    if parse is to_number and isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return countable(value.cast("timestamp_ntz"))
    return parse(value.cast("string"))


def _value(column: str) -> str:
    return f"_{column}_value"


def _missing(column: str) -> Column:
    return F.col(_value(column)).isNull()


def _unparsed(column: str) -> Column:
    return F.col(column).isNotNull() & _missing(column)


def first_failure(earlier: Column, *checks: tuple[str, Column]) -> Column:
    return F.coalesce(earlier, *[F.when(failed, F.lit(reason)) for reason, failed in checks])
