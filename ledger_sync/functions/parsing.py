"""Text to value, yielding null where the text is not a value."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from ledger_sync.schemas import (
    DATE_FORM, DATE_FORMS, FIRST_DATE, LAST_DATE, NA_TOKENS, NUMBER_PATTERN, WHOLE_PATTERN,
)


def null_if_token(text: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Null for the texts that stand for a missing value."""
    return F.when(~text.isin(*tokens), text)


def to_whole(text: Column) -> Column:
    """64-bit whole number, also one that is written with zero decimals (``7.0``)."""
    return F.substring_index(_where(text, WHOLE_PATTERN), ".", 1).try_cast("bigint")


def to_number(text: Column) -> Column:
    """Double; never NaN, which Spark ranks above every number."""
    return _where(text, NUMBER_PATTERN).try_cast("double")


def to_moment(text: Column, form: str = DATE_FORM) -> Column:
    """A date without zone in one of ``DATE_FORMS``; any other form is null."""
    return _where(text, DATE_FORMS[form]).try_cast("timestamp_ntz")


def form_of(date: str | None) -> str:
    """The form of a text; the usual one if it has none of them."""
    found = (f for f, p in DATE_FORMS.items() if date and re.fullmatch(p.removesuffix(r"\z"), date))
    return next(found, DATE_FORM)


def countable(moment: Column) -> Column:
    """Null outside the dates that nanoseconds can count."""
    first, last = (F.lit(t).cast("timestamp_ntz") for t in (FIRST_DATE, LAST_DATE))
    return F.when(moment.between(first, last), moment)


def _where(text: Column, pattern: str) -> Column:
    """Only text of the right form gets to a cast: a failing one costs an exception per row."""
    return F.when(text.rlike(pattern), text)
