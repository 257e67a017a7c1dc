"""Whether a published warehouse keeps its constraints: keys, references, lengths, layout.

Loads check what they bring; this checks what is stored, however it came there. Keys and references
are counted before they are compared, so a key that many rows share is a few rows in each shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledger_sync.plans.warehouse import BUCKET, PERIOD, Warehouse
from ledger_sync.schemas import CONTROL_ID, METADATA, TRANSACTIONS, USERS


def violations(warehouse: Warehouse) -> DataFrame:
    """A row (table, rule, n) for each rule with the number of rows that break it, zeros included.

    Of rows that share a key, all but one break the rule. Null references are allowed. The control
    table breaks its rule once for each row with the control id that is missing or too many."""
    pinned = warehouse.at()
    limits = pinned.limits
    users = pinned.read_users(pinned.buckets(pinned.entries()), with_bucket=True)
    transactions = pinned.read_periods(pinned.periods(pinned.entries()))
    is_control = F.col("id") == CONTROL_ID
    parts = [
        _counted(users, USERS, {
            "userid is null": F.col("userid").isNull(),
            "name is too long": F.length("name") > limits.name_length,
            "contact is too long": F.length("contact") > limits.text_length,
            "userid is in another bucket": F.col(BUCKET) != pinned.bucket_of(F.col("userid")),
        }),
        _counted(transactions, TRANSACTIONS, {
            "transactionid is null": F.col("transactionid").isNull(),
            **{f"{c} is too long": F.length(c) > limits.text_length for c in ("type", "status", "method")},
            "date is in another period": ~F.col(PERIOD).eqNullSafe(pinned.period_of(F.col("date"))),
        }),
        _repeated(users, USERS, "userid"),
        _repeated(transactions, TRANSACTIONS, "transactionid"),
        _unknown(transactions, users),
        pinned.metadata().agg(
            F.abs(F.count_if(is_control) - 1).alias("rows"),
            F.count_if(is_control & F.col("last_update_date").isNull()).alias("marks"),
        ).select(F.inline(F.array(
            _row(METADATA, "the control row is not there once", F.col("rows")),
            _row(METADATA, "last_update_date is null", F.col("marks")),
        ))),
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _row(table: str, rule: str, n: Column) -> Column:
    names = F.lit(table).alias("table"), F.lit(rule).alias("rule")
    return F.struct(*names, F.coalesce(n, F.lit(0)).cast("bigint").alias("n"))


def _counted(rows: DataFrame, table: str, broken: dict[str, Column]) -> DataFrame:
    """All rules on single rows, in one pass."""
    names = {rule: f"_{i}" for i, rule in enumerate(broken)}
    sums = rows.agg(*[F.count_if(broken[rule]).alias(name) for rule, name in names.items()])
    return sums.select(F.inline(F.array(*[_row(table, rule, F.col(name)) for rule, name in names.items()])))


def _repeated(rows: DataFrame, table: str, key: str) -> DataFrame:
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum(F.col("n") - 1).alias("n"))
    return total.select(F.inline(F.array(_row(table, f"{key} is repeated", F.col("n")))))


def _unknown(transactions: DataFrame, users: DataFrame) -> DataFrame:
    sent = transactions.where(F.col("userid").isNotNull()).groupBy("userid").agg(F.count("*").alias("n"))
    total = sent.join(users.select("userid"), "userid", "left_anti").agg(F.sum("n").alias("n"))
    return total.select(F.inline(F.array(_row(TRANSACTIONS, "userid is not in users", F.col("n")))))
