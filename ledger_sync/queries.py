"""Registered queries: the operators over the given tables, each with SQL to check it.

Roles: customers are users, orders and order lines are transactions, events are further
transactions. A batch re-sends one status of orders changed and brings all events as new.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledger_sync.functions.parsing import to_moment, to_number, to_whole
from ledger_sync.functions.rules import amount_in_range, is_contact, replace_contact
from ledger_sync.operators.balance import (
    advance_watermark, apply_net_changes, control_row, credit_debit_totals, net_changes,
    refresh_balances, transaction_summaries,
)
from ledger_sync.operators.clean import clean_transactions, clean_users, first_per_key
from ledger_sync.operators.dedup import keep_first
from ledger_sync.operators.merge import change_classes, matched, upsert
from ledger_sync.operators.parse import null_tokens, parse_transactions, parse_users
from ledger_sync.operators.validate import (
    accepted, check_transactions, check_users, orphan_userids, orphans, repeated_keys,
)
from ledger_sync.plans.audit import violations
from ledger_sync.plans.load import BatchRejected, Report, run_batch
from ledger_sync.plans.warehouse import Warehouse
from ledger_sync.schemas import (
    BLOCK, DAG, DATE_FORM, FILE, NA_TOKENS, REASON, RECORD, ROW, SCRIPT, SCRIPT_CAPPED,
    TRANSACTION_COLUMNS, TRANSACTION_FILLS, TRANSACTION_SINK_COLUMNS, UNDATED, USER_COLUMNS, Limits,
    Preset,
)
from ledger_sync.session import scratch_path
from ledger_sync.sources.extracts import (
    csv_extract, land_rows, read_csv_extract, read_json_extract,
)
from ledger_sync.streaming.ingest import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Sums over a whole table may exceed the ten digits of a single user's account.
WIDE_MONEY = "decimal(22,2)"
WIDE = Limits(key_type="bigint", money=WIDE_MONEY)
MARK = "1998-01-01 00:00:00"
LATER_MARK, LAST_MARK = "2000-01-01 00:00:00", "2025-01-01 00:00:00"
LINE_CAP = Preset("lines", max_amount=50000.0)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        name = function.__name__
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# Roles

USERS_SQL = """
users AS (
  SELECT c_custkey AS userid, c_name AS name,
         CAST(c_nationkey AS VARCHAR) || substr(c_name, 10) AS contact, c_acctbal AS balance
  FROM customer)"""

TXNS_SQL = """
txns AS (
  SELECT o_orderkey AS transactionid, o_custkey AS userid,
         CAST(o_totalprice AS DECIMAL(10,2)) AS amount,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'credit'
              WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'debit'
              ELSE 'transfer' END AS type,
         o_orderdate AS date,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
              ELSE 'failed' END AS status,
         o_orderpriority AS method
  FROM orders)"""

EVENTS_SQL = """
event_txns AS (
  SELECT -1 - event_id AS transactionid, user_id AS userid,
         CAST(value AS DECIMAL(10,2)) AS amount,
         CASE event_type WHEN 'signup' THEN 'credit' WHEN 'purchase' THEN 'debit'
              ELSE event_type END AS type,
         ts AS date,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
         event_type AS method
  FROM events)"""

# Failed orders come again as completed, later, dearer and without a method.
BATCH_SQL = """
batch AS (
  SELECT transactionid, userid, CAST(amount + 10 AS DECIMAL(10,2)) AS amount, type,
         date + INTERVAL 30 DAY AS date, 'completed' AS status, CAST(NULL AS VARCHAR) AS method
  FROM txns WHERE status = 'failed'
  UNION ALL
  SELECT transactionid, userid, amount, type, date, status, method FROM event_txns)"""

MERGED_SQL = """
merged AS (
  SELECT t.* FROM txns t
  WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.transactionid = t.transactionid)
  UNION ALL SELECT * FROM batch)"""

# Overdrawn customers come again without a name and with an empty account; suppliers are new.
USER_BATCH_SQL = """
user_batch AS (
  SELECT userid, CAST(NULL AS VARCHAR) AS name, contact, CAST(0 AS DOUBLE) AS balance
  FROM users WHERE balance < 0
  UNION ALL
  SELECT -1 - s_suppkey, s_name, NULL, s_acctbal FROM supplier)"""

LINES_SQL = """
lines AS (
  SELECT l_orderkey * 10 + l_linenumber AS transactionid, l_suppkey AS userid,
         l_extendedprice AS amount,
         CASE l_returnflag WHEN 'A' THEN 'credit' WHEN 'R' THEN 'debit' END AS type,
         l_shipdate AS date,
         CASE WHEN l_linestatus = 'F' THEN 'completed' END AS status,
         CAST(l_partkey AS VARCHAR) AS method
  FROM lineitem)"""


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _cents(column: str) -> Column:
    return F.col(column).cast("decimal(10,2)")


def users_of(spark: SparkSession, folder: str) -> DataFrame:
    """Customers; the contact is the nation number before the nine digits of the name."""
    return _read(spark, folder, "customer").select(
        F.col("c_custkey").alias("userid"),
        F.col("c_name").alias("name"),
        F.concat(F.col("c_nationkey").cast("string"), F.substring("c_name", 10, 20)).alias(
            "contact"
        ),
        F.col("c_acctbal").alias("balance"),
    )


def transactions_of(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("status")
    named = F.when(status == "F", "completed").when(status == "O", "pending").otherwise("failed")
    return coded_transactions_of(spark, folder).withColumn("status", named)


def coded_transactions_of(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as transactions under their own status codes, which a scan can filter by."""
    priority = F.col("o_orderpriority")
    return _read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transactionid"),
        F.col("o_custkey").alias("userid"),
        _cents("o_totalprice").alias("amount"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "credit")
        .when(priority.isin("4-NOT SPECIFIED", "5-LOW"), "debit")
        .otherwise("transfer")
        .alias("type"),
        F.col("o_orderdate").alias("date"),
        F.col("o_orderstatus").alias("status"),
        priority.alias("method"),
    )


def event_transactions_of(spark: SparkSession, folder: str) -> DataFrame:
    """Events as transactions, under negative ids that no order has."""
    kind = F.col("event_type")
    return _read(spark, folder, "events").select(
        (F.lit(-1) - F.col("event_id")).alias("transactionid"),
        F.col("user_id").alias("userid"),
        _cents("value").alias("amount"),
        F.when(kind == "signup", "credit").when(kind == "purchase", "debit").otherwise(kind).alias(
            "type"
        ),
        F.col("ts").alias("date"),
        F.when(kind == "error", "failed").otherwise("completed").alias("status"),
        kind.alias("method"),
    )


def transaction_batch_of(spark: SparkSession, folder: str) -> DataFrame:
    failed = transactions_of(spark, folder).where(F.col("status") == "failed")
    retried = failed.select(
        "transactionid",
        "userid",
        (F.col("amount") + 10).cast("decimal(10,2)").alias("amount"),
        "type",
        (F.col("date") + F.expr("INTERVAL 30 DAY")).alias("date"),
        F.lit("completed").alias("status"),
        F.lit(None).cast("string").alias("method"),
    )
    return retried.unionByName(event_transactions_of(spark, folder))


def user_batch_of(spark: SparkSession, folder: str) -> DataFrame:
    overdrawn = users_of(spark, folder).where(F.col("balance") < 0)
    reset = overdrawn.select(
        "userid",
        F.lit(None).cast("string").alias("name"),
        "contact",
        F.lit(0.0).alias("balance"),
    )
    suppliers = _read(spark, folder, "supplier").select(
        (F.lit(-1) - F.col("s_suppkey")).alias("userid"),
        F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("contact"),
        F.col("s_acctbal").alias("balance"),
    )
    return reset.unionByName(suppliers)


def lines_of(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as transactions: many share an id, some lack a type or a status."""
    flag = F.col("l_returnflag")
    return _read(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transactionid"),
        F.col("l_suppkey").alias("userid"),
        F.col("l_extendedprice").alias("amount"),
        F.when(flag == "A", "credit").when(flag == "R", "debit").alias("type"),
        F.col("l_shipdate").alias("date"),
        F.when(F.col("l_linestatus") == "F", "completed").alias("status"),
        F.col("l_partkey").cast("string").alias("method"),
    )


# Balances


@query(f"""
WITH {TXNS_SQL},
ts AS (
  SELECT userid, SUM(CASE WHEN type = 'credit' THEN amount ELSE 0 END) AS total_credits,
         SUM(CASE WHEN type = 'debit' THEN amount ELSE 0 END) AS total_debits
  FROM txns WHERE status = 'completed' AND date > TIMESTAMP '{MARK}' GROUP BY userid)
SELECT c_custkey AS userid,
       CAST(CAST(c_acctbal AS DECIMAL(10,2)) + COALESCE(total_credits, 0)
            - COALESCE(total_debits, 0) AS DECIMAL(22,2)) AS balance
FROM customer LEFT JOIN ts ON c_custkey = ts.userid""")
def balance_refresh(spark: SparkSession, folder: str) -> DataFrame:
    return _refreshed(spark, folder, MARK)


@query("""
SELECT c_custkey AS userid,
       CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS DECIMAL(22,2)) AS balance FROM customer""")
def balance_refresh_null_watermark(spark: SparkSession, folder: str) -> DataFrame:
    return _refreshed(spark, folder, None)


@query(f"""
WITH {TXNS_SQL},
control AS (SELECT MAX(date) - INTERVAL 365 DAY AS mark FROM txns WHERE status = 'failed'),
ts AS (
  SELECT userid, SUM(CASE WHEN type = 'credit' THEN amount ELSE 0 END) AS total_credits,
         SUM(CASE WHEN type = 'debit' THEN amount ELSE 0 END) AS total_debits
  FROM txns WHERE status = 'completed' AND date > (SELECT mark FROM control) GROUP BY userid)
SELECT c_custkey AS userid,
       CAST(CAST(c_acctbal AS DECIMAL(10,2)) + COALESCE(total_credits, 0)
            - COALESCE(total_debits, 0) AS DECIMAL(22,2)) AS balance
FROM customer LEFT JOIN ts ON c_custkey = ts.userid""")
def balance_refresh_stored_watermark(spark: SparkSession, folder: str) -> DataFrame:
    """The mark is looked up in a control table first and then filters as a literal."""
    failed = coded_transactions_of(spark, folder).where(F.col("status") == "P")
    last = F.max("date") - F.expr("INTERVAL 365 DAY")
    control = failed.agg(last.alias("last_update_date"))
    mark = control_row(control.select(F.lit(1).alias("id"), "last_update_date")).first()[0]
    return _refreshed(spark, folder, mark)


def _refreshed(spark: SparkSession, folder: str, mark: datetime | str | None) -> DataFrame:
    users, transactions = _opening_balances(spark, folder), coded_transactions_of(spark, folder)
    return refresh_balances(users, transactions, mark, WIDE_MONEY, completed="F")


def _opening_balances(spark: SparkSession, folder: str) -> DataFrame:
    return users_of(spark, folder).select("userid", _cents("balance").alias("balance"))


@query(f"""
WITH {TXNS_SQL}
SELECT userid, SUM(CASE WHEN type = 'credit' THEN amount ELSE 0 END) AS total_credits,
       SUM(CASE WHEN type = 'debit' THEN amount ELSE 0 END) AS total_debits
FROM txns WHERE status = 'completed' AND date > TIMESTAMP '{MARK}' GROUP BY userid""")
def completed_summaries(spark: SparkSession, folder: str) -> DataFrame:
    return transaction_summaries(coded_transactions_of(spark, folder), MARK, completed="F")


@query("""
SELECT user_id AS userid,
       SUM(CASE WHEN event_type = 'signup' THEN CAST(value AS DECIMAL(10,2)) ELSE 0 END)
         AS total_credits,
       SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(10,2)) ELSE 0 END)
         AS total_debits
FROM events GROUP BY user_id""")
def credit_debit_summary(spark: SparkSession, folder: str) -> DataFrame:
    events = event_transactions_of(spark, folder)
    return credit_debit_totals(events, "userid", F.col("type"), F.col("amount"))


@query(f"""
WITH {USERS_SQL}, {TXNS_SQL}, {EVENTS_SQL}, {BATCH_SQL}, {MERGED_SQL}
SELECT u.userid, CAST(CAST(u.balance AS DECIMAL(10,2)) + COALESCE(s.net, 0) AS DECIMAL(22,2))
       AS balance
FROM users u LEFT JOIN (
  SELECT userid, SUM(CASE type WHEN 'credit' THEN amount WHEN 'debit' THEN -amount END) AS net
  FROM merged WHERE status = 'completed' GROUP BY userid) s ON u.userid = s.userid""")
def late_correction(spark: SparkSession, folder: str) -> DataFrame:
    """Balances moved by a batch of corrections equal balances computed from all rows anew."""
    stored, batch = transactions_of(spark, folder), transaction_batch_of(spark, folder)
    opening = _opening_balances(spark, folder)
    before = apply_net_changes(opening, net_changes(stored), WIDE_MONEY)
    changes = net_changes(batch, matched(stored, batch, "transactionid"))
    return apply_net_changes(before, changes, WIDE_MONEY)


@query("""
SELECT id, CASE WHEN id = 1 THEN TIMESTAMP '2002-01-01 00:00:00' ELSE mark END
       AS last_update_date
FROM (SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id, MAX(o_orderdate) AS mark
      FROM orders GROUP BY 1) AS control""")
def watermark_advance(spark: SparkSession, folder: str) -> DataFrame:
    """One control row per order priority; only the first one is set to the run time."""
    ids = F.substring("o_orderpriority", 1, 1).cast("int").alias("id")
    marks = _read(spark, folder, "orders").groupBy(ids)
    control = marks.agg(F.max("o_orderdate").alias("last_update_date"))
    return advance_watermark(control, "2002-01-01 00:00:00")


# Cleaning


LINE_COLUMNS = (
    "l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus"
)


@query(f"""
SELECT {LINE_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_COLUMNS}) AS r
  FROM lineitem) AS ranked WHERE r = 1""")
def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    columns = LINE_COLUMNS.split(", ")
    lines = _read(spark, folder, "lineitem").select(*columns)
    return keep_first(lines, ["l_orderkey", "l_linenumber"], columns)


@query(f"""
SELECT {LINE_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_COLUMNS}) AS r
  FROM lineitem) AS ranked WHERE r = 1 AND l_extendedprice BETWEEN 0 AND 50000""")
def dedup_then_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A bad first row hides a good later one."""
    first = dedup_keep_first(spark, folder)
    return first.where(amount_in_range(F.col("l_extendedprice"), 50000))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def amount_nonnegative(spark: SparkSession, folder: str) -> DataFrame:
    customers = _read(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return customers.where(amount_in_range(F.col("c_acctbal")))


@query("""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 0 AND o_totalprice <= 400000""")
def amount_cap(spark: SparkSession, folder: str) -> DataFrame:
    orders = _read(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.where(amount_in_range(F.col("o_totalprice"), 400000))


@query("""
SELECT event_id, value - 50 AS amount FROM events
WHERE event_type NOT IN ('error', 'view') AND value - 50 >= 0""")
def amount_not_a_number(spark: SparkSession, folder: str) -> DataFrame:
    """NaN ranks above every number in Spark, and still is no valid amount; nor is null."""
    amount = (
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .when(F.col("event_type") == "view", F.lit(None).cast("double"))
        .otherwise(F.col("value") - 50)
    )
    events = _read(spark, folder, "events").select("event_id", amount.alias("amount"))
    return events.where(amount_in_range(F.col("amount")))


@query(f"""
WITH {USERS_SQL}
SELECT userid, CASE WHEN regexp_full_match(contact, '[0-9]{{10}}') THEN contact
       ELSE 'not provided' END AS contact FROM users""")
def contact_replace(spark: SparkSession, folder: str) -> DataFrame:
    users = users_of(spark, folder)
    return users.select("userid", replace_contact(F.col("contact")).alias("contact"))


@query(f"""
WITH {USERS_SQL}
SELECT userid, contact FROM users WHERE regexp_full_match(contact, '[0-9]{{10}}')""")
def contact_drop(spark: SparkSession, folder: str) -> DataFrame:
    return users_of(spark, folder).select("userid", "contact").where(is_contact(F.col("contact")))


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN 0.0 ELSE value END AS amount,
       CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS type,
       CASE WHEN event_type = 'click' THEN 'unknown' ELSE 'seen' END AS status,
       CASE WHEN event_type = 'signup' THEN 'not specified' ELSE props END AS method
FROM events""")
def na_tokens_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that mean "missing" become null, and null becomes the fill value."""
    kind = F.col("event_type")
    landed = _read(spark, folder, "events").select(
        "event_id",
        F.when(kind == "view", "NaN").otherwise(F.col("value").cast("string")).alias("amount"),
        kind.alias("type"),
        F.when(kind == "click", "").otherwise("seen").alias("status"),
        F.when(kind == "signup", "N/A").otherwise(F.col("props")).alias("method"),
    )
    columns = ["amount", "type", "status", "method"]
    nulled = null_tokens(landed, columns, tokens=(*NA_TOKENS, "error"))
    return nulled.withColumn("amount", to_number(F.col("amount"))).na.fill(TRANSACTION_FILLS)


@query("""
SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS number,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS amount,
       CASE WHEN event_type IN ('view', 'click') THEN NULL
            ELSE ts END AS date
FROM events""")
def coerce_types(spark: SparkSession, folder: str) -> DataFrame:
    """Text that is no number or no timestamp of the extract's form becomes null."""
    kind, moment = F.col("event_type"), _to_micros(F.col("ts"))
    text = F.col("value").cast("string")
    return _read(spark, folder, "events").select(
        "event_id",
        to_whole(F.regexp_extract("props", "[0-9]+", 0)).alias("number"),
        to_number(F.when(kind == "error", F.concat(text, F.lit("d"))).otherwise(text)).alias(
            "amount"
        ),
        to_moment(
            F.when(kind == "view", F.substring(moment, 1, 10))
            .when(kind == "click", F.replace(moment, F.lit(" "), F.lit("T")))
            .otherwise(moment),
            "yyyy-MM-dd HH:mm:ss.f",
        ).alias("date"),
    )


# Two versions of each customer: the second under another name, with the balance reversed.
_TWICE_SQL = f"""
WITH {USERS_SQL},
twice AS (
  SELECT userid, name, contact, balance FROM users
  UNION ALL SELECT userid, 'NA', contact, -balance FROM users),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY userid ORDER BY balance, contact, name DESC) AS r
  FROM twice)"""
_TWICE_ORDER = ("balance", "contact")


def _twice(spark: SparkSession, folder: str) -> DataFrame:
    users = users_of(spark, folder)
    again = users.withColumns({"name": F.lit("NA"), "balance": -F.col("balance")})
    return users.unionByName(again)


@query(f"""{_TWICE_SQL}
SELECT userid, name, CASE WHEN regexp_full_match(contact, '[0-9]{{10}}') THEN contact
       ELSE 'not provided' END AS contact, balance FROM ranked WHERE r = 1""")
def clean_users_script(spark: SparkSession, folder: str) -> DataFrame:
    order = [*_TWICE_ORDER, F.desc("name")]
    return clean_users(_twice(spark, folder), SCRIPT, order)


@query(f"""{_TWICE_SQL}
SELECT userid, name, contact, balance FROM ranked
WHERE r = 1 AND regexp_full_match(contact, '[0-9]{{10}}')""")
def clean_users_dag(spark: SparkSession, folder: str) -> DataFrame:
    order = [*_TWICE_ORDER, F.desc("name")]
    return clean_users(_twice(spark, folder), DAG, order)


_LINE_ORDER = ("date", "amount", "method", "userid", "type", "status")


def _lines_sql(cap: float | None) -> str:
    return f"""
WITH {LINES_SQL},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY transactionid
    ORDER BY date, amount, method, userid, type NULLS FIRST, status NULLS FIRST) AS r
  FROM lines)
SELECT transactionid, userid, amount, COALESCE(type, 'unknown') AS type, date,
       COALESCE(status, 'unknown') AS status, method
FROM ranked WHERE r = 1 AND amount >= 0{'' if cap is None else f' AND amount <= {cap}'}"""


@query(_lines_sql(None))
def clean_transactions_script(spark: SparkSession, folder: str) -> DataFrame:
    return clean_transactions(lines_of(spark, folder), SCRIPT, _LINE_ORDER)


@query(_lines_sql(10000))
def clean_transactions_capped(spark: SparkSession, folder: str) -> DataFrame:
    return clean_transactions(lines_of(spark, folder), SCRIPT_CAPPED, _LINE_ORDER)


# CSV round trips: the tables are written as extracts in a known file order and read back.


def _write_extract(df: DataFrame, order: list[str | Column], path: str) -> str:
    """Write a CSV extract of many files whose rows, file after file, follow ``order``."""
    shuffle_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = df.repartitionByRange(shuffle_partitions, *order).sortWithinPartitions(*order)
    sorted_rows.write.option("header", True).option("escape", '"').csv(path)
    return path


def _as_text(df: DataFrame) -> DataFrame:
    """Dates in one form, which keeps their fractions, in any session time zone."""
    if "date" not in df.columns:
        return df
    return df.withColumn("date", _to_micros(F.col("date")))


def _to_micros(moment: Column) -> Column:
    """The text ``yyyy-MM-dd HH:mm:ss.SSSSSS`` of a zoneless timestamp."""
    text = moment.cast("string")
    micros = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.concat(F.substring(text, 1, 19), F.lit("."), micros)


@query(f"""{_TWICE_SQL}
SELECT userid, CASE WHEN name = 'NA' THEN 'unknown' ELSE name END AS name,
       CASE WHEN regexp_full_match(contact, '[0-9]{{10}}') THEN contact
       ELSE 'not provided' END AS contact, balance FROM ranked WHERE r = 1""")
def csv_roundtrip_users(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "users-csv")
    order = [*_TWICE_ORDER, F.desc("name"), "userid"]
    _write_extract(_twice(spark, folder), order, path)
    landed = read_csv_extract(spark, path, USER_COLUMNS)
    return clean_users(parse_users(landed), SCRIPT).select(*USER_COLUMNS)


@query(_lines_sql(50000))
def csv_roundtrip_transactions(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lines-csv")
    lines = lines_of(spark, folder)
    _write_extract(_as_text(lines), [*_LINE_ORDER, "transactionid"], path)
    extract = csv_extract(spark, path, TRANSACTION_COLUMNS)
    parsed = parse_transactions(extract.rows(), extract.date_form())
    return clean_transactions(parsed, LINE_CAP).select(*TRANSACTION_COLUMNS)


@query(f"""
WITH {TXNS_SQL}
SELECT transactionid, amount, type, date, status, method, userid FROM txns""")
def land_table_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a source that is no CSV file go the same way."""
    landed = land_rows(transactions_of(spark, folder), TRANSACTION_COLUMNS)
    cleaned = clean_transactions(parse_transactions(landed))
    checked = accepted(check_transactions(cleaned, Limits(key_type="bigint")))
    return checked.select(*TRANSACTION_SINK_COLUMNS)


# Upserts and checks


@query(f"""
WITH {USERS_SQL}, {USER_BATCH_SQL}
SELECT * FROM users u WHERE NOT EXISTS (SELECT 1 FROM user_batch b WHERE b.userid = u.userid)
UNION ALL SELECT * FROM user_batch""")
def upsert_users(spark: SparkSession, folder: str) -> DataFrame:
    return upsert(users_of(spark, folder), user_batch_of(spark, folder), "userid")


@query(f"""
WITH {TXNS_SQL}, {EVENTS_SQL}, {BATCH_SQL}, {MERGED_SQL}
SELECT transactionid, amount, type, date, status, method, userid FROM merged""")
def upsert_transactions(spark: SparkSession, folder: str) -> DataFrame:
    stored = transactions_of(spark, folder).select(*TRANSACTION_SINK_COLUMNS)
    return upsert(stored, transaction_batch_of(spark, folder), "transactionid")


# The completed orders come again unchanged, too.
_RESENT_SQL = f"""
WITH {TXNS_SQL}, {EVENTS_SQL}, {BATCH_SQL},
resent AS (SELECT * FROM batch UNION ALL SELECT * FROM txns WHERE status = 'completed'),
classes AS (
  SELECT COALESCE(t.transactionid, b.transactionid) AS transactionid,
         CASE WHEN t.transactionid IS NULL THEN 'insert'
              WHEN b.transactionid IS NULL THEN 'absent'
              WHEN t.userid IS DISTINCT FROM b.userid OR t.amount IS DISTINCT FROM b.amount
                OR t.type IS DISTINCT FROM b.type OR t.date IS DISTINCT FROM b.date
                OR t.status IS DISTINCT FROM b.status OR t.method IS DISTINCT FROM b.method
              THEN 'update' ELSE 'unchanged' END AS change
  FROM txns t FULL OUTER JOIN resent b ON t.transactionid = b.transactionid)"""


@query(f"{_RESENT_SQL} SELECT transactionid, change FROM classes")
def change_classes_of_batch(spark: SparkSession, folder: str) -> DataFrame:
    stored = transactions_of(spark, folder)
    unchanged = stored.where(F.col("status") == "completed")
    resent = transaction_batch_of(spark, folder).unionByName(unchanged)
    return change_classes(stored, resent, "transactionid")


@query(f"{_RESENT_SQL} SELECT change, COUNT(*) AS n FROM classes GROUP BY change")
def change_counts_of_batch(spark: SparkSession, folder: str) -> DataFrame:
    classes = change_classes_of_batch(spark, folder)
    return classes.groupBy("change").agg(F.count("*").alias("n"))


@query(f"""
WITH {USERS_SQL}, {TXNS_SQL}
SELECT transactionid, t.userid FROM txns t
WHERE t.userid IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM users u
  WHERE u.userid = t.userid AND regexp_full_match(u.contact, '[0-9]{{10}}'))""")
def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Dropping users with an invalid contact leaves transactions without a user.

    As in a load, the orphan ids are written first: a join of their file with the transactions
    is broadcast where the file is small, and else split by the planner where a user is hot.
    """
    transactions = transactions_of(spark, folder).select("transactionid", "userid")
    path = scratch_path(spark, "orphans")
    orphan_userids(transactions, contact_drop(spark, folder)).write.parquet(path)
    return orphans(transactions, spark.read.schema("userid bigint").parquet(path))


@query(f"""
WITH {USERS_SQL}
SELECT userid, reject_reason FROM (
  SELECT userid, CASE WHEN length(name) > 100 THEN 'name is too long'
    WHEN length(contact) > 10 THEN 'contact is too long'
    WHEN abs(CAST(balance AS DECIMAL(10,2))) >= 1000 THEN 'balance is out of range' END
    AS reject_reason FROM users) AS checked WHERE reject_reason IS NOT NULL""")
def constraint_rejects_users(spark: SparkSession, folder: str) -> DataFrame:
    limits = Limits(key_type="bigint", money="decimal(5,2)", text_length=10)
    checked = check_users(users_of(spark, folder), limits)
    return checked.where(F.col(REASON).isNotNull()).select("userid", REASON)


@query(f"""
WITH {TXNS_SQL}
SELECT method, date, userid, reject_reason FROM (
  SELECT method, date, userid, CASE
    WHEN transactionid * 10 NOT BETWEEN -32768 AND 32767 THEN 'transactionid is out of range'
    WHEN userid NOT BETWEEN -32768 AND 32767 THEN 'userid is out of range'
    WHEN abs(amount) >= 100000 THEN 'amount is out of range'
    WHEN length(method) > 10 THEN 'method is too long' END AS reject_reason
  FROM txns) AS checked WHERE reject_reason IS NOT NULL""")
def constraint_rejects_transactions(spark: SparkSession, folder: str) -> DataFrame:
    limits = Limits(key_type="smallint", money="decimal(7,2)", text_length=10)
    transactions = transactions_of(spark, folder)
    scaled = transactions.withColumn("transactionid", F.col("transactionid") * 10)
    checked = check_transactions(scaled.withColumn("user", F.col("userid")), limits)
    rejected = checked.where(F.col(REASON).isNotNull())
    return rejected.select("method", "date", F.col("userid").cast("bigint").alias("userid"), REASON)


# Whole loads


def _load_extracts(
    warehouse: Warehouse, users: DataFrame, transactions: DataFrame, folder: str, **options
) -> Report:
    paths = []
    for name, df in (("users", users), ("transactions", _as_text(transactions))):
        paths.append(f"{folder}/{name}")
        df.write.option("header", True).option("escape", '"').csv(paths[-1])
    return run_batch(warehouse.spark, *paths, warehouse, **options)


# Both loads refresh; the second starts from the balances the files bring (or that are stored)
# and adds what is dated after the first run, whether it was added before or not.
_TWO_LOADS_SQL = f"""
WITH {USERS_SQL}, {TXNS_SQL}, {EVENTS_SQL}, {BATCH_SQL}, {USER_BATCH_SQL},
filled AS (
  SELECT transactionid, userid, amount, type, date, status,
         COALESCE(method, 'not specified') AS method FROM batch),
merged AS (
  SELECT * FROM txns t
  WHERE NOT EXISTS (SELECT 1 FROM filled b WHERE b.transactionid = t.transactionid)
  UNION ALL SELECT * FROM filled),
first_net AS (
  SELECT userid, SUM(CASE type WHEN 'credit' THEN amount WHEN 'debit' THEN -amount END) AS net
  FROM txns WHERE status = 'completed' AND date > TIMESTAMP '{MARK}' GROUP BY userid),
first_run AS (
  SELECT u.userid, name, contact,
         CAST(balance AS DECIMAL(10,2)) + COALESCE(net, 0) AS balance
  FROM users u LEFT JOIN first_net n ON u.userid = n.userid),
second_users AS (
  SELECT * FROM first_run f
  WHERE NOT EXISTS (SELECT 1 FROM user_batch b WHERE b.userid = f.userid)
  UNION ALL
  SELECT userid, COALESCE(name, 'unknown'), COALESCE(contact, 'not provided'),
         CAST(balance AS DECIMAL(10,2)) FROM user_batch),
second_net AS (
  SELECT userid, SUM(CASE type WHEN 'credit' THEN amount WHEN 'debit' THEN -amount END) AS net
  FROM merged WHERE status = 'completed' AND date > TIMESTAMP '{LATER_MARK}' GROUP BY userid)"""


def _two_loads(spark: SparkSession, folder: str, **options) -> Warehouse:
    base = scratch_path(spark, "loads")
    warehouse = Warehouse(spark, f"{base}/warehouse", WIDE, "month").init(MARK)
    users, transactions = users_of(spark, folder), transactions_of(spark, folder)
    first, second = {"run_ts": LATER_MARK, **options}, {"run_ts": LAST_MARK, **options}
    _load_extracts(warehouse, users, transactions, f"{base}/first", **first)
    more_users, more = user_batch_of(spark, folder), transaction_batch_of(spark, folder)
    _load_extracts(warehouse, more_users, more, f"{base}/second", **second)
    return warehouse


@query(f"""{_TWO_LOADS_SQL}
SELECT u.userid, name, CASE WHEN regexp_full_match(contact, '[0-9]{{10}}') THEN contact
       ELSE 'not provided' END AS contact,
       CAST(balance + COALESCE(net, 0) AS DECIMAL(22,2)) AS balance
FROM second_users u LEFT JOIN second_net n ON u.userid = n.userid""")
def load_batch_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    """Users after two loads of CSV extracts into a fresh warehouse."""
    return _two_loads(spark, folder).users()


@query(f"""{_TWO_LOADS_SQL}
SELECT transactionid, CAST(amount AS DECIMAL(22,2)) AS amount, type, date, status, method, userid
FROM merged""")
def load_batch_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions after the same two loads."""
    return _two_loads(spark, folder).transactions()


@query(f"""
WITH {USERS_SQL}, {TXNS_SQL}, {EVENTS_SQL}, {BATCH_SQL}, {MERGED_SQL}, {USER_BATCH_SQL},
known AS (
  SELECT userid, name, contact, balance FROM users u
  WHERE NOT EXISTS (SELECT 1 FROM user_batch b WHERE b.userid = u.userid)
  UNION ALL
  SELECT b.userid, COALESCE(b.name, 'unknown'), b.contact, COALESCE(u.balance, b.balance)
  FROM user_batch b LEFT JOIN users u ON u.userid = b.userid)
SELECT k.userid, name,
       CASE WHEN regexp_full_match(contact, '[0-9]{{10}}') THEN contact
       ELSE 'not provided' END AS contact,
       CAST(CAST(balance AS DECIMAL(10,2)) + COALESCE(net, 0) AS DECIMAL(22,2)) AS balance
FROM known k LEFT JOIN (
  SELECT userid, SUM(CASE type WHEN 'credit' THEN amount WHEN 'debit' THEN -amount END) AS net
  FROM merged WHERE status = 'completed' GROUP BY userid) s ON k.userid = s.userid""")
def load_batch_net_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Users after two loads that keep balances and move them by what each batch changes."""
    return _two_loads(spark, folder, balances="net_changes").users()


@query(f"""
WITH {USERS_SQL}, {TXNS_SQL}
SELECT 'transactions' AS source, 'userid is not in users' AS reject_reason,
       transactionid, userid, amount
FROM txns t WHERE amount <= 400000 AND NOT EXISTS (
  SELECT 1 FROM users u
  WHERE u.userid = t.userid AND regexp_full_match(u.contact, '[0-9]{{10}}'))""")
def load_batch_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What a load puts in quarantine where users with an invalid contact are dropped."""
    base = scratch_path(spark, "rejects")
    warehouse = Warehouse(spark, f"{base}/warehouse", WIDE, "month").init()
    preset = Preset("orders", contact_policy="drop", max_amount=400000.0)
    users, transactions = users_of(spark, folder), transactions_of(spark, folder)
    _load_extracts(warehouse, users, transactions, f"{base}/first", preset=preset)
    fields = "transactionid bigint, userid bigint, amount decimal(10,2)"
    rejects = warehouse.rejects().withColumn("sent", F.from_json("reject_record", fields))
    return rejects.select(F.col("table").alias("source"), REASON, "sent.*")


@query(f"""
WITH {EVENTS_SQL}
SELECT c_custkey AS userid,
       CAST(CAST(c_acctbal AS DECIMAL(10,2)) + COALESCE(net, 0) AS DECIMAL(22,2)) AS balance
FROM customer LEFT JOIN (
  SELECT userid, SUM(CASE type WHEN 'credit' THEN amount WHEN 'debit' THEN -amount END) AS net
  FROM event_txns WHERE status = 'completed' GROUP BY userid) ON c_custkey = userid""")
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Events arrive as files in two rounds; each round loads the new files only."""
    base = scratch_path(spark, "stream")
    warehouse = Warehouse(spark, f"{base}/warehouse", WIDE, "month").init()
    events = _as_text(event_transactions_of(spark, folder)).select(*TRANSACTION_COLUMNS)
    failed = F.col("status") == "failed"
    inbox = f"{base}/transactions"

    def arrive(df: DataFrame, path: str) -> None:
        df.write.mode("append").option("header", True).csv(path)

    def ingest() -> None:
        ingest_new_files(
            warehouse, f"{base}/users", inbox, f"{base}/checkpoint", balances="net_changes"
        ).awaitTermination()

    arrive(users_of(spark, folder).select(*USER_COLUMNS), f"{base}/users")
    arrive(events.where(failed), inbox)
    ingest()
    arrive(events.where(~failed), inbox)
    ingest()
    return warehouse.users().select("userid", "balance")


# Forms of dates, rows that hide others, and users that come late


# All forms of a date; every other order has the usual form, which only that form's extract takes.
_FORMATS = {
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
    "yyyy-MM-dd HH:mm:ss.f": "%Y-%m-%d %H:%M:%S.%f",
    "yyyy-MM-ddTHH:mm:ss": "%Y-%m-%dT%H:%M:%S",
    "yyyy-MM-ddTHH:mm:ss.f": "%Y-%m-%dT%H:%M:%S.%f",
    "yyyy-MM-dd HH:mm": "%Y-%m-%d %H:%M",
    "yyyy-MM-ddTHH:mm": "%Y-%m-%dT%H:%M",
    "yyyy-MM-dd": "%Y-%m-%d",
}
_FORMS_SQL = " UNION ALL ".join(
    f"SELECT '{form}' AS form, transactionid, "
    f"CASE WHEN {str(form == DATE_FORM).upper()} OR transactionid % 2 = 0 "
    f"THEN strptime(strftime(date, '{pattern}'), '{pattern}') END AS date, "
    f"NOT ({str(form == DATE_FORM).upper()} OR transactionid % 2 = 0) AS undated FROM event_txns"
    for form, pattern in _FORMATS.items()
)


@query(f"WITH {EVENTS_SQL} {_FORMS_SQL}")
def date_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Each form in an extract of its own; dates in another form are null and counted."""
    events = _as_text(event_transactions_of(spark, folder)).select(*TRANSACTION_COLUMNS)
    date, parts = F.col("date"), []
    for form in _FORMATS:
        length = 10 if form == "yyyy-MM-dd" else 16 if "ss" not in form else 19
        text = F.substring(date, 1, 26 if form.endswith("f") else length)
        text = F.replace(text, F.lit(" "), F.lit("T")) if "T" in form else text
        usual = F.substring(date, 1, 19)
        mixed = F.when(F.col("transactionid") % 2 == 0, text).otherwise(usual)
        landed = land_rows(events.withColumn("date", mixed), TRANSACTION_COLUMNS)
        parsed = parse_transactions(landed, form)
        parts.append(
            parsed.select(F.lit(form).alias("form"), "transactionid", "date", F.col(UNDATED).alias("undated"))
        )
    return reduce(DataFrame.unionByName, parts)


@query(f"""
WITH {EVENTS_SQL}
SELECT transactionid, amount, type, date, status, method, userid FROM event_txns""")
def land_events_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Typed rows keep the fractions of their dates."""
    landed = land_rows(event_transactions_of(spark, folder), TRANSACTION_COLUMNS)
    cleaned = clean_transactions(parse_transactions(landed))
    checked = accepted(check_transactions(cleaned, Limits(key_type="bigint")))
    return checked.select(*TRANSACTION_SINK_COLUMNS)


def _landed_lines(spark: SparkSession, folder: str, amount: Column) -> DataFrame:
    """Order lines as text that lands in the order of their numbers, the order's id as key."""
    lines = _read(spark, folder, "lineitem")
    values = {
        "transactionid": F.col("l_orderkey").cast("string"),
        "userid": F.col("l_suppkey").cast("string"),
        "amount": amount,
        "type": F.col("l_returnflag"),
        "date": F.substring(F.col("l_shipdate").cast("string"), 1, 19),
        "status": F.col("l_linestatus"),
        "method": F.col("l_linenumber").cast("string"),
    }
    place = {FILE: F.lit(""), BLOCK: F.lit(0).cast("bigint"), ROW: F.col("l_linenumber").cast("bigint")}
    nothing = {REASON: F.lit(None).cast("string"), RECORD: F.lit(None).cast("string")}
    return lines.select(*[v.alias(k) for k, v in {**values, **place, **nothing}.items()])


@query("""
SELECT transactionid, amount, method, reject_reason FROM (
  SELECT l_orderkey AS transactionid,
         CASE WHEN l_quantity > 25 THEN NULL ELSE l_extendedprice END AS amount,
         CAST(l_linenumber AS VARCHAR) AS method,
         CASE WHEN l_quantity > 25 THEN 'amount is no number' END AS reject_reason,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS r
  FROM lineitem) AS ranked WHERE r = 1""")
def reject_hides_later(spark: SparkSession, folder: str) -> DataFrame:
    """A first row that is rejected hides the later ones of its key, as any first row does."""
    price = F.col("l_extendedprice").cast("string")
    amount = F.when(F.col("l_quantity") > 25, "abc").otherwise(price)
    parsed = parse_transactions(_landed_lines(spark, folder, amount))
    return first_per_key(parsed, "transactionid").select("transactionid", "amount", "method", REASON)


@query(f"""
WITH {USERS_SQL}, {TXNS_SQL}
SELECT u.userid, CAST(CAST(balance AS DECIMAL(10,2)) + COALESCE(net, 0) AS DECIMAL(22,2)) AS balance
FROM users u LEFT JOIN (
  SELECT userid, SUM(CASE type WHEN 'credit' THEN amount WHEN 'debit' THEN -amount END) AS net
  FROM txns WHERE status = 'completed' GROUP BY userid) s ON u.userid = s.userid""")
def late_user(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions that came before half of the users count once those are there."""
    base = scratch_path(spark, "late")
    warehouse = Warehouse(spark, f"{base}/warehouse", WIDE, "year").init(MARK)
    users, transactions = users_of(spark, folder), transactions_of(spark, folder)
    late = F.col("userid") % 2 == 0
    nothing = transactions.where(F.lit(False))
    options = {"balances": "net_changes"}
    _load_extracts(warehouse, users.where(~late), transactions, f"{base}/first", **options)
    _load_extracts(warehouse, users.where(late), nothing, f"{base}/second", **options)
    return warehouse.users().select("userid", "balance")


# Extracts and constraints in the forms that no other query has


@query(f"""
WITH {TXNS_SQL}
SELECT transactionid, userid, CAST(amount AS DOUBLE) AS amount, type, date, status, method FROM txns""")
def header_any_order(spark: SparkSession, folder: str) -> DataFrame:
    """A header with capitals, in another order, with a column more."""
    path = scratch_path(spark, "header")
    rows = _as_text(transactions_of(spark, folder)).withColumn("note", F.lit("x"))
    names = ["method", "note", "userId", "DATE", "amount", "Type", "status", "TransactionID"]
    rows.select(*[F.col(n.lower()).alias(n) for n in names]).write.option("header", True).csv(path)
    extract = csv_extract(spark, path, TRANSACTION_COLUMNS)
    return parse_transactions(extract.rows(), extract.date_form()).select(*TRANSACTION_COLUMNS)


@query(f"""
WITH {TXNS_SQL}
SELECT transactionid, userid, CAST(amount AS DOUBLE) AS amount, type, date, status, method FROM txns""")
def headers_that_differ(spark: SparkSession, folder: str) -> DataFrame:
    """Files of one extract whose headers differ in order, letter case and further columns."""
    path = scratch_path(spark, "headers")
    _arrive_with_headers(_as_text(transactions_of(spark, folder)), path)
    extract = csv_extract(spark, path, TRANSACTION_COLUMNS)
    return parse_transactions(extract.rows(), extract.date_form()).select(*TRANSACTION_COLUMNS)


def _arrive_with_headers(rows: DataFrame, path: str) -> None:
    """Write a third of the rows under each of three headers."""
    headers = (
        ["method", "note", "userId", "DATE", "amount", "Type", "status", "TransactionID"],
        [*TRANSACTION_COLUMNS],
        ["Date", "TransactionId", "type", "status", "method", "AMOUNT", "USERID", "more", "note"],
    )
    rows = rows.withColumns({"note": F.lit("x"), "more": F.lit("a, b")})
    for i, names in enumerate(headers):
        part = rows.where(F.abs("transactionid") % 3 == i).select(*[F.col(n.lower()).alias(n) for n in names])
        part.write.mode("append").option("header", True).csv(path)


@query(f"""
WITH {EVENTS_SQL}
SELECT c_custkey AS userid,
       CAST(CAST(c_acctbal AS DECIMAL(10,2)) + COALESCE(net, 0) AS DECIMAL(22,2)) AS balance
FROM customer LEFT JOIN (
  SELECT userid, SUM(CASE type WHEN 'credit' THEN amount WHEN 'debit' THEN -amount END) AS net
  FROM event_txns WHERE status = 'completed' GROUP BY userid) ON c_custkey = userid""")
def stream_headers_that_differ(spark: SparkSession, folder: str) -> DataFrame:
    """One round of new files, each with a header of its own."""
    base = scratch_path(spark, "stream-headers")
    warehouse = Warehouse(spark, f"{base}/warehouse", WIDE, "month").init()
    _arrive_with_headers(_as_text(event_transactions_of(spark, folder)), f"{base}/transactions")
    users_of(spark, folder).select(*USER_COLUMNS).write.option("header", True).csv(f"{base}/users")
    ingest_new_files(
        warehouse, f"{base}/users", f"{base}/transactions", f"{base}/checkpoint", balances="net_changes"
    ).awaitTermination()
    return warehouse.users().select("userid", "balance")


@query("""
SELECT c_custkey AS userid, CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE c_name END AS name,
       CASE WHEN c_custkey % 3 = 2 THEN 'too many fields' END AS reject_reason
FROM customer""")
def short_and_long_rows(spark: SparkSession, folder: str) -> DataFrame:
    """By turns whole rows, rows that end after their id, and rows with a field too many."""
    path = scratch_path(spark, "fields")
    key = F.col("c_custkey")
    whole = [key, F.col("c_name"), F.lit("0123456789"), F.col("c_acctbal")]
    line = (
        F.when(key % 3 == 0, F.concat_ws(",", *whole))
        .when(key % 3 == 1, key.cast("string"))
        .otherwise(F.concat_ws(",", *whole, F.lit("more")))
    )
    lines = _read(spark, folder, "customer").select(line.alias("userid,name,contact,balance"))
    lines.write.option("header", True).option("sep", "\u0001").csv(path)
    parsed = parse_users(read_csv_extract(spark, path, USER_COLUMNS))
    return parsed.select("userid", "name", REASON)


@query("""
SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS transactionid,
       CASE WHEN o_orderstatus = 'P' THEN 'transactionid is null' END AS reject_reason, o_orderpriority AS method
FROM orders""")
def null_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = coded_transactions_of(spark, folder)
    keyed = rows.withColumn("transactionid", F.when(F.col("status") != "P", F.col("transactionid")))
    checked = check_transactions(keyed, Limits(key_type="bigint"))
    return checked.select("transactionid", REASON, "method")


@query("SELECT l_orderkey AS transactionid, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def repeated_key_counts(spark: SparkSession, folder: str) -> DataFrame:
    lines = _read(spark, folder, "lineitem").select(F.col("l_orderkey").alias("transactionid"))
    return repeated_keys(lines, "transactionid")


_TOKEN_LIST = ", ".join(f"'{t}'" for t in NA_TOKENS)


@query(f"""
SELECT c_custkey AS userid, CASE WHEN t IN ({_TOKEN_LIST}) THEN 'unknown' ELSE t END AS name
FROM (SELECT c_custkey, coalesce(list_extract([{_TOKEN_LIST}], CAST(c_custkey % 25 AS INT) + 1), c_name) AS t
      FROM customer)""")
def na_tokens_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every text that stands for a missing value, in turn."""
    users = users_of(spark, folder)
    token = F.get(F.array(*map(F.lit, NA_TOKENS)), (F.col("userid") % 25).cast("int"))
    marked = users.withColumn("name", F.coalesce(token, F.col("name")))
    return clean_users(null_tokens(marked, ["name"]), SCRIPT, ["userid"]).select("userid", "name")


@query(f"""
WITH {USERS_SQL}, known AS (SELECT userid FROM users),
t AS (SELECT count(*) AS n, count(*) FILTER (WHERE user_id NOT IN (SELECT userid FROM known)) AS orphans FROM events),
u AS (SELECT count(*) AS n FROM users)
SELECT 'users' AS source, u.n AS read, u.n AS filtered, CAST(0 AS BIGINT) AS rejected, u.n AS inserted,
       TIMESTAMP '2024-08-20 00:00:00' AS seed FROM u
UNION ALL SELECT 'transactions', t.n, t.n, t.orphans, t.n - t.orphans, TIMESTAMP '2024-08-20 00:00:00' FROM t""")
def load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What a load of customers and events into a warehouse of the default types and days counts."""
    base = scratch_path(spark, "counts")
    warehouse = Warehouse(spark, f"{base}/warehouse").init()
    seed = warehouse.watermark()
    events = event_transactions_of(spark, folder)
    report = _load_extracts(warehouse, users_of(spark, folder), events, f"{base}/first")
    rows = [
        (name, c.read, c.filtered, sum(c.rejected.values()), c.inserted, seed)
        for name, c in (("users", report.users), ("transactions", report.transactions))
    ]
    schema = "source string, read long, filtered long, rejected long, inserted long, seed timestamp_ntz"
    return spark.createDataFrame(rows, schema)


@query(f"""
WITH {USERS_SQL}
SELECT userid, CAST(balance AS DECIMAL(10,2)) AS balance FROM users""")
def load_refused(spark: SparkSession, folder: str) -> DataFrame:
    """A load with an orphan under the policy ``fail`` leaves what an earlier one published."""
    base = scratch_path(spark, "refused")
    warehouse = Warehouse(spark, f"{base}/warehouse").init()
    users, events = users_of(spark, folder), event_transactions_of(spark, folder)
    _load_extracts(warehouse, users, events.where(F.lit(False)), f"{base}/first")
    reset = users.withColumn("balance", F.lit(0.0))
    unknown = events.withColumn("userid", -F.col("userid") - 1)
    try:
        _load_extracts(warehouse, reset, unknown, f"{base}/second", policy="fail")
    except BatchRejected:
        return warehouse.users().select("userid", "balance")
    raise AssertionError("the load should have been refused")


# Extracts of JSON lines, as an API sends them


def _write_json(rows: DataFrame, path: str) -> None:
    """One object a line, under names in other letter case; every fifth row has its id under a wrong
    name, every seventh is cut off in the middle."""
    named = rows.toDF(*[c.capitalize() for c in rows.columns])
    key = F.col(named.columns[0])
    whole = F.to_json(F.struct(*named.columns, F.lit("x").alias("note")))
    nameless = F.to_json(F.struct(key.alias("number"), *named.columns[1:]))
    line = F.when(key % 7 == 0, F.substring(whole, 1, 20)).when(key % 5 == 0, nameless).otherwise(whole)
    named.select(line.alias("value")).write.text(path)


@query(f"""
WITH {TXNS_SQL}
SELECT CASE WHEN r IS NULL THEN transactionid END AS transactionid,
       CASE WHEN broken THEN NULL ELSE userid END AS userid,
       CASE WHEN broken THEN NULL ELSE CAST(amount AS DOUBLE) END AS amount,
       CASE WHEN broken THEN NULL ELSE type END AS type, CASE WHEN broken THEN NULL ELSE date END AS date,
       r AS reject_reason
FROM (SELECT *, transactionid % 7 = 0 AS broken,
             CASE WHEN transactionid % 7 = 0 THEN 'no JSON object' WHEN transactionid % 5 = 0
                  THEN 'transactionid is missing or no whole number' END AS r FROM txns)""")
def json_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "json")
    _write_json(_as_text(transactions_of(spark, folder)).select(*TRANSACTION_COLUMNS), path)
    landed = read_json_extract(spark, path, TRANSACTION_COLUMNS)
    parsed = parse_transactions(landed, "yyyy-MM-dd HH:mm:ss.f")
    return parsed.select(*TRANSACTION_COLUMNS[:5], REASON)


@query(f"""
WITH {EVENTS_SQL}
SELECT c_custkey AS userid,
       CAST(CAST(c_acctbal AS DECIMAL(10,2)) + COALESCE(net, 0) AS DECIMAL(22,2)) AS balance
FROM customer LEFT JOIN (
  SELECT userid, SUM(CASE type WHEN 'credit' THEN amount WHEN 'debit' THEN -amount END) AS net
  FROM event_txns WHERE status = 'completed' AND transactionid % 7 <> 0 AND transactionid % 5 <> 0
  GROUP BY userid) ON c_custkey = userid""")
def stream_json_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Files of JSON lines arrive; lines that are broken or lack their id go to quarantine."""
    base = scratch_path(spark, "stream-json")
    warehouse = Warehouse(spark, f"{base}/warehouse", WIDE, "month").init()
    _write_json(_as_text(event_transactions_of(spark, folder)).select(*TRANSACTION_COLUMNS), f"{base}/transactions")
    users_of(spark, folder).select(*USER_COLUMNS).write.json(f"{base}/users")
    ingest_new_files(
        warehouse, f"{base}/users", f"{base}/transactions", f"{base}/checkpoint", file_format="json",
        balances="net_changes",
    ).awaitTermination()
    return warehouse.users().select("userid", "balance")


# Constraints of what is stored

_BAD_SQL = """
u AS (
  SELECT c_custkey AS userid, CASE WHEN c_custkey % 7 = 0 THEN repeat(c_name, 6) ELSE c_name END AS name
  FROM customer WHERE c_custkey % 3 <> 0),
t AS (
  SELECT CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey END AS transactionid, o_custkey AS userid,
         o_orderkey % 11 = 0 AS long_method, o_orderkey % 17 = 0 AS misplaced
  FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0))"""


@query(f"""
WITH {_BAD_SQL}
SELECT 'users' AS source, 'name is too long' AS rule, count(*) AS n FROM u WHERE length(name) > 100
UNION ALL SELECT 'transactions', 'transactionid is null', count(*) FROM t WHERE transactionid IS NULL
UNION ALL SELECT 'transactions', 'transactionid is repeated', CAST(sum(n - 1) AS BIGINT) FROM (
  SELECT count(*) AS n FROM t WHERE transactionid IS NOT NULL GROUP BY transactionid)
UNION ALL SELECT 'transactions', 'userid is not in users', count(*) FROM t
  WHERE userid NOT IN (SELECT userid FROM u)
UNION ALL SELECT 'transactions', 'method is too long', count(*) FROM t WHERE long_method
UNION ALL SELECT 'transactions', 'date is in another period', count(*) FROM t WHERE misplaced
UNION ALL SELECT 'updatemetadata', 'the control row is not there once', 1""")
def stored_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that some other writer has stored unchecked: the broken rules, and by how many rows."""
    warehouse = Warehouse(spark, scratch_path(spark, "violations"), WIDE, "year")
    users, txns = users_of(spark, folder).where("userid % 3 <> 0"), transactions_of(spark, folder)
    name = F.when(F.col("userid") % 7 == 0, F.repeat("name", 6)).otherwise(F.col("name"))
    txns = txns.unionByName(txns.where("transactionid % 10 = 0"))
    number = F.col("transactionid")
    bad = txns.withColumns({
        "period": warehouse.period_of(F.when(number % 17 == 0, F.add_months("date", 12)).otherwise(F.col("date"))),
        "method": F.when(number % 11 == 0, F.repeat(F.lit("x"), 60)).otherwise(F.col("method")),
        "transactionid": F.when(number % 13 != 0, number),
    })
    version = warehouse.next_version()
    entries = warehouse.write_users(users.withColumn("name", name), version)
    entries += warehouse.write_periods(bad, version)
    empty = warehouse.limits.metadata()
    entries.append(warehouse.write_whole("updatemetadata", spark.createDataFrame([], empty), version))
    warehouse.publish(version, entries)
    return violations(warehouse).where("n > 0").withColumnRenamed("table", "source")


@query("SELECT 'no rule' AS rule, count(*) AS n FROM orders WHERE o_orderkey IS NULL")
def published_violations(spark: SparkSession, folder: str) -> DataFrame:
    """A load, its upsert, and the tables they publish: no rule is broken."""
    base = scratch_path(spark, "published")
    warehouse = Warehouse(spark, f"{base}/warehouse", WIDE, "year").init()
    _load_extracts(warehouse, users_of(spark, folder), transactions_of(spark, folder), f"{base}/first")
    later = transaction_batch_of(spark, folder)
    _load_extracts(warehouse, users_of(spark, folder).where("userid % 2 = 0"), later, f"{base}/second")
    broken = F.concat_ws("; ", F.array_sort(F.collect_set(F.when(F.col("n") > 0, F.col("rule")))))
    total = violations(warehouse).agg(broken.alias("rule"), F.sum("n").alias("n"))
    return total.select(F.when(F.col("rule") == "", "no rule").otherwise(F.col("rule")).alias("rule"), "n")
