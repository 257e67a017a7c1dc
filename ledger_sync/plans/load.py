"""Load of one batch: extract, clean, check, upsert, refresh balances, publish."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from ledger_sync.operators.balance import (
    advance_watermark, apply_net_changes, apply_summaries, merge_users_keeping_balance,
    net_changes, transaction_summaries,
)
from ledger_sync.operators.clean import first_per_key, transaction_rules, user_rules
from ledger_sync.operators.merge import BROADCAST_KEYS, matched, sized, upsert
from ledger_sync.operators.parse import parse_transactions, parse_users
from ledger_sync.operators.validate import (
    ORPHAN, accepted, as_record, check_transactions, check_users, orphan_userids, orphans,
    rejected, without_orphans,
)
from ledger_sync.plans.warehouse import (
    BUCKET, PERIOD, REJECTS, WAITING, Entry, Warehouse, remove_folder,
)
from ledger_sync.schemas import (
    METADATA, RECORD, REASON, SCRIPT, TRANSACTION_COLUMNS, TRANSACTION_SINK_COLUMNS, TRANSACTIONS,
    UNDATED, USER_COLUMNS, USERS, Preset,
)
from ledger_sync.sources.extracts import FILE_FORMATS, csv_extract, date_form_of, read_json_extract


#: Ranges that the keys of a batch are summed up in.
KEY_RANGES = 4096


class BatchRejected(ValueError):
    """Raised under the ``fail`` policy; nothing has been published."""


@dataclass
class Counts:
    """Rows of one table in one load. ``read``, ``deduped`` and ``undated`` are progress figures:
    a task that runs again after an executor is lost may count twice. The others are exact.

    undated   rows whose date is there but not in the extract's form, or beyond what is kept.
    taken_up  transactions of earlier batches whose user has come now."""

    read: int = 0
    deduped: int = 0
    undated: int = 0
    filtered: int = 0
    rejected: dict[str, int] = field(default_factory=dict)
    taken_up: int = 0
    inserted: int = 0
    updated: int = 0
    unchanged: int = 0

    @property
    def accepted(self) -> int:
        return self.inserted + self.updated + self.unchanged


@dataclass
class Report:
    version: int | None
    users: Counts = field(default_factory=Counts)
    transactions: Counts = field(default_factory=Counts)
    watermark: datetime | None = None
    skipped: bool = False


@dataclass
class _Batch:
    """A table's checked rows as staged, with what was counted there."""

    staged: DataFrame
    rows: DataFrame
    size: int
    counts: Counts
    periods: set[str | None] = field(default_factory=set)
    first_key: int | None = None
    last_key: int | None = None


def run_batch(
    spark: SparkSession,
    users_path: str | list[str],
    transactions_path: str | list[str],
    warehouse: Warehouse,
    multiline: bool | None = None,
    file_format: str = "csv",
    **options,
) -> Report:
    """The whole daily run on two extracts: CSV files, which may each have their header in any order
    and letter case, or files with one JSON object a line. See ``load_batch`` for the options.

    ``multiline`` reads line breaks in quoted text, but does not split files. Where it is not
    given, it is used for a CSV extract with a quote that stays open on some line.
    """
    if file_format not in FILE_FORMATS:
        raise ValueError(f"file_format must be one of {', '.join(FILE_FORMATS)}: {file_format}")
    if file_format == "json":
        users = read_json_extract(spark, users_path, USER_COLUMNS)
        transactions = read_json_extract(spark, transactions_path, TRANSACTION_COLUMNS)
        return load_batch(warehouse, users, transactions, **options)
    users = csv_extract(spark, users_path, USER_COLUMNS)
    transactions = csv_extract(spark, transactions_path, TRANSACTION_COLUMNS)
    if options.get("date_form") is None:
        options["date_form"] = transactions.date_form(multiline)
    return load_batch(warehouse, users.rows(multiline), transactions.rows(multiline), **options)


def load_batch(
    warehouse: Warehouse,
    users: DataFrame,
    transactions: DataFrame,
    run_ts: datetime | str | None = None,
    preset: Preset = SCRIPT,
    policy: str = "quarantine",
    balances: str = "since_watermark",
    batch: str | None = None,
    classify: bool = False,
    date_form: str | None = None,
    undated: str = "keep",
) -> Report:
    """Load landed extracts and publish a new version of all tables, or none. If another load
    publishes meanwhile, this one raises ``Conflict`` and can be run again.

    policy    ``fail``: any rejected row aborts the load. ``quarantine``: rejected rows
              are written apart with their reason; a transaction that only lacks its user waits,
              and is loaded with the batch that brings the user.
    balances  ``since_watermark``: the sent balance replaces the stored one, and completed
              transactions dated after the stored mark are added. ``net_changes``: a known
              user's balance stays and moves by what this batch changes, whatever the date.
    batch     an id of this batch; a batch that was published before is skipped.
    date_form one of ``DATE_FORMS``; default is the form of the first date of the extract.
    undated   ``keep``: a date in another form is stored as null and counted. ``reject``: such a
              row is rejected, so ``fail`` refuses it.
    classify  tell replaced rows that change from those that do not, at the cost of one more
              pass over what is replaced; else all of them count as updated.
    """
    if policy not in ("fail", "quarantine"):
        raise ValueError(f"policy must be fail or quarantine: {policy}")
    if balances not in ("since_watermark", "net_changes"):
        raise ValueError(f"balances must be since_watermark or net_changes: {balances}")
    if undated not in ("keep", "reject"):
        raise ValueError(f"undated must be keep or reject: {undated}")
    form = date_form or date_form_of(transactions)
    if warehouse.spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("set spark.sql.ansi.enabled: else a balance that overflows becomes null")
    if batch is not None and warehouse.has_batch(batch):
        return Report(warehouse.version(), skipped=True)
    warehouse = warehouse.at()  # also if another load publishes meanwhile

    with _staging(warehouse) as staging:
        with ThreadPoolExecutor(2) as pool:  # the two extracts do not depend on each other
            staged = [
                pool.submit(inheritable_thread_target(warehouse.spark)(stage), *inputs)
                for stage, *inputs in (
                    (_stage_users, warehouse, users, preset, f"{staging}/users"),
                    (
                        _stage_transactions, warehouse, transactions, preset, f"{staging}/txns",
                        form, undated == "reject",
                    ),
                )
            ]
            user_batch, txn_batch = [job.result() for job in staged]
        stored_users = warehouse.users()
        orphan_rows = _part_orphans(warehouse, stored_users, user_batch, txn_batch, staging)
        waiting = _take_up_waiting(warehouse, stored_users, user_batch, txn_batch, staging)
        if policy == "fail":
            _abort_on_rejects(user_batch.counts, txn_batch.counts)

        version = warehouse.next_version()
        rejects = _write_rejects(warehouse, version, user_batch, txn_batch, orphan_rows)
        still_waiting = _write_waiting(warehouse, version, waiting, orphan_rows)
        before = warehouse.entries()
        rejects = [e for e in before if e.table == REJECTS] + rejects
        merge = _merge_transactions(warehouse, before, txn_batch, version, classify)
        periods, current, replaced = merge
        if balances == "net_changes":
            changes = net_changes(txn_batch.rows, replaced)
        else:
            mark = warehouse.watermark()
            if mark is not None:  # older periods need not be read
                current = current.where(F.col(PERIOD) >= F.lit(warehouse.start_of(mark.date())))
            changes = transaction_summaries(current, mark)
        changes = _written(changes, f"{staging}/changes")
        buckets, old = _touched_users(warehouse, before, user_batch, changes)
        if balances == "net_changes":
            merged = merge_users_keeping_balance(old, user_batch.rows)
            refreshed = apply_net_changes(merged, changes, warehouse.limits.money)
        else:
            incoming = user_batch.rows.repartition("userid")
            merged = upsert(old, incoming, "userid", user_batch.size)
            refreshed = apply_summaries(merged, changes, warehouse.limits.money)
        written = warehouse.write_users(refreshed, version)
        _count_upserts(user_batch, old, warehouse.read_users(written))
        if classify:
            _count_unchanged(user_batch, matched(old, user_batch.rows, "userid", user_batch.size))

        metadata = advance_watermark(warehouse.metadata(), run_ts)
        marks = warehouse.write_whole(METADATA, metadata, version)
        tables = [*buckets, *written, marks, *periods, *still_waiting, *rejects]
        warehouse.publish(version, tables, batch)
    return Report(version, user_batch.counts, txn_batch.counts, warehouse.at(version).watermark())


@contextmanager
def _staging(warehouse: Warehouse) -> Iterator[str]:
    """A folder of this load alone below the root, which is shared; removed when the load ends."""
    path = f"{warehouse.root}/_staging/{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        remove_folder(warehouse.spark, path)


def _stage_users(warehouse: Warehouse, landed: DataFrame, preset: Preset, path: str) -> _Batch:
    staged, counts = _stage(
        landed,
        lambda df: first_per_key(parse_users(df), "userid"),
        lambda df: check_users(user_rules(df, preset), warehouse.limits),
        path,
    )
    size = 0
    for row in staged.groupBy(REASON).agg(F.count("*").alias("n")).collect():
        size += _tally(counts, row)
    return _Batch(staged, accepted(staged), size, counts)


def _stage_transactions(
    warehouse: Warehouse,
    landed: DataFrame,
    preset: Preset,
    path: str,
    form: str,
    reject_undated: bool,
) -> _Batch:
    def dedup(df: DataFrame) -> DataFrame:
        return first_per_key(parse_transactions(df, form, reject_undated), "transactionid")

    def check(df: DataFrame) -> DataFrame:
        checked = check_transactions(transaction_rules(df, preset), warehouse.limits)
        return checked.withColumn(PERIOD, warehouse.period_of(F.col("date")))

    staged, counts = _stage(landed, dedup, check, path)
    # One row per period and reason: what the merge has to touch, without a look at the rows.
    period = F.when(F.col(REASON).isNull(), F.col(PERIOD)).cast("string")
    key = F.col("transactionid")
    summary = staged.groupBy(period.alias(PERIOD), REASON).agg(
        F.count("*").alias("n"), F.min(key).alias("first"), F.max(key).alias("last")
    )
    result = _Batch(staged, accepted(staged), 0, counts)
    groups = [row for row in summary.collect() if _tally(counts, row)]
    if groups:
        result.size = sum(row["n"] for row in groups)
        result.periods = {row[PERIOD] for row in groups}
        result.first_key = min(row["first"] for row in groups)
        result.last_key = max(row["last"] for row in groups)
    return result


def _stage(
    landed: DataFrame,
    dedup: Callable[[DataFrame], DataFrame],
    check: Callable[[DataFrame], DataFrame],
    path: str,
) -> tuple[DataFrame, Counts]:
    """Parse, clean and check in one pass over the files, and write the outcome.

    Later steps read the written table, so a lost executor never sends them back to the files.
    """
    read, deduped, written = Observation(), Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    good = F.col(REASON).isNull()
    unique = dedup(landed.observe(read, rows))
    lost = F.col(UNDATED) if UNDATED in unique.columns else F.lit(False)
    kept = [F.count_if(good).alias("rows"), F.count_if(good & lost).alias("undated")]
    unique = unique.observe(deduped, *kept)
    checked = check(unique).observe(written, rows)
    checked.write.parquet(path)
    staged = landed.sparkSession.read.schema(checked.schema).parquet(path)
    found, wanted = staged.count(), written.get.get("rows", 0)
    if found != wanted:  # counted by the tasks that wrote them, each once
        raise RuntimeError(f"{path} has {found} of {wanted} rows: is the root a shared folder?")
    progress = deduped.get
    counts = Counts(read=read.get.get("rows", 0), deduped=progress.get("rows", 0))
    counts.undated = progress.get("undated", 0)
    return staged, counts


def _tally(counts: Counts, row: Row) -> int:
    """Book a group of staged rows; the number of accepted ones in it."""
    reason = row[REASON]
    if reason is not None:
        counts.rejected[reason] = counts.rejected.get(reason, 0) + row["n"]
        return 0
    counts.filtered += row["n"]
    return row["n"]


def _part_orphans(
    warehouse: Warehouse, stored_users: DataFrame, users: _Batch, txns: _Batch, staging: str
) -> DataFrame | None:
    """Take transactions of unknown users out of the batch; the rows taken, if any.

    The orphan ids are written first. Their file size then tells the planner whether
    they can be broadcast, so the transactions are shuffled only if they cannot.
    """
    path = f"{staging}/orphans"
    orphan_userids(txns.rows, users.rows, stored_users).write.parquet(path)
    ids = warehouse.spark.read.schema(f"userid {warehouse.limits.key_type}").parquet(path)
    n_ids = ids.count()
    if not n_ids:
        return None
    ids = sized(ids, n_ids, BROADCAST_KEYS)
    taken = orphans(txns.rows, ids)
    n_taken = taken.count()
    txns.counts.rejected[ORPHAN] = n_taken
    txns.rows = without_orphans(txns.rows, ids)
    txns.size -= n_taken
    return taken


def _take_up_waiting(
    warehouse: Warehouse, stored_users: DataFrame, users: _Batch, txns: _Batch, staging: str
) -> DataFrame | None:
    """Add to the batch what has been waiting for a user it brings; returns what waits on.

    A version that the batch brings itself, or that it brings for an unknown user, replaces the
    one that was waiting. Both parts are written first: they are read more than once.
    """
    if not any(e.table == WAITING for e in warehouse.entries()):
        return None
    sent = accepted(txns.staged).select("transactionid")
    waiting = warehouse.waiting().join(sent, "transactionid", "left_anti")
    path = f"{staging}/waiting"
    known = users.rows.select("userid").unionByName(stored_users.select("userid"))
    known = known.select(F.col("userid").alias("_known")).distinct()
    marked = waiting.join(known, F.col("userid") == F.col("_known"), "left")
    marked = marked.withColumn("_found", F.col("_known").isNotNull()).drop("_known")
    marked.write.parquet(path)
    marked = warehouse.spark.read.schema(marked.schema).parquet(path)
    found = marked.where("_found").select(*txns.rows.columns)
    summary = found.groupBy(F.col(PERIOD).cast("string").alias(PERIOD)).agg(
        F.count("*").alias("n"), F.min("transactionid").alias("first"), F.max("transactionid").alias("last")
    )
    groups = summary.collect()
    if groups:
        n = sum(row["n"] for row in groups)
        txns.counts.taken_up = n
        txns.rows = txns.rows.unionByName(found)
        txns.size += n
        txns.periods = txns.periods | {row[PERIOD] for row in groups}
        firsts = [row["first"] for row in groups] + [k for k in (txns.first_key,) if k is not None]
        lasts = [row["last"] for row in groups] + [k for k in (txns.last_key,) if k is not None]
        txns.first_key, txns.last_key = min(firsts), max(lasts)
    return marked.where("NOT _found").drop("_found")


def _abort_on_rejects(*tables: Counts) -> None:
    reasons = {r: n for counts in tables for r, n in counts.rejected.items()}
    if reasons:
        raise BatchRejected("; ".join(f"{r}: {n} rows" for r, n in sorted(reasons.items())))


def _write_rejects(
    warehouse: Warehouse, version: int, users: _Batch, txns: _Batch, orphan_rows: DataFrame | None
) -> list[Entry]:
    if not users.counts.rejected and not txns.counts.rejected:
        return []
    rows = rejected(users.staged, USERS).unionByName(rejected(txns.staged, TRANSACTIONS))
    if orphan_rows is not None:
        records = orphan_rows.select(
            F.lit(TRANSACTIONS).alias("table"),
            F.lit(ORPHAN).alias(REASON),
            as_record(TRANSACTION_SINK_COLUMNS).alias(RECORD),
        )
        rows = rows.unionByName(records)
    return [warehouse.write_whole(REJECTS, rows, version)]


def _write_waiting(
    warehouse: Warehouse, version: int, *parts: DataFrame | None
) -> list[Entry]:
    present = [p for p in parts if p is not None and not p.isEmpty()]
    if not present:
        return []
    rows = present[0] if len(present) == 1 else present[0].unionByName(present[1])
    return [warehouse.write_whole(WAITING, rows, version)]


def _merge_transactions(
    warehouse: Warehouse, before: list[Entry], batch: _Batch, version: int, classify: bool
) -> tuple[list[Entry], DataFrame, DataFrame | None]:
    """Rewrite the periods the batch touches: those of its rows and of the versions they replace.

    Returns the period folders of the new version, its transactions, and the versions replaced.
    """
    key, entries = "transactionid", warehouse.periods(before)
    stored = warehouse.read_periods(entries)
    if not batch.size:
        return entries, stored, None
    ranges = _key_ranges(batch)
    candidates = [e for e in entries if e.may_hold(ranges)]
    searched = stored if candidates == entries else warehouse.read_periods(candidates)
    known = _periods_of_known_keys(searched, batch) if candidates else set()
    # What follows uses the first listing of folders; a filter on the period leaves out the others.
    touched = known | batch.periods
    replaced = matched(warehouse.only(stored, known), batch.rows, key, batch.size)
    old = warehouse.only(stored, touched & {_name(e) for e in entries})
    written = warehouse.write_periods(_by_period(old, batch), version)
    new = warehouse.read_periods(written)
    _count_upserts(batch, old, new)
    if classify:
        _count_unchanged(batch, replaced)
    untouched = [e for e in entries if _name(e) not in touched]
    rest = warehouse.only(stored, {_name(e) for e in untouched})
    return untouched + written, rest.unionByName(new), replaced


def _by_period(stored: DataFrame, batch: _Batch) -> DataFrame:
    """The upserted rows, laid out for a write by period.

    Rebalancing splits a hot period over several tasks and packs small ones together. The
    stored rows lie by period already: where a small batch spares them the shuffle of the
    join, only the batch is rebalanced.
    """
    period, key = F.col(PERIOD), "transactionid"
    if batch.size <= BROADCAST_KEYS:
        return upsert(stored, batch.rows.hint("rebalance", period), key, batch.size)
    return upsert(stored, batch.rows, key, batch.size).hint("rebalance", period)


def _periods_of_known_keys(stored: DataFrame, batch: _Batch) -> set[str | None]:
    """The stored periods that hold a key of the batch, from the key column alone."""
    key = F.col("transactionid")
    in_range = stored.where(key.between(batch.first_key, batch.last_key))
    keys = sized(batch.rows.select("transactionid"), batch.size, BROADCAST_KEYS)
    found = in_range.join(keys, "transactionid", "left_semi")
    return {r[0] for r in found.select(F.col(PERIOD).cast("string")).distinct().collect()}


def _touched_users(
    warehouse: Warehouse, entries: list[Entry], batch: _Batch, changes: DataFrame
) -> tuple[list[Entry], DataFrame]:
    """The buckets that stay as they are, and the stored users of those that a load rewrites:
    buckets with a user that was sent or whose balance moves."""
    ids = batch.rows.select("userid").unionByName(changes.select("userid"))
    touched = ids.select(warehouse.bucket_of(F.col("userid")).alias(BUCKET)).distinct().collect()
    names = {str(row[BUCKET]) for row in touched}
    stored = warehouse.buckets(entries)
    untouched = [e for e in stored if e.period not in names]
    return untouched, warehouse.read_users([e for e in stored if e.period in names])


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _key_ranges(batch: _Batch) -> list[tuple[int, int]]:
    """The keys of a batch as KEY_RANGES short ranges at most, between which there are none.

    Held against the ranges of keys in the manifest, they tell which periods can hold a known key:
    one late row does not open all periods between its id and the others.
    """
    first, last = batch.first_key, batch.last_key
    key, width = F.col("transactionid").cast("bigint"), -(-(last - first + 1) // KEY_RANGES)
    parts = batch.rows.groupBy(F.floor((key - first) / width)).agg(F.min(key), F.max(key))
    return [(row[1], row[2]) for row in parts.collect()]


def _name(entry: Entry) -> str | None:
    return None if entry.start is None else entry.period


def _count_upserts(batch: _Batch, before: DataFrame, after: DataFrame) -> None:
    """Counting rows of written tables reads file footers only: what a table grew by is new."""
    batch.counts.inserted = after.count() - before.count()
    batch.counts.updated = batch.size - batch.counts.inserted


def _count_unchanged(batch: _Batch, replaced: DataFrame) -> None:
    batch.counts.unchanged = replaced.where(~F.col("changed")).count()
    batch.counts.updated -= batch.counts.unchanged
