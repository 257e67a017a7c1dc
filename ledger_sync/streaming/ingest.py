"""Incremental ingestion: every new extract file is loaded once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledger_sync.plans.load import load_batch
from ledger_sync.plans.warehouse import Warehouse
from ledger_sync.schemas import TRANSACTION_COLUMNS, TRANSACTIONS, USER_COLUMNS, USERS
from ledger_sync.sources.extracts import FILE_FORMATS, extract_of, json_rows, text_lines

_TABLE = "_table"


def ingest_new_files(
    warehouse: Warehouse,
    users_dir: str,
    transactions_dir: str,
    checkpoint: str,
    name: str = "ingest",
    multiline: bool | None = None,
    file_format: str = "csv",
    **options,
) -> StreamingQuery:
    """Load the files that arrived since the last run, then stop.

    All new files of both folders are one micro-batch, so first in file order means the same as
    in a batch load, and users and transactions that arrive together are published together. A
    version carries the name and number of its micro-batch; if a batch is replayed after a
    failure, a version it has already published is left alone. ``options`` are those of
    ``load_batch``.

    The stream is of lines, which tell what files are new, their headers (each in any order and
    letter case) and whether a quote stays open; the files are then read as those of a batch load.
    With ``file_format="json"`` the lines are the records, one JSON object each.
    ``multiline`` reads line breaks in quoted text; where it is not given, it is used for a table
    with a quote that stays open. A file that lacks a column stops the run.
    """
    if file_format not in FILE_FORMATS:
        raise ValueError(f"file_format must be one of {', '.join(FILE_FORMATS)}: {file_format}")
    spark = warehouse.spark
    users, transactions = (
        text_lines(spark.readStream, folder).withColumn(_TABLE, F.lit(table))
        for folder, table in ((users_dir, USERS), (transactions_dir, TRANSACTIONS))
    )

    def publish(lines: DataFrame, number: int) -> None:
        batch = f"{name}:{number}"
        if warehouse.has_batch(batch):
            return
        sent = [
            (lines.where(F.col(_TABLE) == table).drop(_TABLE), columns)
            for table, columns in ((USERS, USER_COLUMNS), (TRANSACTIONS, TRANSACTION_COLUMNS))
        ]
        if file_format == "json":
            load_batch(warehouse, *[json_rows(*part) for part in sent], batch=batch, **options)
            return
        sent = [extract_of(*part) for part in sent]
        own = {"date_form": options.get("date_form") or sent[1].date_form(multiline)}
        load_batch(warehouse, *[e.rows(multiline) for e in sent], batch=batch, **options | own)

    writer = users.unionByName(transactions).writeStream.queryName(name).foreachBatch(publish)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
