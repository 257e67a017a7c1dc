"""Command line: ``spark-submit``-able entry for the daily load and for incremental ingestion.

    python -m ledger_sync load --warehouse DIR --users FILE --transactions FILE [--preset dag]
    python -m ledger_sync ingest --warehouse DIR --users DIR --transactions DIR --checkpoint DIR
    python -m ledger_sync check  --warehouse DIR     (exit code 1 if a constraint is broken)
    python -m ledger_sync vacuum --warehouse DIR [--keep 2]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ledger_sync.plans.audit import violations
from ledger_sync.plans.load import Counts, Report, run_batch
from ledger_sync.plans.warehouse import Warehouse
from ledger_sync.schemas import DATE_FORMS, PRESETS, SEED_WATERMARK, Limits
from ledger_sync.sources.extracts import FILE_FORMATS
from ledger_sync.streaming.ingest import ingest_new_files


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledger_sync", description="Sync a wallet-ledger warehouse.")
    commands = top.add_subparsers(dest="command", required=True)
    for name, what in (
        ("load", "load two extracts"), ("ingest", "load the files that are new"),
        ("check", "count rows that break a constraint"), ("vacuum", "remove what old versions left"),
    ):
        command = commands.add_parser(name, help=what)
        command.add_argument("--warehouse", required=True, help="folder of the tables")
        command.add_argument("--period", choices=["day", "month", "year"], default="day")
        command.add_argument("--key-type", choices=["int", "bigint"], default="int")
        command.add_argument("--user-buckets", type=int, default=16, help="units of users to rewrite")
        if name == "vacuum":
            command.add_argument("--keep", type=int, default=2, help="newest versions to keep")
        if name in ("check", "vacuum"):
            continue
        command.add_argument("--users", required=True, help="extract of users")
        command.add_argument("--transactions", required=True, help="extract of transactions")
        command.add_argument("--format", choices=FILE_FORMATS, default="csv", help="of both extracts")
        command.add_argument("--preset", choices=sorted(PRESETS), default="script")
        command.add_argument("--policy", choices=["fail", "quarantine"], default="quarantine")
        command.add_argument(
            "--balances", choices=["since_watermark", "net_changes"], default="since_watermark"
        )
        command.add_argument("--date-form", choices=sorted(DATE_FORMS), help="default: that of the first date")
        command.add_argument("--undated", choices=["keep", "reject"], default="keep")
        command.add_argument("--seed", default=SEED_WATERMARK, help="mark of a fresh warehouse")
        command.add_argument(
            "--multiline", action=argparse.BooleanOptionalAction,
            help="line breaks in quotes; default: where a quote stays open",
        )
        command.add_argument("--classify", action="store_true", help="count unchanged rows apart")
        command.add_argument("--run-ts", help="run time, yyyy-MM-dd HH:mm:ss; default: now")
    commands.choices["ingest"].add_argument("--checkpoint", required=True)
    commands.choices["load"].add_argument("--batch", help="an id; a published batch is skipped")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("ledger_sync").getOrCreate()
    warehouse = Warehouse(
        spark, args.warehouse, Limits(key_type=args.key_type), args.period, args.user_buckets
    )
    if args.command == "check":
        rows = violations(warehouse).where("n > 0").orderBy("table", "rule").collect()
        print("\n".join(f"{r['table']}: {r['rule']}: {r['n']}" for r in rows) or "no constraint is broken")
        if rows:
            raise SystemExit(1)
        return
    if args.command == "vacuum":
        print("\n".join(warehouse.vacuum(args.keep)))
        return
    warehouse.init(args.seed)
    options = {
        "preset": PRESETS[args.preset],
        "policy": args.policy,
        "balances": args.balances,
        "run_ts": args.run_ts,
        "classify": args.classify,
        "date_form": args.date_form,
        "undated": args.undated,
        "file_format": args.format,
    }
    if args.command == "load":
        paths = args.users, args.transactions
        options["multiline"] = args.multiline
        print(summary(run_batch(spark, *paths, warehouse, batch=args.batch, **options)))
        return
    ingest_new_files(
        warehouse, args.users, args.transactions, args.checkpoint,
        multiline=args.multiline, **options
    ).awaitTermination()
    print(f"version {warehouse.version()}, watermark {warehouse.watermark()}")


def summary(report: Report) -> str:
    lines = [f"version {report.version}, watermark {report.watermark}"]
    for name, counts in (("users", report.users), ("transactions", report.transactions)):
        lines.append(f"{name}: {_figures(counts)}")
        lines += [f"  rejected: {reason}: {n}" for reason, n in sorted(counts.rejected.items())]
    return "\n".join(lines)


def _figures(counts: Counts) -> str:
    return (
        f"read {counts.read}, deduped {counts.deduped}, filtered {counts.filtered}, "
        f"inserted {counts.inserted}, updated {counts.updated}, unchanged {counts.unchanged}"
    )


if __name__ == "__main__":
    main()
