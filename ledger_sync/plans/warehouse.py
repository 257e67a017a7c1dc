"""Versioned Parquet tables that are published together.

Each load writes its tables under new ``v=<n>`` folders and, last, one manifest
that names the current folder of every table and period. Readers follow the newest
complete manifest, so a load that fails midway changes nothing: its number is not
used again. Of two loads that began from the same version one is published, and the other fails:
each version has one successor, and a file that only one load can create is the right to publish it.

    <root>/users/v=3/bucket=7/                   buckets of users rewritten by version 3
    <root>/transactions/v=3/period=2024-08-21/   periods rewritten by version 3
    <root>/updatemetadata/v=3/...                whole table
    <root>/rejects/v=3/...                       quarantined rows of the batch
    <root>/waiting/v=3/...                       transactions whose user has not come yet
    <root>/manifest/v=3[-<batch digest>]/...     (batch, layout, table, period, path, keys)
    <root>/claims/v=3, after=2-0                 number 3 is taken; so is the right to follow 2
"""

from __future__ import annotations

import copy
import hashlib
import re
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import date, datetime

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledger_sync.operators.balance import control_row, moment
from ledger_sync.schemas import (
    CONTROL_ID, DEFAULT_LIMITS, METADATA, REASON, RECORD, SEED_WATERMARK, TRANSACTIONS, USERS,
    Limits,
)

PERIOD, BUCKET = "period", "bucket"
#: Seconds after which a claim counts as left behind by a load that was lost as it published. While it
#: holds its claim, a load only writes its manifest, one small file.
CLAIM_SECONDS = 600
_PERIODS = ("day", "month", "year")
REJECTS = "rejects"
WAITING = "waiting"
_NULL_PERIOD = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = (
    T.StructType()
    .add("batch", T.StringType())
    .add("layout", T.StringType())
    .add("table", T.StringType())
    .add("period", T.StringType())
    .add("path", T.StringType())
    .add("first_key", T.LongType())
    .add("last_key", T.LongType())
)
_REJECTS = (
    T.StructType()
    .add("table", T.StringType())
    .add(REASON, T.StringType())
    .add(RECORD, T.StringType())
    .add("v", T.LongType())
)


@dataclass(frozen=True)
class Entry:
    """Where one table, or one period of transactions, currently lies below the root."""

    table: str
    path: str
    period: str | None = None
    first_key: int | None = None
    last_key: int | None = None

    def may_hold(self, ranges: list[tuple[int, int]]) -> bool:
        """Whether a key in one of the ranges can be in this folder."""
        if self.first_key is None or self.last_key is None:
            return True
        return any(a <= self.last_key and b >= self.first_key for a, b in ranges)

    @property
    def start(self) -> date | None:
        """The first day of the period; transactions without a date have none."""
        return None if self.period in (None, _NULL_PERIOD) else date.fromisoformat(self.period)


class Conflict(RuntimeError):
    """Another load has published since this one began; nothing of this one has been."""


class Warehouse:
    """``period`` and ``user_buckets`` set what an upsert rewrites: one period of transactions, or
    one bucket of users. Choose them so that one holds some GB."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        limits: Limits = DEFAULT_LIMITS,
        period: str = "day",
        user_buckets: int = 16,
    ) -> None:
        if period not in _PERIODS:
            raise ValueError(f"period must be one of {', '.join(_PERIODS)}: {period}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.limits = limits
        self.period = period
        self.user_buckets = user_buckets
        self.layout = f"{period}, {limits.key_type}, {limits.money}, {user_buckets} buckets"
        self._known: dict[int, list[Entry]] = {}
        self._pinned: int | None = None

    def at(self, version: int | None = None) -> Warehouse:
        """The warehouse as it was published under a version (the newest one, if none is given),
        whatever is published later. What is published through it has to be the first successor."""
        version, manifests = self._published() if version is None else version, self._manifests()
        if version not in manifests or not self._is_complete(manifests[version]):
            raise ValueError(f"no version {version} at {self.root}")
        pinned = copy.copy(self)
        pinned._pinned = version
        return pinned

    def init(self, watermark: datetime | str | None = SEED_WATERMARK) -> Warehouse:
        """Create empty tables and the control row, unless a version exists already."""
        if self.version() is not None:
            return self
        version = self.next_version()
        metadata = self.spark.range(0 if watermark is None else 1).select(
            F.lit(CONTROL_ID).alias("id"), moment(watermark).alias("last_update_date")
        )
        self.publish(version, [self.write_whole(METADATA, metadata, version)])
        return self

    # Versions

    def version(self) -> int | None:
        """The newest version whose manifest is complete."""
        manifests = self._manifests()
        newest_first = sorted(manifests, reverse=True)
        return next((v for v in newest_first if self._is_complete(manifests[v])), None)

    def next_version(self) -> int:
        """A number that no load has used, not even one that failed, nor takes at the same time."""
        folders = ("manifest", USERS, TRANSACTIONS, METADATA, REJECTS, WAITING, "claims")
        number = max((v for f in folders for v in self._numbered(f)), default=-1) + 1
        while not create_file(self.spark, f"{self.root}/claims/v={number}"):
            number += 1
        return number

    def entries(self) -> list[Entry]:
        """The published folders: one per bucket of users, per period, and per whole table."""
        version = self._published()
        if version not in self._known:  # a manifest never changes once it is published
            path = f"{self.root}/manifest/{self._manifests()[version]}"
            rows = self.spark.read.schema(_MANIFEST).json(path).collect()
            layouts = {r["layout"] for r in rows}
            if layouts != {self.layout}:
                raise ValueError(f"the warehouse has the layout {layouts}, not {self.layout}")
            fields = ("table", "path", "period", "first_key", "last_key")
            self._known = {version: [Entry(*[r[f] for f in fields]) for r in rows]}
        return list(self._known[version])

    def has_batch(self, batch: str) -> bool:
        """Whether any version was published for this batch."""
        ending = _batch_ending(batch)
        return any(n.endswith(ending) and self._is_complete(n) for n in self._manifests().values())

    def publish(self, version: int, entries: list[Entry], batch: str | None = None) -> None:
        """Make a version current. The digest of the batch in the name lets a listing find it."""
        rows = [
            (batch, self.layout, e.table, e.period, e.path, e.first_key, e.last_key) for e in entries
        ]
        columns = dict(zip(_MANIFEST.names, zip(*rows)))
        table = pa.table(columns, schema=to_arrow_schema(_MANIFEST))
        manifest = self.spark.createDataFrame(table).coalesce(1)
        # The marker of a complete folder is what readers look for.
        writer = manifest.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        name = f"v={version}{_batch_ending(batch)}"
        with self._claim(self.version() if self._pinned is None else self._pinned):
            writer.mode("error").json(f"{self.root}/manifest/{name}")

    # Reading

    def users(self) -> DataFrame:
        return self.read_users(self.buckets(self.entries()))

    def buckets(self, entries: list[Entry]) -> list[Entry]:
        return [e for e in entries if e.table == USERS]

    def bucket_of(self, userid: Column) -> Column:
        return F.pmod(F.xxhash64(userid.cast("bigint")), F.lit(self.user_buckets)).cast("int")

    def read_users(self, buckets: list[Entry], with_bucket: bool = False) -> DataFrame:
        schema = _nullable(self.limits.users())
        schema = schema.add(BUCKET, T.IntegerType()) if with_bucket else schema
        if not buckets:
            return _empty(self.spark, schema)
        paths = [f"{self.root}/{e.path}" for e in buckets]
        if not with_bucket:
            return self.spark.read.schema(schema).parquet(*paths)
        # Versions of a bucket lie in several folders, so the column comes from each path.
        parts = F.regexp_extract("_metadata.file_path", rf"/{BUCKET}=(\d+)/[^/]*$", 1).cast("int")
        users = self.spark.read.schema(_nullable(self.limits.users())).parquet(*paths)
        return users.select(*schema.names[:-1], parts.alias(BUCKET))

    def waiting(self) -> DataFrame:
        """Transactions that were put in quarantine because their user was unknown, and still is."""
        schema = _nullable(self.limits.transactions().add(PERIOD, "date"))
        found = [e for e in self.entries() if e.table == WAITING]
        return self._read(found[0], schema) if found else _empty(self.spark, schema)

    def metadata(self) -> DataFrame:
        return self._read(self._entry(METADATA), self.limits.metadata())

    def watermark(self) -> datetime | None:
        """The stored high-water mark: one value, to be used as a literal filter."""
        row = control_row(self.metadata()).first()
        return None if row is None else row[0]

    def transactions(self, since: date | None = None) -> DataFrame:
        """All transactions, or those of the periods that reach ``since`` or a later day."""
        periods = self.periods(self.entries())
        if since is not None:
            first = self.start_of(since)
            periods = [e for e in periods if e.start is not None and e.start >= first]
        return self.read_periods(periods).drop(PERIOD)

    def create_views(self) -> None:
        """Let SQL read the current version as users, transactions and updatemetadata."""
        self.users().createOrReplaceTempView(USERS)
        self.transactions().createOrReplaceTempView(TRANSACTIONS)
        self.metadata().createOrReplaceTempView(METADATA)

    def rejects(self) -> DataFrame:
        """The quarantined rows of all published loads, with the version ``v`` of the load."""
        found = [e for e in self.entries() if e.table == REJECTS]
        if not found:
            return _empty(self.spark, _REJECTS)
        reader = self.spark.read.schema(_REJECTS).option("basePath", f"{self.root}/{REJECTS}")
        return reader.parquet(*[f"{self.root}/{e.path}" for e in found])

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove folders that none of the newest ``keep`` versions names; returns their paths.

        Quarantined rows stay, and so do manifests that tell of a batch. Not to be called while a
        load runs, or while someone still reads an older version.
        """
        manifests = {v: n for v, n in self._manifests().items() if self._is_complete(n)}
        kept = sorted(manifests, reverse=True)[: max(1, keep)]
        rows = self.spark.read.schema(_MANIFEST).json([f"{self.root}/manifest/{manifests[v]}" for v in kept])
        named = {row["path"] for row in rows.select("path").collect()}
        old = [f"manifest/{n}" for v, n in manifests.items() if v not in kept and "-" not in n]
        for table in (USERS, TRANSACTIONS, METADATA, WAITING):
            for version, name in self._numbered(table).items():
                path = f"{table}/{name}"
                parts = [f"{path}/{p}" for p in list_names(self.spark, f"{self.root}/{path}") if "=" in p]
                if version > kept[0] or path in named:
                    continue
                old += [p for p in parts if p not in named] if named & set(parts) else [path]
        for name in list_names(self.spark, f"{self.root}/claims"):
            if int(re.sub(r".*=(\d+).*|.*", r"\1", name) or -1) < kept[0]:
                old.append(f"claims/{name}")
        for path in old:
            remove_folder(self.spark, f"{self.root}/{path}")
        return old

    def periods(self, entries: list[Entry]) -> list[Entry]:
        return [e for e in entries if e.table == TRANSACTIONS]

    def start_of(self, day: date) -> date:
        """The first day of the period that holds a day."""
        if self.period == "day":
            return day
        return day.replace(day=1) if self.period == "month" else date(day.year, 1, 1)

    def period_of(self, moment: Column) -> Column:
        """The first day of the period a transaction belongs to; null without a date."""
        return F.to_date(moment) if self.period == "day" else F.trunc(moment, self.period)

    def read_periods(self, periods: list[Entry]) -> DataFrame:
        """The transactions of the given folders, with their ``period``."""
        schema = _nullable(self.limits.transactions().add(PERIOD, "date"))
        if not periods:
            return _empty(self.spark, schema)
        reader = self.spark.read.schema(schema)
        reader = reader.option("basePath", f"{self.root}/{TRANSACTIONS}")
        return reader.parquet(*[f"{self.root}/{e.path}" for e in periods]).select(*schema.names)

    def only(self, transactions: DataFrame, periods: set[str | None]) -> DataFrame:
        """The rows of ``read_periods`` in some periods; no folder of another period is read."""
        if not periods:
            return self.read_periods([])
        days = [date.fromisoformat(p) for p in periods if p is not None]
        wanted = F.col(PERIOD).isin(days)
        return transactions.where(wanted | F.col(PERIOD).isNull() if None in periods else wanted)

    # Writing

    def write_whole(self, table: str, df: DataFrame, version: int) -> Entry:
        path = f"{table}/v={version}"
        df.write.parquet(f"{self.root}/{path}")
        return Entry(table, path)

    def write_users(self, df: DataFrame, version: int) -> list[Entry]:
        """Write users into one folder per bucket and list the buckets that have rows."""
        path, prefix = f"{USERS}/v={version}", f"{BUCKET}="
        typed = _typed(df, self.limits.users())
        dealt = typed.withColumn(BUCKET, self.bucket_of(F.col("userid"))).hint("rebalance", F.col(BUCKET))
        ordered = dealt.sortWithinPartitions(BUCKET, "userid")
        ordered.write.partitionBy(BUCKET).parquet(f"{self.root}/{path}")
        folders = [n for n in list_names(self.spark, f"{self.root}/{path}") if n.startswith(prefix)]
        return [Entry(USERS, f"{path}/{f}", f.removeprefix(prefix)) for f in folders]

    def write_periods(self, df: DataFrame, version: int) -> list[Entry]:
        """Write transactions into one folder per period and list the periods that have rows.

        A write by period sorts by it anyhow; sorting by id as well gives row groups narrow
        ranges of ids, so that a later upsert can skip those without a key of its batch. Bloom filters
        are as large as the ids of a file need: at full size, they outweighed small files by far.
        """
        path, prefix = f"{TRANSACTIONS}/v={version}", f"{PERIOD}="
        typed = _typed(df, self.limits.transactions().add(PERIOD, "date"))
        ordered = typed.sortWithinPartitions(PERIOD, "transactionid")
        writer = ordered.write.option("parquet.bloom.filter.enabled#transactionid", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.partitionBy(PERIOD).parquet(f"{self.root}/{path}")
        folders = [n for n in list_names(self.spark, f"{self.root}/{path}") if n.startswith(prefix)]
        entries = [Entry(TRANSACTIONS, f"{path}/{f}", f.removeprefix(prefix)) for f in folders]
        key, period = F.col("transactionid").cast("bigint"), F.col(PERIOD).cast("string")
        ranges = self.read_periods(entries).groupBy(period.alias(PERIOD)).agg(F.min(key), F.max(key))
        keys = {r[0] or _NULL_PERIOD: (r[1], r[2]) for r in ranges.collect()}
        return [replace(e, first_key=keys[e.period][0], last_key=keys[e.period][1]) for e in entries]

    @contextmanager
    def _claim(self, base: int | None) -> Iterator[None]:
        """The right to publish the successor of a version while it is newest, or raise ``Conflict``.
        A claim that a lost load left behind is passed over after CLAIM_SECONDS, by one load again."""
        folder, number = f"{self.root}/claims", 0
        while not create_file(self.spark, claim := f"{folder}/after={base}-{number}"):
            changed = changed_at(self.spark, claim)
            if changed is None:  # it has just been given back
                continue
            if self.version() != base or time.time() - changed < CLAIM_SECONDS:
                raise Conflict(f"another load has published, or is about to, after version {base} at {self.root}")
            number += 1
        try:
            if self.version() != base:
                raise Conflict(f"another load has published after version {base} at {self.root}")
            yield
        finally:
            remove_folder(self.spark, claim)

    # Files

    def _published(self) -> int:
        if self._pinned is not None:
            return self._pinned
        version = self.version()
        if version is None:
            raise RuntimeError(f"no published warehouse at {self.root}; call init() first")
        return version

    def _manifests(self) -> dict[int, str]:
        """Manifest folder names by version, complete or not, from one listing."""
        return self._numbered("manifest")

    def _is_complete(self, manifest: str) -> bool:
        return path_exists(self.spark, f"{self.root}/manifest/{manifest}/_SUCCESS")

    def _numbered(self, folder: str) -> dict[int, str]:
        names = [n for n in list_names(self.spark, f"{self.root}/{folder}") if n.startswith("v=")]
        return {int(n.removeprefix("v=").split("-")[0]): n for n in names}

    def _entry(self, table: str) -> Entry:
        (entry,) = [e for e in self.entries() if e.table == table]
        return entry

    def _read(self, entry: Entry, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(_nullable(schema)).parquet(f"{self.root}/{entry.path}")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, on any file system Spark can reach; none if there is no folder."""
    folder, files = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def path_exists(spark: SparkSession, path: str) -> bool:
    location, files = _file_system(spark, path)
    return files.exists(location)


def create_file(spark: SparkSession, path: str) -> bool:
    """Whether an empty file could be created; as atomic as the file system is in that."""
    location, files = _file_system(spark, path)
    files.mkdirs(location.getParent())
    try:
        files.create(location, False).close()
    except Py4JJavaError as error:
        if not files.exists(location):
            raise error
        return False
    return True


def changed_at(spark: SparkSession, path: str) -> float | None:
    """Seconds since 1970 of a file's last change; none if there is no file."""
    location, files = _file_system(spark, path)
    try:
        return files.getFileStatus(location).getModificationTime() / 1000
    except Py4JJavaError as error:
        if files.exists(location):
            raise error
        return None


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, files = _file_system(spark, path)
    files.delete(folder, True)


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _batch_ending(batch: str | None) -> str:
    return "" if batch is None else f"-{hashlib.sha256(batch.encode()).hexdigest()[:32]}"


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, which the planner can see."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).where(F.lit(False)).select(*columns)


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the types that the table is read with; a value beyond them raises."""
    kinds = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
