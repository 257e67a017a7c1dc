"""How filters interact: what each removes, and what it would have removed elsewhere in the order.

Each filter has a table of the ids of the rows that fail it. Rows that fail none survive every order
and are only counted; the others are narrowed down prefix by prefix: the survivors of a prefix are
those of the prefix without its last filter, left anti join that filter's ids, and what a filter
removes after a prefix is the prefix's survivors, left semi join its ids. As a set of filters leaves
the same rows in any order, the 32 sets stand for the prefixes of all 120 orders, and the survivors of
all sets without a filter meet its ids in one join.

All id tables have the same buckets by row id, so that none of these joins shuffles; buckets grow in
number with the rows. Only sums for each part, set and filter leave them, and orders are put together
from those.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import permutations
from math import factorial

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger_sync.session import scratch_path

from .common import NO_ID, as_bytes, map_texts

FILTERS = "ABCDE"
EVERY = 2 ** len(FILTERS) - 1
#: Rows of a bucket at most, and at least unless there is one bucket only.
BUCKET_ROWS, LEAST_BUCKET_ROWS = 1_000_000, 10_000
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
_MARK = re.compile(rb"[#$%&*|]")


def text_failures(text: bytes, code_points: int) -> tuple[bool, bool, bool, bool]:
    """Whether a text fails A (short), B (repeats words), C (capitals), D (marks)."""
    words = text.split()
    n = len(words)
    return (
        n < 50,
        100 * len(set(words)) < 65 * n,
        100 * len(text.translate(None, _NOT_CAPITAL)) > 5 * code_points,
        _MARK.search(text) is not None,
    )


def _flags(block: pa.RecordBatch) -> dict:
    texts = as_bytes(block.column("text"))
    points = pc.fill_null(pc.utf8_length(block.column("text")), 0).to_pylist()
    fails = list(zip(*map(text_failures, texts, points)))
    ids = block.column("doc_id")
    return dict(zip(["doc_id", "part", *"ABCD", "h"],
                    [ids, block.column("part"), *fails, [xxhash.xxh3_128_digest(t) for t in texts]]))


class _Relations:
    """Bucketed tables of row ids in the shared scratch folder, known to the session while in use."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.buckets = spark, root, 1
        self.prefix = f"filter_audit_{uuid.uuid4().hex}"
        self.names: list[str] = []

    def store(self, name: str, rows: DataFrame) -> DataFrame:
        """Add rows, which lie by row id already or are dealt by it: one more file for each bucket."""
        table = f"{self.prefix}_{name}"
        writer = rows.write.format("parquet").bucketBy(self.buckets, "row").option("path", f"{self.root}/{name}")
        self.names.append(table)
        writer.mode("append").saveAsTable(table)
        return self.spark.table(table)

    def dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, "row")


@contextmanager
def _relations(spark: SparkSession, root: str) -> Iterator[_Relations]:
    found = _Relations(spark, root)
    try:
        yield found
    finally:
        for name in found.names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _without(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return rows.join(ids.hint("merge"), "row", "left_anti")


def _within(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return rows.join(ids.hint("merge"), "row", "left_semi")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _steps() -> Column:
    """All orders, step by step: the set before it, the filter, the set after it."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            name = "".join(FILTERS[i] for i in order)
            after = before | 1 << f
            steps.append({"filter_order": name, "step": step, "f": f, "before": before, "after": after})
            before = after
    fields = "filter_order:string,step:int,f:int,before:int,after:int"
    return F.from_json(F.lit(json.dumps(steps)), f"array<struct<{fields}>>")


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """A row for each part, order of the five filters and step, with counts of the part's documents.

    Columns part, filter_order, step, and as longs kept (after the step), removed (by it), redundant
    (fail its filter, removed before), unique_fails (fail its filter only), good_lost and toxic_lost
    (removed by it, labelled quality or toxic 1), shapley (removed by its filter, over all orders).

    A null text is empty; it fails A alone, and E if a smaller id is empty as well. A null part is the
    empty string. Rows that repeat an id are each a document; none is E on account of the other. A row
    without an id comes after all ids, and has no label. An id that is labelled more than once counts as
    labelled 1 if any of its labels is. Other columns are not looked at. No documents give no rows.
    """
    spark, root = docs.sparkSession, scratch_path(docs.sparkSession, "filter-audit")
    own = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        "text",
    )
    schema = "doc_id long, part string, A boolean, B boolean, C boolean, D boolean, h binary"
    flagged = map_texts(own, ["doc_id", "part", "text"], _flags, schema)
    # Numbers of rows differ when a task runs again, so they are written before they are used.
    rows = _written(flagged.withColumn("row", F.monotonically_increasing_id()), f"{root}/rows")

    firsts = rows.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    firsts = _written(firsts.where("first < last").select("h", "first"), f"{root}/firsts")
    copies = rows.join(firsts, "h").where("doc_id > first").select("row", "doc_id", "part")
    copies = _written(copies, f"{root}/copies")
    known = labels.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    known = _written(known.where(f"(good = 1 OR toxic = 1) AND labelled < {NO_ID}"), f"{root}/labels")

    failing = rows.where("A OR B OR C OR D").select(*copies.columns).unionByName(copies)
    n_failing = failing.count()
    with _relations(spark, root) as relations:
        cores = spark.sparkContext.defaultParallelism
        some = min(cores, n_failing // LEAST_BUCKET_ROWS)
        relations.buckets = max(1, some, -(-n_failing // BUCKET_ROWS))
        failing = failing.join(known, failing["doc_id"] == known["labelled"], "left").select(
            "row", "part", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
        )
        failing = relations.dealt(failing).dropDuplicates(["row"])
        survivors = relations.store("survivors", failing.withColumn("filters", F.lit(0)))
        ids = [relations.store(f"fails_{f}", relations.dealt(
            copies.select("row") if f == "E" else rows.where(f).select("row"))) for f in FILTERS]
        # With each filter the sets double: those there are, and what is left of them without its ids.
        for f, failed in enumerate(ids):
            narrower = _without(survivors, failed).withColumn("filters", F.col("filters") + (1 << f))
            survivors = relations.store("survivors", narrower)

        left = survivors.groupBy("part", "filters").agg(F.count("*").alias("n"))
        gone = _union([
            _within(survivors.where(F.col("filters").bitwiseAND(1 << f) == 0), failed).withColumn("f", F.lit(f))
            for f, failed in enumerate(ids)
        ])
        gone = gone.groupBy("part", F.col("filters").alias("before"), "f").agg(
            F.count("*").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost")
        )
        left, gone = _written(left, f"{root}/left"), _written(gone, f"{root}/gone")
    return _by_step(rows, left, gone)


def _by_step(rows: DataFrame, left: DataFrame, gone: DataFrame) -> DataFrame:
    """Put the orders together: a part has at most 31 counts of survivors and 80 of removals."""
    letters = range(len(FILTERS))
    weight = reduce(
        lambda rest, k: F.when(F.bit_count("before") == k, factorial(k) * factorial(len(FILTERS) - 1 - k)).otherwise(rest),
        letters, F.lit(0),
    )

    def each(value: Column, when) -> Column:
        sums = [F.sum(F.when((F.col("f") == f) & when(f), value)) for f in letters]
        return F.array(*[F.coalesce(s, F.lit(0)) for s in sums])

    parts = rows.groupBy("part").agg(F.count("*").alias("n"))
    left = left.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("filters", "n"))).alias("left"),
        F.sum(F.when(F.col("filters") == 0, F.col("n"))).alias("n_failing"),
    )
    counts = F.struct("removed", "good_lost", "toxic_lost")
    gone = gone.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct(F.struct("before", "f"), counts))).alias("gone"),
        each(F.col("removed"), lambda f: F.col("before") == 0).alias("fails"),
        each(F.col("removed"), lambda f: F.col("before") == EVERY & ~(1 << f)).alias("alone"),
        each(F.col("removed") * weight, lambda f: F.lit(True)).alias("shapley"),
    )
    steps = parts.join(left, "part", "left").join(gone, "part", "left")
    steps = steps.select("*", F.inline(_steps()))
    here, still = F.try_element_at("gone", F.struct("before", "f")), F.try_element_at("left", F.col("after"))
    steps = steps.withColumns({"here": here, "still": still})

    def count(value: Column) -> Column:
        return F.coalesce(value, F.lit(0)).cast("long")

    removed = count(F.col("here.removed"))
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - count(F.col("n_failing")) + count(F.col("still"))).alias("kept"),
        removed.alias("removed"),
        (count(F.col("fails")[F.col("f")]) - removed).alias("redundant"),
        count(F.col("alone")[F.col("f")]).alias("unique_fails"),
        count(F.col("here.good_lost")).alias("good_lost"),
        count(F.col("here.toxic_lost")).alias("toxic_lost"),
        count(F.col("shapley")[F.col("f")]).alias("shapley"),
    )
