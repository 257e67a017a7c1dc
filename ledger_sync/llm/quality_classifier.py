"""Quality scores from statistics of a text.

Random Fourier features approximate a Gaussian kernel over some standardised statistics of each
document. A ridge regression of the labels on them needs only sums of products, which the tasks make
for their own rows; the sums are kept for each of some folds, so that leaving one out gives scores
for rows a model has not seen, and those calibrate the score by isotonic regression. The sample to
learn from has a fixed bound; every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger_sync.session import scratch_path

from .common import arrow_schema, as_bytes, blocks, map_batches

#: Labelled rows to learn from at most: those with the smallest hashes of their ids.
TRAIN_ROWS = 100_000
#: Random features, folds, the ridge penalty for a row, and tasks that sum up products.
N_FEATURES = 256
FOLDS = 5
PENALTY = 1e-4
TASKS = 16

_KINDS = np.zeros((256, 9))
for _b in range(256):
    _c = chr(_b)
    if _b >= 128:
        _KINDS[_b, 0] = 1
    else:
        _tests = (_c.islower(), _c.isupper(), _c.isdigit(), _c in " \t\r\x0b\x0c", _c == "\n")
        _marks = (_c in "#*$%&|<>", _c in "!?", _c in ".,;:'\"()-")
        _KINDS[_b, 1:] = (*_tests, *_marks)
N_STATISTICS = 9 + 7


def statistics(text: bytes) -> np.ndarray:
    """Shares of kinds of bytes, lengths, and how much of the text repeats itself; all finite."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _KINDS
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n = max(1, len(words))
    begun = sum(w[:1].isupper() for w in words)
    return np.r_[
        counts / max(1, len(text)),
        np.log1p(len(words)),
        np.log1p(len(text) / n),
        np.log1p(len(words) / max(1, len(lines))),
        len(set(words)) / n**0.8,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        begun / n,
    ]


@dataclass
class Model:
    """What scoring needs; its size is fixed by N_FEATURES and the bound on the sample."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    raw: np.ndarray  # ascending raw scores
    calibrated: np.ndarray  # and what they mean

    def score(self, statistics: np.ndarray) -> np.ndarray:
        raw = fourier(statistics, self.mean, self.spread) @ self.weights
        return np.clip(np.interp(raw, self.raw, self.calibrated), 0, 1)


def fourier(rows: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Random features of the standardised rows, and a 1."""
    random = np.random.default_rng(20240817)
    directions = random.normal(0, 1 / np.sqrt(N_STATISTICS), (N_STATISTICS, N_FEATURES))
    phases = random.uniform(0, 2 * np.pi, N_FEATURES)
    standard = np.clip((rows - mean) / spread, -8, 8)
    waves = np.sqrt(2 / N_FEATURES) * np.cos(standard @ directions + phases)
    return np.c_[waves, np.ones(len(rows))]


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nondecreasing fit of labels to scores, as points: the mean score and value of each block."""
    order = np.argsort(scores, kind="stable")
    blocks_: list[list[float]] = []  # rows, sum of scores, sum of labels
    for x, y in zip(scores[order].tolist(), labels[order].tolist()):
        blocks_.append([1.0, x, y])
        while len(blocks_) > 1 and blocks_[-2][2] * blocks_[-1][0] >= blocks_[-1][2] * blocks_[-2][0]:
            n, sx, sy = blocks_.pop()
            blocks_[-1] = [blocks_[-1][0] + n, blocks_[-1][1] + sx, blocks_[-1][2] + sy]
    points = np.array(blocks_)
    return points[:, 1] / points[:, 0], points[:, 2] / points[:, 0]


def is_held_out(doc_id: Column) -> Column:
    """Every third id by its checksum is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (row, label, s) to learn from: TRAIN_ROWS at most, whose ids can be broadcast."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~is_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("double").alias("__label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    known = known.withColumnRenamed("doc_id", "__labelled")
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("__labelled"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            own = [statistics(t).tolist() for t in as_bytes(block.column("text"))]
            columns = [block.column("doc_id"), block.column("__label"), pa.array(own, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "s"])

    schema = "doc_id long, label double, s array<double>"
    return map_batches(rows.select("doc_id", "__label", "text"), run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, N_STATISTICS)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled documents that are not held out (see ``is_held_out``)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "quality-sample")
    _sample(docs, labels).write.parquet(path)
    sample = spark.read.schema("doc_id long, label double, s array<double>").parquet(path)
    one = sample.groupBy("doc_id").agg(F.min(F.struct("label", "s")).alias("r"))  # of those that share an id
    sample = one.select("doc_id", "r.*").repartition(TASKS, "doc_id")
    sums = [F.avg(F.col("s")[i]) for i in range(N_STATISTICS)]
    spreads = [F.stddev_pop(F.col("s")[i]) for i in range(N_STATISTICS)]
    n, label, *moments = sample.agg(F.count("*"), F.avg("label"), *sums, *spreads).first()
    if not n or label in (0.0, 1.0):  # nothing to tell apart
        flat = np.full(2, label if n else 0.5)
        none = np.zeros(N_FEATURES + 1)
        return Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS), none, np.array([0.0, 1.0]), flat)
    mean, spread = np.array(moments[:N_STATISTICS]), np.array(moments[N_STATISTICS:])
    spread[spread < 1e-9] = 1.0
    size = N_FEATURES + 1

    def folds(block: pa.RecordBatch) -> np.ndarray:
        ids = block.column("doc_id").to_numpy().astype(np.uint64)
        return (ids * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(FOLDS)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, size, size + 1))
        for block in batches:
            waves, fold = fourier(_matrix(block.column("s")), mean, spread), folds(block)
            both = np.c_[waves, block.column("label").to_numpy()]
            for k in range(FOLDS):
                total[k] += waves[fold == k].T @ both[fold == k]
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    parts = map_batches(sample, products, "sums binary").toLocalIterator()
    total = sum(np.frombuffer(p["sums"]).reshape(FOLDS, size, size + 1) for p in parts)

    def solve(sums: np.ndarray) -> np.ndarray:
        return np.linalg.solve(sums[:, :size] + PENALTY * n * np.eye(size), sums[:, size])

    unseen = np.array([solve(total.sum(axis=0) - total[k]) for k in range(FOLDS)])

    def cross_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches:
            raw = fourier(_matrix(block.column("s")), mean, spread) @ unseen.T
            own = raw[np.arange(len(raw)), folds(block).astype(int)]
            yield pa.RecordBatch.from_pydict({"raw": own, "label": block.column("label")})

    rows = map_batches(sample, cross_scores, "raw double, label double").collect()  # TRAIN_ROWS at most
    raw, calibrated = isotonic(np.array([r["raw"] for r in rows]), np.array([r["label"] for r in rows]))
    return Model(mean, spread, solve(total.sum(axis=0)), raw, calibrated)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of the documents and held_out, score, predicted.

    score: how likely label 1 is (0 to 1), from the text alone; predicted: 1 if it is 0.5 or more.
    held_out: the id's rows are never learnt from (false for a null id, which has no label either).
    Null texts count as empty; those are scored like any other. An id that is labelled twice has the
    lower label; of documents that share an id, one is learnt from. With no usable labels all scores are
    0.5, with labels of one kind that label. Columns of these names are replaced. No documents give
    no rows.
    """
    kept = docs.drop("held_out", "score", "predicted")
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    schema = T.StructType(kept.schema.fields + T.StructType.fromDDL("score double").fields)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            rows = np.array([statistics(t) for t in as_bytes(block.column("text"))])
            columns = [*block.columns, pa.array(model.value.score(rows))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    scored = map_batches(kept, run, schema)
    return scored.select(
        *kept.columns,
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
