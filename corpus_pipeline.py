"""A corpus from documents to token ids: five stages, each over all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledger_sync.llm.bpe import encode_decode
from ledger_sync.llm.common import table
from ledger_sync.llm.decontaminate import decontaminate
from ledger_sync.llm.line_dedup import line_dedup
from ledger_sync.llm.quality_classifier import score_quality
from ledger_sync.llm.simhash import simhash_groups
from ledger_sync.session import scratch_path


def _apart(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """The documents with other columns under names no operator uses, and the columns as they were."""
    names = {c: f"__column_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.withColumnsRenamed(names), [F.col(names.get(c, c)).alias(c) for c in docs.columns]


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good; it learns from labelled ones among ``docs``."""
    docs, columns = _apart(docs)
    scored = score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 10 characters or more that several documents have stay in the first of these only."""
    docs, columns = _apart(docs)
    return line_dedup(docs, min_docs=2, min_chars=10).select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id (a null id comes last)."""
    docs, columns = _apart(docs)
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    groups = simhash_groups(keyed.select("doc_id", "text", "__row"), shingle=4, max_distance=4)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("__row").alias("row"))
    chosen = groups.groupBy("component").agg(F.min(order).alias("first")).select(F.col("first.row").alias("__kept"))
    kept = keyed.join(chosen, keyed["__row"] == chosen["__kept"])
    number = F.row_number().over(Window.partitionBy("__row").orderBy("__row"))  # rows equal in id and text
    return kept.withColumn("__number", number).where("__number = 1").select(*columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage of 10 words (or a whole shorter item)."""
    docs, columns = _apart(docs)
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.where("NOT contaminated").select(*columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and digests of the ids and of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_decode(docs, ranks, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality_classifier", classify_quality),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_level_bpe", encode_tokens),
]

#: SQL cannot say the classifier, SimHash or the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written and read again."""
    scratch = scratch_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{scratch}/{number}-{name}")
        docs = spark.read.parquet(f"{scratch}/{number}-{name}")
    return docs
