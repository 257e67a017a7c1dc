"""Lines that many documents share are kept in the first of them only.

Each text is cut into normalised lines, whose 128-bit hashes go with the document's id through one
aggregation (combined before its shuffle, so that a line in a third of all documents costs a row a
task) that counts distinct documents and finds the smallest id. Hashes over the threshold are written
to the shared folder and joined back to the lines: as both sides are then plain shuffles, adaptive
execution can split a hot hash. What a document has to drop is gathered for each document, and its text is put together
again from the lines that stay, in their order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger_sync.session import scratch_path

from .common import NO_ID, arrow_schema, as_bytes, blocks, map_batches, map_texts


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """128 bits of a line without white space at its ends and with A-Z lowered; None if short."""
    key = line.strip().lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def _line_rows(min_chars: int):
    def work(block: pa.RecordBatch) -> dict:
        rows, hashes = [], []
        for i, text in enumerate(as_bytes(block.column("text"))):
            own = {line_hash(line, min_chars) for line in text.split(b"\n")}
            own.discard(None)
            rows += [i] * len(own)
            hashes += own
        return {"line_id": block.column("line_id").take(pa.array(rows, pa.int64())), "h": hashes}

    return work


def shared_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """A row (h, first_id) for each line hash found in ``min_docs`` or more documents."""
    lines = _lines(docs, min_chars)
    if min_docs == 2:  # two distinct ids are there if the smallest is not the largest
        many = F.min("line_id") != F.max("line_id")
    else:
        many = F.count_distinct("line_id") >= min_docs
    found = lines.groupBy("h").agg(F.min("line_id").alias("first_id"), many.alias("many"))
    return found.where("many").select("h", "first_id")


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    ids = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("line_id"), "text")
    return map_texts(ids, ["line_id", "text"], _line_rows(min_chars), "line_id long, h binary")


def line_dedup(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """The documents with shared lines taken out, and the columns n_lines and n_dropped.

    A line is shared if its key has ``min_chars`` code points and is in ``min_docs`` documents; all
    its lines go, but for those in the document with the smallest id. Null and empty texts are one
    empty line, and become the empty text. Rows without an id are one document, the last. Rows that
    repeat an id are one document too. All other columns stay; columns of the input that are called
    n_lines or n_dropped are replaced. No documents give no rows.
    """
    path = scratch_path(docs.sparkSession, "shared-lines")
    shared_lines(docs, min_docs, min_chars).write.parquet(path)
    shared = docs.sparkSession.read.schema("h binary, first_id long").parquet(path)
    drops = (
        _lines(docs, min_chars)
        .join(shared, "h")
        .where(F.col("line_id") != F.col("first_id"))
        .groupBy(F.col("line_id").alias("__drop_id"))
        .agg(F.collect_set("h").alias("__drop"))
    )
    kept = docs.drop("n_lines", "n_dropped")
    keyed = kept.withColumn("__line_id", F.coalesce("doc_id", F.lit(NO_ID)).cast("long"))
    joined = keyed.join(drops, keyed["__line_id"] == drops["__drop_id"], "left")
    counts = T.StructType.fromDDL("n_lines long, n_dropped long")
    schema = T.StructType(kept.schema.fields + counts.fields)
    arrow, names = arrow_schema(schema), kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts, n_lines, n_dropped = [], [], []
            for text, drop in zip(as_bytes(block.column("text")), block.column("__drop").to_pylist()):
                n_lines.append(text.count(b"\n") + 1)
                if drop:
                    gone, lines = set(drop), text.split(b"\n")
                    lines = [x for x in lines if line_hash(x, min_chars) not in gone]
                    n_dropped.append(n_lines[-1] - len(lines))
                    text = b"\n".join(lines)
                else:
                    n_dropped.append(0)
                texts.append(text)
            new = {"text": pa.array(texts, pa.binary()).cast(pa.string())}
            columns = [new[n] if n in new else block.column(n) for n in names]
            columns += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            columns = [c.cast(f.type) for c, f in zip(columns, arrow)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return map_batches(joined.select(*names, "__drop"), run, schema)
