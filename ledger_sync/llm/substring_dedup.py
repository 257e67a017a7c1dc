"""Words inside passages that stand more than once.

A window is a suffix of its document, cut after so many words; windows that are equal are leaves of
one node of the suffix tree of the corpus. The tree is never built whole. Each window is filed under
a short run of its words, the one with the smallest hash, so that equal windows are filed alike and
neighbouring windows mostly under the same run: one entry stands for all of these. Runs that occur
once hold no repeat and go no further. For the others, the passages of whole entries are counted by
their hash, which combines before the shuffle: one that stands more than once is repeated throughout.
Of each passage, one or a few copies go on. A task gets those filed under some runs, sorts the
suffixes in them, and reads the deep nodes off equal neighbours; adjacent windows in such nodes join
to maximal repeats. A run with more passages than fit in a task is lengthened to the whole window, for
one copy of each passage: its groups are then nodes themselves, and need only be counted.

The texts cross the network twice, packed: to meet the runs that occur again, and to meet what is
removed from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from struct import unpack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger_sync.session import scratch_path

from .common import arrow_schema, as_bytes, blocks, map_batches

#: Words of the run a window is filed under.
RUN = 12
#: Passages under one run that a task takes; a run with more is lengthened.
GROUP = 4096
#: Passages that a task remembers to have passed on.
SEEN = 1 << 17
#: Bytes of passages whose suffixes are sorted together.
TREE_BYTES = 6 << 20
_PLACE = np.uint64((1 << 28) - 1)
_KNOWN_WORDS = 1 << 18


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_hashes = _Hashes()


def filed(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (their hashes) and the first and last window filed under each, in order."""
    n, run = len(words), min(RUN, window)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    each = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    key = np.zeros(n - run + 1, np.uint64)
    for i in range(run):
        key = key * np.uint64(0x9E3779B97F4A7C15) + each[i : n - run + 1 + i]
    key ^= key >> np.uint64(32)
    key *= np.uint64(0xD6E8FEB86659FD93)
    key ^= key >> np.uint64(32)
    least = (key & ~_PLACE) | np.arange(len(key), dtype=np.uint64)
    width, size = window - run + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: size - width], least[width - size :])
    at = (least & _PLACE).astype(np.int64)
    first = np.r_[0, np.flatnonzero(at[1:] != at[:-1]) + 1]
    last = np.r_[first[1:], len(at)] - 1
    return key[at[first]].view(np.int64), first, last


def _entries(docs: DataFrame, window: int) -> DataFrame:
    """A row (key, rid) for each run that windows are filed under."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            keys = [filed(t.split(), window)[0] for t in as_bytes(block.column("text"))]
            rows = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            columns = [pa.array(np.concatenate(keys)), block.column("__rid").take(pa.array(rows))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "rid"])

    return map_batches(docs.select("__rid", "text"), run, "key long, rid long")


def _packed(docs: DataFrame) -> DataFrame:
    """The text column as __packed, compressed."""
    rest = [c for c in docs.columns if c != "text"]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("__packed", T.BinaryType())])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for block in blocks(batches):
            texts = [packer.compress(t) for t in as_bytes(block.column("text"))]
            columns = [*(block.column(c) for c in rest), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return map_batches(docs.select(*rest, "text"), run, schema)


def _unpacked(column: pa.Array) -> Iterator[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    for packed in column:
        yield unpacker.decompress(packed.as_py())


def _passages(docs: DataFrame, window: int) -> DataFrame:
    """Passages of entries under repeated runs, from (__rid, __rid2, __packed, __runs).

    high, low: the hash of a passage; n: its windows. words is null where the task has sent them.
    """
    schema = "high long, low long, key long, rid long, rid2 long, at int, n int, words binary"
    kinds = arrow_schema(T.StructType.fromDDL(schema))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for block in blocks(batches, "__packed"):
            out: list[tuple] = []
            ids = zip(block.column("__rid").to_pylist(), block.column("__rid2").to_pylist())
            wanted = _numbers(block.column("__runs"))
            for (rid, rid2), runs, text in zip(ids, wanted, _unpacked(block.column("__packed"))):
                words = text.split()
                keys, first, last = filed(words, window)
                chosen = np.isin(keys, runs)
                for key, a, b in zip(*(x[chosen].tolist() for x in (keys, first, last))):
                    own = b" ".join(words[a : b + window])
                    digest = xxhash.xxh3_128_digest(own)
                    if digest in seen:
                        own = None
                    elif len(seen) < SEEN:
                        seen.add(digest)
                    out.append((*unpack("<2q", digest), key, rid, rid2, a, b - a + 1, own))
                if len(out) > 20_000:
                    yield batch_of(out)
                    out = []
            yield batch_of(out)

    return map_batches(docs.select("__rid", "__rid2", "__packed", "__runs"), run, schema)


def _windows(passages: DataFrame, window: int) -> DataFrame:
    """A row (high, low, rid, rid2, at) for each window of some passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, rows, at = [], [], []
            begins = batch.column("at").to_pylist()
            for i, (begin, passage) in enumerate(zip(begins, batch.column("words").to_pylist())):
                words = passage.split(b" ")
                n = len(words) - window + 1
                digests += [xxhash.xxh3_128_digest(b" ".join(words[j : j + window])) for j in range(n)]
                rows += [i] * n
                at += range(begin, begin + n)
            hashes = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            taken = batch.select(["rid", "rid2"]).take(pa.array(rows, pa.int64()))
            columns = [pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), *taken.columns, pa.array(at, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["high", "low", "rid", "rid2", "at"])

    columns = ["rid", "rid2", "at", "words"]
    return map_batches(passages.select(*columns), run, "high long, low long, rid long, rid2 long, at int")


def _numbers(column: pa.Array) -> Iterator[np.ndarray]:
    """The lists of numbers in a column, one after the other; null is an empty one."""
    values, ends = column.flatten().to_numpy(), np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())
    return (values[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()))


def deep_nodes(passages: list[bytes], window: int) -> list[np.ndarray]:
    """For each passage, which of its windows have an equal one among all.

    Equal passages are one in the tree; all windows of such a passage stand again.
    """
    number: dict[bytes, int] = {}
    which = [number.setdefault(p, len(number)) for p in passages]
    times = np.bincount(which)
    again = _equal_windows(list(number), window)
    for i in np.flatnonzero(times > 1):
        again[i][:] = True
    return [again[i] for i in which]


def _equal_windows(passages: list[bytes], window: int) -> list[np.ndarray]:
    """Sort the windows of different passages; those with an equal neighbour are in a deep node."""
    cut = [p.split(b" ") for p in passages]
    ids: dict[bytes, int] = {}
    flat = np.array([ids.setdefault(w, len(ids) + 1) for words in cut for w in words], np.int64)
    sizes = np.array([len(words) for words in cut])
    begins = np.cumsum(sizes) - sizes
    counts = sizes - window + 1
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(begins, counts) + inside
    bits = len(ids).bit_length()
    each = max(1, 62 // bits)
    keys = []
    for i in range(0, window, each):
        key = np.zeros(len(starts), np.int64)
        for j in range(i, min(i + each, window)):
            key = (key << bits) | flat[starts + j]
        keys.append(key)
    order = np.lexsort(keys[::-1])
    same = np.ones(max(0, len(order) - 1), bool)
    for key in keys:
        ordered = key[order]
        same &= ordered[1:] == ordered[:-1]
    again = np.zeros(len(order), bool)
    again[order] = np.r_[same, False] | np.r_[False, same]
    return np.split(again, np.cumsum(counts)[:-1])


def _subtrees(passages: DataFrame, window: int) -> DataFrame:
    """Maximal repeats (rid, rid2, span) within passages that come sorted by their run."""

    def work(rows: pa.Table) -> pa.RecordBatch:
        found = deep_nodes(rows.column("words").to_pylist(), window)
        row, begin, end = [], [], []
        for i, again in enumerate(found):
            if again.any():
                step = np.flatnonzero(np.diff(np.r_[False, again, False]))
                row += [i] * (len(step) // 2)
                begin.append(step[::2])
                end.append(step[1::2] - 1 + window)
        row = pa.array(row, pa.int64())
        at = rows.column("at").to_numpy()[row.to_numpy()].astype(np.int64)
        empty = [np.zeros(0, np.int64)]
        columns = {
            "rid": rows.column("rid").take(row).combine_chunks(),
            "rid2": rows.column("rid2").take(row).combine_chunks(),
            "span": pa.array((at + np.concatenate(begin or empty) << 32) + at + np.concatenate(end or empty)),
        }
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < TREE_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            keys = rows.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last run may go on
            if cut:
                yield work(rows.slice(0, cut).combine_chunks())
            rest = rows.slice(cut).combine_chunks()
            held, size = rest.to_batches(), rest.nbytes
        if held:
            yield work(pa.Table.from_batches(held).combine_chunks())

    dealt = passages.repartition("key").sortWithinPartitions("key")
    return map_batches(dealt, run, "rid long, rid2 long, span long")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _with_keys(docs: DataFrame) -> DataFrame:
    """A row's key is 128 bits of its id and text; rows that share it are equal in both."""
    return docs.withColumns({"__rid": F.xxhash64("doc_id", "text"), "__rid2": F.xxhash64("text", "doc_id")})


def _repeats(keyed: DataFrame, window: int) -> DataFrame:
    scratch = scratch_path(keyed.sparkSession, "substrings")
    entries = _written(_entries(keyed, window), f"{scratch}/entries")
    counts = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    runs = _written(counts.select("key"), f"{scratch}/runs")
    wanted = entries.join(runs, "key").groupBy("rid").agg(F.collect_set("key").alias("__runs"))
    texts = _packed(keyed.select("__rid", "__rid2", "text"))
    met = texts.join(wanted, texts["__rid"] == wanted["rid"])
    passages = _written(_passages(met, window), f"{scratch}/passages")

    sender = F.when(F.col("words").isNotNull(), F.col("rid"))
    copies = passages.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(sender).alias("sender"))
    copies = _written(copies, f"{scratch}/copies")
    again = copies.where("n > 1").select("high", "low")
    spans = passages.select("high", "low", "rid", "rid2", "at", "n").join(again, ["high", "low"])
    found = spans.select("rid", "rid2", _span(F.col("n") + (window - 1)))

    sent = passages.where("words IS NOT NULL").select("key", "high", "low", "rid", "rid2", "at", "words")
    crowded = sent.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("key")
    crowded = _written(crowded, f"{scratch}/crowded")
    if not crowded.isEmpty():
        one = copies.select("high", "low", F.col("sender").alias("rid"))
        windows = _windows(sent.join(crowded, "key", "left_semi").join(one, ["high", "low", "rid"]), window)
        windows = _written(windows, f"{scratch}/windows")
        nodes = windows.groupBy("high", "low").agg(F.count("*").alias("n")).where("n > 1").select("high", "low")
        hot = windows.join(_written(nodes, f"{scratch}/nodes"), ["high", "low"])
        found = found.unionByName(hot.select("rid", "rid2", _span(F.lit(window))))
        sent = sent.join(crowded, "key", "left_anti")
    return found.unionByName(_subtrees(sent, window))


def _span(length: Column) -> Column:
    begin = F.col("at").cast("long")
    return (F.shiftleft(begin, 32) + begin + length).alias("span")


def repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """Spans (doc_id, begin, end) of words whose windows all stand elsewhere too; spans may overlap.

    Null texts have none; rows that share id and text each have theirs.
    """
    keyed = _with_keys(docs.select("doc_id", "text"))
    found = _repeats(keyed, window).distinct()
    rows = keyed.select("doc_id", "__rid", "__rid2")
    same = (found["rid"] == rows["__rid"]) & (found["rid2"] == rows["__rid2"])
    end = F.col("span").bitwiseAND(F.lit((1 << 32) - 1))
    return rows.join(found, same).select("doc_id", F.shiftright("span", 32).alias("begin"), end.alias("end"))


def substring_dedup(docs: DataFrame, window: int = 35) -> DataFrame:
    """All columns, with repeated words taken out of the text, and n_words, n_removed.

    Words are cut at ASCII white space. A word goes if a window of ``window`` words of its document
    covers it that starts anywhere else too, in the same document or another, be it a row with the
    same id or text; all places lose it. What is left is joined by one space. Null texts and texts
    without words become empty; a text shorter than a window loses nothing. Null and repeated ids
    are allowed; columns called n_words or n_removed are replaced. No documents give no rows.
    """
    kept = docs.drop("n_words", "n_removed")
    names, keyed = kept.columns, _with_keys(kept)
    found = _repeats(keyed, window).groupBy("rid", "rid2").agg(F.collect_set("span").alias("__spans"))
    spans = found.withColumnsRenamed({"rid": "__of", "rid2": "__of2"})
    texts = _packed(keyed)
    same = (texts["__rid"] == spans["__of"]) & (texts["__rid2"] == spans["__of2"])
    joined = texts.join(spans, same, "left")
    rest = [c for c in names if c != "text"]
    counts = T.StructType.fromDDL("n_words long, n_removed long")
    schema = T.StructType(kept.schema.fields + counts.fields)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "__packed"):
            texts, n_words, n_removed = [], [], []
            for text, spans in zip(_unpacked(block.column("__packed")), _numbers(block.column("__spans"))):
                words = text.split()
                n_words.append(len(words))
                if len(spans):
                    gone = np.zeros(len(words) + 1, np.int64)
                    np.add.at(gone, spans >> 32, 1)
                    np.add.at(gone, spans & 0xFFFFFFFF, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
                n_removed.append(n_words[-1] - len(words))
                texts.append(b" ".join(words))
            new = pa.array(texts, pa.binary()).cast(pa.string())
            columns = [new if c == "text" else block.column(c) for c in names]
            columns += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return map_batches(joined.select(*rest, "__packed", "__spans"), run, schema)
