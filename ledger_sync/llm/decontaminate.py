"""Documents that hold passages of a benchmark.

A task takes the words of some texts as one array of numbers and sorts its suffixes: a suffix array
of that shard, to the depth of a window. Every suffix of every benchmark item is then found in it by
binary search. Adjacent finds on a diagonal make the longest verbatim matches, with their places;
matches of different items may overlap. The benchmark is broadcast in blocks of a checked size, one
pass over the corpus for each; the corpus itself is never shuffled for one block. Copies of a text
come one after another and are cut at the same sizes, so they may lie in several blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES, arrow_schema, as_bytes, blocks, map_batches

#: Bytes of benchmark text that are searched for in one pass over the corpus.
BENCHMARK_BYTES = 16 << 20
#: Bytes that each word of a text takes when it is packed, about, and each word of a further copy.
PACKED_WORD, PACKED_COPY = 160, 16
#: Words of a shard whose suffixes are sorted together; a longer text is a shard of its own.
SHARD_WORDS = 1 << 19

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

MATCHES = "array<struct<item_id:long,item_word:int,doc_word:int,n_words:int>>"


def words(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters and digits of ASCII and of all other characters."""
    return text.translate(_WORD_BYTES).split()


class Benchmark:
    """The distinct windows of a block of items as packed numbers, ready to be searched for."""

    def __init__(self, items: list[tuple[int, bytes]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        places: dict[tuple[int, ...], dict[int, int]] = {}  # of a window: first place in each item
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                places.setdefault(tuple(ids[i : i + size]), {}).setdefault(item, i)
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.each = min(window, 62 // self.bits)  # words in a number
        self.n_keys = -(-window // self.each)
        found = list(places)
        self.sizes = np.array([len(w) for w in found], np.int64)
        self.shortest = int(self.sizes.min()) if found else 0
        most = (1 << self.bits) - 1
        self.low = self._packed([w + (0,) * (window - len(w)) for w in found])
        self.high = self._packed([w + (most,) * (window - len(w)) for w in found])
        self.first = np.cumsum([0] + [len(places[w]) for w in found])
        self.items = np.array([i for w in found for i in places[w]], np.int64)
        self.item_words = np.array([n for w in found for n in places[w].values()], np.int64)

    @property
    def n_bytes(self) -> int:
        """About what is broadcast; a word of the vocabulary takes some 100 bytes besides its own."""
        arrays = [*self.low, *self.high, self.sizes, self.first, self.items, self.item_words]
        return sum(a.nbytes for a in arrays) + sum(len(w) + 100 for w in self.vocabulary)

    def _packed(self, windows: list[tuple[int, ...]]) -> list[np.ndarray]:
        return self.keys(np.array(windows, np.int64).reshape(len(windows), self.window).T)

    def keys(self, columns) -> list[np.ndarray]:
        """Pack the words at each place of a window, which come as one array a place."""
        out = []
        for k in range(0, self.n_keys * self.each, self.each):
            key = np.zeros(len(columns[0]), np.int64)
            for i in range(k, k + self.each):
                key <<= self.bits
                if i < self.window:
                    key |= columns[i]
            out.append(key)
        return out

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of windows and where in ``ids`` they stand. ``ids`` ends with ``window`` zeros."""
        n = len(ids) - self.window
        known = ids[:n] != 0
        for i in range(1, self.shortest):  # a shorter suffix can't hold a window
            known &= ids[i : n + i] != 0
        suffixes = np.flatnonzero(known)
        keys = self.keys([ids[suffixes + i] for i in range(self.window)])
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        begin, end = self._bound(keys, self.low, False), self._bound(keys, self.high, True)
        counts = end - begin
        windows = np.repeat(np.arange(len(counts)), counts)
        inside = np.arange(len(windows)) - np.repeat(np.cumsum(counts) - counts, counts)
        return windows, suffixes[order[np.repeat(begin, counts) + inside]]

    def _bound(self, keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
        """Binary search of all windows at once: the first suffix not below (or above) each."""
        low = np.searchsorted(keys[0], wanted[0], "left")
        high = np.searchsorted(keys[0], wanted[0], "right")
        if len(keys) == 1:
            return high if after else low
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            below, same = np.zeros(len(open_), bool), np.ones(len(open_), bool)
            for key, want in zip(keys[1:], wanted[1:]):
                here, target = key[middle], want[open_]
                below |= same & (here < target)
                same &= here == target
            if after:
                below |= same
            low[open_[below]] = middle[below] + 1
            high[open_[~below]] = middle[~below]
        return low

    def matches(self, windows: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """Longest matches as arrays (item, word of the item, place, words)."""
        n = self.first[windows + 1] - self.first[windows]
        rows = np.repeat(np.arange(len(windows)), n)
        inside = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
        entry = self.first[windows[rows]] + inside
        item, word, place, size = self.items[entry], self.item_words[entry], at[rows], self.sizes[windows[rows]]
        order = np.lexsort((place, place - word, item))
        item, word, place, size = (x[order] for x in (item, word, place, size))
        if not len(item):
            return [item, word, place, size]
        joined = (item[1:] == item[:-1]) & (place[1:] == place[:-1] + 1) & (word[1:] == word[:-1] + 1)
        starts = np.flatnonzero(np.r_[True, ~joined])
        ends = np.r_[starts[1:], len(item)] - 1
        return [item[starts], word[starts], place[starts], place[ends] + size[ends] - place[starts]]


def _shards(texts: list[bytes]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Number of the first text and the words of some texts, about SHARD_WORDS together."""
    start, held, total = 0, [], 0
    for i, text in enumerate(texts):
        own = words(text)
        if held and total + len(own) > SHARD_WORDS:
            yield start, held
            start, held, total = i, [], 0
        held.append(own)
        total += len(own)
    if held:
        yield start, held


def _search_pass(docs: DataFrame, bench: Benchmark) -> DataFrame:
    """All columns and n_words, matches (null if none) for one block of the benchmark."""
    block_of_items = docs.sparkSession.sparkContext.broadcast(bench)
    added = T.StructType.fromDDL(f"n_words long, matches {MATCHES}")
    schema = T.StructType(docs.schema.fields + added.fields)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = block_of_items.value
        for block in blocks(batches):
            n_words, matches = [], []
            for _, shard in _shards(as_bytes(block.column("text"))):
                n_words += map(len, shard)
                matches += _matches_of(bench, shard)
            columns = [*block.columns, pa.array(n_words, pa.int64()), pa.array(matches, arrow[-1].type)]
            columns = [c.cast(f.type) for c, f in zip(columns, arrow)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return map_batches(docs, run, schema)


def _matches_of(bench: Benchmark, shard: list[list[bytes]]) -> list[list[dict] | None]:
    out: list[list[dict] | None] = [None] * len(shard)
    if not bench.shortest:
        return out
    gap = [0] * bench.window
    starts, ids = [], []
    for own in shard:
        starts.append(len(ids))
        ids += map(bench.vocabulary.get, own, repeat(0))
        ids += gap
    found = bench.matches(*bench.search(np.array(ids, np.int64)))
    if len(found[0]):
        begins = np.array(starts)
        row = np.searchsorted(begins, found[2], "right") - 1
        found[2] = found[2] - begins[row]
        order = np.lexsort((found[0], found[1], found[2], row))
        for r, i, w, p, n in zip(row[order].tolist(), *(x[order].tolist() for x in found)):
            if out[r] is None:
                out[r] = []
            out[r].append({"item_id": i, "item_word": w, "doc_word": p, "n_words": n})
    return out


def _blocks_of(benchmark: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """The distinct items, equal texts together, in blocks by running size.

    A block has BENCHMARK_BYTES of text at most, each copy counted, and takes about BROADCAST_BYTES
    when packed; a longer text is a block of its own.
    """
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    rows = benchmark.where("item_id IS NOT NULL").select("item_id", text).where(F.length("text") > 0)
    held: list[tuple[int, bytes]] = []
    size = packed = n_words = 0
    for row in rows.distinct().sort("text", "item_id").toLocalIterator():
        item, own = row["item_id"], bytes(row["text"])
        copy = bool(held) and held[-1][1] == own
        if copy:
            own = held[-1][1]
        else:
            n_words = len(words(own))
        cost = n_words * (PACKED_COPY if copy else PACKED_WORD)
        if held and (size + len(own) > BENCHMARK_BYTES or packed + cost > BROADCAST_BYTES):
            yield held
            held, size, packed, cost = [], 0, 0, n_words * PACKED_WORD
        held.append((item, own))
        size, packed = size + len(own), packed + cost
    yield held


def _packed_blocks(items: list[tuple[int, bytes]], window: int) -> Iterator[Benchmark]:
    """A block ready to be broadcast, halved as long as it takes more than BROADCAST_BYTES."""
    bench = Benchmark(items, window)
    if len(items) < 2 or bench.n_bytes <= BROADCAST_BYTES:
        yield bench
        return
    del bench
    half = len(items) // 2
    yield from _packed_blocks(items[:half], window)
    yield from _packed_blocks(items[half:], window)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """All columns of the documents and n_words, matches.

    matches: the longest verbatim runs of words that a document and an item share, of ``window``
    words at least, or of a whole item that is shorter; null if there are none. A run names the
    first word on both sides, from 0; where an item repeats a window, the window's first place.
    Null and empty texts have no words. Items with no words or a null id match nothing; rows that
    repeat an item's id are one item. Columns called n_words or matches are replaced.
    """
    kept = docs.drop("n_words", "matches")
    parts = [_search_pass(kept, b) for items in _blocks_of(benchmark) for b in _packed_blocks(items, window)]
    out = parts[0]
    if len(parts) > 1:  # the same rows come from each pass; their matches are put together
        names = kept.columns
        for part in parts[1:]:
            out = out.unionByName(part)
        lists = F.flatten(F.collect_list("matches"))
        merged = out.groupBy(*names, "n_words").agg(lists.alias("matches"), F.count("*").alias("__n"))
        # a row that is there more than once has all its matches as often
        times = F.expr("explode(sequence(1, CAST(__n AS INT) DIV " + str(len(parts)) + "))")
        distinct = F.array_distinct("matches")
        merged = merged.withColumn("matches", F.when(F.size(distinct) > 0, distinct))
        out = merged.select(*names, "n_words", "matches", times.alias("__k")).drop("__k")
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """All columns of the documents and n_words, n_hit, items, longest_match, contaminated.

    A word is hit if a window of some item that stands in the text covers it. items: the distinct
    ids of items with such windows, sorted as strings; longest_match: words of the longest verbatim
    match (0 if none). Filter on ``contaminated`` to remove affected documents. Nulls, empty texts
    and clashing names are as in ``longest_matches``.
    """
    own = ("n_words", "n_hit", "items", "longest_match", "contaminated", "matches")
    found = longest_matches(docs.drop(*own), benchmark, window)
    ranges = F.array_sort(F.transform("matches", lambda m: F.struct(m["doc_word"].alias("begin"), (m["doc_word"] + m["n_words"]).alias("end"))))
    covered = F.aggregate(  # matches by place: add what goes beyond the last end
        ranges,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, r: F.struct(
            F.greatest(acc["end"], r["end"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(acc["end"], r["begin"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"].cast("string"))))
    longest = F.array_max(F.transform("matches", lambda m: m["n_words"])).cast("long")
    return found.select(
        *found.columns[:-1],
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(items, F.array().cast("array<string>")).alias("items"),
        F.coalesce(longest, F.lit(0)).alias("longest_match"),
        F.col("matches").isNotNull().alias("contaminated"),
    )
