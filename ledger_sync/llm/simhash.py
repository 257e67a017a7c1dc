"""Near-duplicate documents by SimHash.

Fingerprints are made task by task and written once; from there on the work is on distinct ones, so
copies count once. Two fingerprints with at most d differing bits agree in 8 - d of their 8 bytes at
least. The inverted index therefore has an entry for each choice of that many byte positions and the
bytes there: a pair that shares an entry has reached the guaranteed number of matches, and no pair
below it is ever formed. Entries are sorted over range partitions. A task tallies the equal bytes of
the pairs in an entry, leaves a pair to the first entry it is in, and verifies the bits.

An entry that is large, or that lies across the border of two partitions, is split instead: the bits
that its members may differ in are cut into 8 parts again, of which 8 - d have to agree, and so on,
until so few bits are left that a group is small by construction. A task reports only a spanning star
of the links in a group. Components come from rounds of star contraction over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger_sync.session import scratch_path

from .common import as_bytes, map_batches, map_texts

#: Members of an entry that are compared with each other in one task.
GROUP = 4096
#: Open bits at which a group, with 1 << FEW_BITS members at most, is split no further.
FEW_BITS = 12
SEED = 42


def fingerprint(text: bytes, shingle: int) -> int:
    """64 bits, each the majority of the shingles' hashes; signed. No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    line, size = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i : i + (1 << 16)], np.uint64).view(np.uint8)
        counts += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """All columns but the text, and print."""
    rest = [c for c in docs.columns if c != "text"]

    def work(block: pa.RecordBatch) -> dict:
        prints = [fingerprint(t, shingle) for t in as_bytes(block.column("text"))]
        return {**{c: block.column(c) for c in rest}, "print": prints}

    fields = [docs.schema[c] for c in rest]
    return map_texts(docs, [*rest, "text"], work, T.StructType([*fields, T.StructField("print", T.LongType())]))


def choices(open_bits: list[int], max_distance: int) -> list[tuple[int, list[int]]]:
    """Cut the bits into 8 parts: each mask of parts that have to agree, and the bits it leaves open."""
    parts = [p.tolist() for p in np.array_split(np.array(open_bits), 8)]
    out = []
    for kept in combinations(range(8), 8 - max_distance):
        mask = sum(1 << bit for i in kept for bit in parts[i])
        out.append((mask, [bit for i in range(8) if i not in kept for bit in parts[i]]))
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _star(prints: np.ndarray, max_distance: int, mask: np.uint64 | None) -> list[tuple[int, int]]:
    """Links (member, first member) that connect what is linked in one group."""
    m = len(prints)
    linked = np.zeros((m, m), bool)
    for i in range(0, m, 256):
        apart = prints[i : i + 256, None] ^ prints[None, :]
        linked[i : i + 256] = np.bitwise_count(apart) <= max_distance
        if mask is not None:
            linked[i : i + 256] &= _first_choice(apart, max_distance) == mask
    links, unseen = [], np.ones(m, bool)
    for root in range(m):
        if not unseen[root]:
            continue
        unseen[root] = False
        edge = np.array([root])
        while edge.size:
            reached = linked[edge].any(axis=0) & unseen
            unseen &= ~reached
            edge = np.flatnonzero(reached)
            links += [(int(prints[i]), int(prints[root])) for i in edge]
    return links


def _first_choice(apart: np.ndarray, max_distance: int) -> np.ndarray:
    """Tally equal bytes; the mask of the first 8 - max_distance of them, 0 if there are fewer."""
    tally = np.zeros(apart.shape, np.int8)
    mask = np.zeros(apart.shape, np.uint64)
    for byte in range(8):
        own = np.uint64(0xFF << 8 * byte)
        equal = ((apart & own) == 0) & (tally < 8 - max_distance)
        tally += equal
        mask[equal] |= own
    mask[tally < 8 - max_distance] = 0
    return mask


def _near_places(
    masks: np.ndarray | None, prints: np.ndarray, sizes: np.ndarray, max_distance: int
) -> list[tuple[int, int]]:
    """All links in many small groups that stand one after the other: members 1, 2, ... places apart."""
    links = []
    group = np.repeat(np.arange(len(sizes)), sizes)
    for step in range(1, int(sizes.max())):
        pair = group[step:] == group[:-step]
        a, b = prints[step:][pair], prints[:-step][pair]
        apart = a ^ b
        near = np.bitwise_count(apart) <= max_distance
        if masks is not None:
            near[near] = _first_choice(apart[near], max_distance) == masks[step:][pair][near]
        links += zip(a[near].tolist(), b[near].tolist())
    return links


def _found(links: list[tuple[int, int]], masks: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    """Rows (0, a, b) for links and (mask, print, null) for what has to be split."""
    ends = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    columns = {
        "mask": np.r_[np.zeros(len(ends), np.int64), masks],
        "a": np.r_[ends[:, 0], prints],
        "b": pa.concat_arrays([pa.array(ends[:, 1]), pa.nulls(len(prints), pa.int64())]),
    }
    return pa.RecordBatch.from_pydict(columns)


class _Scan:
    """One partition of sorted entries (mask, key, print), whose groups come whole, one after the other.

    The first and the last group may go on in another partition, so they are split, as large ones
    are; on the last level all groups are small, and dealt out by their key.
    """

    def __init__(self, max_distance: int, level: int, last: bool):
        self.max_distance, self.first_level, self.last = max_distance, level == 0, last

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = [np.zeros(0, np.int64)] * 3
        hot, at_start = None, True
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(3)]
            if hot is not None:  # rows that go on with a group that is being split
                n = int(np.argmin(np.r_[(columns[0] == hot[0]) & (columns[1] == hot[1]), False]))
                yield _found([], columns[0][:n], columns[2][:n])
                columns = [c[n:] for c in columns]
                if not len(columns[0]):
                    continue
                hot = None
            columns = [np.concatenate(x) for x in zip(carry, columns)]
            if not len(columns[0]):
                continue
            mask, key, prints = columns
            begin = np.r_[0, np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1]
            cut = int(begin[-1])  # of the last group, there may be more rows to come
            if cut:
                yield self._groups(mask[:cut], prints[:cut], np.diff(begin), at_start)
                at_start = False
            carry = [c[cut:] for c in columns]
            if len(carry[0]) > GROUP and not self.last:
                yield _found([], carry[0], carry[2])
                hot, at_start = (carry[0][0], carry[1][0]), False
                carry = [c[:0] for c in carry]
        if len(carry[0]):
            sizes = np.array([len(carry[0])])
            yield self._groups(carry[0], carry[2], sizes, True)

    def _groups(
        self, mask: np.ndarray, prints: np.ndarray, sizes: np.ndarray, at_border: bool
    ) -> pa.RecordBatch:
        split = np.zeros(len(sizes), bool)
        if not self.last:
            split |= sizes > GROUP
            split[0] |= at_border
        bits, masks = prints.view(np.uint64), mask.view(np.uint64)
        few, links = (sizes > 1) & (sizes <= 32) & ~split, []
        if few.any():
            rows = np.repeat(few, sizes)
            own = masks[rows] if self.first_level else None
            links += _near_places(own, bits[rows], sizes[few], self.max_distance)
        ends = np.cumsum(sizes)
        for i in np.flatnonzero((sizes > 32) & ~split):
            own = slice(ends[i] - sizes[i], ends[i])
            links += _star(bits[own], self.max_distance, masks[own][0] if self.first_level else None)
        rows = np.repeat(split, sizes)
        return _found(links, mask[rows], prints[rows])


def _index(prints: DataFrame, max_distance: int) -> DataFrame:
    """An entry for each print and choice of bytes."""
    masks = [_signed(m) for m, _ in choices(list(range(64)), max_distance)]
    entry = F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask")
    return prints.select(entry, "print").select(
        "mask", F.col("mask").bitwiseAND(F.col("print")).alias("key"), "print"
    )


def _resplit(groups: DataFrame, max_distance: int) -> DataFrame:
    """Entries for each further choice among the bits that a mask leaves open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, prints = (batch.column(i).to_numpy() for i in range(2))
            for mask in np.unique(masks):
                own = prints[masks == mask]
                whole = int(mask) & ((1 << 64) - 1)
                open_bits = [b for b in range(64) if not whole >> b & 1]
                for more, _ in choices(open_bits, max_distance):
                    full = np.int64(_signed(whole | more))
                    yield pa.RecordBatch.from_pydict(
                        {"mask": np.full(len(own), full), "key": own & full, "print": own}
                    )

    return map_batches(groups, run, "mask long, key long, print long").distinct()


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def links_between(prints: DataFrame, max_distance: int, scratch: str) -> DataFrame:
    """Links (a, b) that connect every two distinct prints with at most ``max_distance`` other bits."""
    if not 0 < max_distance < 8:
        raise ValueError("max_distance is 1 to 7")
    open_bits = 8 * max_distance
    entries, links = _index(prints, max_distance), []
    level = 0
    while True:
        last = level > 0 and open_bits <= FEW_BITS
        scan = _Scan(max_distance, level, last)
        if last:  # few bits are open, so no group is large
            dealt = entries.repartition("mask", "key")
        else:
            dealt = entries.repartitionByRange("mask", "key", "print")
        ordered = dealt.sortWithinPartitions("mask", "key", "print")
        found = _written(map_batches(ordered, scan, "mask long, a long, b long"), f"{scratch}/level-{level}")
        links.append(found.where("b IS NOT NULL").select("a", "b"))
        rest = found.where("b IS NULL").select("mask", F.col("a").alias("print"))
        if last or rest.isEmpty():
            break
        open_bits = max_distance * -(-open_bits // 8)
        entries = _resplit(rest, max_distance)
        level += 1
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out.distinct()


def components(links: DataFrame, scratch: str) -> DataFrame:
    """(node, root) for each node of a link that is not its component's smallest, by star contraction.

    A round hangs the larger neighbours of each node on its smallest one, then its smaller ones.
    """
    edges = _written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), f"{scratch}/stars-0")
    state, turn = None, 0
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state, turn = now, turn + 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = _written(small, f"{scratch}/stars-{turn}")


def simhash_groups(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """All columns but the text, and fingerprint, component_id, component.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a text of fewer than ``shingle`` words
    is one shingle, and one of none (null, empty) has the fingerprint 0 and is linked like any other.
    component_id is the smallest id in the component, null ids left out (null if there is no other);
    component is a number that no other component has. Rows that repeat an id or a text each get
    their row. Columns of these names are replaced. No documents give no rows. The fingerprints and the tables of the rounds are
    written below the shared scratch folder.
    """
    spark: SparkSession = docs.sparkSession
    scratch = scratch_path(spark, "simhash")
    kept = docs.drop("fingerprint", "component_id", "component", "print")
    prints = _written(fingerprints(kept, shingle), f"{scratch}/prints")
    distinct = prints.groupBy("print").agg(F.min("doc_id").alias("first_id"))
    distinct = _written(distinct, f"{scratch}/distinct")
    links = links_between(distinct.select("print"), max_distance, scratch)
    roots = components(links, scratch)
    rooted = distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("__component"))
    named = rooted.join(smallest, "root").select(F.col("print").alias("__print"), "__component", F.col("root").alias("__root"))
    return prints.join(named, prints["print"] == named["__print"]).select(
        *[c for c in prints.columns if c != "print"],
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("__component").alias("component_id"),
        F.col("__root").alias("component"),
    )
