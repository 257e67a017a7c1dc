"""Documents dealt into shards of nearly equal size, equal texts together.

Texts are ordered by their hash; equal ones are a group that is not split. The least capacity that
lets a greedy cut of that order do with the given number of shards is found by binary search; the
shards are then cut within it, each near an equal share of what is left. The search runs on a summary of the running total: of each of a fixed number of stretches, its first and
last group end. A summary tells for sure that a capacity is enough, or that it is not, but for some
capacities in between; the stretches where their cuts may lie are then summed up more finely, until
the greedy cut is known to the byte. So the driver sees a bounded table a round, however many groups
there are. A group that is larger than an equal share has a shard of its own, first in the order.

Running totals and numbers of rows are made in two steps, within stretches of the hash and over their
sums; copies are also dealt by their ids, so that a text in a third of all rows is no task of its own.
All of it is DataFrame operations on one small row for each document; texts are not shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledger_sync.session import scratch_path

#: Stretches in a summary; parts that the copies of a text are dealt into; hex digits of a bucket.
STRETCHES = 1 << 14
COPY_PARTS = 64
BUCKET_DIGITS = 3
#: Bytes that a row counts besides its text.
ROW_BYTES = 8


def _rows(docs: DataFrame) -> DataFrame:
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        (F.octet_length(content) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.md5(content).alias("__group"),
        F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(COPY_PARTS)).alias("__part"),
    )


def own_shards(largest: list[int], total: int, n_shards: int) -> int:
    """How many of the largest groups are larger than an equal share of what is left without them."""
    n = 0
    while n < len(largest) and n < n_shards - 1 and largest[n] * (n_shards - n) > total:
        total -= largest[n]
        n += 1
    return n


class Summary:
    """Group ends that are known, and between which of them there are more."""

    def __init__(self, start: int, stretches: list[tuple[int, int, int]]):
        """stretches: the first end, the last end and the number of groups of each."""
        self.start, self.ends, self.open = start, [start], [False]
        for first, last, n in sorted(stretches):
            self.ends.append(first)
            self.open.append(False)
            if last > first:
                self.ends.append(last)
                self.open.append(n > 2)  # before this one there are others

    def cut(self, target: int) -> tuple[int, int]:
        """The last end up to the target: at least the first number, at most the second."""
        i = bisect_right(self.ends, target)
        low = self.ends[i - 1]
        return low, target if i < len(self.ends) and self.open[i] else low

    def cuts(self, capacity: int, n: int, most: bool) -> list[int]:
        """Greedy cuts: each as early as it may be, or (``most``) as late."""
        at, out = self.start, []
        for _ in range(n):
            at = self.cut(at + capacity)[most]
            out.append(at)
            if at >= self.ends[-1]:
                break
        return out

    def enough(self, capacity: int, n: int, most: bool) -> bool:
        """If not ``most``: surely enough. If ``most``: not surely too little."""
        return self.cuts(capacity, n, most)[-1] >= self.ends[-1]

    def least(self, low: int, high: int, n: int, most: bool) -> int:
        while low < high:
            middle = (low + high) // 2
            if self.enough(middle, n, most):
                high = middle
            else:
                low = middle + 1
        return low

    def even_cuts(self, capacity: int, n: int) -> tuple[list[int], set[tuple[int, int]]]:
        """Cuts within the capacity, each as near as can be to an equal share of what is left.

        Also the stretches whose inner ends matter for them; if there are any, the cuts are guesses.
        """
        unclear: set[tuple[int, int]] = set()

        def around(target: int) -> tuple[int, int]:
            """The last end up to the target and the first one from it on."""
            i = bisect_left(self.ends, target)
            if self.ends[i] != target and self.open[i]:
                unclear.add((self.ends[i - 1], self.ends[i]))
            return (target if self.ends[i] == target else self.ends[i - 1]), self.ends[i]

        total = self.ends[-1]
        least = [total]  # what the shards from each one on can hold begins here or later
        for _ in range(n - 1):
            target = least[-1] - capacity
            least.append(around(target)[1] if target > self.start else self.start)
        at, out = self.start, []
        for k in range(1, n + 1):
            if at == total:
                break
            most = around(min(at + capacity, total))[0]
            share = at + (total - at) // (n - k + 1)
            below, above = around(share)
            near = above if below <= at or above - share < share - below else below
            at = min(max(near, least[n - k]), most)
            out.append(at)
        return out, unclear


def _summary(groups: DataFrame, windows: list[tuple[int, int]], n: int) -> list[tuple[int, int, int]]:
    """First end, last end and number of groups of STRETCHES equal parts of the windows.

    There are at least 64 for each of ``n`` shards, so windows of two parts a cut shrink each round.
    """
    width = -(-sum(b - a + 1 for a, b in windows) // max(STRETCHES, 64 * n))
    stretch, base = F.lit(None).cast("long"), 0
    for a, b in windows:
        own = base + F.floor((F.col("end") - a) / width).cast("long")
        stretch = F.when(F.col("end").between(a, b), own).otherwise(stretch)
        base += (b - a) // width + 1
    parts = groups.select("end", stretch.alias("s")).where("s IS NOT NULL").groupBy("s")
    rows = parts.agg(F.min("end").alias("first"), F.max("end").alias("last"), F.count("*").alias("n")).collect()
    return [(r["first"], r["last"], r["n"]) for r in rows]


def _merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def least_cuts(groups: DataFrame, start: int, total: int, largest: int, n: int) -> list[int]:
    """Ends of ``n`` shards at most, none larger than the least capacity that does, as even as may be.

    groups: a distinct ``end`` for each group, its running total from ``start`` to ``total``.
    """
    size = total - start
    if size == 0:
        return []
    low = max(largest, -(-size // n))
    high = low + largest
    windows, known = [(start + 1, total)], {}
    while True:
        stretches = _summary(groups, windows, n)
        outside = [s for s in known if not any(a <= s[0] and s[1] <= b for a, b in windows)]
        known = dict.fromkeys([*outside, *stretches])
        summary = Summary(start, list(known))
        high = summary.least(low, high, n, False)
        low = summary.least(low, high, n, True)
        if low == high:
            cuts, unclear = summary.even_cuts(low, n)
            if not unclear:
                return cuts
            windows = _merged(list(unclear))
            continue
        earliest, latest = summary.cuts(low, n, False), summary.cuts(high, n, True)
        latest += [total] * (len(earliest) - len(latest))
        found = []  # a window takes in the whole stretches at its ends
        for a, b in zip(earliest, latest):
            a = summary.ends[max(1, bisect_left(summary.ends, a))]
            b = summary.ends[min(bisect_left(summary.ends, b), len(summary.ends) - 1)]
            if a < b:
                found.append((a, b))
        windows = _merged(found)


def _position(value: Column, cuts: list[int]) -> Column:
    """How many cuts come before a group end."""
    return sum((F.when(value > c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")


def shard(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """A row (doc_id, size, text_crc32, law, shard, slot, grown_shard) for each document.

    size: UTF-8 bytes and 8. The law is ``bytes``: the largest shard is as small as the order of the
    groups allows. slot numbers a shard's rows from 0: by the text's hash, the id's remainder, the id.
    grown_shard is null: another number of shards cuts elsewhere. A null text counts as empty, and is
    in one group with empty texts; a null id comes with those that leave no remainder, before them.
    Rows that repeat id and text are as good as each other, and each has a slot. If there are fewer
    groups than shards, or none, shards stay empty. Other columns are left out.
    """
    spark = docs.sparkSession
    scratch = scratch_path(spark, "shards")
    rows = _rows(docs)
    cells = rows.groupBy("__group", "__part").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    cells.write.parquet(f"{scratch}/cells")
    cells = spark.read.schema(cells.schema).parquet(f"{scratch}/cells")

    sizes = cells.groupBy("__group").agg(F.sum("bytes").alias("bytes"))
    largest = sizes.orderBy(F.desc("bytes"), "__group").limit(n_shards).collect()
    total = cells.agg(F.sum("bytes")).first()[0] or 0
    n_own = own_shards([r["bytes"] for r in largest], total, n_shards)
    own = [r["__group"] for r in largest[:n_own]]

    bucket = F.substring("__group", 1, BUCKET_DIGITS)
    for i, group in enumerate(own):  # first in the order
        bucket = F.when(F.col("__group") == group, F.lit(f"!{i:09d}")).otherwise(bucket)
    cells = cells.withColumn("__bucket", bucket)
    sums = cells.groupBy("__bucket").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # a fixed number of rows
    offsets = sums.select(
        F.col("__bucket").alias("__b"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__rows"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("__bytes"),
    )
    in_bucket = Window.partitionBy("__bucket")
    through_group = in_bucket.orderBy("__group").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before_cell = in_bucket.orderBy("__group", "__part").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.select(
        "*",
        F.sum("bytes").over(through_group).alias("end"),
        F.coalesce(F.sum("n").over(before_cell), F.lit(0)).alias("first_row"),
    )
    placed = placed.join(F.broadcast(offsets), placed["__bucket"] == offsets["__b"]).select(
        "__group",
        "__part",
        (F.col("end") + F.col("__bytes")).alias("end"),
        (F.col("first_row") + F.col("__rows")).alias("first_row"),
    )
    placed.write.parquet(f"{scratch}/placed")
    placed = spark.read.schema(placed.schema).parquet(f"{scratch}/placed")

    cuts = [sum(r["bytes"] for r in largest[: i + 1]) for i in range(n_own)]
    start = cuts[-1] if cuts else 0
    next_largest = largest[n_own]["bytes"] if n_own < len(largest) else 0
    groups = placed.where(F.col("end") > start).select("end").distinct()
    cuts += least_cuts(groups, start, total, next_largest, n_shards - n_own)

    shards = placed.withColumn("shard", _position(F.col("end"), cuts))
    firsts = {r["shard"]: r["f"] for r in shards.groupBy("shard").agg(F.min("first_row").alias("f")).collect()}
    first = F.lit(0).cast("long")
    for number, row in firsts.items():
        first = F.when(F.col("shard") == number, F.lit(row)).otherwise(first)
    shards = shards.select("__group", "__part", "shard", (F.col("first_row") - first).alias("__slot"))
    inside = F.row_number().over(Window.partitionBy("__group", "__part").orderBy("doc_id"))
    return rows.join(shards, ["__group", "__part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("__slot") + inside - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
