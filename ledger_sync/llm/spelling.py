"""Spelling variants: words one edit apart, found by walking a trie level by level.

The trie of all words is a table of edges (node, letter, child), by depth; a node's name is the hash
of its prefix. The frontier is a table of states (word, position, node, edits), and each level joins
it with the edges of its depth: a state without an edit goes on with its own letter, with a later
letter in its place, or with its letter left out; a state with an edit can only go on with its own
letter. States that have used up their word at the end of another one are neighbours. A node has as
many edges as there are letters at most, so a level makes no lists of pairs, whatever words share.

The upper levels, where nearly all paths exist, are never searched: one edit is in one half of a
word, so the frontier starts at the middle of each word, once in the trie of the words and once in
that of the words written backwards. Each pair is met from one side: letters are replaced by later
ones and left out, never put in.

A level is one job, which a word of thousands of letters would ask for thousands of; words longer
than LONGEST are compared by rolling hashes of what is left when each letter is left out, instead.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger_sync.session import scratch_path

from .common import as_bytes, blocks, map_batches

#: Letters of a word that is walked letter by letter.
LONGEST = 64
#: Words that a task counts before it passes them on, and rows of a batch.
HELD_WORDS = 200_000
BATCH_ROWS = 50_000
#: A modulus and a base for rolling hashes.
_PRIME, _BASE = (1 << 61) - 1, 0x1B873593CC9E2D51 % ((1 << 61) - 1)
_STATE = "w string, dir int, pos int, node long"
_ZERO, _ONE, _DONE = 0, 1, 2


def doc_words(text: bytes, doc_id: int | None, min_length: int, typo_every: int | None) -> Counter:
    """Runs of Latin letters with A-Z lowered, and how often each is there; see ``word_counts``."""
    runs = Counter(re.findall(f"[a-zÀ-ÿ]{{{min_length},}}", text.lower().decode()))
    if not typo_every:
        return runs
    begun, counts = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id)), Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), begun)
        if not h % typo_every:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < min_length:
                continue
        counts[run] += n
    return counts


def word_counts(
    docs: DataFrame, min_length: int = 6, min_count: int = 5, typo_every: int | None = None
) -> DataFrame:
    """A row (word, n) for each word of ``min_length`` code points found ``min_count`` times or more.

    A task passes on each word once for every HELD_WORDS words, so a word in all texts is few rows.
    ``typo_every`` plants typos: where it divides the unsigned crc32 h of ``<doc_id>:<run>``, the run
    loses its code point h % length (a null id is written as nothing).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for block in blocks(batches):
            for doc_id, text in zip(block.column("doc_id").to_pylist(), as_bytes(block.column("text"))):
                held.update(doc_words(text, doc_id, min_length, typo_every))
            if len(held) >= HELD_WORDS:
                yield from _counted(held)
                held = Counter()
        yield from _counted(held)

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = map_batches(ids, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def _counted(held: Counter) -> Iterator[pa.RecordBatch]:
    words, counts = list(held), list(held.values())
    for i in range(0, len(words), BATCH_ROWS):
        yield pa.RecordBatch.from_pydict({"word": words[i : i + BATCH_ROWS], "n": counts[i : i + BATCH_ROWS]})


def _written(df: DataFrame, path: str, *by: str) -> DataFrame:
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _prefix(size: Column | str) -> Column:
    """The node of a prefix of ``w``."""
    return F.xxhash64("dir", F.expr(f"substring(w, 1, {size})"))


def _both_ways(words: DataFrame) -> DataFrame:
    """Each word forwards (dir 0) and backwards (dir 1), as ``w``."""
    ways = F.array(F.struct(F.lit(0).alias("dir"), F.col("word").alias("w")),
                   F.struct(F.lit(1).alias("dir"), F.reverse("word").alias("w")))
    return words.select("word", F.inline(ways)).withColumn("size", F.length("w"))


def _edges(ways: DataFrame) -> DataFrame:
    """The lower halves of the tries; ``ends``: a word ends at the child."""
    at = ways.select("*", F.explode(F.sequence(F.expr("size div 2").cast("int"), F.col("size") - 1)).alias("depth"))
    rows = at.select(
        "depth", _prefix("depth").alias("node"), F.expr("substring(w, depth + 1, 1)").alias("c"),
        _prefix("depth + 1").alias("child"), (F.col("depth") + 1 == F.col("size")).alias("ends"),
    )
    return rows.groupBy("depth", "node", "c").agg(F.first("child").alias("child"), F.max("ends").alias("ends"))


def _advance(zero: DataFrame, one: DataFrame, edges: DataFrame) -> DataFrame:
    """The states of the next depth, by kind: without an edit, with one, at the end of a word."""
    own, following, edge = F.expr("substring(w, pos + 1, 1)"), F.expr("substring(w, pos + 2, 1)"), F.col("c")

    def to(steps: int, kind: int) -> Column:
        return F.struct((F.col("pos") + steps).alias("pos"), F.lit(kind).alias("kind"))

    moves = F.array_compact(F.array(
        F.when(edge == own, to(1, _ZERO)),
        F.when(edge > own, to(1, _ONE)),
        F.when((edge == following) & (own != following), to(2, _ONE)),
    ))
    free = zero.join(edges, "node").select("w", "dir", "child", "ends", F.inline(moves))
    bound = one.withColumn("c", own).join(edges, ["node", "c"])
    bound = bound.select("w", "dir", "child", "ends", (F.col("pos") + 1).alias("pos"), F.lit(_ONE).alias("kind"))
    at_end = F.col("pos") == F.length("w")
    moved = free.unionByName(bound).where(~at_end | (F.col("ends") & (F.col("kind") == _ONE))).select(
        "w", "dir", "pos", F.col("child").alias("node"), F.when(at_end, _DONE).otherwise(F.col("kind")).alias("kind")
    )
    last = zero.where(F.col("pos") + 1 == F.length("w")).withColumn("kind", F.lit(_DONE))  # its last letter left out
    return moved.unionByName(last)


def _short_pairs(words: DataFrame, longest: int, root: str) -> DataFrame:
    """Neighbours (word, near), each pair once or twice, among words of LONGEST letters at most."""
    spark = words.sparkSession
    ways = _both_ways(words)
    start = F.expr("IF(dir = 0, size div 2, size - size div 2)").cast("int")
    starts = ways.select("w", "dir", start.alias("pos")).withColumn("node", _prefix("pos"))
    starts = _written(starts.withColumn("depth", F.col("pos")), f"{root}/starts", "depth")
    edges = _written(_edges(ways), f"{root}/edges", "depth")
    begins = starts.agg(F.min("depth")).first()[0]
    if begins is None:
        return spark.createDataFrame([], "word string, near string")
    empty = spark.createDataFrame([], f"{_STATE}, kind int")
    found, states = [], empty
    for depth in range(begins, longest + 1):
        zero = starts.where(F.col("depth") == depth).drop("depth")
        zero = zero.unionByName(states.where(F.col("kind") == _ZERO).drop("kind"))
        one = states.where(F.col("kind") == _ONE).drop("kind")
        here = edges.where(F.col("depth") == depth).drop("depth")
        path = f"{root}/depth-{depth}"
        _advance(zero, one, here).write.partitionBy("kind").parquet(path)
        states = spark.read.schema(empty.schema).parquet(path)
        found.append(path)
    # Every depth in one scan; only the folders of ends are read.
    ends = [spark.read.schema(empty.schema).parquet(path).where(F.col("kind") == _DONE) for path in found]
    ended = ends[0]
    for more in ends[1:]:
        ended = ended.unionByName(more)
    ended = ended.select(F.expr("IF(dir = 0, w, reverse(w))").alias("word"), "node")
    terminals = ways.select(_prefix("size").alias("node"), F.col("word").alias("near"))
    return ended.join(terminals, "node").select("word", "near")


def _hashes(word: str, longest: int) -> Iterator[tuple[int, int, bool]]:
    """The whole word's hash at -1, then what is left without each letter, and whether no later place
    leaves the same; a word of ``longest`` letters is only met whole."""
    heads, powers = [0], [1]
    for c in word:
        heads.append((heads[-1] * _BASE + ord(c)) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)
    size = len(word)
    yield -1, heads[size], True
    if size > longest:
        for p in range(size):
            rest = size - 1 - p
            tail = heads[size] - heads[p + 1] * powers[rest]
            yield p, (heads[p] * powers[rest] + tail) % _PRIME, p + 1 == size or word[p] != word[p + 1]


def _long_pairs(words: DataFrame, root: str) -> DataFrame:
    """Neighbours (word, near) of which one at least has over LONGEST letters.

    Words that are equal but for one letter at one place have the same rest there: as many as there
    are letters. The rows carry hashes of the words, not the words.
    """
    longest = LONGEST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, word in zip(batch.column("key").to_pylist(), batch.column("word").to_pylist()):
                rows = []
                for row in _hashes(word, longest):
                    rows.append((key, *row))
                    if len(rows) == BATCH_ROWS:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["key", "at", "h", "last"])

    keyed = words.where(F.length("word") >= LONGEST).select(F.xxhash64("word").alias("key"), "word")
    keyed = _written(keyed, f"{root}/long-words")
    schema = "key long, at long, h long, last boolean"
    rests = _written(map_batches(keyed, run, schema), f"{root}/rests")
    whole = rests.where("at = -1").select("h", F.col("key").alias("other"))
    without = rests.where("at >= 0")
    same = without.select("at", "h", F.col("key").alias("other"))
    shorter = without.where("last").join(whole, "h").select("key", "other")
    replaced = without.join(same, ["at", "h"]).where("key < other").select("key", "other")
    names = keyed.select(F.col("key").alias("other"), F.col("word").alias("near"))
    pairs = shorter.unionByName(replaced).distinct()
    return pairs.join(keyed, "key").join(names, "other").select("word", "near")


def neighbours(words: DataFrame) -> DataFrame:
    """Rows (word, near) for words that differ by one code point put in, left out or replaced.

    ``words`` has distinct, non-null words in its column ``word``. Each pair comes both ways, once.
    """
    spark, root = words.sparkSession, scratch_path(words.sparkSession, "spelling-pairs")
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0
    pairs = _short_pairs(words.where(F.length("word") <= LONGEST), min(longest, LONGEST), root)
    if longest > LONGEST:
        pairs = pairs.unionByName(_long_pairs(words, root))
    # Nodes are hashes: two prefixes of one hash could only add pairs.
    pairs = pairs.where(F.levenshtein("word", "near", 1) == 1)
    ways = F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))
    return pairs.select(F.inline(ways)).distinct()


def spelling_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Group words (word, n) with the frequent words they may be a misspelling of.

    Columns word, form, root, n, n_near, form_n. form is the near word of largest n (of those, the
    smallest in code-point order) if that n, form_n, is ``ratio`` (2 or more) times the word's or
    more, else both are null. root is where forms lead to from the word, the word itself without a
    form. n_near counts near words. Rows without a word or a count are left out, and rows that repeat
    a word add up; other columns are not looked at. No words give no rows.
    """
    if ratio < 2:
        raise ValueError("a ratio under 2 does not lead anywhere")
    spark, root = words.sparkSession, scratch_path(words.sparkSession, "spelling")
    own = words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    own = _written(own, f"{root}/words")
    counts = own.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    near = neighbours(own).join(counts, "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    has = -F.col("best.less") >= ratio * F.col("n")
    found = own.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n"),
    )
    found = _written(found, f"{root}/forms")
    return found.join(_roots(spark, found, root), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(spark: SparkSession, found: DataFrame, path: str) -> DataFrame:
    """Where forms lead to: each round doubles the steps taken; counts grow with every step, so a
    chain has no circle, and no more steps than a count has digits."""
    roots, rounds = found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), 0
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        further = roots.join(ahead, "root", "left").select(
            "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")
        )
        further = _written(further, f"{path}/roots-{rounds}")
        roots, rounds = further.drop("moved"), rounds + 1
        if further.where("moved").isEmpty():
            return roots
