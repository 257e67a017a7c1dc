"""Toxicity scores from a convolutional network over words.

A word is the sum of two hashed embeddings, of itself and of its first letters, which also speak for
words that were never learnt. Filters over one, two and three words in a row are pooled by their
largest answer in the text, and a logistic unit weighs the pools. Every labelled document that is not
held out is learnt from: they are written once as blocks of bounded size, whose bucket counts are summed,
and in each round every block trains copies of FOLDS + 1 networks in numpy, which are averaged, each
embedding over the blocks that have its bucket. The scores that a model gives to the fold it has not seen
set, for each language, the threshold above which a text counts as toxic. The language is told from the
text by its function words. Every document is scored.
"""

from __future__ import annotations

import copy
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger_sync.session import scratch_path

from .common import BROADCAST_BYTES, arrow_schema, as_bytes, blocks, map_batches
from .quality_classifier import is_held_out

#: Rows and words of a block at most; a text of more words is a block of its own.
BLOCK_ROWS = 8_000
BLOCK_WORDS = 4_000_000
#: Rounds of training where there are several blocks, after each of which their networks are averaged.
ROUNDS = 3
#: Rows from which logits are counted by steps of 1 / LOGIT_STEPS, within LARGEST_LOGIT, to set thresholds.
LOGIT_ROWS, LOGIT_STEPS, LARGEST_LOGIT = 100_000, 256, 64
#: Blocks that a task takes in turn where all cores have some, tasks that sum up what blocks have counted
#: or learnt, and rows of a network that go together.
TASK_BLOCKS, TASKS, PART_ROWS = 4, 16, 4_096
#: Bits, for each labelled id and at most, of the filter that lets through ids that may be labelled.
FILTER_BITS, MOST_FILTER_BITS = 16, 1 << 26
#: Score from which a text is toxic.
TOXIC = 0.7
FOLDS = 3
WORD_BUCKETS, PREFIX_BUCKETS, PREFIX = 1 << 17, 1 << 15, 4
DIMENSIONS, FILTERS, WIDTHS = 16, 16, (1, 2, 3)
#: A bucket is learnt if so many texts have it.
LEAST_TEXTS = 3
BATCH_TEXTS, STEPS, LEAST_EPOCHS, MOST_EPOCHS, RATE, DECAY = 32, 600, 3, 24, 0.05, 1e-3
#: Toxic texts of a language that its own threshold needs; others share one.
LEAST_TOXIC = 30
#: Words that are looked at in one go, and letters that are cut into words in one go.
CHUNK_WORDS, SLICE_LETTERS, CACHED_WORDS = 1 << 16, 1 << 20, 500_000
_PAD = WORD_BUCKETS + PREFIX_BUCKETS  # the bucket of nothing, whose embedding stays zero
_GAP = max(WIDTHS) - 1

# Frequent words that belong to one of these languages only.
FUNCTION_WORDS = {
    "en": "the of and to is that it with was for this are by or as",
    "de": "der das und ist nicht ein eine mit von den zu auf für im sich",
    "fr": "le les et des est une dans pour du sur par au qui pas",
    "es": "el los las y una por con para del es como más lo",
}
LANGUAGES = ("", *FUNCTION_WORDS)
_LANGUAGE_OF = {w: i for i, k in enumerate(LANGUAGES) for w in FUNCTION_WORDS.get(k, "").split()}
_WORD = re.compile(r"\w+")
_SPACE = re.compile(r"\s")


class _Codes(dict):
    """A word's buckets and language in one number; forgets all when it has grown to its bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        own = zlib.crc32(word.encode()) % WORD_BUCKETS
        begun = WORD_BUCKETS + zlib.crc32(word[:PREFIX].encode()) % PREFIX_BUCKETS
        code = self[word] = own | begun << 20 | _LANGUAGE_OF.get(word, 0) << 40
        return code


def encode(text: str, codes: _Codes) -> np.ndarray:
    """Codes of a text's words, cut in slices that end at white space where there is any."""
    parts, start = [], 0
    while start < len(text):
        stop = len(text)
        if stop - start > SLICE_LETTERS:
            space = _SPACE.search(text, start + SLICE_LETTERS)
            stop = space.end() if space else stop
        parts.append(np.array([codes[w] for w in _WORD.findall(text[start:stop].lower())], np.int64))
        start = stop
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def language(codes: np.ndarray) -> int:
    """The language with most function words in the text; 0 if there are none."""
    votes = np.bincount(codes >> 40, minlength=len(LANGUAGES))[1:]
    return int(votes.argmax()) + 1 if votes.any() else 0


def buckets(codes: np.ndarray) -> np.ndarray:
    return np.stack([codes & 0xFFFFF, codes >> 20 & 0xFFFFF])


@dataclass
class Network:
    """Embeddings, filters, their biases, the weights of the pools and a bias."""

    embedding: np.ndarray  # (_PAD + 1, DIMENSIONS)
    filters: list[np.ndarray]  # for each width (width, DIMENSIONS, FILTERS)
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float

    def answers(self, words: np.ndarray, width: int) -> np.ndarray:
        """Of each filter of a width at each place that has so many words from it on."""
        k, n = WIDTHS.index(width), len(words) - width + 1
        return sum(words[j : n + j] @ self.filters[k][j] for j in range(width)) + self.biases[k]

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        """Of each text, in chunks of CHUNK_WORDS words however they lie in texts."""
        flat, starts, ends = _laid_out(texts)
        pools = np.zeros((len(texts), len(WIDTHS) * FILTERS), np.float32)
        for begin in range(0, len(flat[0]), CHUNK_WORDS):
            stop = min(begin + CHUNK_WORDS, len(flat[0]))
            own = flat[:, begin : stop + _GAP]
            own = np.pad(own, ((0, 0), (0, stop + _GAP - begin - own.shape[1])), constant_values=_PAD)
            words = self.embedding[own[0]] + self.embedding[own[1]]
            first, last = np.searchsorted(ends, begin, "right"), np.searchsorted(starts, stop, "left")
            inside = np.arange(first, last)
            inside = inside[np.minimum(ends[inside], stop) > np.maximum(starts[inside], begin)]
            if not len(inside):
                continue
            bounds = np.stack([np.maximum(starts[inside], begin), np.minimum(ends[inside], stop)], 1).ravel() - begin
            for k, width in enumerate(WIDTHS):
                found = self.answers(words, width)[: stop - begin]
                cut = bounds if bounds[-1] < len(found) else bounds[:-1]
                largest = np.maximum.reduceat(found, cut)[::2]
                at = slice(k * FILTERS, (k + 1) * FILTERS)
                pools[inside, at] = np.maximum(pools[inside, at], largest)  # a pool is 0 at least
        return pools @ self.weights + self.bias


def _laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all texts one after another with gaps between, where each starts and ends."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + _GAP)[:-1]]).astype(np.int64) if len(texts) else sizes
    flat = np.full((2, int((sizes + _GAP).sum())), _PAD, np.int64)
    for text, start in zip(texts, starts):
        flat[:, start : start + len(text)] = buckets(text)
    return flat, starts, starts + sizes


def tally(texts: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """For each label how many texts have each bucket, and in the place of _PAD how many there are."""
    counts = np.zeros((2, _PAD + 1))
    for text, label in zip(texts, toxic):
        counts[int(label), np.unique(buckets(text))] += 1
        counts[int(label), _PAD] += 1
    return counts


@dataclass
class State:
    """A network in training: which buckets it learns, its rows without and with toxicity, its chance."""

    network: Network
    known: np.ndarray
    rows: np.ndarray
    random: np.random.Generator

    @property
    def epochs(self) -> int:
        return int(np.clip(STEPS * BATCH_TEXTS // max(1, int(self.rows.sum())), LEAST_EPOCHS, MOST_EPOCHS))


def begin(counts: np.ndarray, seed: int = 7) -> State:
    """A network to begin with, from the counts of all texts that it will learn from."""
    random, (n_clean, n_toxic) = np.random.default_rng(seed), counts[:, _PAD].astype(int)
    known = counts.sum(0) >= LEAST_TEXTS
    known[_PAD] = False
    odds = np.log((counts[1] + 1) / (n_toxic + 2)) - np.log((counts[0] + 1) / (n_clean + 2))
    embedding = random.normal(0, 0.05, (_PAD + 1, DIMENSIONS))
    embedding[:, 0] += odds / 4  # where the first filter of each width begins to look
    embedding = np.where(known[:, None], embedding, 0).astype(np.float32)
    net = Network(
        embedding,
        [random.normal(0, 0.3 / np.sqrt(w * DIMENSIONS), (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        random.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32),
        0.0,
    )
    for k in range(len(WIDTHS)):
        net.filters[k][:, 0, 0] += 1 / WIDTHS[k]
        net.weights[k * FILTERS] += 1
    return State(net, known, counts[:, _PAD].copy(), random)


def _largest(net: Network, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text, width and filter the place of the largest answer, and the answer or 0."""
    shape = (len(WIDTHS), len(starts), FILTERS)
    places, pools = np.zeros(shape, np.int64), np.zeros(shape, np.float32)
    if flat.shape[1] <= CHUNK_WORDS:
        words = net.embedding[flat[0]] + net.embedding[flat[1]]
        for k, width in enumerate(WIDTHS):
            found = net.answers(words, width)
            places[k] = np.stack([found[s:e].argmax(0) + s for s, e in zip(starts, ends)])
            pools[k] = found[places[k], np.arange(FILTERS)]
        return places, np.maximum(pools, 0)
    pools -= np.inf
    for i, (start, end) in enumerate(zip(starts, ends)):
        for at in range(start, end, CHUNK_WORDS):
            n = min(CHUNK_WORDS, end - at)
            words = net.embedding[flat[0, at : at + n + _GAP]] + net.embedding[flat[1, at : at + n + _GAP]]
            for k, width in enumerate(WIDTHS):
                found = net.answers(words, width)[:n]
                best = found.argmax(0)
                own = found[best, np.arange(FILTERS)]
                places[k, i] = np.where(own > pools[k, i], best + at, places[k, i])
                pools[k, i] = np.maximum(own, pools[k, i])
    return places, np.maximum(pools, 0)


def learn(state: State, texts: list[np.ndarray], toxic: np.ndarray, epochs: int) -> Network:
    """Train the state's network on texts, which may be some of its rows; each label weighs the same in all."""
    net, known, random, (n_clean, n_toxic) = state.network, state.known, state.random, state.rows
    if not n_toxic or not n_clean:
        return net
    weight = np.where(toxic, 0.5 / n_toxic, 0.5 / n_clean) * (n_clean + n_toxic)
    squares = [np.full(p.shape, 0.1, np.float32) for p in (net.embedding, *net.filters, *net.biases, net.weights)]
    bias_square, n_widths = 0.1, len(WIDTHS)

    def step(parameter: np.ndarray, square: np.ndarray, gradient: np.ndarray, at=slice(None)) -> None:
        square[at] += gradient**2
        parameter[at] -= RATE * gradient / np.sqrt(square[at])

    for _ in range(epochs):
        order = random.permutation(len(texts))
        for first in range(0, len(order), BATCH_TEXTS):
            chosen = [i for i in order[first : first + BATCH_TEXTS] if len(texts[i])]
            if not chosen:
                continue
            flat, starts, ends = _laid_out([texts[i] for i in chosen])
            places, pools = _largest(net, flat, starts, ends)
            pools = pools.swapaxes(0, 1)
            logits = pools.reshape(len(chosen), -1) @ net.weights + net.bias
            error = weight[chosen] * (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - toxic[chosen]) / len(chosen)
            error = error.astype(np.float32)
            back = error[:, None, None] * net.weights.reshape(n_widths, FILTERS) * (pools > 0)
            rows, moves = [], []
            for k, width in enumerate(WIDTHS):
                gradient = np.empty_like(net.filters[k])
                for j in range(width):
                    seen = flat[:, places[k] + j]  # (2, texts, FILTERS)
                    words = net.embedding[seen[0]] + net.embedding[seen[1]]
                    gradient[j] = np.einsum("tfd,tf->df", words, back[:, k])
                    move = back[:, k, :, None] * net.filters[k][j].T
                    for half in seen:
                        rows.append(half.ravel())
                        moves.append(move.reshape(-1, DIMENSIONS))
                step(net.filters[k], squares[1 + k], gradient + DECAY * net.filters[k])
                step(net.biases[k], squares[1 + n_widths + k], back[:, k].sum(0))
            touched, at = np.unique(np.concatenate(rows), return_inverse=True)
            summed = np.zeros((len(touched), DIMENSIONS), np.float32)
            np.add.at(summed, at, np.concatenate(moves))
            learnt = known[touched]
            step(net.embedding, squares[0], summed[learnt], touched[learnt])
            step(net.weights, squares[-1], error @ pools.reshape(len(chosen), -1) + DECAY * net.weights)
            bias_square += float(error.sum()) ** 2
            net.bias -= RATE * float(error.sum()) / bias_square**0.5
    return net


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Network:
    """A network from encoded texts and their labels, where there is one block of them."""
    toxic = labels == 1
    state = begin(tally(texts, toxic), seed)
    return learn(state, texts, toxic, state.epochs)


def threshold(logits: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> float:
    """Between the two neighbouring logits where the F1 of toxic texts is best."""
    order = np.argsort(-logits, kind="stable")
    hits, all_ = np.cumsum((weights * toxic)[order]), np.cumsum(weights[order])
    f1 = 2 * hits / (all_ + (weights * toxic).sum())
    ranked = logits[order]
    last = np.r_[ranked[1:] < ranked[:-1], True]  # ties fall on one side
    best = int(np.where(last, f1, -1).argmax())
    below = ranked[best + 1] if best + 1 < len(ranked) else ranked[best] - 1
    return float((ranked[best] + below) / 2)


@dataclass
class Model:
    network: Network | None  # none without two kinds of labels
    thresholds: np.ndarray  # for each language
    slope: float
    constant: float = 0.5

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """0 to 1; TOXIC or more from the threshold of the text's language on."""
        if self.network is None:
            return np.full(len(texts), self.constant)
        bound = self.thresholds[[language(t) for t in texts]] if texts else np.zeros(0)
        over = self.slope * (self.network.logits(texts).astype(float) - bound)
        score = 1 / (1 + np.exp(-np.clip(over + np.log(TOXIC / (1 - TOXIC)), -30, 30)))
        return np.where(over >= 0, np.maximum(score, TOXIC), np.minimum(score, np.nextafter(TOXIC, 0)))


def _slope(logits: np.ndarray, toxic: np.ndarray, bound: np.ndarray, weights: np.ndarray) -> float:
    """The steepness that makes the scores likeliest, of a few; the sign stays."""
    steps, at = np.geomspace(0.05, 20, 40), np.log(TOXIC / (1 - TOXIC))
    x = np.clip(steps[:, None] * (logits - bound) + at, -30, 30)
    loss = np.logaddexp(0, np.where(toxic, -x, x)) @ weights
    return float(steps[loss.argmin()])


_BITMAP = 1 << 15  # bits of one of Spark's bitmaps
_ENCODED = "doc_id long, language int, n_words int, words binary"
_BLOCKS = "ids binary, labels binary, languages binary, sizes binary, words binary"
_BLOCKS_ARROW = pa.schema([(n, pa.binary()) for n in ("ids", "labels", "languages", "sizes", "words")])


def _packed(codes: np.ndarray) -> bytes:
    """A word's two buckets in 32 bits."""
    return ((codes & 0xFFFFF) | ((codes >> 20 & 0xFFFFF) - WORD_BUCKETS) * WORD_BUCKETS).astype("<u4").tobytes()


def _codes(content: bytes) -> np.ndarray:
    """Codes again, without the language."""
    words = np.frombuffer(content, "<u4").astype(np.int64)
    return words % WORD_BUCKETS | words // WORD_BUCKETS + WORD_BUCKETS << 20


def _write_blocks(docs: DataFrame, labels: DataFrame, path: str) -> tuple[DataFrame, dict[int, int]]:
    """Blocks of all rows to learn from, written; and how many labelled rows there are of each label."""
    spark, most_rows, most_words = docs.sparkSession, BLOCK_ROWS, BLOCK_WORDS
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~is_held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.max("toxic").cast("int").alias("label"))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    n = sum(totals.values())
    parts = 1 if n <= most_rows else -(-n * 10 // (most_rows * 9))  # by ids' hashes a part may have some rows more
    n_bits = min(MOST_FILTER_BITS, max(_BITMAP, 1 << (n * FILTER_BITS).bit_length()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(n_bits)).alias("place")
    known = known.select(F.col("labelled").alias("doc_id"), "label")
    bitmaps = known.select(place).groupBy((F.col("place") / _BITMAP).cast("int").alias("k"))
    bitmaps = bitmaps.agg(F.bitmap_construct_agg(F.col("place") % _BITMAP).alias("bits")).collect()
    bits = np.zeros((n_bits // _BITMAP, _BITMAP // 8), np.uint8)
    for r in bitmaps:
        bits[r["k"]] = np.frombuffer(r["bits"], np.uint8)
    bits = spark.sparkContext.broadcast(bits.ravel())
    rows = docs.where(F.col("doc_id").isNotNull()).where(~is_held_out(F.col("doc_id")))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for block in blocks(batches):
            place = block.column("place").to_numpy()
            block = block.filter(pa.array((bits.value[place >> 3] >> (place & 7) & 1).astype(bool)))
            own = [encode(t.decode(), codes) for t in as_bytes(block.column("text"))]
            columns = [block.column("doc_id"), pa.array([language(c) for c in own], pa.int32()),
                       pa.array([len(c) for c in own], pa.int32()), pa.array([_packed(c) for c in own], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "language", "n_words", "words"])

    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select("*", place)
    rows = map_batches(rows, encoded, _ENCODED)
    # An id's label and its rows meet in a part, the label first. A join might deal them anew, into other parts.
    rows = rows.unionByName(known, allowMissingColumns=True).select("doc_id", "n_words", "words", "label", "language")
    rows = rows.repartition(parts, "doc_id").sortWithinPartitions("doc_id", F.asc_nulls_first("n_words"), "words")

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block() -> pa.RecordBatch:
            ids, sizes, words, label, spoken = zip(*held)
            content = [np.array(x, t).tobytes() for x, t in ((ids, "<i8"), (label, "i1"), (spoken, "i1"), (sizes, "<i8"))]
            columns = [pa.array([x], pa.binary()) for x in (*content, b"".join(words))]
            return pa.RecordBatch.from_arrays(columns, schema=_BLOCKS_ARROW)

        held, n_words, labelled, label = [], 0, None, None
        for batch in batches:
            for doc_id, size, words, own, spoken in zip(*(c.to_pylist() for c in batch.columns)):
                if size is None:
                    labelled, label = doc_id, own
                elif doc_id == labelled:
                    if held and (len(held) == most_rows or n_words + size > most_words):
                        yield block()
                        held, n_words = [], 0
                    held.append((doc_id, size, words, label, spoken))
                    n_words, labelled = n_words + size, None  # of rows that share an id only the shortest
        if held:
            yield block()

    map_batches(rows, gathered, _BLOCKS).write.parquet(path)
    bits.destroy()
    return spark.read.schema(_BLOCKS).parquet(path), totals


def _fold(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(FOLDS)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of each block texts, which are toxic, languages and folds."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, labels, spoken, sizes, words = (c[i].as_py() for c in batch.columns)
            bounds = np.r_[0, np.cumsum(np.frombuffer(sizes, "<i8"))]
            flat, fold = _codes(words), _fold(np.frombuffer(ids, "<i8"))
            texts = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
            yield texts, np.frombuffer(labels, "i1") == 1, np.frombuffer(spoken, "i1"), fold


#: Rows of some tables: each a mean and what it weighs; whole parts of a table go together.
_MEANS = "name int, part int, places binary, means binary, weights binary"
_MEANS_ARROW = pa.schema([("name", pa.int32()), ("part", pa.int32()),
                          *((n, pa.binary()) for n in ("places", "means", "weights"))])


class _Means:
    """Running means of the rows of tables."""

    def __init__(self, rows: int, width: int):
        self.rows, self.width, self.sums = rows, width, {}

    def add(self, name: int, places: np.ndarray, means: np.ndarray, weights: np.ndarray | float) -> None:
        """Places are each there once."""
        if name not in self.sums:
            self.sums[name] = np.zeros((self.rows, self.width)), np.zeros(self.rows)
        sums, weighed = self.sums[name]
        weights = np.broadcast_to(weights, len(places))
        sums[places] += means * weights[:, None].astype(float)
        weighed[places] += weights

    def batches(self) -> Iterator[pa.RecordBatch]:
        for name, (sums, weighed) in self.sums.items():
            for part in range(-(-self.rows // PART_ROWS)):
                places = np.flatnonzero(weighed[part * PART_ROWS : (part + 1) * PART_ROWS]) + part * PART_ROWS
                if not len(places):
                    continue
                means = (sums[places] / weighed[places, None]).astype("<f4")
                row = [name, part, places.astype("<i4").tobytes(), means.tobytes(), weighed[places].tobytes()]
                yield pa.RecordBatch.from_pylist([dict(zip(_MEANS_ARROW.names, row))], _MEANS_ARROW)


def _averaged(found: DataFrame, rows: int, width: int) -> Iterator[tuple]:
    """The means of all tasks' means, a part of a table in one task: names, places, means and weights."""

    def read(row: dict) -> tuple:
        places, weights = np.frombuffer(row["places"], "<i4"), np.frombuffer(row["weights"], "<f8")
        return row["name"], places, np.frombuffer(row["means"], "<f4").reshape(len(places), width), weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means = _Means(rows, width)
        for batch in batches:
            for row in batch.to_pylist():
                means.add(*read(row))
        yield from means.batches()

    parts = map_batches(found.repartition(TASKS, "name", "part"), run, _MEANS).toLocalIterator()
    return (read(row.asDict()) for row in parts)


def _tallied(rows: DataFrame) -> np.ndarray:
    """The tally of each fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, 2, _PAD + 1))
        for texts, toxic, _, fold in _unpacked(batches):
            for k in range(FOLDS):
                own = np.flatnonzero(fold == k)
                total[k] += tally([texts[i] for i in own], toxic[own])
        counts = _Means(_PAD + 1, 0)  # no means: the weights are the counts
        for name, own in enumerate(total.reshape(2 * FOLDS, -1)):
            places = np.flatnonzero(own)
            counts.add(name, places, np.zeros((len(places), 0)), own[places])
        yield from counts.batches()

    total = np.zeros((2 * FOLDS, _PAD + 1))
    for name, places, _, counts in _averaged(map_batches(rows, run, _MEANS), _PAD + 1, 0):
        total[name, places] = counts
    return total.reshape(FOLDS, 2, _PAD + 1)


_OTHERS = -(-(FILTERS * DIMENSIONS * sum(WIDTHS) + 2 * FILTERS * len(WIDTHS) + 1) // DIMENSIONS)


def _values(net: Network) -> np.ndarray:
    """The embeddings and, in _OTHERS rows more, all else."""
    flat = np.concatenate([*(p.ravel() for p in (*net.filters, *net.biases, net.weights)), np.float32([net.bias])])
    others = np.pad(flat, (0, _OTHERS * DIMENSIONS - len(flat))).reshape(_OTHERS, DIMENSIONS)
    return np.concatenate([net.embedding, others])


def _network(values: np.ndarray) -> Network:
    flat, at = values.ravel(), 0

    def take(*shape: int) -> np.ndarray:
        nonlocal at
        size = int(np.prod(shape))
        at += size
        return flat[at - size : at].reshape(shape)

    return Network(take(_PAD + 1, DIMENSIONS), [take(w, DIMENSIONS, FILTERS) for w in WIDTHS],
                   [take(FILTERS) for _ in WIDTHS], take(len(WIDTHS) * FILTERS), float(take(1)[0]))


def _round(rows: DataFrame, states: list[State], epochs: list[int]) -> None:
    """Train each state on its rows of each block, from where it is; then let it be the blocks' average."""
    context, n_rows = rows.sparkSession.sparkContext, _PAD + 1 + _OTHERS
    begun = [context.broadcast(s) for s in states]
    tables = [_values(s.network) for s in states]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means = _Means(n_rows, DIMENSIONS)
        for texts, toxic, _, fold in _unpacked(batches):
            for k, shared in enumerate(begun):
                own = np.flatnonzero(fold != k)  # the last one sees all rows
                if not len(own):
                    continue
                values = _values(shared.value.network)
                state = State(_network(values.copy()), shared.value.known, shared.value.rows, copy.deepcopy(shared.value.random))
                learnt = _values(learn(state, [texts[i] for i in own], toxic[own], epochs[k]))
                moved = (learnt != values).any(1)
                moved[_PAD + 1 :] = True
                means.add(k, np.flatnonzero(moved), learnt[moved], float(len(own)))
        yield from means.batches()

    for k, places, means, _ in _averaged(map_batches(rows, run, _MEANS), n_rows, DIMENSIONS):
        tables[k][places] = means
    for state, values in zip(states, tables):
        state.network = _network(values)
    for shared in begun:
        shared.destroy()


_LOGITS = "logit double, label int, language int"


def _unseen_logits(rows: DataFrame, networks: list[Network], path: str) -> tuple[np.ndarray, ...]:
    """Logits of all rows by the network that has not seen them, labels, languages and how many rows have these."""
    shared = [rows.sparkSession.sparkContext.broadcast(n) for n in networks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, toxic, spoken, fold in _unpacked(batches):
            for k in range(FOLDS):
                own = np.flatnonzero(fold == k)
                logits = shared[k].value.logits([texts[i] for i in own]).astype(float)
                columns = [pa.array(logits), pa.array(toxic[own].astype(np.int32)), pa.array(spoken[own].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["logit", "label", "language"])

    map_batches(rows, run, _LOGITS).write.parquet(path)
    scored = rows.sparkSession.read.schema(_LOGITS).parquet(path)
    if scored.count() > LOGIT_ROWS:
        step = F.round(F.col("logit") * LOGIT_STEPS) / LOGIT_STEPS
        scored = scored.withColumn("logit", F.greatest(F.least(step, F.lit(float(LARGEST_LOGIT))), F.lit(-float(LARGEST_LOGIT))))
    counts = scored.groupBy("logit", "label", "language").count().orderBy("logit", "label", "language").collect()
    for s in shared:
        s.destroy()
    return tuple(np.array([r[c] for r in counts]) for c in ("logit", "label", "language", "count"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled documents that are not held out (see ``is_held_out``)."""
    flat, path = np.zeros(len(LANGUAGES)), scratch_path(docs.sparkSession, "toxicity")
    rows, totals = _write_blocks(docs, labels, f"{path}/blocks")
    n_blocks, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    rows = rows.coalesce(max(1, min(n_blocks, cores), n_blocks // TASK_BLOCKS))
    tallies = _tallied(rows)
    found = tallies[:, :, _PAD].sum(0)
    if not found.all():
        return Model(None, flat, 1.0, 0.5 if not found.any() else float(found[1] > 0))
    states = [begin(tallies.sum(0) - (tallies[k] if k < FOLDS else 0)) for k in range(FOLDS + 1)]
    rounds = 1 if n_blocks == 1 else ROUNDS
    for k in range(rounds):
        _round(rows, states, [max(1, s.epochs // rounds) for s in states])
        for state in states:
            state.random = np.random.default_rng([7, k])
    *others, network = [s.network for s in states]
    logits, toxic, spoken, counts = _unseen_logits(rows, others, f"{path}/logits")
    toxic, spoken = toxic == 1, spoken.astype(int)
    # Labelled rows without a document count as those that have one.
    weights = counts * np.where(toxic, totals[1] / found[1], totals[0] / found[0])
    bounds = np.full(len(LANGUAGES), threshold(logits, toxic, weights))
    for k in range(len(LANGUAGES)):
        own = spoken == k
        if counts[toxic & own].sum() >= LEAST_TOXIC and (~toxic & own).any():
            bounds[k] = threshold(logits[own], toxic[own], weights[own])
    return Model(network, bounds, _slope(logits, toxic, bounds[spoken], weights))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of the documents and held_out, score, predicted.

    score: how likely label toxic = 1 is (0 to 1), from the text alone; predicted: 1 if it is TOXIC or
    more. held_out: the id's rows are never learnt from (false for a null id, which has no label either).
    Null texts count as empty; those are scored like any other. An id that is labelled more than once
    counts as toxic if any label says so; of documents that share an id, one is learnt from. With no
    usable labels all scores are 0.5, with labels of one kind that label. Columns of these names are
    replaced. No documents give no rows.
    """
    kept = docs.drop("held_out", "score", "predicted")
    fitted = fit(docs, labels)
    if fitted.network is not None and fitted.network.embedding.nbytes > BROADCAST_BYTES:
        raise ValueError("the embeddings are too large to be broadcast")
    model = docs.sparkSession.sparkContext.broadcast(fitted)
    schema = T.StructType(kept.schema.fields + T.StructType.fromDDL("score double").fields)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for block in blocks(batches):
            texts = [encode(t.decode(), codes) for t in as_bytes(block.column("text"))]
            columns = [*block.columns, pa.array(model.value.score(texts))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return map_batches(kept, run, schema).select(
        *kept.columns,
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"),
    )
