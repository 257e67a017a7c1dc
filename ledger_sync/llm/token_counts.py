"""Numbers of tokens by a byte-level BPE tokenizer, without shuffling a word.

Texts are cut into words (a space and what follows it) and runs of other white space, which the
tokenizer never joins. Only a text with a special token in it is encoded whole. A first pass counts them task by task and merges only each task's most frequent ones; the lengths of the
most frequent of all go to every worker as a table of a fixed size. In the second pass a word is
looked up there, then among those its worker has met lately; what is left of a block of texts is
encoded in one call.
"""

from __future__ import annotations

import hashlib
import json
import os
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import words_of
from .common import as_bytes, blocks, broadcast_bytes, file_bytes, map_batches, map_texts

#: Words a task reports, words in the table, words a task counts before it drops the rarest.
TASK_WORDS = 1 << 13
TABLE_WORDS = 1 << 16
COUNTED_WORDS = 1 << 18
#: The longest word in the table, and words a worker remembers.
WORD_CHARS = 48
CACHE_WORDS = 1 << 18
CACHE_CHARS = 1 << 25

_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # as the library has them
#: The last of several white space characters goes with what follows, if it is a space, or stands alone.
_PARTS = re.compile(f"[{_SPACES}]+(?![^{_SPACES}])| ?[^{_SPACES}]+|[{_SPACES}]")


def _key(part: str) -> str:
    """How a part is looked up: a word without its space; a space goes before all other parts."""
    return part[1:] if part[0] == " " and not part.isspace() else " " + part


def _part(key: str) -> str:
    return key[1:] if key[0] == " " else " " + key


def cut(text: str) -> tuple[str, list[str]]:
    """What the text begins with, and the keys of the parts that follow; each is encoded apart."""
    words = words_of(text)
    if words is not None:
        return words[0], words[1:]
    return "", list(map(_key, _PARTS.findall(text)))


class _Tokenizer:
    """The library's tokenizer, and which strings it takes for special tokens."""

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(content)
        splits = spec["pre_tokenizer"] or {}
        plain = splits.get("type") == "ByteLevel" and splits.get("use_regex", True)
        if spec["normalizer"] or not plain or splits.get("add_prefix_space"):
            raise ValueError("only byte-level tokenizers without a normalizer or prefix space")
        self.library = Tokenizer.from_str(content.decode())
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [token["content"] for token in spec["added_tokens"]]
        self.latest: dict[str, int] = {}
        self.latest_chars = 0

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.library.encode_batch(texts, add_special_tokens=False)]

    def cut(self, text: str) -> tuple[str, list[str]]:
        """As ``cut``; a text with a special string is left whole."""
        return (text, []) if any(s in text for s in self.special) else cut(text)


_tokenizers: dict[str, _Tokenizer] = {}


def _tokenizer(content: bytes) -> _Tokenizer:
    key = hashlib.sha256(content).hexdigest()
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = _Tokenizer(content)
    return _tokenizers[key]


def frequent_words(docs: DataFrame) -> list[str]:
    """The words that are frequent in the whole corpus, TABLE_WORDS at most, as keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for block in blocks(batches):
            for text in as_bytes(block.column("text")):
                counts.update(cut(text.decode())[1])
            if len(counts) > COUNTED_WORDS:
                counts = Counter(dict(counts.most_common(COUNTED_WORDS // 2)))
        short = ((w, n) for w, n in counts.items() if len(w) <= WORD_CHARS and n > 1)
        top = Counter(dict(short)).most_common(TASK_WORDS)
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array([w for w, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())}
        )

    found = map_batches(docs.select("text"), run, "word string, n long")
    top = found.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(TABLE_WORDS)
    return [row["word"] for row in top.collect()]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int) -> DataFrame:
    """A row (doc_id, n_bytes, n_tokens, over_limit) for each document.

    n_tokens is what the tokenizers library gives for the file without tokens added at the ends;
    special strings in a text are special tokens, as by its default. over_limit: more tokens than
    ``limit``. Null texts count as empty (0 bytes, 0 tokens). Null and repeated ids pass through, a
    row for a row; other columns are left out.
    """
    spark = docs.sparkSession
    content = file_bytes(tokenizer_path)
    tokenizer = broadcast_bytes(spark, content, tokenizer_path)
    words = frequent_words(docs)
    lengths = _tokenizer(content).lengths(list(map(_part, words))) if words else []
    table = spark.sparkContext.broadcast(pickle.dumps(list(zip(words, lengths))))
    known: dict[str, int] = {}  # filled once in each worker

    def work(block: pa.RecordBatch) -> dict:
        own = _tokenizer(tokenizer.value)
        if not known:
            known.update(pickle.loads(table.value) or [("", 1)])
        texts = [t.decode() for t in as_bytes(block.column("text"))]
        heads, keys = zip(*map(own.cut, texts))
        if len(own.latest) > CACHE_WORDS or own.latest_chars > CACHE_CHARS:
            own.latest.clear()
            own.latest_chars = 0
        latest = own.latest
        wanted = [w for w in set().union(*keys) if w not in known and w not in latest]
        latest.update(zip(wanted, own.lengths(list(map(_part, wanted)))))
        own.latest_chars += sum(map(len, wanted))
        totals = own.lengths(list(heads))
        for i, c in enumerate(keys):
            found = list(map(known.get, c, repeat(0)))
            total = sum(found)
            if 0 in found:
                total += sum(latest[w] for w, n in zip(c, found) if not n)
            totals[i] += total
        n_bytes = [len(t.encode()) for t in texts]
        return {
            "doc_id": block.column("doc_id"),
            "n_bytes": n_bytes,
            "n_tokens": totals,
            "over_limit": [n > limit for n in totals],
        }

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return map_texts(docs, ["doc_id", "text"], work, schema)
