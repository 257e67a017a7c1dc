"""Byte-level BPE by backtracking, and back.

Ids are found for each match of a splitting pattern. All vocabulary entries that occur in it come
from one pass of an Aho-Corasick automaton (bytes are mapped to Latin-1 characters, which the
automaton takes); the longest one at each place is tried first. Two adjacent tokens stay if the
merges would leave them apart, which is found by undoing merges on both sides of the seam and is
kept for each pair; if no shorter entry fits either, the last token is taken back. A place that
once failed is not tried again, so the work is linear in the length. Each worker keeps the ids of
words and pieces it has seen, up to a bound.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import as_bytes, broadcast_bytes, file_bytes, map_texts

#: Words or pieces that a worker remembers, and pairs of tokens.
CACHE_WORDS = 200_000
CACHE_PAIRS = 1_000_000
#: White space that keeps a text from being cut at its spaces.
_ODD_SPACE = re.compile(r"[^\S \n]")


def read_ranks(content: bytes) -> dict[bytes, int]:
    """The entries of a rank file: a token in base 64 and its id on each line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


class Bpe:
    """Encoder and decoder for one vocabulary. Ids are ranks: a lower one merges first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: token for token, i in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}  # the longest other entry that a token begins with
        for token, i in ranks.items():
            cuts = (ranks.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self.shorter[i] = next((c for c in cuts if c is not None), None)
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.apart: dict[tuple[int, int], bool] = {}
        for i in sorted(self.tokens):
            self._learn_merge(i)
        self.apart.clear()  # answers given while merges were missing

    def _learn_merge(self, i: int) -> None:
        """Find the two older tokens whose merge makes token ``i``; a byte is made of itself."""
        left, token = self.shorter[i], self.tokens[i]
        while left is not None:
            right = self.ranks.get(token[len(self.tokens[left]) :])
            if right is not None and max(left, right) < i and self._stay_apart(left, right):
                self.merged[left, right] = i
                self.parts[i] = (left, right)
                return
            left = self.shorter[left]
        self.parts[i] = (i, i)

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives these two tokens again.

        The younger of the two at the seam is split, time after time; at each state, a merge over
        the seam would have come first if it is older than what was split last.
        """
        limit = 1 << 32
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < limit:
                return False
            for side in (0, 1) if left > right else (1, 0):
                if side == 0 and self.parts[left][1] != left:
                    limit, left = left, self.parts[left][1]
                    break
                if side == 1 and self.parts[right][0] != right:
                    limit, right = right + 1, self.parts[right][0]
                    break
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        known = self.apart.get((left, right))
        if known is None:
            if len(self.apart) >= CACHE_PAIRS:
                self.apart.clear()
            known = self.apart[left, right] = self._stay_apart(left, right)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        size = len(piece)
        longest = [(0, -1)] * size
        for end, (n, i) in self.automaton.iter(piece.decode("latin-1")):
            start = end - n + 1
            if n > longest[start][0]:
                longest[start] = (n, i)
        usable = bytearray(b"\x01") * (size + 1)
        ids: list[int] = []
        at, token = 0, longest[0][1]
        while at < size:
            while token is not None:
                end = at + len(self.tokens[token])
                if usable[end] and (not ids or self.fits(ids[-1], token)):
                    break
                token = self.shorter[token]
            if token is None:  # nothing fits here: take the last token back and try a shorter one
                usable[at] = 0
                token = ids.pop()
                at -= len(self.tokens[token])
                continue
            ids.append(token)
            at = end
            token = longest[at][1] if at < size else None
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Remembered(dict):
    """Results of a function for short texts that were seen lately.

    When it is full, it starts anew and keeps the former results aside; those that are asked for
    again come back, so what is frequent stays.
    """

    def __init__(self, find: Callable[[str], object], most: int = CACHE_WORDS):
        self.find, self.most, self.former = find, most, {}

    def __missing__(self, text: str):
        found = self.former.get(text)
        if found is None:
            found = self.find(text)
        if len(text) <= 100:
            if len(self) >= self.most:
                self.former = dict(self)
                self.clear()
            self[text] = found
        return found


def words_of(text: str) -> list[str] | None:
    """The text cut at each space, if no piece of the splitting pattern can lie across a cut.

    A piece has white space at its front only, or is all white space. So a single space between
    two other characters begins a piece, and what follows it up to the next one can be split
    apart from the rest. None if some space stands beside other white space or at an end.
    """
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ":
        return None
    return None if _ODD_SPACE.search(text) else text.split(" ")


class TextEncoder:
    """Ids of whole texts, 4 bytes each, lowest byte first."""

    def __init__(self, bpe: Bpe, pattern: str):
        self.bpe, self.splitter = bpe, regex.compile(pattern)
        self.pieces = Remembered(self._piece)
        self.spaced_words = Remembered(lambda word: self._pieces(" " + word))

    def _piece(self, piece: str) -> bytes:
        ids = self.bpe.encode_piece(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.splitter.findall(text)))

    def encode(self, text: str) -> bytes:
        words = words_of(text)
        if words is None:
            return self._pieces(text)
        return self._pieces(words[0]) + b"".join(map(self.spaced_words.__getitem__, words[1:]))


_encoders: dict[str, TextEncoder] = {}


def _encoder(content: bytes, pattern: str) -> TextEncoder:
    """This worker's encoder, made once for each vocabulary and pattern."""
    key = hashlib.sha256(content + pattern.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = TextEncoder(Bpe(read_ranks(content)), pattern)
    return _encoders[key]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = True) -> DataFrame:
    """A row (doc_id, n_tokens, ids, ids_sha256, decoded_sha256) for each document.

    Each match of ``pattern`` is encoded apart, by the ranks in the file; no special tokens. ids
    is null unless ``keep_ids``. Null texts count as empty: no tokens, and the digests of no bytes.
    Null and repeated ids pass through, a row for a row; other columns are left out.
    """
    ranks = broadcast_bytes(docs.sparkSession, file_bytes(ranks_path), ranks_path)

    def work(block: pa.RecordBatch) -> dict:
        encoder = _encoder(ranks.value, pattern)
        bpe, n_tokens, ids_sha, text_sha, kept = encoder.bpe, [], [], [], []
        for text in as_bytes(block.column("text")):
            coded = encoder.encode(text.decode())
            ids = np.frombuffer(coded, "<u4")
            n_tokens.append(len(ids))
            ids_sha.append(hashlib.sha256(coded).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(ids.tolist())).hexdigest())
            kept.append(ids.astype(np.int32) if keep_ids else None)
        return {
            "doc_id": block.column("doc_id"),
            "n_tokens": n_tokens,
            "ids": kept,
            "ids_sha256": ids_sha,
            "decoded_sha256": text_sha,
        }

    schema = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs, ["doc_id", "text"], work, schema)
