"""Spelling variants against a plain search of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from ledger_sync.llm import spelling
from ledger_sync.llm.spelling import neighbours, spelling_variants, word_counts
from tests.llm.helpers import LONG, ROWS, documents, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, min_length=6, min_count=5, typo_every=None):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if typo_every and not h % typo_every:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def are_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(counts, ratio=5):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and are_near(w, v)] for w in counts}
    best = {w: min(vs, key=lambda v: (-counts[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if counts[v] >= ratio * counts[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()}


def rows_of(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@pytest.mark.parametrize(("typo_every", "held"), [(None, 200_000), (3, 2)])
def test_words_are_counted(spark, monkeypatch, typo_every, held):
    monkeypatch.setattr(spelling, "HELD_WORDS", held)
    rows = [*ROWS, *[(20 + i, "Straße STRASSE École×÷ naïveté aaaaaa b1c cafécafé") for i in range(7)], (50, LONG.replace(" ", ""))]
    got = word_counts(documents(spark, rows), 2, 2, typo_every).collect()
    assert len(got) == len({r["word"] for r in got})
    assert {r["word"]: r["n"] for r in got} == counted(rows, 2, 2, typo_every)


def test_runs_that_shrink_below_the_length_are_no_words(spark):
    rows = [(i, "sixlet sevenle") for i in range(40)]
    got = word_counts(documents(spark, rows), 6, 5, typo_every=2).collect()
    assert {r["word"]: r["n"] for r in got} == counted(rows, 6, 5, 2)


def test_variants_of_dense_words(spark):
    """Few letters, so that nearly all words have many neighbours, runs of a letter and long chains."""
    random_ = random.Random(11)
    words = {"".join(random_.choices("aabéz", k=random_.randint(1, 8))) for _ in range(500)}
    words |= {"a" * k for k in range(1, 12)} | {"é" * k for k in range(1, 6)}
    counts = {w: 5 ** random_.randint(0, 9) for w in sorted(words)}
    got = {tuple(r) for r in spelling_variants(rows_of(spark, counts)).collect()}
    assert got == grouped(counts)


def test_variants_about_the_longest_walk(spark, monkeypatch):
    """Words of more letters than are walked are compared by hashes, the same way."""
    monkeypatch.setattr(spelling, "LONGEST", 9)
    random_ = random.Random(3)
    words = set()
    for base in ("abcdefgh", "abcdefghi", "aaaaaaaaaaaa", "abababababab", "xy" * 20):
        words.add(base)
        for _ in range(25):
            at, letter = random_.randrange(len(base)), random_.choice("abé")
            words |= {base[:at] + base[at + 1 :], base[:at] + letter + base[at + 1 :], base[:at] + letter + base[at:]}
    counts = {w: 5 ** random_.randint(0, 9) for w in sorted(words)}
    got = {tuple(r) for r in spelling_variants(rows_of(spark, counts)).collect()}
    assert got == grouped(counts)


def test_very_long_words(spark):
    long = "".join(random.Random(1).choices("abcdefghij", k=60_000))
    counts = {long: 50, long[:30_000] + long[30_001:]: 5, "z" + long[1:]: 7, long[:64]: 9, long[:65]: 90}
    got = {tuple(r) for r in spelling_variants(rows_of(spark, counts)).collect()}
    assert got == grouped(counts)


def test_rows_without_a_word_and_rows_that_repeat_one(spark):
    rows = [("spelling", 3), ("spelling", 3), (None, 9), ("speling", None), ("speling", 1), ("other", 0)]
    words = spark.createDataFrame([(*r, "x", "y") for r in rows], "word string, n long, root string, dir string")
    got = {tuple(r) for r in spelling_variants(words).collect()}
    assert got == {
        ("spelling", None, "spelling", 6, 1, None), ("speling", "spelling", "spelling", 1, 1, 6),
        ("other", None, "other", 0, 0, None),
    }


def test_variants_of_nothing(spark):
    assert spelling_variants(word_counts(empty(spark))).collect() == []
    assert neighbours(rows_of(spark, {"single": 1}).where("n > 0")).collect() == []


def test_words_that_share_a_middle_make_no_lists_of_pairs(spark):
    """A thousand words under one node: states follow its edges, which are as many as letters."""
    stem = "commonstem"
    counts = {stem + a + b + c: 1 for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"}
    pairs = neighbours(rows_of(spark, counts)).collect()
    assert len(pairs) == len(counts) * 27
