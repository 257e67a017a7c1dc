"""Small tables with every odd case, and words as the operators take them."""

import random
import re

SPACES = re.compile(r"[\x20\x09-\x0D]+")

_rng = random.Random(5)
LONG = " ".join(_rng.choice("abcdefghij") + _rng.choice("klmnopqrstu") for _ in range(30_000))
PASSAGE = " ".join(f"passage{i % 9}x{i}" for i in range(60))
PROSE = "The quick brown fox, jumps over the lazy dog.\nIt does so again and again, for no reason.\n"

#: Null ids and texts, empty and blank texts, rows that repeat an id or all, ties, long texts, other scripts.
ROWS = [
    (1, PROSE + PASSAGE),
    (2, None),
    (3, ""),
    (4, " \t\n\r\x0b\x0c \n"),
    (None, "A text without an id, " + PROSE),
    (None, None),
    (5, LONG),
    (6, "before " + PASSAGE + " after"),
    (6, "before " + PASSAGE + " after"),
    (6, "another text of the same id\n" + PROSE),
    (7, "ÀÉÎ straße 漢字 🎉 Kelvin İstanbul naïve café end"),
    (8, "word " * 400),
    (9, PROSE + PASSAGE),
    (10, "one"),
    (11, PROSE.upper()),
]

#: Names that operators use for their own columns.
CLASHING = (
    "n_words n_hit items matches contaminated n_lines n_dropped line_id h first_id score predicted "
    "held_out fingerprint component component_id print root node rid rid2 key begin end n_removed "
    "labels n_base fail_bits word_chars shard slot size law n_tokens ids"
).split()


def documents(spark, rows=ROWS, clashing=True):
    names = CLASHING if clashing else []
    schema = ", ".join(["doc_id long", "text string", *[f"`{n}` string" for n in names]])
    return spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], schema)


def empty(spark):
    return documents(spark, [])


def words(text):
    return [w for w in SPACES.split(text or "") if w]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))
