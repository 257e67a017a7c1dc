"""Operators that look at one text at a time, against the libraries or plain Python."""

import base64
import hashlib
import random
import re
import struct

import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from ledger_sync.llm import bpe, license_scan, quality_rules, token_counts
from tests.llm.helpers import ROWS, documents, empty, order, words

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def coder():
    with open(RANKS, "rb") as file:
        return bpe.TextEncoder(bpe.Bpe(bpe.read_ranks(file.read())), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    pattern = public_tokenizers.PATTERN
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _random_texts(n):
    rng = random.Random(1)
    parts = ["a", "e", " ", "  ", "the", "tion", "é", "漢", "🎉", "0", "12", "\n", " \n", "\t", "ß", "'s"]
    parts += ["'ll", "!!", "́", "x" * 40, "ab" * 30, " ", "\x1c", "<|endoftext|>", "क"]
    for _ in range(n):
        yield "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))


def test_bpe_is_that_of_the_library(coder, library):
    for text in [*_random_texts(4000), *(t or "" for _, t in ROWS)]:
        ids = struct.unpack(f"<{len(coded := coder.encode(text)) // 4}I", coded)
        assert list(ids) == library.encode_ordinary(text), text
        assert coder.bpe.decode(list(ids)) == text.encode()


def test_bpe_of_a_piece_is_linear(coder):
    for piece in (b"a" * 100_000, b"ab!x" * 30_000):
        assert coder.bpe.decode(coder.bpe.encode_piece(piece)) == piece


def test_words_are_cut_where_no_piece_is(coder):
    splitter = regex.compile(public_tokenizers.PATTERN)
    for text in _random_texts(4000):
        if cut := bpe.words_of(text):
            parts = [cut[0], *[" " + w for w in cut[1:]]]
            assert [p for part in parts for p in splitter.findall(part)] == splitter.findall(text)


def test_remembered_keeps_what_is_asked_for_again():
    asked = []
    cache = bpe.Remembered(lambda t: asked.append(t) or t, most=3)
    for text in ("a", "b", "a", "c", "a", "d", "a", "e", "a", "f", "g", "a"):
        assert cache[text] == text
    assert asked.count("a") == 1 and len(cache) <= 3


def test_encode_decode_rows(spark, library):
    coded = bpe.encode_decode(documents(spark), RANKS, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    want = []
    for doc_id, text in ROWS:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        want.append((doc_id, len(ids), ids, digest, hashlib.sha256((text or "").encode()).hexdigest()))
    key = lambda r: (r[0] or -1, r[3])
    assert sorted(map(tuple, coded.collect()), key=key) == sorted(want, key=key)
    assert bpe.encode_decode(empty(spark), RANKS, public_tokenizers.PATTERN).collect() == []


def test_token_counts(spark, monkeypatch):
    rows = [*ROWS, *((100 + i, t) for i, t in enumerate(_random_texts(200)))]
    tokenizer = Tokenizer.from_file(JSON)
    want = []
    for doc_id, text in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 50))
    docs = documents(spark, rows)
    assert order(map(tuple, token_counts.token_counts(docs, JSON, 50).collect())) == order(want)
    monkeypatch.setattr(token_counts, "TABLE_WORDS", 3)  # most words are found in a worker's cache
    assert order(map(tuple, token_counts.token_counts(docs, JSON, 50).collect())) == order(want)
    assert token_counts.token_counts(empty(spark), JSON, 50).collect() == []


def test_frequent_words_cover_the_corpus(spark):
    found = token_counts.frequent_words(documents(spark, [(1, "a b b c c c"), (2, "a b b z"), (3, None)]))
    assert found == ["b", "c"]


def test_frequent_words_may_hold_nul(spark):
    rows = [(i, "the a\x00b internationalization a\x00b \x00 internationalization unquestionably \x00 x") for i in range(9)]
    tokenizer = Tokenizer.from_file(JSON)
    want = [(i, len(t), len(tokenizer.encode(t, add_special_tokens=False).ids)) for i, t in rows]
    docs = documents(spark, rows).coalesce(1)
    assert "a\x00b" in token_counts.frequent_words(docs)
    assert order(tuple(r)[:3] for r in token_counts.token_counts(docs, JSON, 50).collect()) == want


def test_texts_with_odd_white_space_are_cut(spark):
    tokenizer = Tokenizer.from_file(JSON)
    n = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    rng, spaces = random.Random(3), [chr(c) for c in (*range(9, 14), 0x85, 0xA0, 0x2003, 0x3000)]
    made = ["".join(rng.choice([*spaces, " ", " ", "\n", "ab", "c's", "!", "\x1c"]) for _ in range(30)) for _ in range(500)]
    for text in [t for t in [*_random_texts(2000), *made, " ", "  a", "a  ", "a \n"] if "<|" not in t]:
        head, keys = token_counts.cut(text)
        parts = [head, *map(token_counts._part, keys)]
        assert "".join(parts) == text and sum(map(n, parts)) == n(text), text
        assert not any(p.strip(" ").count("\t") and p.strip() for p in parts)
    found = token_counts.frequent_words(documents(spark, [(1, "if  x:\n\treturn  x"), (2, "\treturn  x  ")]).coalesce(1))
    assert {"x", " return"} <= set(found)


def _measures(text):
    text, ws = text or "", words(text)
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered), len(lines), len(re.findall("[A-Z]", text)),
    )


def test_quality_measures_and_bits(spark):
    rng = random.Random(2)
    made = [" ".join(rng.choice("ab#") + rng.choice(" \n") for _ in range(rng.randrange(200))) for _ in range(40)]
    rows = [r for r in ROWS if r[0] != 5] + [(100 + i, t) for i, t in enumerate(made)]
    ledger = quality_rules.ledger(documents(spark, rows)).collect()
    got = [(r["doc_id"], *(r[m] for m in quality_rules.MEASURES)) for r in ledger]
    assert order(got) == order((d, *_measures(t)) for d, t in rows)
    for r in ledger:
        n = r["n_words"]
        bits = [
            n < 50, 100 * r["n_repeat_words"] > 50 * n, 10 * r["n_symbols"] > 3 * n,
            100 * r["n_dup_lines"] > 30 * r["n_lines"], not 2 * n <= r["word_chars"] <= 15 * n,
            2 * r["n_capitals"] > r["word_chars"],
        ]
        assert r["fail_bits"] == sum(1 << i for i, b in enumerate(bits) if b)
    assert quality_rules.ledger(empty(spark)).collect() == []
    long = quality_rules.ledger(documents(spark, [(5, dict(ROWS)[5])])).first()
    assert long["n_words"] == 30_000 and long["n_dup_lines"] == 0 and long["n_repeat_words"] > 0


def test_quality_ablations(spark):
    rows = [(i, "a b c" if i % 3 else "# " * 60 + " ".join(f"w{j}" for j in range(i % 5 * 30))) for i in range(60)]
    ledger = quality_rules.ledger(documents(spark, rows))
    bits = [r["fail_bits"] for r in ledger.collect()]
    for policy in (quality_rules.BASE, quality_rules.CURRENT):
        got = {r["rule"]: r.asDict() for r in quality_rules.ablations(ledger, policy).collect()}
        assert set(got) == set(policy.rules)
        for rule in quality_rules.RULES:
            if rule.name not in policy.rules:
                continue
            masked, bit = [b & policy.mask for b in bits], 1 << rule.bit
            kept = masked.count(0)
            assert got[rule.name] == {
                "rule": rule.name, "version": policy.version,
                "n_failed": sum(b & bit != 0 for b in masked), "n_failed_alone": masked.count(bit),
                "n_kept": kept, "n_kept_without": kept + masked.count(bit),
            }


def test_quality_rules_stay_in_the_jvm(spark):
    plan = quality_rules.ledger(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


MIT = license_scan.TEMPLATES[3].text


def test_licences(spark):
    rows = [
        *ROWS,
        (20, "Under the MIT License. x, under-the mit LICENSE"),
        (21, "apache license, version 2.0 and CC BY-NC 4.0"),
        (22, f"Copyright. {MIT.title()} and so on"),
        (23, MIT.replace("copy", "klop").replace("person", "user")),  # 14 of 16 in place
        (24, MIT.replace("hereby", "never")),  # the key phrase is missing
        (25, "under the mit licenses, undere the mit license under the mit"),
        (26, "under the mit license " * 300),
        (28, "cc by nc and \u212acc by nc"),  # the Kelvin sign is no k, and part of a word
    ]
    got = {}
    for r in license_scan.license_scan(documents(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    pick = lambda i: tuple(got[i][0][c] for c in ("n_base", "first_word", "last_word", "base_labels", "labels"))
    assert pick(20) == (2, 0, 5, "mit", "mit")
    assert pick(21) == (2, 0, 6, "apache-2,cc-by-nc", "apache-2,cc-by-nc")
    assert pick(22) == (0, None, None, "", "mit") and got[22][0]["score"] == 1.0
    assert pick(23) == (0, None, None, "", "mit") and got[23][0]["score"] == 14 / 16
    assert pick(24) == (0, None, None, "", "")
    assert pick(25) == (0, None, None, "", "")
    assert pick(26) == (300, 0, 1196, "mit", "mit")
    assert pick(28)[0] == 1
    for i, text in rows:
        if i is not None and i != 6:
            lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
            assert got[i][0]["n_words"] == len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower))
    assert len(got[6]) == 3 and len(got[None]) == 2
    assert license_scan.license_scan(empty(spark)).collect() == []


def test_licence_scan_stays_in_the_jvm(spark):
    plan = license_scan.license_scan(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
