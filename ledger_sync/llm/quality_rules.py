"""Quality rules as a ledger.

Each text is measured once and each rule evaluated once: a bit of one number says whether it failed.
Policies are masks over those bits, so a new version of a policy, or what would change without one of
its rules, is found from the ledger alone. All of it is built-in expressions; measuring shuffles
nothing, and the arrays it needs live for one row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """``fails`` says of the measurements whether a document fails."""

    bit: int
    name: str
    fails: Callable[[], Column]


#: Bits are never reused for another rule.
RULES = (
    Rule(0, "few_words", lambda: F.col("n_words") < 50),
    Rule(1, "repeated_words", lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    Rule(2, "symbols", lambda: 10 * F.col("n_symbols") > 3 * F.col("n_words")),
    Rule(3, "repeated_lines", lambda: 100 * F.col("n_dup_lines") > 30 * F.col("n_lines")),
    Rule(4, "word_length", lambda: ~F.col("word_chars").between(2 * F.col("n_words"), 15 * F.col("n_words"))),
    Rule(5, "capitals", lambda: 2 * F.col("n_capitals") > F.col("word_chars")),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


@dataclass(frozen=True)
class Policy:
    """A version of what counts: a document that fails any of the named rules is not kept."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << r.bit for r in RULES if r.name in self.rules)


BASE = Policy(1, ("few_words", "repeated_words"))
CURRENT = Policy(2, tuple(r.name for r in RULES))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where value is computed once, also if a lambda in ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def _repeat_words(words: Column) -> Column:
    """Words in windows of three that stand twice or more: sort the windows' hashes with their places."""
    window = F.transform(
        words,
        lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )
    whole = F.slice(window, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))

    def places(s: Column) -> Column:
        same = lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])
        return F.array_sort(F.array_compact(F.transform(s, lambda x, j: F.when(same(x, j), x["i"]))))

    covered = F.aggregate(
        _let(F.sort_array(whole), places),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return covered.cast("long")


def _left(text: Column, others: str) -> Column:
    """Characters that are left when all others are taken out."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """All columns and MEASURES, from whole texts (null: none)."""
    names = [c for c in docs.columns if c not in MEASURES]
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = docs.select(*names, _words(text).alias("__words"))
    words = F.col("__words")
    full = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    return kept.select(
        *names,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _left(text, r"[^#*$%&|<>]+").alias("n_symbols"),
        _let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(words).alias("n_repeat_words"),
        F.size(full).cast("long").alias("n_lines"),
        _left(text, r"[^A-Z]+").alias("n_capitals"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """All columns, MEASURES, and fail_bits: bit b is set if the rule with bit b failed.

    Null texts have no words and fail the rules on that; empty ones too. No measure is null, so
    neither is fail_bits. Rows with null or repeated ids are rows of their own. Columns of these
    names are replaced. No documents give no rows.
    """
    measured = measure(docs.drop("fail_bits"))
    bits = [F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(0).cast("long") for rule in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("fail_bits", total)


def passes(policy: Policy) -> Column:
    """Whether a row of the ledger is kept under a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(rows: DataFrame, *policies: Policy) -> DataFrame:
    """A row (rule, version, n_failed, n_failed_alone, n_kept, n_kept_without) for each rule of each policy.

    Rows of the ledger are counted by their bits first, in one pass for all policies: there are at
    most 2 to the number of rules.
    """
    counts = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    own = [(p, r) for p in policies for r in RULES if r.name in p.rules]
    long = lambda n: F.lit(n).cast("long")
    fields = [
        F.struct(F.lit(r.name).alias("rule"), F.lit(p.version).alias("version"), long(p.mask).alias("mask"), long(1 << r.bit).alias("bit"))
        for p, r in own
    ]
    each = counts.select("fail_bits", "n", F.explode(F.array(*fields)).alias("r")).select("fail_bits", "n", "r.*")
    bits = F.col("fail_bits").bitwiseAND(F.col("mask"))
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    alone, kept = bits == F.col("bit"), bits == 0
    return each.groupBy("rule", "version").agg(
        total(bits.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(alone).alias("n_failed_alone"),
        total(kept).alias("n_kept"),
        total(alone | kept).alias("n_kept_without"),
    )
