"""Licences that texts name or quote.

Templates are short runs of words with a key phrase that has to be there. The words of all key
phrases are counted over the corpus, and each template is indexed under the rarest word of its key
phrase, with that word's place. A text is scanned once for those few words; where one stands, the
templates listed under it are laid so that both words meet, and only then are the other words
compared by place and the key phrase verified. All of it is built-in expressions; what is shuffled
is a count for each word.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``key`` has to stand word for word; of all words, ``share`` have to be in place."""

    label: str
    text: str
    key: str
    share: float = 0.8
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        n = len(self.key_words)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.key_words)


def phrase(label: str, text: str) -> Template:
    return Template(label, text, text, 1.0, True)


BASE_PHRASES = (
    phrase("mit", "under the mit license"),
    phrase("apache-2", "apache license version 2"),
    phrase("cc-by-nc", "cc by nc"),
)
TEMPLATES = BASE_PHRASES + (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "permission is hereby granted free of charge",
    ),
    Template(
        "apache-2",
        "you may not use this file except in compliance with the license",
        "except in compliance with the license",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistribution and use in source and binary forms",
    ),
    Template(
        "gpl",
        "redistribute it and or modify it under the terms of the gnu general public license",
        "gnu general public license",
    ),
    Template(
        "lgpl",
        "modify it under the terms of the gnu lesser general public license",
        "gnu lesser general public license",
    ),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license",
        "mozilla public license",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose",
        "and or distribute this software for any purpose",
    ),
    Template(
        "cc0",
        "the person who associated a work with this deed has dedicated the work to the public domain",
        "has dedicated the work to the public domain",
    ),
    Template(
        "cc-by-sa",
        "this work is licensed under a creative commons attribution sharealike",
        "creative commons attribution sharealike",
    ),
)


def words(text: Column) -> Column:
    """Runs of ASCII letters and digits and of other characters; A-Z are lower-cased.

    The two letters beyond ASCII whose lower case has an ASCII letter are exchanged for another one
    beforehand, so that lower() touches no other word that is compared.
    """
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), "[Kİ]", "é")
    return F.array_remove(F.split(F.lower(plain), NOT_WORD), "")


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many texts each word of a small vocabulary is; those that are in none are left out."""
    found = F.array_distinct(F.filter(words(F.col("text")), lambda w: w.isin(vocabulary)))
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return {r["word"]: r["n"] for r in counts.collect()}


def _matches(tokens: Column, anchors: Column, template: Template, anchor: int) -> Column:
    """Structs (start, share, label, base) where a template lies, by the places of its anchor word."""
    own, key, at = template.words, template.key_words, template.key_at
    literal = F.array(*map(F.lit, own))
    starts = F.transform(
        F.filter(anchors, lambda p: F.get(tokens, p) == own[anchor]), lambda p: p - F.lit(anchor)
    )
    verified = F.filter(
        starts,
        lambda s: (s + at >= 0) & (F.slice(tokens, F.greatest(s + at + 1, F.lit(1)), len(key)) == F.array(*map(F.lit, key))),
    )
    in_place = lambda s: F.size(F.filter(F.transform(literal, lambda w, j: F.get(tokens, s + j) == w), lambda x: x))
    label, base = F.lit(template.label).alias("label"), F.lit(template.base).alias("base")
    scored = F.transform(
        verified, lambda s: F.struct(s.alias("start"), (in_place(s) / F.lit(len(own))).alias("share"), label, base)
    )
    return F.filter(scored, lambda m: m["share"] >= template.share)


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """All columns and n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base templates are phrases: n_base counts their places, first_word and last_word are the smallest
    and the largest start (null without one), base_labels their labels. labels: those of all templates
    that were found, distinct and sorted, as base_labels are; score: the largest share of a found
    template's words that are in place, 0 without one. Null and empty texts have no words. Rows with
    null or repeated ids are rows of their own; columns of these names are replaced.
    """
    added = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    names = [c for c in docs.columns if c not in added]
    vocabulary = sorted({w for t in templates for w in t.key_words})
    counts = document_frequencies(docs, vocabulary)

    def rarest(t: Template) -> int:
        return t.key_at + min(range(len(t.key_words)), key=lambda i: (counts.get(t.key_words[i], 0), i))

    anchors = [rarest(t) for t in templates]
    keys = sorted({t.words[a] for t, a in zip(templates, anchors)})
    tokens, places = F.col("__words"), F.col("__anchors")
    cut = docs.select(*names, words(F.col("text")).alias("__words"))
    at = F.array_compact(F.transform(tokens, lambda w, i: F.when(w.isin(keys), i)))
    cut = cut.select(*names, "__words", at.alias("__anchors"))
    found = [_matches(tokens, places, t, a) for t, a in zip(templates, anchors)]
    kind = "array<struct<start:int,share:double,label:string,base:boolean>>"
    any_found = F.when(F.size(places) > 0, reduce(F.concat, found)).otherwise(F.array().cast(kind))
    cut = cut.select(*names, F.size(tokens).cast("long").alias("n_words"), any_found.cast(kind).alias("__found"))
    matches = F.col("__found")
    base = F.filter(matches, lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    label_text = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    return cut.select(
        *names,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        label_text(base).alias("base_labels"),
        label_text(matches).alias("labels"),
        F.coalesce(F.array_max(F.transform(matches, lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )
