"""One registered query for each operator, over the whole documents table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_decode
from .common import table, text_digest
from .decontaminate import decontaminate
from .filter_audit import filter_audit
from .hash_sql import xxh64_sql
from .license_scan import TEMPLATES, license_scan
from .line_dedup import line_dedup
from .quality_classifier import score_quality
from .quality_rules import BASE, CURRENT, ablations, ledger, passes
from .sharding import shard
from .simhash import simhash_groups
from .spelling import spelling_variants, word_counts
from .substring_dedup import substring_dedup
from .token_counts import token_counts
from .toxicity import score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Further queries of an operator, whose rows are not documents.
FURTHER: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
FURTHER_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words of both tables; windows of 10 words (or a whole shorter item) as lists; hit words by place.
_OP1_SQL = f"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS size, list_slice(ws, i, i + least(10, len(ws)) - 1) AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i
        FROM item_words WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, i, size, list_slice(ws, i, i + size - 1) AS w
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM doc_words, sizes WHERE len(ws) >= size)),
hits AS (SELECT doc_id, i, d.size, item_id FROM doc_windows d JOIN item_windows b ON d.w = b.w),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words w ON w.doc_id = d.doc_id LEFT JOIN hit_items i ON i.doc_id = d.doc_id"""


@query(_OP1_SQL)
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(documents(spark, folder), table(spark, folder, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


@query()
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard(documents(spark, folder), n_shards=24)


_OP3_SQL = f"""
WITH lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   '{_UPPER}', '{_LOWER}') AS key
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
shared AS (
  SELECT key, min(doc_id) AS first_id FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT l.doc_id, i, line, first_id IS NOT NULL AND first_id <> l.doc_id AS gone
  FROM lines l LEFT JOIN shared s ON s.key = l.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query(_OP3_SQL)
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup(documents(spark, folder), min_docs=2, min_chars=10)
    return kept.select("doc_id", "n_lines", "n_dropped", text_digest(F.col("text")).alias("kept_sha256"))


# Windows of three words by hash join of their text; the rules as they are in the ledger.
_OP4_MEASURES = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, list_slice(ws, i, i + 2) AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)),
again AS (SELECT doc_id, w FROM windows GROUP BY doc_id, w HAVING count(*) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT windows.doc_id, unnest(range(i, i + 3)) AS p FROM windows JOIN again USING (doc_id, w))
  GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
  FROM d LEFT JOIN repeats r ON r.doc_id = d.doc_id)"""
_OP4_SQL = f"""{_OP4_MEASURES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words
            OR 100 * n_dup_lines > 30 * n_lines OR 2 * n_capitals > word_chars
            OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words) AS kept
FROM m"""


@query(_OP4_SQL)
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = ledger(documents(spark, folder))
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select("doc_id", *measures, (~passes(BASE)).alias("base_failed"), passes(CURRENT).alias("kept"))


def op4_quality_ablations(spark: SparkSession, folder: str) -> DataFrame:
    """What each rule of both policies takes out, from the failure bits of all documents."""
    return ablations(ledger(documents(spark, folder)), BASE, CURRENT)


_OP4_FAILS = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars NOT BETWEEN 2 * n_words AND 15 * n_words",
    "capitals": "2 * n_capitals > word_chars",
}


def _ablations_sql() -> str:
    """Each rule of each policy on its own, counted from the measures."""
    rows = []
    for version, rules in ((1, list(_OP4_FAILS)[:2]), (2, list(_OP4_FAILS))):
        for rule in rules:
            others = " OR ".join(f"({_OP4_FAILS[r]})" for r in rules if r != rule)
            own = f"({_OP4_FAILS[rule]})"
            rows.append(f"""SELECT '{rule}' AS rule, {version} AS version, count(*) FILTER (WHERE {own}) AS n_failed,
       count(*) FILTER (WHERE {own} AND NOT ({others})) AS n_failed_alone,
       count(*) FILTER (WHERE NOT ({own} OR {others})) AS n_kept,
       count(*) FILTER (WHERE NOT ({others})) AS n_kept_without FROM m""")
    return _OP4_MEASURES + "\n" + "\nUNION ALL\n".join(rows)


FURTHER["op4_quality_ablations"] = op4_quality_ablations
FURTHER_ORACLES["op4_quality_ablations"] = _ablations_sql()


@query()
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    scored = score_quality(documents(spark, folder), table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query()
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(documents(spark, folder), tokenizer, limit=1024)


# Majorities bit by bit; fingerprints against each other; what is reachable from each.
_OP7_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT doc_id, array_to_string(list_slice(ws, i, i + 3), ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 0) + 2)) AS i FROM d WHERE len(ws) > 0)),
{xxh64_sql("shingles")},
ones AS (
  SELECT doc_id, bit, 2 * sum(CAST((h >> CAST(bit AS UHUGEINT)) & 1 AS BIGINT)) > count(*) AS most
  FROM (SELECT doc_id, h, unnest(range(64)) AS bit FROM shingles JOIN hashes USING (s)) GROUP BY doc_id, bit),
prints AS (
  SELECT d.doc_id, coalesce(p, 0) AS print
  FROM d LEFT JOIN (SELECT doc_id, CAST(sum(CAST(1 AS HUGEINT) << CAST(bit AS HUGEINT)) AS HUGEINT) AS p
                    FROM ones WHERE most GROUP BY doc_id) o ON o.doc_id = d.doc_id),
single AS (SELECT print, min(doc_id) AS first_id FROM prints GROUP BY print),
links AS (SELECT a.print AS a, b.print AS b FROM single a, single b WHERE bit_count(xor(a.print, b.print)) <= 4),
reach AS (
  SELECT print AS a, print AS b FROM single
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, lower(lpad(hex(CAST(p.print AS UBIGINT)), 16, '0')) AS fingerprint, component_id
FROM prints p JOIN (SELECT a AS print, min(first_id) AS component_id
                    FROM reach JOIN single ON single.print = reach.b GROUP BY a) c ON c.print = p.print"""


@query(_OP7_SQL)
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_groups(documents(spark, folder), shingle=4, max_distance=4)
    return found.select("doc_id", "fingerprint", "component_id")


@query()
def op8_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode_decode(documents(spark, folder), ranks, public_tokenizers.PATTERN, keep_ids=False)
    return coded.drop("ids")


def _op9_sql() -> str:
    """Each template is tried at each word; what is indexed does not change what is found."""
    cases = []
    for t in TEMPLATES:
        key = f"list_slice(ws, i + {t.key_at + 1}, i + {t.key_at + len(t.key_words)}) = {t.key_words}"
        share = " + ".join(f"CASE WHEN ws[i + {j + 1}] = '{w}' THEN 1 ELSE 0 END" for j, w in enumerate(t.words))
        cases.append(
            f"SELECT doc_id, i, '{t.label}' AS label, {str(t.base).upper()} AS base, ({share}) / {len(t.words)}.0 AS share "
            f"FROM places WHERE {key} AND ({share}) / {len(t.words)}.0 >= {t.share}"
        )
    found = "\n  UNION ALL ".join(cases)
    has_key = " OR ".join(f"contains(line, ' {t.key} ')" for t in TEMPLATES)
    return f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
candidates AS (
  SELECT doc_id, ws FROM (SELECT doc_id, ws, ' ' || array_to_string(ws, ' ') || ' ' AS line FROM d)
  WHERE {has_key}),
places AS (SELECT doc_id, ws, unnest(range(len(ws))) AS i FROM candidates),
found AS (
  {found}),
sums AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(i) FILTER (WHERE base) AS first_word,
         max(i) FILTER (WHERE base) AS last_word, max(share) AS score,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(CAST(score AS DOUBLE), 0.0) AS score
FROM d LEFT JOIN sums s ON s.doc_id = d.doc_id"""


@query(_op9_sql())
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(documents(spark, folder)).drop("text")


# Windows are grouped by their words; a word goes if a window that covers it is in a group of two or more.
_OP10_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + 34), ' ')) AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)),
again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows WHERE w IN (SELECT w FROM again)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN removed r ON r.doc_id = d.doc_id"""


@query(_OP10_SQL)
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup(documents(spark, folder), window=35)
    return kept.select("doc_id", "n_words", "n_removed", text_digest(F.col("text")).alias("kept_sha256"))


# Sums for each pattern of failures, held against each step of each order.
_OP11_SQL = """
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
flags AS (
  SELECT doc_id, part, CAST(len(ws) < 50 AS INT)
         + 2 * CAST(100 * len(list_distinct(ws)) < 65 * len(ws) AS INT)
         + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS INT)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
         + 16 * CAST(doc_id > min(doc_id) OVER (PARTITION BY text) AS INT) AS fails FROM words),
patterns AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good,
         count(*) FILTER (WHERE toxic = 1) AS toxic
  FROM flags f LEFT JOIN labels l ON l.doc_id = f.doc_id GROUP BY part, fails),
bits AS (SELECT unnest(range(5)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM bits a, bits b, bits c, bits d, bits e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (
  SELECT array_to_string(list_transform(o, lambda x: substr('ABCDE', x + 1, 1)), '') AS filter_order, s AS step,
         o[s] AS f, CAST(coalesce(list_sum(list_transform(o[1:s - 1], lambda x: 1 << x)), 0) AS BIGINT) AS before
  FROM (SELECT o, unnest(range(1, 6)) AS s FROM orders)),
counts AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN fails & (before | (1 << f)) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails & (1 << f) <> 0 AND fails & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails & (1 << f) <> 0 AND fails & before <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = 1 << f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails & (1 << f) <> 0 AND fails & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails & (1 << f) <> 0 AND fails & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM patterns, steps
  GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counts"""


@query(_OP11_SQL)
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = score_toxicity(documents(spark, folder), table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


# A CRC is the XOR of what each byte adds at its distance from the end, the first four bytes inverted.
# Words are near if the same rest is left without one letter at the same place, or one is such a rest.
_OP13_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n, hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS bytes
  FROM (SELECT doc_id, unnest(regexp_extract_all(
               translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
        FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
single AS (
  SELECT b, format('{{:02X}}', b) AS pair,
         list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS v
  FROM (SELECT unnest(range(256)) AS b)),
shares AS (
  SELECT CAST(0 AS BIGINT) AS distance, b, v FROM single
  UNION ALL
  SELECT distance + 1, s.b, xor(s.v >> 8, t.v) FROM shares s JOIN single t ON t.b = s.v & 255
  WHERE distance < (SELECT max(length(bytes)) // 2 FROM runs)),
bytes AS (
  SELECT doc_id, run, length(bytes) // 2 - 1 - i AS distance, i, substr(bytes, 2 * i + 1, 2) AS pair
  FROM (SELECT doc_id, run, bytes, unnest(range(length(bytes) // 2)) AS i FROM runs)),
hashes AS (
  SELECT doc_id, run, xor(bit_xor(s.v), 4294967295) AS h
  FROM bytes y JOIN single x ON x.pair = y.pair
  JOIN shares s ON s.distance = y.distance AND s.b = CASE WHEN y.i < 4 THEN xor(x.b, 255) ELSE x.b END
  GROUP BY doc_id, run),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 199 = 0 THEN substr(r.run, 1, h % length(r.run)) || substr(r.run, h % length(r.run) + 2)
                  ELSE r.run END AS word
        FROM runs r JOIN hashes h ON h.run = r.run AND h.doc_id IS NOT DISTINCT FROM r.doc_id)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
rests AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near FROM rests a JOIN rests b ON b.i = a.i AND b.rest = a.rest AND b.word <> a.word
  UNION SELECT r.word, w.word FROM rests r JOIN words w ON w.word = r.rest
  UNION SELECT w.word, r.word FROM rests r JOIN words w ON w.word = r.rest),
best AS (
  SELECT near.word, count(*) AS n_near, first(near ORDER BY w.n DESC, near) AS near, max(w.n) AS near_n
  FROM near JOIN words w ON w.word = near.near GROUP BY near.word),
forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
         CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word),
walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT walk.word, form FROM walk JOIN forms ON forms.word = walk.at WHERE form IS NOT NULL)
SELECT forms.word, forms.form, walk.at AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN walk ON walk.word = forms.word JOIN forms ends ON ends.word = walk.at WHERE ends.form IS NULL"""


@query(_OP13_SQL)
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = word_counts(documents(spark, folder), min_length=6, min_count=5, typo_every=199)
    return spelling_variants(words, ratio=5)
