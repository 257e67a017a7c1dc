"""Registered queries against their SQL on the same tables."""

from pathlib import Path

import duckdb
import pytest
import xxhash

from ledger_sync.llm.hash_sql import xxh64_sql
from ledger_sync.llm.queries import FURTHER, FURTHER_ORACLES, ORACLES, QUERIES
from tests.llm.test_spelling import counted, grouped

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def values(columns, rows):
    order = sorted(columns)
    return sorted(repr([row[columns.index(c)] for c in order]) for row in rows)


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert ORACLES.keys() <= QUERIES.keys() and FURTHER_ORACLES.keys() <= FURTHER.keys()


@pytest.mark.parametrize("name", sorted({**ORACLES, **FURTHER_ORACLES}))
def test_query_equals_sql(spark, duck, name):
    df = {**QUERIES, **FURTHER}[name](spark, DATA)
    result = duck.execute({**ORACLES, **FURTHER_ORACLES}[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert values(df.columns, df.collect()) == values(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_every_document_has_its_row(spark, name):
    docs = sorted(r[0] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect())
    assert sorted(r["doc_id"] for r in QUERIES[name](spark, DATA).collect()) == docs


def test_ablations_run_over_all_documents(spark):
    from __spark_entry__ import queries

    kept = QUERIES["op4_quality_rules"](spark, DATA).select("base_failed", "kept").collect()
    got = {(r["version"], r["rule"]): r for r in queries()["op4_quality_ablations"](spark, DATA).collect()}
    assert len(got) == 8
    for version, n in ((1, sum(not r["base_failed"] for r in kept)), (2, sum(r["kept"] for r in kept))):
        own = [r for (v, _), r in got.items() if v == version]
        assert {r["n_kept"] for r in own} == {n}
        assert all(r["n_kept_without"] == n + r["n_failed_alone"] and r["n_failed"] >= r["n_failed_alone"] for r in own)
        assert sum(r["n_failed_alone"] for r in own) <= len(kept) - n <= sum(r["n_failed"] for r in own)


def test_variants_are_those_of_a_plain_search(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in QUERIES["op13_spelling_variants"](spark, DATA).collect()}
    assert got == grouped(counted([tuple(r) for r in docs], typo_every=199))


def test_the_hash_in_sql_is_the_library_s(duck):
    """Every length about whole stripes, and bytes of all values a text has."""
    texts = ["é漢🎉z\x00\x7f"[: n % 7] + "abcdefghij" * 12 for n in range(7)]
    texts = sorted({t[:n] for t in texts for n in range(len(t))})
    duck.execute("CREATE TABLE texts AS SELECT unnest(?) AS s", [texts])
    got = dict(duck.execute(f"WITH {xxh64_sql('texts')} SELECT s, h FROM hashes").fetchall())
    assert got == {t: xxhash.xxh64_intdigest(t.encode(), 42) for t in texts}
