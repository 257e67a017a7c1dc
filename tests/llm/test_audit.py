"""Filter audits, spelling variants and toxicity against plain models of what they promise."""

from collections import Counter
from itertools import permutations

import pytest

from ledger_sync.llm import filter_audit as audit
from tests.llm.helpers import ROWS, words

LABELS = [(1, 1, 0), (1, 0, 1), (6, 1, 1), (8, 0, 1), (None, 1, 1), (10, None, None), (99, 1, 1)]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def with_sources(spark, rows, sources=("a", "b", None, "")):
    schema = "doc_id long, text string, source string, row long, part string, good string, filters string, h string"
    dealt = [(*r, sources[i % len(sources)], i, "x", "y", "z", "h") for i, r in enumerate(rows)]
    return spark.createDataFrame(dealt, schema), [(i, t or "", s or "") for i, t, s, *_ in dealt]


def failing(rows, text, doc_id):
    own = words(text)
    capitals, points = sum("A" <= c <= "Z" for c in text), len(text)
    id_of = [i for i, t, _ in rows if t == text and i is not None]
    return {
        "A": len(own) < 50,
        "B": 100 * len(set(own)) < 65 * len(own),
        "C": 100 * capitals > 5 * points,
        "D": any(c in "#$%&*|" for c in text),
        "E": any(doc_id is None or i < doc_id for i in id_of),
    }


def audited(rows, marks):
    """All orders, one after another, over sets of rows."""
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, t in marks if t == 1 and i is not None}
    fails = [failing(rows, t, i) for i, t, _ in rows]
    out = {}
    for part in {s for _, _, s in rows}:
        mine = {k for k, r in enumerate(rows) if r[2] == part}
        for names in permutations("ABCDE"):
            left = set(mine)
            for step, f in enumerate(names, 1):
                failed = {k for k in mine if fails[k][f]}
                gone = failed & left
                left -= gone
                out[part, "".join(names), step] = [
                    len(left), len(gone), len(failed) - len(gone), sum(sum(fails[k].values()) == 1 for k in failed),
                    sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone),
                ]
    whole = Counter()
    for (part, names, step), row in out.items():
        whole[part, names[step - 1]] += row[1]
    return {k: (*row, whole[k[0], k[1][k[2] - 1]]) for k, row in out.items()}


@pytest.mark.parametrize("bucket_rows", [1_000_000, 3])
def test_filter_audit(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(audit, "BUCKET_ROWS", bucket_rows)
    fine = " ".join(f"word{i}" for i in range(60))
    many = [(100 + i, "SAME text # again") for i in range(40)] + [(200 + i, f"{fine} {i}") for i in range(5)]
    docs, rows = with_sources(spark, [*ROWS, *many, (300, fine + " #"), (301, fine.upper()), (302, "a a " * 30)])
    got = audit.filter_audit(docs, labels(spark)).collect()
    assert len(got) == 3 * 600
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == audited(rows, LABELS)


def test_filter_audit_of_little(spark):
    docs, _ = with_sources(spark, [])
    assert audit.filter_audit(docs, labels(spark)).collect() == []
    fine = " ".join(f"word{i}" for i in range(60))
    docs, _ = with_sources(spark, [(1, fine)])
    got = audit.filter_audit(docs, labels(spark, [])).collect()
    assert len(got) == 600 and {tuple(r[3:]) for r in got} == {(1, 0, 0, 0, 0, 0, 0)}


def test_joins_of_id_tables_do_not_shuffle(spark, monkeypatch):
    plans, written = [], audit._written
    monkeypatch.setattr(audit, "LEAST_BUCKET_ROWS", 1)
    monkeypatch.setattr(
        audit, "_written", lambda df, path: plans.append((path, _plan(df))) or written(df, path)
    )
    docs, _ = with_sources(spark, ROWS)
    audit.filter_audit(docs, labels(spark)).collect()
    (gone,) = [p for path, p in plans if path.endswith("/gone")]
    assert gone.count("LeftSemi") == 5 and gone.count("Exchange") == 1 and "Broadcast" not in gone
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("filter_audit")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
