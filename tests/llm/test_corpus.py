"""Operators that compare documents, against brute force; and the whole pipeline."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from ledger_sync.llm import decontaminate, line_dedup, quality_classifier, sharding, simhash, substring_dedup
from ledger_sync.llm.queries import QUERIES
from tests.llm.helpers import CLASHING, LONG, PASSAGE, PROSE, ROWS, documents, empty, order, words


def hot_rows(n=120, seed=3):
    """A third copies, a third near copies, the rest with a passage and a line in common."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(n):
        own = list(base)
        if i % 3 == 1:
            own[rng.randrange(150)] = f"x{i}"
        if i % 3 == 2:
            own = [f"y{rng.randrange(100)}" for _ in range(100)] + base[20:70] + ["z"] * (i % 50)
        rows.append((1000 + i, " ".join(own) + "\nA line they all have\n" + f"own line {i}"))
    return rows


# Line dedup


def lines_kept(rows, min_docs, min_chars=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    number = lambda d: (1 << 63) - 1 if d is None else d
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(number(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        gone = lambda x: len(holders[key(x)]) >= min_docs and min(holders[key(x)]) != number(d)  # noqa: B023, E731
        kept = [x for x in lines if not gone(x)]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup(spark, min_docs):
    rows = [*ROWS, *hot_rows(30), (50, "ÄÖÜ äöü 漢\n ÄÖÜ äöü 漢字 \nABC"), (51, "ÄÖÜ äöü 漢字\r\nÄÖÜ äöü 漢")]
    docs = documents(spark, rows)
    kept = line_dedup.line_dedup(docs, min_docs=min_docs)
    assert kept.columns == [c for c in docs.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    got = kept.select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert order(map(tuple, got)) == order(lines_kept(rows, min_docs))
    assert line_dedup.line_dedup(empty(spark)).collect() == []


# SimHash


def prints_of(rows, size=4):
    out = []
    for _, text in rows:
        ws = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
        shingles = [" ".join(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))] if ws else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        out.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return out


def linked(prints, distance):
    """Smallest member of each print's component."""
    nodes = np.array(sorted(set(prints)), np.uint64)
    parent = list(range(len(nodes)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(nodes)):
        for j in np.flatnonzero(np.bitwise_count(nodes[i + 1 :] ^ nodes[i]) <= distance):
            parent[root(i + 1 + int(j))] = root(i)
    return {int(x): int(nodes[root(i)]) for i, x in enumerate(nodes)}


def test_simhash_groups(spark):
    rows = [r for r in ROWS if r[0] != 5] + hot_rows(60)
    docs = documents(spark, rows)
    got = simhash.simhash_groups(docs)
    assert set(CLASHING) <= {*got.columns, "fingerprint", "component_id", "component", "print"}
    prints = prints_of(rows)
    roots = linked(prints, 4)
    smallest = defaultdict(list)
    for (d, _), x in zip(rows, prints):
        if d is not None:
            smallest[roots[x]].append(d)
    want = [(d, f"{x:016x}", min(smallest[roots[x]], default=None)) for (d, _), x in zip(rows, prints)]
    assert order(map(tuple, got.select("doc_id", "fingerprint", "component_id").collect())) == order(want)
    assert simhash.simhash_groups(empty(spark)).collect() == []


@pytest.mark.parametrize(("distance", "group"), [(1, 4096), (3, 4096), (4, 4096), (4, 3)])
def test_links_between_clustered_prints(spark, tmp_path, monkeypatch, distance, group):
    """Clusters around a few prints, entries that are split on each level, no link lost."""
    monkeypatch.setattr(simhash, "GROUP", group)
    rng = random.Random(distance)
    centres = [rng.getrandbits(64) for _ in range(40)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for c in centres for _ in range(12)}
    prints |= {centres[0] ^ x for x in range(200)}  # one entry with many members
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    frame = spark.createDataFrame(signed, "print long")
    links = simhash.links_between(frame, distance, str(tmp_path / "links"))
    roots = {r["node"]: r["root"] for r in simhash.components(links, str(tmp_path / "stars")).collect()}
    groups, want = defaultdict(set), defaultdict(set)
    of = linked(list(prints), distance)
    for (s,) in signed:
        groups[roots.get(s, s)].add(s)
        want[of[s & ((1 << 64) - 1)]].add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_hot_entry_over_many_batches():
    """A group that arrives in pieces is passed on whole."""
    import pyarrow as pa

    n = simhash.GROUP * 3
    columns = [np.zeros(n, np.int64), np.r_[0, np.full(n - 2, 5), 9], np.arange(n)]
    batches = [pa.record_batch([pa.array(c[i : i + 1000]) for c in columns], ["mask", "key", "print"]) for i in range(0, n, 1000)]
    found = pa.Table.from_batches(list(simhash._Scan(4, 0, False)(iter(batches))))
    assert sorted(found.column("a").to_pylist()) == list(range(n))
    assert found.column("b").null_count == n


def test_long_chain_is_one_component(spark, tmp_path):
    links = spark.range(60).selectExpr("id + 1 AS a", "id AS b")
    roots = simhash.components(links, str(tmp_path / "chain")).collect()
    assert {r["node"]: r["root"] for r in roots} == {i: 0 for i in range(1, 61)}


# Decontamination


ITEMS = [
    (1, "alpha beta gamma"), (2, "one two three four five six seven eight nine ten eleven twelve"), (3, "word"),
    (4, None), (5, "  ..."), (None, "alpha beta"), (6, PASSAGE), (7, "Beta-Gamma é漢 delta"), (8, "word word word"),
    (2, "a second row of this item"), (10, "alpha beta gamma"),
]


def tokens(text):
    lower = (text or "").encode().translate(decontaminate._WORD_BYTES)
    return [w.decode() for w in lower.split()]


def contaminated(rows, items, window=10):
    out = []
    wins = defaultdict(set)
    for i, t in items:
        ws = tokens(t)
        size = min(window, len(ws))
        for k in range(len(ws) - size + 1 if size and i is not None else 0):
            wins[tuple(ws[k : k + size])].add(i)
    sizes = {len(w) for w in wins}
    for d, t in rows:
        ws, hit, found = tokens(t), set(), set()
        for s in sizes:
            for k in range(len(ws) - s + 1):
                if own := wins.get(tuple(ws[k : k + s])):
                    hit |= set(range(k, k + s))
                    found |= own
        out.append((d, len(ws), len(hit), sorted(map(str, found)), bool(hit)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 24, 300])
def test_decontaminate(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", block_bytes)
    rows = [
        *ROWS, (20, "x ONE two-three four five six seven eight nine ten, eleven twelve y"),
        (21, "one two three four five six seven eight nine x two three four five six seven eight nine ten eleven"),
        (22, "alpha beta gamma alpha beta gamma É漢"), (23, "beta gamma é漢 delta"), (24, "alpha betagamma"),
    ]
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, n_words string")
    docs = documents(spark, rows)
    got = decontaminate.decontaminate(docs, items)
    rest = [c for c in docs.columns if c not in ("n_words", "n_hit", "items", "contaminated", "matches")]
    assert got.columns[: len(rest)] == rest
    picked = got.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert order(map(tuple, picked)) == order(contaminated(rows, ITEMS))
    assert decontaminate.decontaminate(empty(spark), items).collect() == []
    nothing = decontaminate.decontaminate(docs, items.limit(0)).where("contaminated").count()
    assert nothing == 0


def test_copies_of_an_item_are_dealt_by_size(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", 300)
    copied = "one two three four five six seven eight nine ten eleven twelve"
    items = [(i, copied) for i in range(30)] + [(3, copied), (40, "alpha beta"), (41, "gamma " * 90), (42, "")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(decontaminate._blocks_of(frame))
    assert sorted((i, t.decode()) for b in blocks for i, t in b) == sorted({x for x in items if x[1]})
    assert all(len(b) == 1 or sum(len(t) for _, t in b) <= 300 for b in blocks)
    rows = [(1, f"x {copied} y"), (2, "alpha beta"), (3, "gamma " * 12), (4, "delta")]
    got = decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), frame)
    picked = got.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert order(map(tuple, picked)) == order(contaminated(rows, items))


def test_packed_blocks_are_of_a_checked_size(monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 4000)
    items = [(i, " ".join(f"w{i}x{j}" for j in range(20)).encode()) for i in range(8)]
    benches = list(decontaminate._packed_blocks(items, 10))
    assert len(benches) > 1
    assert all(b.n_bytes <= 4000 or len(set(b.items.tolist())) == 1 for b in benches)
    assert sorted({i for b in benches for i in b.items.tolist()}) == list(range(8))


def test_longest_matches_have_places(spark):
    item = " ".join(f"t{i}" for i in range(30))
    text = "a b " + " ".join(f"t{i}" for i in range(5, 25)) + " c " + " ".join(f"t{i}" for i in range(12))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    found = decontaminate.longest_matches(docs, items).first()["matches"]
    assert [tuple(m) for m in found] == [(9, 5, 2, 20), (9, 0, 23, 12)]


def test_search_by_words_that_fill_several_numbers():
    rng = random.Random(4)
    vocabulary = [f"v{i}".encode() for i in range(300)]
    text = [rng.choice(vocabulary[:3]) for _ in range(3000)]
    items = [(i, b" ".join(text[i * 7 : i * 7 + 14]) + b" " + b" ".join(vocabulary)) for i in range(20)]
    bench = decontaminate.Benchmark(items, 10)
    assert bench.n_keys > 1
    found = decontaminate._matches_of(bench, [text])
    want = contaminated([(0, b" ".join(text).decode())], [(i, t.decode()) for i, t in items])
    assert sorted({str(m["item_id"]) for m in found[0]}) == want[0][3]


# Substring dedup


def without_repeats(rows, window):
    counts = Counter()
    for _, t in rows:
        ws = words(t)
        counts.update(tuple(ws[i : i + window]) for i in range(len(ws) - window + 1))
    out = []
    for d, t in rows:
        ws = words(t)
        gone = {
            j for i in range(len(ws) - window + 1) if counts[tuple(ws[i : i + window])] > 1 for j in range(i, i + window)
        }
        out.append((d, " ".join(w for j, w in enumerate(ws) if j not in gone), len(ws), len(gone)))
    return out


@pytest.mark.parametrize(("window", "group"), [(35, 4096), (35, 5), (14, 1), (5, 4096)])
def test_substring_dedup(spark, monkeypatch, window, group):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    rows = [*ROWS, *hot_rows(60), (70, "ab " * 200), (71, " ".join(LONG.split()[500:600])), (72, "x " * 35)]
    docs = documents(spark, rows)
    kept = substring_dedup.substring_dedup(docs, window)
    assert kept.columns == [c for c in docs.columns if c not in ("n_words", "n_removed")] + ["n_words", "n_removed"]
    got = kept.select("doc_id", "text", "n_words", "n_removed").collect()
    assert order(map(tuple, got)) == order(without_repeats(rows, window))


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup.substring_dedup(empty(spark)).collect() == []


def test_repeats_are_spans(spark):
    rows = [(1, "a b c " + PASSAGE + " d"), (2, PASSAGE + " e"), (3, PROSE)]
    found = substring_dedup.repeats(documents(spark, rows)).collect()
    covered = {d: set() for d, _ in rows}
    for r in found:
        covered[r["doc_id"]] |= set(range(r["begin"], r["end"]))
    assert covered == {1: set(range(3, 63)), 2: set(range(60)), 3: set()}


def test_equal_windows_are_filed_alike():
    rng = random.Random(6)
    passage = [b"p%d" % rng.randrange(50) for _ in range(80)]
    keys = []
    for lead in (0, 13):
        ws = [b"l%d" % i for i in range(lead)] + passage + [b"t"]
        by_window = {}
        for key, first, last in zip(*(x.tolist() for x in substring_dedup.filed(ws, 35))):
            by_window |= {w - lead: key for w in range(first, last + 1)}
        assert len(by_window) == len(ws) - 34
        keys.append([by_window[w] for w in range(80 - 34)])
    assert keys[0] == keys[1]


# Sharding


def dealt(rows, n):
    groups = defaultdict(list)
    for d, t in rows:
        content = (t or "").encode()
        groups[hashlib.md5(content).hexdigest()].append((d, len(content) + 8, zlib.crc32(content)))
    size = {h: sum(x[1] for x in v) for h, v in groups.items()}
    big, total, own = sorted(groups, key=lambda h: (-size[h], h)), sum(size.values()), []
    while len(own) < min(len(big), n - 1) and size[big[len(own)]] * (n - len(own)) > total:
        total -= size[big[len(own)]]
        own.append(big[len(own)])
    rest, m = sorted(set(groups) - set(own)), n - len(own)

    def shards_at(capacity):
        out, held = 1, 0
        for h in rest:
            if size[h] > capacity:
                return m + 1
            out, held = (out + 1, size[h]) if held + size[h] > capacity else (out, held + size[h])
        return out

    low, high = 1, max(1, total)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if shards_at(middle) <= m else (middle + 1, high)
    return groups, size, own, low


@pytest.mark.parametrize(("n", "stretches"), [(24, 1 << 14), (3, 1), (7, 1)])
def test_shards(spark, monkeypatch, n, stretches):
    monkeypatch.setattr(sharding, "STRETCHES", stretches)
    rows = [*ROWS, *hot_rows(200), *((5000 + i, "copy " * 40) for i in range(300)), *((None, "tie") for _ in range(4))]
    got = sharding.shard(documents(spark, rows), n).collect()
    groups, size, own, capacity = dealt(rows, n)
    want = [(d, s, c, "bytes") for v in groups.values() for d, s, c in v]
    assert order((r["doc_id"], r["size"], r["text_crc32"], r["law"]) for r in got) == order(want)
    held, slots, of_text = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        held[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        of_text[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in of_text.values()) and set(held) <= set(range(n))
    alone = sorted(size[h] for h in own)
    assert sorted(held[i] for i in range(len(own))) == alone
    assert max(held[i] for i in range(len(own), n)) == capacity


def test_shards_of_little(spark):
    assert sharding.shard(empty(spark)).collect() == []
    got = sharding.shard(documents(spark, [(1, "a"), (2, "a")]), 24).collect()
    assert {(r["shard"], r["slot"]) for r in got} == {(0, 0), (0, 1)}


def test_sharding_stays_in_the_jvm(spark):
    plan = sharding.shard(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Quality classifier


def test_classifier_tells_held_out_rows(spark):
    import pandas as pd

    folder = "/root/testdata/sf0.01"
    got = QUERIES["op5_quality_classifier"](spark, folder).toPandas()
    labels = pd.read_parquet(f"{folder}/labels.parquet")
    held = [zlib.crc32(str(d).encode()) % 3 == 1 for d in got.doc_id]
    assert got.held_out.tolist() == held
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    seen = got.merge(labels, on="doc_id").query("held_out")
    assert len(seen) > 80 and (seen.predicted == seen.quality).mean() > 0.97


def test_classifier_ignores_held_out_labels(spark):
    """Turning round the labels of held-out rows changes no score."""
    rows = [(i, ("good text of some words here " * 3) if i % 2 else "### $$$ &&& " * (i % 7 + 2)) for i in range(300)]
    docs = documents(spark, rows)
    make = lambda flip: spark.createDataFrame(
        [(i, (i % 2) ^ (flip and zlib.crc32(str(i).encode()) % 3 == 1)) for i in range(300)], "doc_id long, quality int"
    )
    scores = []
    for flip in (False, True):
        found = quality_classifier.score_quality(docs, make(flip)).collect()
        scores.append({r["doc_id"]: r["score"] for r in found})
    assert scores[0] == pytest.approx(scores[1])
    assert all((scores[0][i] >= 0.5) == bool(i % 2) for i in range(300))


def test_classifier_odd_rows_and_labels(spark):
    docs = documents(spark)
    kinds = "doc_id long, quality int, text string"
    none = quality_classifier.score_quality(docs, spark.createDataFrame([], kinds))
    assert {r["score"] for r in none.collect()} == {0.5} and none.count() == len(ROWS)
    odd = [(1, 1, "x"), (1, 0, "x"), (3, 0, "x"), (None, 1, "x"), (7, None, "x"), (8, 5, "x"), (99, 1, "x")]
    some = quality_classifier.score_quality(docs, spark.createDataFrame(odd, kinds)).collect()
    assert len(some) == len(ROWS) and all(0 <= r["score"] <= 1 for r in some)
    assert quality_classifier.score_quality(empty(spark), spark.createDataFrame(odd, kinds)).collect() == []


def test_isotonic_is_nondecreasing_and_keeps_the_mean():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=500).round(1)
    labels = (rng.uniform(size=500) < 1 / (1 + np.exp(-scores))).astype(float)
    x, y = quality_classifier.isotonic(scores, labels)
    assert (np.diff(y) >= 0).all() and (np.diff(x) >= 0).all() and y.min() >= 0 and y.max() <= 1


# Pipeline


def test_pipeline_is_its_stages(spark, tmp_path):
    """Each stage's rows against brute force on the rows before it."""
    folder = tmp_path / "tables"
    good = [(2000 + i, f"This is text number {i} of the set.\n" + " ".join(f"g{i}w{j}" for j in range(60))) for i in range(60)]
    junk = [(3000 + i, " ".join(f"J{i}{j}!!&&" for j in range(60))) for i in range(60)]
    item = " ".join(f"bench{i}" for i in range(20))
    near = [(2100, good[0][1] + " tail"), (2101, good[1][1]), (2102, " ".join(f"h{j}w{j}" for j in range(60)) + ". " + item)]
    rows = good + junk + near
    documents(spark, [*rows, *[r for r in ROWS if r[0] != 5]]).drop("ids").write.parquet(f"{folder}/documents.parquet")
    labels = [(d, int(d < 3000)) for d, _ in good + junk]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pairs = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(folder))
        before, columns = pairs(docs), docs.columns
        if name == "byte_level_bpe":
            sha = {hashlib.sha256((t or "").encode()).hexdigest() for _, t in before}
            assert out.count() == len(before) and {r["decoded_sha256"] for r in out.collect()} == sha
            continue
        assert out.columns == columns
        after = pairs(out)
        if name == "quality_classifier":
            assert not {d for d, _ in junk} & {d for d, _ in after}
            assert {d for d, _ in good + near} <= {d for d, _ in after}
        elif name == "line_dedup":
            assert order(after) == order((d, t) for d, t, *_ in lines_kept(before, 2))
        elif name == "simhash_near_dedup":
            roots = linked(x := prints_of(before), 4)
            assert len(after) == len({roots[p] for p in x})
            kept = {roots[p] for p in prints_of(after)}
            assert len(kept) == len(after)
        else:
            dirty = [r[0] for r in contaminated(before, [(1, item)]) if r[4]]
            assert dirty == [2102] and order(after) == order(r for r in before if r[0] != 2102)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")


def test_pipeline_of_no_documents(spark, tmp_path):
    for name, kinds in (
        ("documents", "doc_id long, text string, lang string"), ("labels", "doc_id long, quality int"),
        ("benchmark", "item_id long, text string"),
    ):
        spark.createDataFrame([], kinds).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
