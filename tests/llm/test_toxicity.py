"""The convolutional classifier: held-out rows, odd rows, and its parts against plain versions."""

import random
import zlib

import numpy as np
import pytest

from ledger_sync.llm import toxicity as tox
from ledger_sync.llm.toxicity import Model, encode, score_toxicity, threshold, train
from tests.llm.helpers import LONG, PROSE, ROWS, documents, empty

CALM = "river stone quiet meadow basket window lantern orchard pebble harvest".split()
RUDE = "blargh snoot grumph".split()


def corpus(n=400, seed=2):
    """Every fourth text has some rude words, now and then with another ending."""
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = rng.choices(CALM, k=rng.randint(20, 60)) + ["the", "of", "and"]
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(RUDE) + rng.choice(["", "", "ish", "ly"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = corpus()
    fresh = [(1000, "quiet meadow snootable basket the of and"), (1001, "quiet meadow basket the of and"), *ROWS]
    fresh = [(i if i is None or i > 999 else 2000 + i, t) for i, t in fresh]
    docs = documents(spark, rows + fresh)
    return docs, score_toxicity(docs, labels_of(spark, labels)), dict(labels)


def test_held_out_texts_are_told_apart(scored):
    docs, result, labels = scored
    assert result.columns == [*docs.drop("held_out", "score", "predicted").columns, "held_out", "score", "predicted"]
    rows = result.collect()
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    unseen = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(unseen) > 100
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in unseen]) > 0.97


def test_endings_never_seen_are_known_by_the_first_letters(scored):
    found = {r["doc_id"]: r["predicted"] for r in scored[1].collect()}
    assert found[1000] == 1 and found[1001] == 0


def test_odd_rows_are_scored(scored):
    rows = scored[1].collect()
    assert len(rows) == 400 + 2 + len(ROWS)
    by_text = {r["text"]: r["score"] for r in rows if r["text"] in (None, "", " \t\n\r\x0b\x0c \n", LONG, PROSE.upper())}
    assert len(by_text) == 5 and by_text[None] == by_text[""] == by_text[" \t\n\r\x0b\x0c \n"] < 0.7


def test_held_out_labels_and_other_columns_are_not_learnt_from(spark, scored):
    rows, labels = corpus()
    turned = [(i, 1 - t if held_out(i) else t) for i, t in labels] + [(None, 1), (5, None), (7, 9)]
    docs = spark.createDataFrame([(*r, f"{r[0]}", "xx") for r in rows], "doc_id long, text string, source string, lang string")
    once = {r["doc_id"]: r["score"] for r in score_toxicity(docs, labels_of(spark, turned)).collect()}
    assert once == {r["doc_id"]: r["score"] for r in scored[1].where("doc_id < 400").collect()}


@pytest.mark.parametrize(("rows", "score"), [([], 0.5), ([(0, 1), (2, 1)], 1.0), ([(0, 0)], 0.0), ([(9, 1)], 0.5)])
def test_without_two_kinds_of_labels(spark, rows, score):
    rows = [r for r in rows if not held_out(r[0])]
    docs = documents(spark, [(0, "a"), (2, "b"), (3, None)])
    assert [r["score"] for r in score_toxicity(docs, labels_of(spark, rows)).collect()] == [score] * 3


def test_no_documents(spark):
    assert score_toxicity(empty(spark), labels_of(spark, [(1, 1), (2, 0)])).collect() == []


def unpacked(rows):
    """Ids and words of each block, and their labels."""
    found = []
    for r in rows.collect():
        columns = ((r["ids"], "<i8"), (r["sizes"], "<i8"), (r["labels"], "i1"))
        found.append(list(zip(*(np.frombuffer(x, t).tolist() for x, t in columns))))
    return found


def test_every_labelled_row_is_learnt_from_however_long(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(tox, "BLOCK_WORDS", 200)
    a, b, c, d, gone = 0, 8, 10, 12, 14  # none is held out
    docs = documents(spark, [(a, "a " * 150), (b, "b " * 150), (c, "c " * 300), (d, "d " * 20), (d, "e " * 10), (7, "x")])
    labels = labels_of(spark, [(a, 0), (a, 1), (b, 0), (c, 1), (d, 1), (gone, 1)])
    rows, totals = tox._write_blocks(docs, labels, str(tmp_path / "blocks"))
    # Toxic if any label says so; the shortest of the rows of an id.
    assert sorted(unpacked(rows)) == [[(a, 150, 1)], [(b, 150, 0)], [(c, 300, 1)], [(d, 10, 1)]]
    assert totals == {0: 1, 1: 4}


def test_rows_that_fill_several_blocks_are_all_learnt_from(spark, tmp_path):
    ids = spark.range(14_000)
    docs = ids.selectExpr("id AS doc_id", "concat('word', id % 5, ' and') AS text")
    rows, _ = tox._write_blocks(docs, ids.selectExpr("id AS doc_id", "int(id % 20 = 0) AS toxic"), str(tmp_path / "blocks"))
    found, learnt = unpacked(rows), [i for i in range(14_000) if not held_out(i)]
    assert len(learnt) > tox.BLOCK_ROWS and all(len(x) <= tox.BLOCK_ROWS for x in found)
    assert sorted(x for block in found for x in block) == [(i, 2, int(i % 20 == 0)) for i in learnt]
    counts = tox._tallied(rows).sum(0)
    assert counts[:, tox._PAD].tolist() == [sum(i % 20 > 0 for i in learnt), sum(i % 20 == 0 for i in learnt)]
    for i in range(5):
        bucket = tox.buckets(encode(f"word{i}", tox._Codes()))[0, 0]
        assert counts[:, bucket].sum() == sum(x % 5 == i for x in learnt)


def test_blocks_are_averaged_and_logits_counted(spark, monkeypatch):
    rows, labels = corpus()
    docs, labels = documents(spark, rows), labels_of(spark, labels)
    one = tox.fit(docs, labels)
    seen = []
    rounds, logits = tox._round, tox._unseen_logits
    monkeypatch.setattr(tox, "_round", lambda blocks, *a: (seen.append(blocks.count()), rounds(blocks, *a)))
    monkeypatch.setattr(tox, "_unseen_logits", lambda *a: seen.append(logits(*a)) or seen[-1])
    monkeypatch.setattr(tox, "BLOCK_ROWS", 100)
    monkeypatch.setattr(tox, "LOGIT_ROWS", 10)
    several = tox.fit(docs, labels)
    *blocks, (found, _, _, counts) = seen
    assert len(blocks) == tox.ROUNDS and min(blocks) >= 3
    assert counts.sum() == sum(not held_out(i) for i, _ in rows) and (found * tox.LOGIT_STEPS % 1 == 0).all()
    unseen = [(encode(t, tox._Codes()), i % 4 == 0) for i, t in rows if held_out(i)]
    for model in (one, several):
        right = (model.score([t for t, _ in unseen]) >= 0.7) == np.array([x for _, x in unseen])
        assert right.mean() > 0.97


def test_chunks_do_not_change_what_is_learnt(monkeypatch):
    rows, labels = corpus(40)
    texts, labels = [encode(t, tox._Codes()) for _, t in rows], np.array([t for _, t in labels])
    whole = tox._values(train(texts, labels))
    monkeypatch.setattr(tox, "CHUNK_WORDS", 7)
    assert np.allclose(tox._values(train(texts, labels)), whole, atol=1e-3)


def test_words_are_the_same_however_texts_are_sliced(monkeypatch):
    text = f"Straße {LONG} ÉCOLE　the\n\n end" + "x" * 500
    whole = encode(text, tox._Codes())
    monkeypatch.setattr(tox, "SLICE_LETTERS", 50)
    monkeypatch.setattr(tox, "CACHED_WORDS", 10)
    assert (encode(text, tox._Codes()) == whole).all()
    assert not len(encode("", tox._Codes())) and not len(encode(" \n", tox._Codes()))


def test_chunks_do_not_change_answers(monkeypatch):
    rows, labels = corpus(120)
    texts = [encode(t, tox._Codes()) for _, t in rows] + [encode("", tox._Codes()), encode("one", tox._Codes())]
    net = train(texts[:120], np.array([t for _, t in labels]))

    def plain(codes):
        own = np.pad(tox.buckets(codes), ((0, 0), (0, 2)), constant_values=tox._PAD)
        words = net.embedding[own[0]] + net.embedding[own[1]]
        pools = [np.maximum(net.answers(words, w)[: len(codes)], 0).max(0, initial=0) for w in tox.WIDTHS]
        return np.concatenate(pools) @ net.weights + net.bias

    expected = np.array([plain(t) for t in texts])
    for chunk in (1, 3, 50, 1 << 16):
        monkeypatch.setattr(tox, "CHUNK_WORDS", chunk)
        assert np.allclose(net.logits(texts), expected, atol=1e-4)


def test_threshold_is_where_f1_is_best():
    rng = np.random.default_rng(4)
    for _ in range(20):
        logits, toxic = rng.integers(0, 6, 30).astype(float), rng.random(30) < 0.3
        toxic[0] = True
        f1 = {t: 2 * (toxic & (logits >= t)).sum() / ((logits >= t).sum() + toxic.sum()) for t in set(logits)}
        bound = threshold(logits, toxic, np.ones(30))
        assert f1[min(t for t in f1 if t >= bound)] == max(f1.values())


def test_each_language_has_its_threshold():
    net = train([], np.zeros(0))
    texts = [encode(t, tox._Codes()) for t in ("the of and", "der die das und", "le la les", "el los y", "漢字")]
    assert [tox.LANGUAGES[tox.language(t)] for t in texts] == ["en", "de", "fr", "es", ""]
    bounds = np.array([-1.0, 1, -1, 1, -1])
    assert (Model(net, bounds, 1.0).score(texts) >= 0.7).tolist() == [False, True, False, True, True]
