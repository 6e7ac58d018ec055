"""Toxicity by compression distance: held-out accuracy on made-up text, and awkward rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurekit.llm import toxicity

SLURS = ["blargface", "snorkwit", "gromphead", "fizzlebrat"]


def _rows(n=1500, seed=4):
    rng = random.Random(seed)
    syllables = [a + b for a in "b d f g k l m n p r s t".split() for b in "a e i o u".split()]
    lexicon = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(lexicon) for _ in range(rng.randint(20, 160))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(SLURS))
        docs.append((i, " ".join(words), "l", "x"))
        if rng.random() < 0.8:
            labels.append((i, int(toxic)))
    return docs, labels, {i: int(any(s in t for s in SLURS)) for i, t, *_ in docs}


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels, truth = _rows()
    d = spark.createDataFrame(docs, "doc_id long, text string, score string, toxic string").repartition(4)
    own = toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    return {r.doc_id: r for r in toxicity.score(d, own).collect()}, truth, own


def test_held_out_accuracy(scored):
    rows, truth, _ = scored
    out = [r for r in rows.values() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows.values())
    caught = [r.predicted for r in out if truth[r.doc_id]]
    clean = [r.predicted for r in out if not truth[r.doc_id]]
    assert np.mean(caught) > 0.9 and np.mean(clean) < 0.03
    assert all((r.score >= 0.3) == bool(r.predicted) and 0 <= r.score <= 1 for r in rows.values())


def test_windows_cover_whole_texts():
    for text in ("", None, "a", "x " * 5000, "y" * 1000 + " z", "Ä ß " * 300):
        own = toxicity.windows(text)
        assert b"".join(own) == (text or "").strip().lower().encode()
        assert all(len(w) <= 2 * toxicity.WINDOW for w in own)


def test_awkward_rows(spark, scored):
    model = scored[2]
    rows = [(None, "no id"), (1, None), (2, ""), (3, " \n\t"), (4, "blargface " * 20000), (5, "a" * 100_000), (5, "a" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.score(docs, model).collect()
    assert len(got) == 7 and {r.score for r in got if r.doc_id in (1, 2, 3)} == {0.0}
    assert [r.predicted for r in got if r.doc_id == 4] == [1] and len({r.score for r in got if r.doc_id == 5}) == 1
    assert toxicity.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("labels,share", [([], 0.0), ([(1, 1), (4, None)], 1.0), ([(1, 0), (None, 1)], 0.0)])
def test_one_class_or_none(spark, labels, share):
    docs = spark.createDataFrame([(1, "some text"), (2, "")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r.doc_id: r.score for r in toxicity.score(docs, model).collect()} == {1: share, 2: 0.0}


def test_bounded_fit(spark, monkeypatch):
    docs, labels, _ = _rows(800, 9)
    d, own = spark.createDataFrame([x[:2] for x in docs], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "MAX_DOCS", 120)
    taken = []
    monkeypatch.setattr(toxicity, "train", lambda a, b, train=toxicity.train: taken.extend([len(a), len(b)]) or train(a, b))
    model = toxicity.fit(d, own)
    assert "weight" in model and 0 < model["share"] < 0.3        # of all labels, though the classes were cut alike
    assert own.where(~toxicity.held_out(F.col("doc_id"))).count() > 240 and taken[1] < taken[0] < 120 * 20
