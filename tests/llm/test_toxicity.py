import random
import zlib

import numpy as np
import pytest

from quern.llm import toxicity
from quern.llm.toxicity import Model, fold, slots

from .conftest import words


def labelled(n=400, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        w = words(rng, rng.randint(5, 80)).split()
        if bad:
            for _ in range(max(1, len(w) // 15)):
                w[rng.randrange(len(w))] = rng.choice(["zzyqvur", "WWXZTOK", "vuzzyr"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = labelled()
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    return docs, marks, toxicity.train(docs, marks, n_features=512), dict(labels)


def test_held_out_accuracy(trained):
    docs, _, model, labels = trained
    got = toxicity.score(docs, model).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_held_out_labels_are_not_used(spark, trained):
    docs, marks, model, _ = trained
    flipped = marks.withColumn("toxic", (fold(marks.doc_id) == 0).cast("int") * (1 - marks.toxic) + (fold(marks.doc_id) != 0).cast("int") * marks.toxic)
    again = toxicity.train(docs, flipped, n_features=512)
    assert np.array_equal(again.weights, model.weights) and again.intercept == model.intercept


def test_score_against_brute_force(trained):
    _, _, model, _ = trained
    text = "Some zzyqvur text"
    low = text.lower()
    grams = {low[i : i + n] for n in model.sizes for i in range(len(low) - n + 1)}
    held = {int(s) for g in grams for part in slots(g, (len(g),)) for s in part}
    z = model.intercept + sum(float(model.weights[s]) for s in held)
    assert model.score(text) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-6)


def test_long_texts_are_scored_whole(trained):
    _, _, model, _ = trained
    filler = "ab " * 5000
    assert model.score(filler + "zzyqvur") == model.score("zzyqvur " + filler) or model.score(filler + "zzyqvur") > model.score(filler)
    pieces = lambda p: np.unique(np.concatenate(list(slots(filler + "zzyqvur", (3, 4, 5), piece=p))))
    assert np.array_equal(pieces(97), pieces(1 << 18))


def test_edges(docs, no_docs, rows, spark):
    marks = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    assert toxicity.score(docs, model).count() == len(rows)
    none = toxicity.train(docs, marks.filter("false"))
    assert {r["score"] < 1e-9 for r in toxicity.score(docs, none).collect()} == {True}
    assert toxicity.score(no_docs, toxicity.train(no_docs, marks)).collect() == []
    kept = toxicity.clean(docs, none)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert Model(np.zeros(1 << toxicity.BITS, np.float32), 0.0, (3,)).score(None) == 0.5


def test_rows_that_share_a_labelled_id_count_once(spark):
    rows, labels = labelled(120)
    hot = [(1, rows[1][1])] * 300 + [(1, "another text")] * 5
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    one = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), marks)
    few = toxicity.train(spark.createDataFrame(rows + hot[:300], "doc_id long, text string"), marks)
    assert np.allclose(one.weights, few.weights) and np.isclose(one.intercept, few.intercept)
    assert toxicity.train(spark.createDataFrame(rows + hot, "doc_id long, text string"), marks).weights.any()
