"""Boosted trees: fit, flattened traversal, odd rows."""

from __future__ import annotations

import random

import numpy as np

from sparrowscope.llm import classifier


def walk(trees, row):
    """One tree node after another, by plain loops."""
    raw = trees.prior
    for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
        node = 0
        for _ in range(classifier.DEPTH):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        raw += value[node]
    return 1 / (1 + np.exp(-raw))


def test_trees_learn_and_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > -0.2)).astype(float)
    trees = classifier.fit_trees(x[:2000], y[:2000])
    score = trees.score(x[2000:])
    assert ((score > 0.5) == (y[2000:] == 1)).mean() > 0.97
    assert np.allclose(score[:50], [walk(trees, row) for row in x[2000:2050]])


def test_without_both_labels():
    assert np.allclose(classifier.fit_trees(np.ones((5, 3)), np.ones(5)).score(np.ones((2, 3))), 0.999)
    assert np.allclose(classifier.fit_trees(np.zeros((0, 3)), np.zeros(0)).score(np.ones((2, 3))), 0.5)


def test_held_out_and_odd_rows(spark, docs_of):
    rng = random.Random(4)
    good = lambda: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(80)) + "."
    rows, labels = [], []
    for i in range(400):
        label = i % 2
        rows.append((i, good() if label else good().replace(" ", "### ")))
        labels.append((i, label))
    labels += [(7, 1), (1000, 1), (None, 0), (5, None)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int")
    docs = docs_of(rows + [(900, None), (901, ""), (None, good()), (902, "a " * 400_000), (3, rows[3][1])], "score")
    trees = classifier.fit(docs, table.where("doc_id % 3 > 0"))
    found = classifier.score(docs, trees).collect()
    assert len(found) == len(rows) + 5 and all(0 <= r["score"] <= 1 for r in found)
    by_id = {r["doc_id"]: r["score"] for r in found}
    assert all((by_id[i] >= 0.3) == (i % 2 == 1) for i in range(0, 400, 3))
    assert by_id[900] == by_id[901]
    assert classifier.score(docs.where("doc_id = -1"), trees).collect() == []
