"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown level by level on binned statistics with logistic loss, then flattened
into arrays (feature, threshold, value of each node of a full binary tree) that numpy
walks for a whole batch and all trees at once. The fit uses a bounded sample: the
FIT_ROWS labelled rows with the smallest hash of their id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparrowscope.llm.common import map_texts
from sparrowscope.llm.textstats import Text

FIT_ROWS = 10_000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.15
SMOOTH = 1.0

FEATURES = (
    "words", "word_length", "symbols", "repeated_lines", "repeated_words", "letters", "upper",
    "digits", "high", "ends", "distinct", "lines", "characters",
)


def statistics(t: Text) -> list[float]:
    """The document statistics that the trees see, in the order of FEATURES."""
    words, chars, letters = max(1, t.n_words), max(1, t.word_chars), max(1, t.n_letters)
    return [
        float(t.n_words),
        t.word_chars / words,
        t.n_symbols / words,
        t.n_dup_lines / max(1, len(t.lines)),
        t.n_repeat_words / words,
        t.n_letters / chars,
        t.n_upper / letters,
        t.n_digits / chars,
        t.n_high / letters,
        t.n_ends / words,
        t.n_distinct_words / words,
        len(t.lines) / words,
        float(len(t.text)),
    ]


@dataclass
class Trees:
    """Flattened trees. Node k of a tree has the children 2k+1 and 2k+2; a node without
    a split has an infinite threshold, which leads left to the same value."""

    prior: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.prior)
        if len(self.feature):
            tree = np.arange(len(self.feature))[None, :]
            node = np.zeros((len(x), len(self.feature)), np.int64)
            row = np.arange(len(x))[:, None]
            for _ in range(DEPTH):
                right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            raw = raw + self.value[tree, node].sum(axis=1)
        return 1 / (1 + np.exp(-raw))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost on the rows of `x` with labels 0 and 1; without both labels the score is
    their share everywhere."""
    share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    prior = float(np.log(share / (1 - share)))
    nodes = (1 << (DEPTH + 1)) - 1
    empty = (np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes)))
    if len(y) == 0 or y.min() == y.max():
        return Trees(prior, *empty)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    raw = np.full(len(y), prior)
    features, thresholds, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        gradient, weight = p - y, p * (1 - p)
        feature, threshold = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        value, at = np.zeros(nodes), np.zeros(len(y), np.int64)
        for level in range(DEPTH + 1):
            first, width = (1 << level) - 1, 1 << level
            local = at - first
            g = np.bincount(local, gradient, width)
            h = np.bincount(local, weight, width)
            value[first : first + width] = -RATE * g / (h + SMOOTH)
            if level == DEPTH:
                break
            best = np.full(width, 1e-6)
            cut = np.full(width, -1)
            for f, edge in enumerate(edges):
                if not len(edge):
                    continue
                size = len(edge) + 1
                key = local * size + binned[:, f]
                gl = np.bincount(key, gradient, width * size).reshape(width, size).cumsum(1)[:, :-1]
                hl = np.bincount(key, weight, width * size).reshape(width, size).cumsum(1)[:, :-1]
                gr, hr = g[:, None] - gl, h[:, None] - hl
                gain = gl**2 / (hl + SMOOTH) + gr**2 / (hr + SMOOTH) - (g**2 / (h + SMOOTH))[:, None]
                top = gain.argmax(1)
                better = gain[np.arange(width), top] > best
                best = np.where(better, gain[np.arange(width), top], best)
                feature[first : first + width] = np.where(better, f, feature[first : first + width])
                cut = np.where(better, top, cut)
            for k in np.flatnonzero(cut >= 0):
                threshold[first + k] = edges[feature[first + k]][cut[k]]
            right = x[np.arange(len(y)), feature[at]] > threshold[at]
            at = 2 * at + 1 + right
        raw += value[at]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(prior, np.array(features), np.array(thresholds), np.array(values))


def fit(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id: str = "doc_id", label: str = "quality",
    text: str = "text",
) -> Trees:
    """Fit on at most `fit_rows` rows of `labels` (id, label 0 or 1; null labels and ids
    are left out, of several labels of one id the smallest counts). Only their statistics
    come to the driver."""
    known = labels.where(labels[label].isin(0, 1) & labels[id].isNotNull())
    known = known.groupBy(known[id].alias("id")).agg(F.min(label).cast("int").alias("label"))
    picked = known.orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    sample = rows.join(F.broadcast(picked), "id").select("label", "text", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [statistics(Text(value)) for value in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(2).cast(pa.string()), batch.column(0), pa.array(made, pa.list_(pa.float64()))],
                names=["id", "label", "x"],
            )

    found = map_texts(sample, run, "id string, label int, x array<double>").collect()
    found.sort(key=lambda r: (r["id"], r["x"]))
    x = np.array([row["x"] for row in found], float).reshape(len(found), len(FEATURES))
    return fit_trees(x, np.array([row["label"] for row in found], float))


def score(docs: DataFrame, trees: Trees, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id and score (0 to 1) of every row. Null counts as empty, whose statistics are
    zeros; repeated rows are scored each on their own; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [statistics(Text(value)) for value in batch.column(1).to_pylist()]
            x = np.array(made, float).reshape(len(made), len(FEATURES))
            yield pa.record_batch([batch.column(0), pa.array(trees.score(x), pa.float64())], names=["id", "score"])

    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_texts(rows, run, f"id {kind}, score double").withColumnRenamed("id", id)
