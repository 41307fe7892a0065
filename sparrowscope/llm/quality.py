"""Quality rules as a short-circuit cascade.

Every rule rejects a text by one statistic. Cost and selectivity of the rules are
measured on a sample; the rule with most rejections per second of the texts still
standing goes first, then the next one, given what the earlier ones leave. A text is
tested until the first rejection only. The order decides the time, never the verdict:
a text is kept when no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparrowscope.llm.common import map_texts
from sparrowscope.llm.textstats import Text


@dataclass(frozen=True)
class Rule:
    """A name and a test that is true for texts to reject."""

    name: str
    rejects: Callable[[Text], bool]


def _too_short(t: Text) -> bool:
    return t.n_words < 50


def _repetitive(t: Text) -> bool:
    return 100 * t.n_repeat_words > 50 * t.n_words


def _symbols(t: Text) -> bool:
    return 10 * t.n_symbols > t.n_words


def _repeated_lines(t: Text) -> bool:
    return 2 * t.n_dup_lines > len(t.lines)


def _word_length(t: Text) -> bool:
    return not 2 * t.n_words <= t.word_chars <= 20 * t.n_words


def _few_letters(t: Text) -> bool:
    return 2 * t.n_letters < t.word_chars


BASE_RULES = (Rule("too_short", _too_short), Rule("repetitive", _repetitive))
RULES = (
    *BASE_RULES,
    Rule("symbols", _symbols),
    Rule("repeated_lines", _repeated_lines),
    Rule("word_length", _word_length),
    Rule("few_letters", _few_letters),
)

# Rows on which cost and selectivity are measured.
SAMPLE_ROWS = 1_000


def rejected_by(text: Text, rules: Sequence[Rule]) -> str | None:
    """Name of the first rule that rejects; later rules are not evaluated."""
    for rule in rules:
        if rule.rejects(text):
            return rule.name
    return None


def measure(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, text: str = "text"
) -> tuple[np.ndarray, np.ndarray]:
    """Mean seconds per text of each rule, and which sampled text each rule rejects.
    Only bits and times of at most `sample_rows` texts come to the driver."""
    rows = docs.count()
    fraction = min(1.0, 1.2 * sample_rows / max(1, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, seconds = [], []
            for value in batch.column(0).to_pylist():
                hit, took = [], []
                for rule in rules:
                    sample = Text(value)  # fresh, so each rule pays for its statistics
                    began = time.perf_counter()
                    hit.append(bool(rule.rejects(sample)))
                    took.append(time.perf_counter() - began)
                bits.append(hit)
                seconds.append(took)
            yield pa.record_batch(
                [pa.array(bits, pa.list_(pa.bool_())), pa.array(seconds, pa.list_(pa.float64()))],
                names=["bits", "seconds"],
            )

    sample = docs.select(text).sample(fraction=fraction, seed=7).limit(sample_rows)
    found = map_texts(sample, run, "bits array<boolean>, seconds array<double>").collect()
    if not found:
        return np.ones(len(rules)), np.zeros((0, len(rules)), bool)
    return (
        np.array([row["seconds"] for row in found]).mean(axis=0),
        np.array([row["bits"] for row in found], bool),
    )


def order_rules(rules: Sequence[Rule], seconds: np.ndarray, bits: np.ndarray) -> list[Rule]:
    """Greedy order by rejections per second among the texts that earlier rules leave;
    without any rejection left, cheap rules go first."""
    left, standing, ordered = list(range(len(rules))), np.ones(len(bits), bool), []
    while left:
        best = max(
            left,
            key=lambda i: (bits[standing, i].sum() / max(seconds[i], 1e-9), -seconds[i], -i),
        )
        left.remove(best)
        standing &= ~bits[:, best] if len(bits) else standing
        ordered.append(rules[best])
    return ordered


def judge(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    statistics: Sequence[str] = (),
    sample_rows: int = SAMPLE_ROWS,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of `docs`: id, the named statistics of the text (long), `kept`,
    and `base_failed` (a base rule rejects).

    Null and empty texts have no words and are too short. Repeated rows are judged each
    on their own, an empty table gives an empty result, other columns are not read.
    `base_failed` is true only if one of BASE_RULES is among `rules` and rejects.
    """
    ordered = order_rules(rules, *measure(docs, rules, sample_rows, text))
    base = [rule for rule in rules if rule in BASE_RULES]
    names = list(statistics)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[int]] = [[] for _ in names]
            failed, kept = [], []
            for value in batch.column(1).to_pylist():
                current = Text(value)
                for name, column in zip(names, columns):
                    column.append(getattr(current, name))
                kept.append(rejected_by(current, ordered) is None)
                failed.append(not kept[-1] and rejected_by(current, base) is not None)
            yield pa.record_batch(
                [
                    batch.column(0),
                    *[pa.array(column, pa.int64()) for column in columns],
                    pa.array(failed, pa.bool_()),
                    pa.array(kept, pa.bool_()),
                ],
                names=["id", *names, "base_failed", "kept"],
            )

    source = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    schema = ", ".join(
        [
            f"id {source.schema['id'].dataType.simpleString()}",
            *[f"{name} bigint" for name in names],
            "base_failed boolean, kept boolean",
        ]
    )
    return map_texts(source, run, schema).withColumnRenamed("id", id)
