"""Quality cascade: statistics, order, verdicts."""

from __future__ import annotations

import numpy as np

from sparrowscope.llm import quality
from sparrowscope.llm.textstats import Text

WORDS = " ".join(f"word{i}" for i in range(60))


def test_statistics():
    t = Text("a b c a b c\n \n# x\n# x\né|")
    assert (t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words) == (11, 12, 3, 1, 6)
    assert Text("a a a a").n_repeat_words == 4 and Text("a a a").n_repeat_words == 0
    assert Text(None).n_words == Text("").n_repeat_words == Text(" \n").n_dup_lines == 0


def test_order_by_rejections_per_cost():
    rules = [quality.Rule(n, bool) for n in "abc"]
    bits = np.array([[1, 1, 0], [1, 1, 0], [0, 0, 1], [0, 1, 0]], bool)
    ordered = quality.order_rules(rules, np.array([1.0, 1.0, 0.4]), bits)
    # b rejects most per second; a has nothing left after b and c
    assert [r.name for r in ordered] == ["b", "c", "a"]
    assert [r.name for r in quality.order_rules(rules, np.ones(3), bits[:0])] == ["a", "b", "c"]


def test_short_circuit():
    seen = []
    rules = [quality.Rule("x", lambda t: bool(seen.append("x")) or True), quality.Rule("y", lambda t: bool(seen.append("y")))]
    assert quality.rejected_by(Text("z"), rules) == "x" and seen == ["x"]


def test_verdicts(spark, docs_of):
    rows = [
        (1, WORDS), (2, None), (3, ""), (4, "short"), (5, "a b c d " * 40), (6, WORDS.replace(" ", "### ")),
        (7, WORDS), (7, WORDS), (None, WORDS), (8, "x" * 300_000 + " " + WORDS), (9, ("same line here\n" * 5) + WORDS),
    ]
    found = quality.judge(docs_of(rows, "kept"), statistics=("n_words", "n_symbols"))
    assert found.columns == ["doc_id", "n_words", "n_symbols", "base_failed", "kept"]
    got = sorted((r["doc_id"] or 0, r["base_failed"], r["kept"]) for r in found.collect())
    assert got == [
        (0, False, True), (1, False, True), (2, True, False), (3, True, False), (4, True, False),
        (5, True, False), (6, False, False), (7, False, True), (7, False, True), (8, False, False),
        (9, False, False),
    ]


def test_empty_table(docs_of):
    assert quality.judge(docs_of([(1, "a")]).where("doc_id > 5")).collect() == []
