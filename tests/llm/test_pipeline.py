"""The pipeline on a small corpus, stage by stage, against plain rules."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(9)
    syllables = {"en": "the ing tion and er th wh ly", "fr": "eau é è tion ou le ê que"}

    def sentence(lang, n=9):
        parts = syllables[lang].split()
        return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n)) + ". "

    def text(lang, n=14):
        return "".join(sentence(lang) for _ in range(n))

    rows = [(i, text(lang), lang) for i, lang in enumerate(rng.choices(["en", "fr"], k=40))]
    passage = "".join(sentence("en") for _ in range(8))
    benchmark = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows += [
        (50, "12 34 %%", "en"), (51, None, "en"), (52, "", "fr"),
        (60, rows[3][1], rows[3][2]), (61, rows[4][1] + "onemore word", rows[4][2]), (3, rows[3][1], rows[3][2]),
        (70, text("en") + passage + text("en"), "en"), (71, text("fr") + passage + text("fr"), "fr"),
        (72, passage, "en"), (80, text("en") + benchmark + " " + text("en"), "en"), (None, text("en"), None),
    ]
    full = [(i, t, lang, "src", len(t or "")) for i, t, lang in rows]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(
        3
    ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, benchmark)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), {r[0]: r[1] for r in rows}, passage


def test_stages(spark, corpus):
    folder, texts, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.store(stage(spark, docs, folder), f"test-{name}")
        assert docs.columns == NAMES
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.count() == len(seen[name]) + (name == "language")  # one row comes twice
    usual = {*range(40), None}
    assert set(seen["language"]) == usual | {60, 61, 70, 71, 72, 80}
    assert set(seen["near_copies"]) == usual | {70, 71, 72, 80}
    assert set(seen["repeated_passages"]) == usual | {70, 71, 80}
    assert seen["repeated_passages"][70] == texts[70] and len(seen["repeated_passages"][71]) < len(texts[71]) - 300
    assert all(seen["repeated_passages"][i] == texts[i] for i in usual)
    assert set(seen["benchmark_passages"]) == usual | {70, 71}
    lengths = {r["doc_id"]: r["n_chars"] for r in docs.collect()}
    assert all(lengths[i] == len(t) for i, t in seen["benchmark_passages"].items())


def test_run(spark, corpus):
    folder, _, _ = corpus
    found = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in found} == {*range(40), None, 70, 71}
    assert all(r["round_trip"] for r in found) and {r["rank"] for r in found} == {1, 2}
