"""Language identification: held-out accuracy, odd rows, nothing to learn from."""

from __future__ import annotations

import random

import numpy as np

from sparrowscope.llm import language

SYLLABLES = {
    "en": "the ing tion and er th wh ly", "de": "sch ung keit ein ü ä pf der", "fr": "eau é è tion ou le ê que",
    "es": "ción os ñ í do que ar ie", "xx": "zzq qqx xkk vvz qvx kzz",
}


def text(rng, lang):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(8, 60))).capitalize() + "."


def test_held_out_accuracy(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, text(rng, lang), lang) for i, lang in enumerate(rng.choices(list(SYLLABLES), k=600))]
    model = language.fit(docs_of(rows[:400]))
    assert set(model.languages) == {"germanic", "romance", "xx"}
    found = {r["doc_id"]: r for r in language.predict(docs_of(rows[400:], "score"), model).collect()}
    assert np.mean([found[i]["lang_pred"] == lang for i, _, lang in rows[400:]]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found.values())
    odd = [(1, None), (2, ""), (3, "12 &%"), (4, "é"), (None, text(rng, "de")), (5, text(rng, "fr") * 4000), (5, "x")]
    got = [(r["doc_id"], r["lang_pred"]) for r in language.predict(docs_of(odd), model).collect()]
    assert sorted(got, key=str)[:3] == [(1, "und"), (2, "und"), (3, "und")]
    assert (None, "de") in got and (5, "fr") in got and len(got) == 7
    kept = language.keep_determined(docs_of(odd, "lang_pred"), model)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["4", "5", "5", "None"]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "lang_pred"]


def test_blocks_count_like_one_text(monkeypatch):
    value = "Straße und Über " * 50
    whole = language.trigram_counts(value)
    monkeypatch.setattr(language, "_BLOCK", 7)
    assert (language.trigram_counts(value) == whole).all()


def test_signs_are_no_letters(docs_of):
    import sys
    import unicodedata

    for code in range(sys.maxunicode + 1):
        sign = chr(code)
        assert language.has_letter(sign) == unicodedata.category(sign).startswith("L")
    model = language.fit(docs_of([(1, "hello there"), (2, "le mot", "fr")]))
    texts = ["½ ² ① 12", "١٢", "_", "²" * 1000, "½a"]
    found = language.predict(docs_of(list(enumerate(texts))), model).collect()
    assert [r["lang_pred"] == "und" for r in sorted(found)] == [True, True, True, True, False]


def test_features_and_votes_against_plain_loops():
    for value in ("The Straße, of 12 cats\n", "", None, "ab", "éÉ zz"):
        kept = [32, *(value or "").lower().encode(), 32]
        kept = [b if b >= 128 or 97 <= b <= 122 else 32 for b in kept]
        expected = [0] * (1 << language.BITS)
        for i in range(len(kept) - 2):
            code = (kept[i] << 16) + (kept[i + 1] << 8) + kept[i + 2]
            expected[(code * 2654435761) % 2**32 >> (32 - language.BITS)] += 1
        assert language.trigram_counts(value).tolist() == expected
    rng = np.random.default_rng(4)
    names = ["a", "b", "c", "d"]
    for _ in range(50):
        x = rng.normal(size=6).astype(np.float32)
        pairs = [(i, j) for i in range(4) for j in range(i + 1, 4)]
        weights = rng.normal(size=(6, 7)).astype(np.float32)
        margins = [float(w[:-1] @ x + w[-1]) for w in weights]
        votes, sums = [0] * 4, [0.0] * 4
        for (i, j), margin in zip(pairs, margins):
            votes[i if margin >= 0 else j] += 1
            sums[i] += margin
            sums[j] -= margin
        best = sorted(range(4), key=lambda i: (-votes[i], -sums[i], i))[0]
        least = min(m if i == best else -m for (i, j), m in zip(pairs, margins) if best in (i, j))
        name, score = language.Machines(names, pairs, weights).predict(x)
        assert name == names[best] and abs(score - 1 / (1 + np.exp(-3 * least))) < 1e-6


def test_little_to_learn_from(docs_of):
    empty = docs_of([(1, "a")]).where("doc_id > 5")
    nothing = language.fit(empty)
    assert [tuple(r)[1:] for r in language.predict(docs_of([(1, "abc")]), nothing).collect()] == [("und", 0.0)]
    one = language.fit(docs_of([(1, "hello there"), (2, None), (3, "hi", None)]))
    assert [tuple(r)[1:] for r in language.predict(docs_of([(1, "abc")]), one).collect()] == [("en", 1.0)]
    assert language.predict(empty, one).collect() == []
