"""Sentence spans against plain loops, and what stays untouched."""

from __future__ import annotations

import random

import numpy as np
import xxhash

from sparrowscope.llm import spans


def sentence(rng, n=6):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n)) + rng.choice([". ", "! ", ", ", ".\n"])


def plain(rows):
    """Remaining texts by loops over all spans."""
    parts, seen = {}, {}
    for doc_id, text in rows:
        data = (text or "").encode()
        bounds = spans.sentence_bounds(data).tolist()
        parts[doc_id] = (data, bounds)
        for at, end in enumerate(spans.span_ends(spans.sentence_bounds(data)).tolist()):
            seen.setdefault(data[bounds[at] : bounds[end]].rstrip(), []).append((doc_id, at, end))
    gone = {doc_id: set() for doc_id, _ in rows}
    for places in seen.values():
        for doc_id, at, end in sorted(places)[1:]:
            gone[doc_id] |= set(range(at, end))
    return {
        d: b"".join(data[b[k] : b[k + 1]] for k in range(len(b) - 1) if k not in gone[d]).decode()
        for d, (data, b) in parts.items()
    }


def test_against_loops(spark, docs_of):
    rng = random.Random(5)
    passages = ["".join(sentence(rng) for _ in range(9)) for _ in range(3)]
    rows = []
    for i in range(60):
        own = [sentence(rng) for _ in range(rng.randint(0, 12))]
        if rng.random() < 0.6:
            own.insert(rng.randint(0, len(own)), rng.choice(passages))
        rows.append((i, "".join(own)))
    rows += [(70, rows[3][1]), (71, rows[3][1]), (72, None), (73, ""), (74, "   "), (75, "a. b. c. d. e. a. b. c.")]
    rows += [(80, passages[0] + passages[1] + passages[0]), (81, " ".join(["word" + str(k) for k in range(400)])),
             (82, "start here " + " ".join(["word" + str(k) for k in range(400)]))]
    found = spans.remove_repeats(docs_of(rows, "at"), counts=True).collect()
    assert {r["doc_id"]: r["text"] or "" for r in found} == plain(rows)
    assert {r["doc_id"]: r["text"] for r in found}[72] is None
    assert all(r["at"] == 1 and r["lang"] == "en" for r in found)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[72]["n_sentences"] == 0 and by_id[81]["n_removed"] == 0
    assert len(by_id[82]["text"]) < 200 and len(by_id[71]["text"]) == 0 == len(by_id[70]["text"])


def test_repeated_rows_and_null_ids(spark, docs_of):
    rng = random.Random(6)
    text = "".join(sentence(rng) for _ in range(8))
    found = spans.remove_repeats(docs_of([(5, text), (5, text), (None, "x. " + text)])).collect()
    # the null id comes first; its text keeps everything
    assert sorted((r["doc_id"] or 0, r["text"]) for r in found) == [(0, "x. " + text), (5, ""), (5, "")]
    found = spans.remove_repeats(docs_of([(5, text), (5, text)])).collect()
    assert [r["text"] for r in found] == [text, text]


def test_empty_table(docs_of):
    empty = docs_of([(1, "a")]).where("doc_id > 5")
    assert spans.remove_repeats(empty).collect() == []


def test_bounds_cover_the_text():
    rng = random.Random(7)
    for _ in range(200):
        data = "".join(rng.choices("ab. !,\n\té", k=rng.randint(0, 400))).encode()
        bounds = spans.sentence_bounds(data)
        assert bounds[0] == 0 and bounds[-1] == len(data) and (bounds[1:] > bounds[:-1]).all()
    assert xxhash.xxh3_128_intdigest(b"") != 0


def test_passages_in_other_surroundings(spark, docs_of):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(3, 8)))
    words = lambda n: " ".join(word() for _ in range(n))
    signs = lambda n: "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(n))
    one_word = [" ".join([w] * 55) for w in ("na", "word", "lalala")]
    long_word = "".join(rng.choices("abcdefgh", k=400))
    # starts and ends inside sentences of less than 110 bytes in one text, of more in the other
    middle = [f"{words(14)}, {words(15)}, {words(14)}. {words(11)}" for _ in range(10)]
    cases = [(p, lambda: words(9) + " ", lambda: " " + words(9)) for p in one_word + middle]
    cases += [(p, lambda: words(40) + " ", lambda: " " + words(40) + ".") for p in middle]
    cases += [(p, lambda: words(9) + "\n", lambda: "\n" + words(9)) for p in [one_word[1], long_word]]
    cases += [(signs(120), lambda: signs(70), lambda: signs(70)), (signs(80), lambda: "\n", lambda: "\n" + signs(9))]
    for k, (passage, before, after) in enumerate(cases):
        rows = [(1, before() + passage + after()), (2, before() + passage + after())]
        found = {r["doc_id"]: r["text"] for r in spans.remove_repeats(docs_of(rows)).collect()} if k in (0, 3, 25, 26) else plain(rows)
        assert found[1] == rows[0][1] or passage in one_word  # these repeat within themselves
        # all but some words at both ends is gone
        assert len(rows[1][1].encode()) - len(found[2].encode()) > len(passage.encode()) - 2 * 13 * 8, passage


def test_cuts_are_near_and_local():
    rng = random.Random(9)
    for signs in ("ab ", "a ", "abcdefghijk      .,", "\u4e00\u4e01\u4e02", "\u4e00\u4e01 ab."):
        passage = "".join(rng.choices(signs, k=3000)).encode()
        found = []
        for _ in range(2):
            before = "".join(rng.choices(signs, k=rng.randint(0, 300))).encode()
            data = before + passage + "".join(rng.choices(signs, k=300)).encode()
            bounds = spans.sentence_bounds(data) - len(before)
            assert np.diff(bounds).max() < 400
            found.append(bounds[(bounds > 500) & (bounds < len(passage) - 500)].tolist())
        assert found[0] == found[1]


def test_sentence_ends_against_a_pattern():
    import re

    pattern = re.compile(rb"[.!?,;:]+[ \t\r\f\v]+|[ \t\r\f\v]*\n\s*")
    rng = random.Random(10)
    for _ in range(3000):
        data = bytes(rng.choices(b"ab. !,\n\t\r;", k=rng.randint(1, 40)))
        expected = {m.end() for m in pattern.finditer(data)}
        assert set(spans._sentence_ends(np.frombuffer(data, np.uint8)).tolist()) == expected, data


def test_texts_together_as_alone():
    rng = random.Random(12)
    texts = ["".join(rng.choices("ab. !,\n\té一", k=rng.choice([0, 1, 3, 20, 300]))).encode() for _ in range(200)]
    together = spans.all_spans(texts)
    past = 0
    for text, bounds, ends in zip(texts, together.bounds, together.ends):
        alone = spans.all_spans([text])
        assert (alone.bounds[0] == bounds).all() and (alone.ends[0] == ends).all()
        assert (alone.high == together.high[past : past + len(ends)]).all()
        assert (alone.low == together.low[past : past + len(ends)]).all()
        past += len(ends)
    assert past == len(together.high)


def test_equal_spans_have_equal_hashes(monkeypatch):
    """And others other ones; blocks change nothing."""
    rng = random.Random(13)
    texts = ["".join(rng.choices("ab. ,\n", k=rng.randint(100, 600))).encode() for _ in range(100)]
    found = spans.all_spans(texts)
    value, seen, at = {}, {}, 0
    for text, bounds, ends in zip(texts, found.bounds, found.ends):
        for begin, end in zip(bounds, bounds[ends]):
            key = (int(found.high[at]), int(found.low[at]))
            at += 1
            cut = text[begin:end].rstrip()
            assert value.setdefault(cut, key) == key and seen.setdefault(key, cut) == cut
    monkeypatch.setattr(spans, "_BLOCK", 50)
    again = spans.all_spans(texts)
    assert (again.high == found.high).all() and (again.low == found.low).all()


def test_any_columns(spark, docs_of):
    text = "One sentence of some length here. Another sentence of the same kind. A third one follows it now. "
    docs = docs_of([(1, text + "End a."), (2, text + "End b."), (3, None)])
    wide = docs
    for name in ("n_removed", "n_sentences", "__key", "__marks", "__row", "__id", "h", "at", "c0"):
        wide = wide.withColumn(name, spans.F.lit(5))
    kept = spans.remove_repeats(wide)
    assert kept.dtypes == wide.dtypes
    plain_kept = {r["doc_id"]: r["text"] for r in spans.remove_repeats(docs).collect()}
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == plain_kept
    assert {r["__marks"] for r in kept.collect()} == {5} and plain_kept[2] != text + "End b."
