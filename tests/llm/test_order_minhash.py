"""Order MinHash against plain loops."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from sparrowscope.llm.order_minhash import as_text, compare_with_edited, fingerprints, with_signatures

DOCS = "doc_id bigint, text string, id int, mark string, own int, part int"


def xx(values: list[int], seed: int = 42) -> int:
    for value in values:
        seed = xxhash.xxh64_intdigest((value & (1 << 64) - 1).to_bytes(8, "little"), seed)
    return seed


def numbered(text: str) -> list[tuple[int, int]]:
    """(hash, place) of the k-mers, numbered by occurrence."""
    tokens = [xxhash.xxh64_intdigest(t.encode(), 42) for t in re.findall(r"[^\x20\x09-\x0D]{1,12}", text or "")]
    if not tokens:
        return []
    runs = [tokens] if len(tokens) < 3 else [tokens[i : i + 3] for i in range(len(tokens) - 2)]
    seen, out = Counter(), []
    for place, run in enumerate(runs, 1):
        value = xx(run) >> 24 & (1 << 39) - 1
        seen[value] += 1
        if seen[value] > 1:
            number = xxhash.xxh64_intdigest(seen[value].to_bytes(4, "little"), xx([value]))
            value = number >> 24 & (1 << 39) - 1
        out.append((value, place))
    return out


def plain(text: str | None) -> str:
    kmers = numbered(text)
    if not kmers:
        return "00000000" * 64
    out = []
    for j in range(64):
        start = j << 33  # 2 ** 39 / 64 apart
        chosen = sorted(kmers, key=lambda k: ((k[0] - start) % (1 << 39), k[1]))[:2]
        in_order = [value for value, _ in sorted(chosen, key=lambda k: k[1])]
        out.append(f"{xx(in_order) >> 33:08x}")
    return "".join(out)


def near(a: str, b: str) -> float:
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, 512, 8)) / 64


def compared(rows):
    """All result rows; `rows` have distinct ids or are equal."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    prints = {r: plain(r[1]) for r in order}
    results = {}
    for row, after in zip(order, order[1:] + order[:1]):
        text, following = row[1] or "", after[1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        results[row] = (
            row[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[row], plain(edited),
            near(prints[row], plain(edited)), near(prints[row], prints[after]),
        )
    return Counter(results[row] for row in rows)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*row, 1, "m", 2, 3) for row in rows], DOCS).repartition(parts)


def prose(number: int, seed: int) -> str:
    choose = random.Random(seed)
    return " ".join(choose.choice(["wind", "Straße", "a", "日本語の文字がここに続きます", "x\ny", "incomprehensibilities"]) for _ in range(number))


CASES = {
    "words": [(i * 3 % 17, prose(5 * i, i)) for i in range(17)],
    "empty and short": [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (6, "one two three"), (None, "null id here")],
    "repeats": [(1, "a b c " * 40), (2, "a b c " * 41), (3, "same same same same same"), (4, "a b c " * 40)],
    "repeated rows": [(1, "some text that stands twice"), (2, "another text of words")] * 3,
    "one row": [(7, "alone in this table of one row")],
    "very long": [(1, prose(60_000, 1)), (2, "z" * 300_000), (3, prose(10, 2))],
    "same text": [(i, "a text that all of them share, word for word") for i in range(9)],
}


@pytest.mark.parametrize("case", CASES)
def test_against_plain_loops(spark, case):
    rows = CASES[case]
    found = compare_with_edited(frame(spark, rows))
    assert found.columns == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ]
    assert Counter(map(tuple, found.collect())) == compared(rows)
    prints = fingerprints(frame(spark, rows)).collect()
    assert Counter(map(tuple, prints)) == Counter((i, plain(t)) for i, t in rows)


def test_empty_table(spark):
    assert compare_with_edited(frame(spark, [])).collect() == []
    assert fingerprints(frame(spark, [])).collect() == []


def test_one_id_with_several_texts(spark):
    rows = [(1, "first text of the id"), (1, "second text of the id"), (2, "the other one")]
    found = compare_with_edited(frame(spark, rows)).collect()
    assert Counter(r["doc_id"] for r in found) == {1: 2, 2: 1}
    assert {r["fingerprint"] for r in found} == {plain(t) for _, t in rows}


def test_order_matters(spark):
    """The same k-mers in another order are less alike, unlike with plain MinHash."""
    choose = random.Random(1)
    blocks = [" ".join(f"w{choose.randrange(10**6)}" for _ in range(8)) for _ in range(40)]
    turned = list(reversed(blocks))
    edited = blocks[:38] + ["quite other words stand here now and there"] * 2
    texts = [" ".join(b) for b in (blocks, turned, edited)]
    same, moved, changed = (r["fingerprint"] for r in fingerprints(frame(spark, list(enumerate(texts)), 1)).collect())
    assert near(same, moved) < 0.6 < 0.8 < near(same, changed)


def test_plan_is_native(spark):
    plan = with_signatures(frame(spark, [(1, "a b c d")]), "text", "sig").select(as_text(F.col("sig")))
    text = plan._jdf.queryExecution().toString()
    full = compare_with_edited(frame(spark, [(1, "a b c d"), (2, "e f g h")]))._jdf.queryExecution().toString()
    for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text and word not in full
