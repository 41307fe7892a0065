"""Suffix de-duplication against plain loops."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from sparrowscope.llm import suffixes


def plain(rows):
    order = lambda d: (d is not None, d or 0)
    least = {}
    for d, t in rows:
        data = (t or "").encode()
        for p in range(len(data) - 49):
            w = data[p : p + 50]
            if w not in least or order(d) < order(least[w]):
                least[w] = d
    out = []
    for d, t in rows:
        data = (t or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - 49):
            if order(least[data[p : p + 50]]) < order(d):
                gone[p : p + 50] = [True] * 50
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, docs=70):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choices("abé \n", k=n))
    shared = [noise(n) for n in (49, 50, 51, 60, 120, 300)] + ["x" * 200, "ab" * 90, "\x00" * 70]
    texts = []
    for _ in range(docs):
        t = noise(rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            t += s[a : rng.randint(a, len(s))] + noise(rng.randint(0, 60))
        texts.append(t)
    ids = rng.sample(range(1000), docs)
    rows = list(zip(ids, texts))
    return rows + [(2000, texts[0]), (2001, texts[0]), (2002, None), (2003, ""), (2004, "y" * 49), (2005, texts[3]),
                   (2005, texts[3]), (2005, texts[4] + texts[5]), (None, texts[6] + texts[7]), (2006, "z" * 500)]


@pytest.mark.parametrize("seed, bucket", [(1, 1 << 25), (2, 2000), (3, 700)])
def test_against_loops(spark, docs_of, seed, bucket):
    rows = corpus(seed)
    found = suffixes.remove_substrings(docs_of(rows, "mark"), bucket_bytes=bucket)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows)


def test_column_sort():
    rng = np.random.default_rng(5)
    table = rng.integers(0, 3, (200, 9)).astype(np.uint8)
    table[50:80] = table[:30]
    for c, (order, common) in zip(range(8, -1, -1), suffixes.sort_columns((table[:, k] for k in range(8, -1, -1)), 200)):
        tails = [bytes(table[k, c:]) for k in order]
        assert tails == sorted(tails)
        for a, b, n in zip(tails[:-1], tails[1:], common[1:]):
            assert n == next((k for k in range(len(a)) if a[k] != b[k]), len(a))


def test_empty_table(docs_of):
    assert suffixes.remove_substrings(docs_of([(1, "a")]).where("doc_id > 5")).collect() == []


@pytest.mark.parametrize("chunk", [60, 700, 1 << 22])
def test_segments_hold_every_string_once(monkeypatch, chunk):
    monkeypatch.setattr(suffixes, "CHUNK", chunk)
    texts = [t for _, t in corpus(4, 30)]
    seen, offsets = {}, {}
    for pieces in suffixes.pieces_of(texts):
        joined = b"".join(pieces.data)
        starts = np.cumsum([0] + [len(d) for d in pieces.data[:-1]])
        for piece, first, strings, anchor, value in zip(*suffixes.anchors_of(pieces)):
            for at in range(first, first + strings):
                place = (pieces.docs[piece], pieces.offsets[piece] + int(at - starts[piece]))
                assert place not in seen
                seen[place] = joined[at : at + 50]
                # equal strings have one anchor at one offset
                assert offsets.setdefault(joined[at : at + 50], (int(anchor - at), int(value))) == (int(anchor - at), int(value))
    expected = {(k, p): t.encode()[p : p + 50] for k, t in enumerate(t or "" for t in texts) for p in range(len(t.encode()) - 49)}
    assert seen == expected


def test_short_phrase_in_other_surroundings(spark, docs_of):
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    phrase, passage = noise(40), noise(90)
    rows = [(k, noise(70) + phrase + noise(70) + (passage + noise(60) if k % 3 == 0 else "")) for k in range(150)]
    rows += [(200 + k, noise(30) + rows[k][1][60:130] + noise(30)) for k in range(5)]
    docs = docs_of(rows)
    found = suffixes.remove_substrings(docs, bucket_bytes=6000)
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows)
    # no bucket gets all segments around the phrase
    seen = []
    tables = suffixes.Tables(spark)
    sorted_buckets = suffixes._sorted_buckets

    def spy(rows, buckets):
        packed = rows.where("bytes IS NOT NULL").select("bucket", "packed").collect()
        size = suffixes._SEGMENT.itemsize
        seen.extend(sum(len(r[1]) // size for r in packed if r[0] == b) for b in range(buckets))
        return sorted_buckets(rows, buckets)

    suffixes._sorted_buckets = spy
    try:
        texts = docs.selectExpr("doc_id AS id", "xxhash64(text) AS mark", "text")
        suffixes.repeated_ranges(texts, tables, 6000)
    finally:
        suffixes._sorted_buckets = sorted_buckets
    assert 0 < len(seen) and max(seen) < 100
