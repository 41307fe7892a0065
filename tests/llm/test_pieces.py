"""Sampling of segmentations against full enumeration, decoding, odd rows."""

from __future__ import annotations

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from sparrowscope.llm import pieces
from sparrowscope.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab():
    return pieces.vocabulary(MODEL)


def segmentations(vocab, text):
    """Every segmentation of a short text and its probability, by recursion."""
    data = b" " + text.encode()
    known = {p: k for k, p in enumerate(vocab.pieces) if p and k not in set(vocab.byte_id.tolist())}
    out = {}

    def go(at, ids, log):
        if at == len(data):
            out[tuple(ids)] = log
            return
        for end in range(at + 1, len(data) + 1):
            k = known.get(data[at:end])
            if k is not None:
                go(end, [*ids, k], log + vocab.share[k])
        char = data[at:].decode()[0].encode()
        if char not in known:
            go(at + len(char), [*ids, *vocab.byte_id[list(char)]], log + len(char) * vocab.byte_share)

    go(0, [], 0.0)
    total = math.log(sum(map(math.exp, out.values())))
    return {ids: log - total for ids, log in out.items()}


def sampled(vocab, texts, keys, k=2, seed=1):
    made = pieces.sample_texts(vocab, texts, keys, k, seed)
    return [[(tuple(pieces.path_ids(vocab, s.lattice, p, d).tolist()), p) for p in s.paths] for s, d in made]


@pytest.mark.parametrize("text", ["them", "the on", "a\nb \U0001f642x", "é1", "Queßü."])
def test_log_probabilities(vocab, text):
    expected = segmentations(vocab, text)
    for paths in sampled(vocab, [text] * 40, [b"%d" % i for i in range(40)], k=4):
        assert len({ids for ids, _ in paths}) == len(paths) == min(4, len(expected))
        values = [p.value for _, p in paths]
        assert values == sorted(values, reverse=True)
        for ids, path in paths:
            assert abs(path.log - expected[ids]) < 1e-9
            assert pieces.decode(vocab, np.array(ids)) == text


def test_draws_without_replacement(vocab):
    expected = segmentations(vocab, "them")
    n = 6000
    made = sampled(vocab, ["them"] * n, [b"%d" % i for i in range(n)], k=2)
    first, pairs = Counter(p[0][0] for p in made), Counter((p[0][0], p[1][0]) for p in made)
    for ids, log in expected.items():
        p = math.exp(log)
        assert abs(first[ids] - n * p) < 5 * math.sqrt(n * p * (1 - p)) + 3
        for other, log2 in expected.items():
            if other != ids:
                q = p * math.exp(log2) / (1 - p)
                assert abs(pairs[ids, other] - n * q) < 5 * math.sqrt(n * q) + 4
    # 1 / inclusion weighs samples without bias: the sum over all segmentations is 1.
    total = np.mean([sum(math.exp(p.log - p.inclusion) for _, p in paths) for paths in made])
    assert abs(total - 1) < 0.05


def test_texts_with_few_segmentations(vocab):
    made = sampled(vocab, ["", None, "\U0001f642", "\n\n"], [b"1", b"2", b"3", b"4"], k=6)
    assert [len(p) for p in made[:2]] == [1, 1] and made[0][0][0] == ()
    for text, paths in zip(["\U0001f642", "\n\n"], made[2:]):
        expected = segmentations(vocab, text)
        assert {ids for ids, _ in paths} <= set(expected) and len(paths) == min(6, len(expected))
        if len(expected) <= 6:
            assert all(p.inclusion == 0 for _, p in paths)


def test_results_do_not_depend_on_company(vocab):
    texts = ["Is and retitioning ouen the of", "them " * 500, "", "x" * 3000, "ñandú\t中文"]
    keys = [b"a", b"b", b"c", b"d", b"e"]
    together = sampled(vocab, texts, keys, k=3)
    alone = [sampled(vocab, [t], [k], k=3)[0] for t, k in zip(texts, keys)]
    assert [[ids for ids, _ in p] for p in together] == [[ids for ids, _ in p] for p in alone]
    again = sampled(vocab, texts, keys, k=3, seed=2)
    assert [p[0][0] for p in again[:2]] != [p[0][0] for p in together[:2]]


def test_rows(spark, docs_of):
    rows = [(1, "Hello there"), (1, "Hello there"), (2, None), (3, ""), (None, "x y"), (4, "ab " * 60_000)]
    found = pieces.encode(docs_of(rows, "rank"), MODEL).collect()
    assert Counter((r["doc_id"], r["rank"]) for r in found) == {
        (1, 1): 2, (1, 2): 2, (2, 1): 1, (3, 1): 1, (None, 1): 1, (None, 2): 1, (4, 1): 1, (4, 2): 1}
    assert all(r["round_trip"] and r["n_ids"] == len(r["ids"]) and r["log_prob"] <= 1e-9 for r in found)
    ones = [tuple(r["ids"]) for r in found if r["doc_id"] == 1]
    assert len(set(ones)) == 2
    assert pieces.encode(docs_of(rows).where("doc_id > 9"), MODEL, with_ids=False).collect() == []


def test_decode_operator(spark, docs_of):
    model = public_tokenizers.path("piece_bpe_32k.model")
    vocab = pieces.vocabulary(model)
    texts = {1: "Plain words, and more.", 2: " two  spaces ", 3: "日本語 \U0001f600 \x07", 4: "", 5: None, 6: "x\n\ty" * 3000}
    encoded = pieces.encode(docs_of(list(texts.items())), model)
    found = pieces.decode_ids(encoded, model).collect()
    assert {r["doc_id"] for r in found} == set(texts)
    assert all(r["text"] == (texts[r["doc_id"]] or "") for r in found)
    a = vocab.pieces.index(b"a")
    odd = [(1, None), (2, []), (3, [a, None, a]), (4, [a, -1, len(vocab.pieces), 10**6]), (5, [int(vocab.byte_id[0xFF]), a]),
           (6, [int(b) for b in vocab.byte_id[list("é".encode())]]), (7, [1, a, 2])]
    rows = spark.createDataFrame([(*row, "old", 3) for row in odd], "k int, ids array<bigint>, text string, place int")
    got = {r["k"]: r["text"] for r in pieces.decode_ids(rows, model).collect()}
    mark = "\ufffd"
    assert got == {1: None, 2: "", 3: f"a{mark}a", 4: f"a{mark * 3}", 5: f"{mark}a", 6: "é", 7: got[7]} and "a" in got[7]
    assert pieces.decode_ids(rows, model).columns == ["k", "ids", "place", "text"]
    assert pieces.decode_ids(rows.where("k > 99"), model).collect() == []


def batches_of(rows, size):
    for at in range(0, len(rows), size):
        ids, texts = zip(*rows[at : at + size])
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_chunks(monkeypatch, size):
    monkeypatch.setattr(pieces, "CHUNK", 100)
    monkeypatch.setattr(pieces, "ROWS", 5)
    random.seed(3)
    texts = [random.choice([None, "", "ab", "\u65e5\u672c" * 8, "x" * 60, "y" * 500]) for _ in range(200)]
    rows = [(k if k % 9 else None, text) for k, text in enumerate(texts)] + [(k, None) for k in range(12)]
    made = list(pieces.chunks(batches_of(rows, size)))
    assert [row for ids, texts in made for row in zip(ids, texts, strict=True)] == rows
    for _, texts in made:
        assert 1 <= len(texts) <= 5
        assert sum(len(t.encode()) for t in texts if t) <= 100 or len(texts) == 1
    assert list(pieces.chunks(iter([]))) == []


def test_memory_of_a_worker(vocab):
    """Lattices of a batch of many texts; 151 MB with chunks of 3 MB."""
    random.seed(4)
    words = ["".join(random.choices("abcdefghijklmnop", k=random.randint(3, 12))) for _ in range(20_000)]
    rows = [(k, " ".join(random.choices(words, k=300))) for k in range(1200)]
    most = 0
    for ids, texts in pieces.chunks(batches_of(rows, len(rows))):
        tracemalloc.start()
        pieces.sample_texts(vocab, texts, [b"%d" % i for i in ids], pieces.SAMPLES, 1)
        most = max(most, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert most < 100 << 20


def test_digests_come_from_the_ids(spark, docs_of):
    rows = spark.createDataFrame(
        [(1, [7, 8, 40_000], 9), (1, [7, 8, 40_000], 9), (2, [], 9), (3, None, 9), (None, [8, 7], 9)],
        "doc_id bigint, ids array<int>, n_ids bigint").repartition(2)
    crc = lambda *ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    found = pieces.digests(rows)
    assert Counter(map(tuple, found.select("doc_id", "n_ids", "ids_crc32").collect())) == {
        (1, 3, crc(7, 8, 40_000)): 2, (2, 0, 0): 1, (3, None, None): 1, (None, 2, crc(8, 7)): 1}
    assert pieces.digests(rows.where("doc_id > 9")).collect() == []


def test_query_makes_the_segmentations(spark, docs_of, tmp_path, monkeypatch):
    texts = {1: "Hello there, you.", 2: "日本語 \U0001f600", 3: "", 4: None, 5: "ab " * 3000}
    docs_of(list(texts.items())).write.parquet(str(tmp_path / "documents.parquet"))
    made, encode = [], pieces.encode
    monkeypatch.setattr(pieces, "encode", lambda *a, **b: made.append(encode(*a, **b)) or made[-1])
    found = {(r["doc_id"], r["rank"]): r for r in QUERIES["op2_pieces"](spark, str(tmp_path)).collect()}
    decoded = pieces.decode_ids(made[0], MODEL).collect()
    assert len(decoded) == len(found) and {r["doc_id"] for r in decoded} == set(texts)
    for r in decoded:
        mine, ids = found[r["doc_id"], r["rank"]], np.array(r["ids"], "<u4")
        assert r["text"] == (texts[r["doc_id"]] or "") and mine["round_trip"]
        assert (mine["n_ids"], mine["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
