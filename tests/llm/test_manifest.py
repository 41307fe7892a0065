"""The Merkle manifest against trees built by plain loops."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparrowscope.llm.manifest import _steps, _subtree, fold, manifest, verify

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, g int, part int, `row` int, k int"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lowered=False) -> str:
    doc_id, source, lang, n, text = row
    if lowered and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)]
    return sha("".join(parts))


def tree(leaves: list[str], fanout: int):
    """Root, and the steps (slot, siblings) of every leaf."""
    steps, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i in range(len(leaves)):
            start = at[i] // fanout * fanout
            run = nodes[start : start + fanout]
            steps[i].append((at[i] - start, run[: at[i] - start] + run[at[i] - start + 1 :]))
            at[i] //= fanout
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], steps


def plain(rows, fanout: int):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        groups[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = tree([leaf(r) for r in groups[source]], fanout)
    root, tops = tree([trees[s][0] for s in order], fanout)
    out = []
    for source, top in zip(order, tops):
        subroot, steps = trees[source]
        for row, own in zip(groups[source], steps):
            path = own + top
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded = fold(leaf(row, tampered), path)
            proof = sha("".join("".join(siblings) for _, siblings in path))
            out.append((row[0], leaf(row), subroot, root, proof, folded, folded == root))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, 4) for row in rows], DOCS).repartition(3)


def corpus(counts: dict) -> list[tuple]:
    rows, number = [], 0
    for source, count in counts.items():
        for _ in range(count):
            rows.append((number * 7 % 1009, source, None if number % 4 == 0 else "en", number, f"Text {number} É\n"))
            number += 1
    return rows


CASES = {
    "ragged": (corpus({"a": 29, "b": 1, "ä": 10, "": 3, None: 4}), 3, 1),
    "one source": (corpus({"only": 40}), 2, 2),
    "many sources": (corpus({f"s{i}": 1 + i % 3 for i in range(23)}), 3, 1),
    "one row": ([(5, None, None, None, None)], 16, 2),
    "repeats and nulls": (
        [(1, "x", "en", 3, "A b")] * 5 + [(None, "x", "en", 0, "")] * 2 + [(1, "x", "de", 3, "Z"), (2, "x", None, None, None)],
        3, 1,
    ),
    "long text": ([(i, "x", "en", None, "Long Wörd " * 40_000) for i in range(4)], 16, 2),
}


@pytest.mark.parametrize("case", CASES)
def test_against_plain_trees(spark, case):
    rows, fanout, levels = CASES[case]
    found = manifest(frame(spark, rows), fanout=fanout, levels=levels)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, found.collect())) == Counter(plain(rows, fanout))


def test_empty(spark):
    assert manifest(frame(spark, [])).collect() == []


def test_every_ragged_size(spark):
    """All numbers of partitions that need up to three rounds, each as a group of its own."""
    rows = [(i, f"n{n:02}", "en", i, str(i)) for n in range(1, 20) for i in range(n)]
    found = manifest(frame(spark, rows), fanout=2, levels=1)
    assert Counter(map(tuple, found.collect())) == Counter(plain(rows, 2))


def test_proofs_verify(spark):
    rows = corpus({"a": 20, "b": 2})
    proofs = manifest(frame(spark, rows), proofs=True, fanout=3, levels=1)
    assert verify(proofs).where("verified").count() == 22
    wrong = proofs.withColumn("leaf", F.sha2(F.concat("leaf", F.lit("?")).cast("binary"), 256))
    assert verify(wrong).where("verified").count() == 0
    nulls = proofs.withColumn("leaf", F.lit(None).cast("string"))
    assert verify(nulls).where("NOT verified").count() == 22


def test_block_steps():
    leaves = [sha(str(i)) for i in range(7)]
    levels = _subtree(leaves, False, 3, 9)
    root, steps = tree(leaves, 3)
    assert levels[-1] == [root]
    assert [_steps(levels, i, 3) for i in range(7)] == steps
    assert all(fold(h, s) == root for h, s in zip(leaves, steps))


def test_rounds_follow_the_logarithm(spark, monkeypatch):
    """Partitions acquire their upper proofs in log rounds, and no round holds more rows
    for a partition than the fanout."""
    import sparrowscope.llm.manifest as module

    sizes, swap = [], module._swap

    def counted(state, round_, fanout):
        out = swap(state, round_, fanout)
        sizes.append((state.count(), out.count()))
        return out

    monkeypatch.setattr(module, "_swap", counted)
    manifest(frame(spark, corpus({"a": 50})), fanout=2, levels=1).count()
    assert sizes == [(25, 25)] * 5
