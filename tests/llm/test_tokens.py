"""Token archives: ids, offsets, damage, empty and odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparrowscope.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = list("aZé'sS.,!? \n\t \x1cΣİǅßẞÉ12<|>中🙂&#-_") + ["'S ", "'ll", "<|endoftext|>", "<|ENDOFTEXT|>", "don't. "]


def test_words_encode_like_whole_texts():
    random.seed(3)
    texts = ["".join(random.choices(ODD, k=random.randint(0, 60))) for _ in range(3000)]
    expected = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    for by_word in (True, False):
        found = tokens.encode_texts(PATH, texts, by_word)
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [e.ids for e in expected]


def _expected(rows):
    tokenizer, at, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("archive_bytes", [1, 500, 1 << 24])
def test_index(spark, docs_of, archive_bytes):
    rows = [(7, "Hello there, world."), (3, None), (1, ""), (3, "x " * 3000), (None, "no id"), (7, "Hello there, world.")]
    path = tokens.archive_folder(spark)
    tokens.write_archives(docs_of(rows, "ids"), path, PATH, end_id=2, by_word=True, archive_bytes=archive_bytes)
    found = sorted(map(tuple, tokens.token_index(spark, path).collect()), key=lambda r: r[1])
    assert found == _expected(rows)


def test_selective_read(spark, docs_of):
    path = tokens.archive_folder(spark)
    tokens.write_archives(docs_of([(i, f"text number {i}") for i in range(50)]), path, PATH)
    found = {r["doc_id"]: r["ids"] for r in tokens.read_documents(spark, path, wanted=[3, 44, 99]).collect()}
    tokenizer = Tokenizer.from_file(PATH)
    assert found == {i: tokenizer.encode(f"text number {i}").ids for i in (3, 44)}


def test_empty_table(spark, docs_of):
    path = tokens.archive_folder(spark)
    tokens.write_archives(docs_of([(1, "a")]).where("doc_id > 5"), path, PATH, end_id=2)
    assert tokens.token_index(spark, path).collect() == []


def test_damage_is_found():
    content = bytearray(tokens.build_archive([1, 2], [b"abcd" * 500, b"efgh" * 3]))
    archive = tokens.Archive(bytes(content))
    assert archive.ids == [1, 2] and archive.document(1) == b"efgh" * 3
    content[int(archive.at[3]) - 3] ^= 1
    damaged = tokens.Archive(bytes(content))
    assert damaged.document(0) == b"abcd" * 500
    with pytest.raises(Exception):
        damaged.document(1)
    with pytest.raises(ValueError):
        tokens.Archive(bytes(content[:-1]))
