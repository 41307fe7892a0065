"""Token ids as binary archives of independent zstandard frames.

An archive holds the documents of one id range in id order. Frame 0 is the directory
(the document ids), then one frame per document with its token ids as little-endian
unsigned 32-bit integers. A seek table in a skippable frame closes the file: sizes of
every frame and the low half of the XXH64 of its content. A reader finds a document
through directory and table and decompresses its frame alone.

The archives are written by Spark's own file writer, one row a file, so that a retried
task leaves no half file and any store that Spark can write to will do. That writer ends
each row with a line separator: the last four bytes of an archive, the magic number of
the seek table, are that separator.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparrowscope.llm.common import map_texts, store, utf8
from sparrowscope.sources.shared import fresh_path

# Fixed values of the seekable zstandard format.
SEEK_FRAME_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

LEVEL = 3
# Token bytes after which a new archive begins; a longer document has one of its own.
ARCHIVE_BYTES = 16 << 20
# Words whose ids a Python worker keeps.
CACHED_WORDS = 600_000

_DIRECTORY = np.dtype([("known", "u1"), ("doc_id", "<i8")])
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
_MAGIC = struct.pack("<I", SEEK_TABLE_MAGIC)


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_words: dict[bytes, bytes] = {}
_words_of: list[str] = []
_BREAKS = bytes.maketrans(b"\n", b" ")
# A letter, then the punctuation that ends the word.
_TRAILING = re.compile(rb"(.*[a-z])([!-&(-/:-@\[-`{-~]+)", re.DOTALL)
# Bytes of text whose words are looked up at a time.
_CHUNK = 8 << 20


def _byte_letters() -> dict[int, str]:
    """The visible character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


_BYTE_LETTERS = _byte_letters()


def _one_run(word: bytes) -> str | None:
    """The word as the model of a byte-level tokenizer sees it, if it is one run of
    lower-case letters in composed form; else null, for the whole tokenizer."""
    if word.isalpha():
        return word.decode()
    if len(word) > 1 and (text := word.decode()).isalpha() and text == text.lower():
        if unicodedata.is_normalized("NFC", text) and all(c in _LATIN for c in text):
            return "".join([_BYTE_LETTERS[byte] for byte in word])
    return None


# Letters without special casing rules: a to z and the small letters of Latin-1.
_LATIN = frozenset(map(chr, [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))


def _word_ids(tokenizer, words: list[bytes]) -> list[bytes]:
    """Ids of each word; of words not seen before, trailing punctuation is looked up on
    its own."""
    known = _words
    out = [*map(known.get, words)]
    missing = [k for k, ids in enumerate(out) if ids is None]
    cut = [_TRAILING.fullmatch(words[k]) for k in missing]
    parts = [match.groups() if match else (words[k],) for k, match in zip(missing, cut)]
    fresh = {part for group in parts for part in group if part not in known}
    model, byte_level, mixed = tokenizer.model, _is_byte_level(tokenizer), []
    for word in fresh:
        run = _one_run(word) if byte_level else None
        if run is None:
            mixed.append(word)
        else:
            known[word] = array("I", [token.id for token in model.tokenize(run)]).tobytes()
    found = tokenizer.encode_batch_fast([word.decode() for word in mixed], add_special_tokens=False)
    for word, encoding in zip(mixed, found):
        known[word] = array("I", encoding.ids).tobytes()
    for k, group in zip(missing, parts):
        if len(group) == 2:
            known[words[k]] = known[group[0]] + known[group[1]]
        out[k] = known[words[k]]
    return out


@cache
def _is_byte_level(tokenizer) -> bool:
    """Whether the model gets runs of letters as bytes written by visible characters."""
    stages = json.loads(tokenizer.to_str())
    split = json.dumps(stages["pre_tokenizer"])
    return '"ByteLevel"' in split and r"[\\p{L}]+" in split


def _encode_by_word(tokenizer, texts: list[bytes]) -> list[bytes]:
    """Split at spaces, encode the distinct words, put the ids together again."""
    lists = pc.split_pattern(pa.array(texts, pa.binary()), b" ")
    offsets, coded = lists.offsets.to_numpy(), lists.values.dictionary_encode()
    found = _word_ids(tokenizer, coded.dictionary.to_pylist())
    places = coded.indices.to_numpy()
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    ids = np.frombuffer(b"".join(found), "<u4")
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[places]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    joined = ids[np.repeat(starts[places] - ends[:-1], lengths) + np.arange(ends[-1])]
    bounds = ends[offsets]
    return [joined[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


def encode_texts(path: str, texts: list[str | None], by_word: bool) -> list[bytes]:
    """Ids of each text as little-endian 32-bit integers, without special tokens.

    With `by_word`, which is right for tokenizers that lower-case, drop white space and
    part letters from punctuation, every distinct word is encoded once and kept for the
    texts to come. Texts that may name a special token are encoded as a whole.
    """
    tokenizer = _tokenizer(path)
    whole = [k for k, t in enumerate(texts) if t and (not by_word or "<|" in t)]
    out = [b""] * len(texts)
    found = tokenizer.encode_batch_fast([texts[k] for k in whole], add_special_tokens=False)
    for k, encoding in zip(whole, found):
        out[k] = np.asarray(encoding.ids, "<u4").tobytes()
    if not by_word:
        return out
    rest = [k for k in range(len(texts)) if texts[k] and "<|" not in texts[k]]
    at = 0
    while at < len(rest):
        if len(_words) > CACHED_WORDS or _words_of != [path]:
            _words.clear()
            _words_of[:] = [path]
        chunk, size = [], 0
        while at + len(chunk) < len(rest) and size < _CHUNK:
            chunk.append(utf8(texts[rest[at + len(chunk)]]).lower().translate(_BREAKS))
            size += len(chunk[-1])
        for k, content in zip(rest[at : at + len(chunk)], _encode_by_word(tokenizer, chunk)):
            out[k] = content
        at += len(chunk)
    return out


def frame(content: bytes, packer: zstandard.ZstdCompressor) -> tuple[bytes, tuple[int, int, int]]:
    """A frame of its own and its seek table entry."""
    packed = packer.compress(content)
    return packed, (len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF)


def build_archive(ids: list[int | None], contents: list[bytes]) -> bytes:
    packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=True)
    directory = np.array([(i is not None, i or 0) for i in ids], _DIRECTORY).tobytes()
    frames = [frame(content, packer) for content in (directory, *contents)]
    table = np.array([entry for _, entry in frames], _ENTRY).tobytes()
    footer = struct.pack("<IB", len(frames), CHECKSUM_FLAG) + _MAGIC
    head = struct.pack("<II", SEEK_FRAME_MAGIC, len(table) + len(footer))
    return b"".join([*(packed for packed, _ in frames), head, table, footer])


class Archive:
    """Reads the seek table; documents are decompressed only when asked for."""

    def __init__(self, content: bytes):
        self.content = memoryview(content)
        if bytes(self.content[-4:]) != _MAGIC:
            raise ValueError("no seek table")
        frames, flags = struct.unpack("<IB", self.content[-9:-4])
        if flags != CHECKSUM_FLAG:
            raise ValueError("seek table without checksums")
        begin = len(content) - 9 - frames * _ENTRY.itemsize
        self.table = np.frombuffer(self.content[begin : len(content) - 9], _ENTRY)
        if struct.unpack("<II", self.content[begin - 8 : begin]) != (SEEK_FRAME_MAGIC, len(content) - begin):
            raise ValueError("broken seek table")
        self.at = np.concatenate([[0], np.cumsum(self.table["packed"], dtype=np.int64)])
        if self.at[-1] != begin - 8:
            raise ValueError("frames and seek table disagree")
        self._unpacker = zstandard.ZstdDecompressor()
        directory = np.frombuffer(self._read(0), _DIRECTORY)
        self.ids = [int(row["doc_id"]) if row["known"] else None for row in directory]

    def _read(self, k: int) -> bytes:
        entry = self.table[k]
        content = self._unpacker.decompress(
            self.content[self.at[k] : self.at[k + 1]], max_output_size=int(entry["size"])
        )
        if len(content) != entry["size"] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != entry["check"]:
            raise ValueError(f"frame {k} is damaged")
        return content

    def lengths(self) -> np.ndarray:
        """Token count of every document, from the table alone."""
        return self.table["size"][1:].astype(np.int64) // 4

    def document(self, k: int) -> bytes:
        return self._read(k + 1)


def write_archives(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = None,
    by_word: bool = False,
    archive_bytes: int = ARCHIVE_BYTES,
    id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode the texts and write archives in ascending id order below `path`.

    Null texts are empty and get the end id alone; null ids come first; rows with equal
    ids are documents of their own, ordered by text. An empty table gives no archive
    with content. Other columns are not read.
    """
    ending = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        contents: list[bytes] = []
        size = 0
        for batch in batches:
            encoded = encode_texts(tokenizer, batch.column(1).to_pylist(), by_word)
            for i, content in zip(batch.column(0).to_pylist(), encoded):
                ids.append(i)
                contents.append(content + ending)
                size += len(contents[-1])
                if size >= archive_bytes:
                    yield _row(build_archive(ids, contents))
                    ids, contents, size = [], [], 0
        if ids:
            yield _row(build_archive(ids, contents))

    def _row(archive: bytes) -> pa.RecordBatch:
        return pa.record_batch([pa.array([archive[:-4]], pa.binary())], names=["value"])

    rows = docs.select(docs[id].cast("bigint").alias("id"), docs[text].alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    archives = map_texts(ordered, run, "value binary", rows=1024).select(F.col("value").cast("string"))
    archives.write.option("encoding", "ISO-8859-1").option("lineSep", _MAGIC.decode("latin-1")).option(
        "maxRecordsPerFile", 1
    ).text(path)


def read_archives(
    spark: SparkSession,
    path: str,
    schema: str,
    rows: Callable[[Archive, Iterable[int]], dict[str, list]],
    wanted: Iterable[int] | None = None,
) -> DataFrame:
    """Rows of every archive: the columns that `rows` makes from an archive and the
    places of its documents (all, or those whose id is in `wanted`), after the number of
    the partition and of the file that wrote it."""
    chosen = None if wanted is None else frozenset(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, file, content in zip(*(column.to_pylist() for column in batch.columns)):
                if not content:
                    continue
                archive = Archive(content)
                places = [k for k, i in enumerate(archive.ids) if chosen is None or i in chosen]
                made = rows(archive, places)
                yield pa.record_batch(
                    [pa.array([part] * len(places), pa.int32()), pa.array([file] * len(places), pa.int32())]
                    + [pa.array(values) for values in made.values()],
                    names=["part", "file", *made],
                )

    name = F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)[^/]*$", 1)
    files = spark.read.format("binaryFile").load(path)
    files = files.select(
        name.cast("int").alias("part"),
        F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)[^/]*$", 2).cast("int").alias("file"),
        "content",
    )
    return map_texts(files, run, f"part int, file int, {schema}")


def _digest(archive: Archive, places: Iterable[int]) -> dict[str, list]:
    lengths = archive.lengths()
    before = np.concatenate([[0], np.cumsum(lengths)])
    places = list(places)
    return {
        "doc_id": pa.array([archive.ids[k] for k in places], pa.int64()),
        "before": pa.array([int(before[k]) for k in places], pa.int64()),
        "n_tokens": pa.array([int(lengths[k]) for k in places], pa.int64()),
        "ids_crc32": pa.array([zlib.crc32(archive.document(k)) for k in places], pa.int64()),
    }


def _content(archive: Archive, places: Iterable[int]) -> dict[str, list]:
    places = list(places)
    ids = [np.frombuffer(archive.document(k), "<u4").astype(np.int64) for k in places]
    return {
        "doc_id": pa.array([archive.ids[k] for k in places], pa.int64()),
        "ids": pa.array(ids, pa.list_(pa.int64())),
    }


def read_documents(spark: SparkSession, path: str, wanted: Iterable[int] | None = None) -> DataFrame:
    """doc_id and token ids of the documents asked for, or of all."""
    return read_archives(spark, path, "doc_id bigint, ids array<bigint>", _content, wanted).drop("part", "file")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document its length, checksum and the number of ids in all documents before
    it. The totals of the archives, a row per file, pass through the driver."""
    found = store(
        read_archives(
            spark, path, "doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint", _digest
        ),
        "token-index",
    )
    totals = found.groupBy("part", "file").agg(F.sum("n_tokens").alias("n")).collect()
    starts, at = [], 0
    for row in sorted(totals, key=lambda r: (r["part"], r["file"])):
        starts.append((row["part"], row["file"], at))
        at += row["n"]
    offsets = spark.createDataFrame(starts, "part int, file int, offset bigint")
    return found.join(F.broadcast(offsets), ["part", "file"]).select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def archive_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "token-archives")
