"""JSON array files of any size, read by as many tasks as they have byte ranges.

Spark's reader takes an array file whole, because a range that begins somewhere in it does
not show whether it begins inside a string, nor how deep it is nested. Here the text reader
splits the file, at any `}`. A first pass notes for every chunk of a range how many
unescaped quotes it has (odd or even) and how its brackets change the depth, once if it
began outside a string and once if inside. A prefix over these notes, one narrow row a
chunk, settles which of the two holds everywhere. A second pass cuts the chunks into
records; only the pieces at their edges, at most two a chunk, are brought together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RECORD
from .batch import CORRUPT, POSITION
from .shared import ship_package, stored

CHUNK_BYTES = 1 << 20

_END = b"}"
_MARK = b"\xef\xbb\xbf"
_WEIGHT = np.zeros(256, np.int8)
_WEIGHT[list(b"{[")] = 1
_WEIGHT[list(b"}]")] = -1
_SPACE = rb"[ \t\r\n]*"
# What may stand before a record: the array's bracket, a comma, or nothing between objects
# that are in no array; and after the last record, the added end apart.
_FIRST = re.compile(rb"(?:\xef\xbb\xbf)?" + _SPACE + rb"\[" + _SPACE)
_NEXT = re.compile(_SPACE + b"," + _SPACE)
_LOOSE = re.compile(rb"(?:\xef\xbb\xbf)?" + _SPACE)
_CLOSE = re.compile(_SPACE + rb"\]" + _SPACE + rb"\}")
_CLOSE_EMPTY = re.compile(rb"(?:\xef\xbb\xbf)?" + _SPACE + rb"\[" + _SPACE + rb"\]" + _SPACE + rb"\}")
_CLOSE_LOOSE = re.compile(rb"(?:\xef\xbb\xbf)?" + _SPACE + rb"\}")

_CHUNK = "file string, block bigint, seq bigint, data binary"
_NOTES = "file string, block bigint, seq bigint, bytes bigint, odd int, outside bigint, inside bigint, root string"
_FOUND = "file string, block bigint, seq bigint, n bigint, kind int, bad boolean, text binary"
_RECORD, _HEAD, _MIDDLE, _TAIL = range(4)


def _pieces(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    lines = spark.read.option("lineSep", _END.decode()).text(paths if isinstance(paths, str) else list(paths))
    meta = F.col("_metadata")
    return lines.select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.col("value").cast("binary").alias("piece")
    )


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, int, int, bytes]]:
    """Runs of pieces of about `size` bytes, the separators put back. Where they end
    follows from the range alone."""
    place, seq, parts, filled = None, 0, [], 0
    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        for file, block, piece in zip(files, blocks, batch.column("piece").to_pylist()):
            if place != (file, block) or filled >= size:
                if parts:
                    yield *place, seq, _END.join(parts) + _END
                seq = seq + 1 if place == (file, block) else 0
                place, parts, filled = (file, block), [], 0
            parts.append(piece)
            filled += len(piece) + 1
    if parts:
        yield *place, seq, _END.join(parts) + _END


def _quotes(data: np.ndarray) -> np.ndarray:
    """Places of the quotes that no backslash escapes."""
    places = np.flatnonzero(data == 34)
    slashes = data == 92
    if not len(places) or not slashes.any():
        return places
    last = np.maximum.accumulate(np.where(slashes, -1, np.arange(len(data))))
    run = np.where(places > 0, places - 1 - last[places - 1], 0)
    return places[run % 2 == 0]


def _brackets(data: np.ndarray, quotes: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the brackets outside strings and what they do to the depth."""
    weight = _WEIGHT[data]
    places = np.flatnonzero(weight)
    places = places[(np.searchsorted(quotes, places) + inside) % 2 == 0]
    return places, weight[places]


def _note(size: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, seq, raw in _chunks(batches, size):
            data = np.frombuffer(raw, np.uint8)
            quotes = _quotes(data)
            change = [int(_brackets(data, quotes, inside)[1].sum(dtype=np.int64)) for inside in (0, 1)]
            root = None
            if block == 0 and seq == 0:
                root = raw.removeprefix(_MARK).lstrip(b" \t\r\n")[:1].decode("ascii", "replace")
            values = [file, block, seq, len(raw), len(quotes) % 2, *change, root]
            yield pa.RecordBatch.from_pydict(
                {name.split()[0]: [value] for name, value in zip(_NOTES.split(", "), values)},
                pa.schema([pa.field(n.split()[0], {"string": pa.string(), "int": pa.int32()}.get(n.split()[1], pa.int64())) for n in _NOTES.split(", ")]),
            )

    return make


def _gather(size: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, seq, raw in _chunks(batches, size):
            yield pa.RecordBatch.from_pydict({"file": [file], "block": [block], "seq": [seq], "data": [raw]})

    return make


def _states(notes: DataFrame) -> DataFrame:
    """Where every chunk starts (depth, in a string or not), and whether its file is whole."""
    file = Window.partitionBy("file")
    order = file.orderBy("block", "seq")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    base = F.when(F.first("root", ignorenulls=True).over(file) == "[", 1).otherwise(0)
    known = notes.withColumn("in_string", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).withColumn("base", base)
    known = known.withColumn("change", F.when(F.col("in_string") == 1, F.col("inside")).otherwise(F.col("outside")))
    last = F.lead("seq").over(order).isNull()
    known = known.select(
        "file", "block", "seq", "base", "in_string",
        F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
        F.sum("change").over(file).alias("final"),
        (F.sum("odd").over(file) % 2 == 1).alias("open_string"),
        last.alias("last"),
    )
    # The reader does not tell whether the last piece had its `}`; one is put there anyhow,
    # so after a closed array it is one too many.
    closed = (F.col("final") == -1) | ((F.col("base") == 0) & (F.col("final") == 0))
    return known.withColumn("whole", closed & ~F.col("open_string")).drop("final", "open_string")


def _cleaned(text: bytes, base: int, first: bool) -> tuple[bool, bytes]:
    """Whether what stands before the record is wrong, and the record."""
    before = (_FIRST if first else _NEXT) if base else _LOOSE
    found = before.match(text)
    if found is None or text[found.end() : found.end() + 1] != b"{":
        return True, text
    return False, text[found.end() :]


def _cut(edges: bool):
    """Chunks with their states to records, or to the pieces before the first and after
    the last record that ends in them."""

    def rows(chunk: dict) -> Iterator[tuple]:
        raw, base = chunk["data"], chunk["base"]
        data = np.frombuffer(raw, np.uint8)
        places, weight = _brackets(data, _quotes(data), chunk["in_string"])
        depth = chunk["depth"] + np.cumsum(weight, dtype=np.int64)
        ends = places[(depth == base) & (data[places] == 125)] + 1
        # The `}` at the end of a cut file may be the added one.
        doubtful = chunk["last"] and not chunk["whole"]
        if not len(ends):
            if edges:
                yield 0, _MIDDLE, False, raw
            return
        if edges:
            yield 0, _HEAD, bool(doubtful and ends[0] == len(raw)), raw[: ends[0]]
            if ends[-1] < len(raw):
                yield len(ends), _TAIL, False, raw[ends[-1] :]
            return
        for n, (start, end) in enumerate(zip(ends, ends[1:]), 1):
            bad, text = _cleaned(raw[start:end], base, False)
            yield n, _RECORD, bool(bad or (doubtful and end == len(raw))), text

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = batch.slice(i, 1).to_pylist()[0]
                yield _found(chunk["file"], chunk["block"], chunk["seq"], list(rows(chunk)))

    return make


def _found(file: str, block: int, seq: int, rows: list[tuple]) -> pa.RecordBatch:
    count = len(rows)
    n, kind, bad, text = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([file] * count, pa.string()), pa.array([block] * count, pa.int64()), pa.array([seq] * count, pa.int64()),
            pa.array(n, pa.int64()), pa.array(kind, pa.int32()), pa.array(bad, pa.bool_()), pa.array(text, pa.binary()),
        ],
        [part.split()[0] for part in _FOUND.split(", ")],
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edge pieces of one record, or of what stands after the last, to that record."""
    for batch in batches:
        for i in range(batch.num_rows):
            group = batch.slice(i, 1).to_pylist()[0]
            parts, base, first, whole = group["parts"], group["base"], group["number"] == 0, group["whole"]
            place = parts[0]
            text = b"".join(part["text"] for part in parts)
            if parts[-1]["kind"] == _HEAD:
                bad, text = _cleaned(text, base, first)
                bad = bad or parts[-1]["bad"]
                yield _found(group["file"], place["block"], place["seq"], [(place["n"], _RECORD, bad, text)])
                continue
            ending = (_CLOSE_EMPTY if first else _CLOSE) if base else _CLOSE_LOOSE
            if not whole or not ending.fullmatch(text):
                yield _found(group["file"], place["block"], place["seq"], [(place["n"], _RECORD, True, text)])


def read_array_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = RECORD,
    *,
    position: bool = False,
    on_error: str = "fail",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """JSON records of files that hold one array each (or objects one after the other), in
    UTF-8, with control characters tolerated: what ``read_records`` gives, with a task for
    every range of ``spark.sql.files.maxPartitionBytes``, not for every file.

    Files are read twice. The states of the chunks are stored first, one narrow row for
    each ``chunk_bytes``; files that end inside a record or string, or with a bracket too
    many, then fail. So do records that are no JSON and texts that do not belong between
    records, when they are read. With ``on_error="mark"`` such a text becomes a row with
    the text in ``_corrupt``; other than with ``read_records`` the good records of a broken
    file stay, and of a cut file the text after the last good record is the marked one.
    ``position`` adds the columns of ``POSITION``. A record has to fit in memory.
    """
    if on_error not in ("fail", "mark"):
        raise ValueError(f"on_error is fail or mark, not {on_error}")
    mark = on_error == "mark"
    ship_package(spark)
    pieces = _pieces(spark, paths)
    states = stored(_states(pieces.mapInArrow(_note(chunk_bytes), _NOTES)))
    if not mark:
        broken = [row["file"] for row in states.filter("last AND NOT whole").limit(5).collect()]
        if broken:
            raise ValueError(f"not whole JSON arrays: {', '.join(broken)}")

    keys = ["file", "block", "seq"]
    chunks = pieces.mapInArrow(_gather(chunk_bytes), _CHUNK).join(states, keys, "left")
    # Ranges that the first pass did not see cannot be read; the depth is null there.
    unknown = F.raise_error(F.lit("files or their ranges changed between two passes"))
    chunks = chunks.withColumn("depth", F.when(F.col("depth").isNull(), unknown.cast("bigint")).otherwise(F.col("depth")))
    records = chunks.mapInArrow(_cut(False), _FOUND)
    edges = chunks.mapInArrow(_cut(True), _FOUND).join(states.select(*keys, "base", "whole"), keys)
    order = Window.partitionBy("file").orderBy("block", "seq", "n")
    ended = (F.col("kind") == _HEAD).cast("long")
    number = F.coalesce(F.sum(ended).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.struct("block", "seq", "n", "kind", "bad", "text")
    groups = edges.withColumn("number", number).groupBy("file", "number", "base", "whole").agg(
        F.array_sort(F.collect_list(part)).alias("parts")
    )
    found = records.unionByName(groups.mapInArrow(_joined, _FOUND))
    return _parsed(found, schema, mark, position)


def _parsed(found: DataFrame, schema: T.StructType, mark: bool, position: bool) -> DataFrame:
    text = F.col("text").cast("string")
    if mark:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"allowUnquotedControlChars": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        nothing = F.struct(
            *[(text if field.name == CORRUPT else F.lit(None)).cast(field.dataType).alias(field.name) for field in schema.fields]
        )
        record = F.when(F.col("bad"), nothing).otherwise(F.from_json(text, schema, options))
    else:
        options = {"allowUnquotedControlChars": "true", "mode": "FAILFAST"}
        wrong = F.raise_error(F.concat(F.lit("no JSON record in "), "file", F.lit(": "), F.substring(text, 1, 200)))
        record = F.from_json(F.when(F.col("bad"), wrong.cast("string")).otherwise(text), schema, options)
    file, block, row = POSITION
    place = [
        F.col("file").alias(file), F.col("block").alias(block),
        (F.shiftleft("seq", 32) + F.col("n")).alias(row),
    ]
    parsed = found.select(record.alias("record"), *(place if position else []))
    return parsed.select("record.*", *(POSITION if position else []))
