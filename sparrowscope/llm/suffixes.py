"""Exact substring de-duplication by column-wise suffix sorting.

A byte goes when a string of LENGTH bytes that covers it also starts in a document with a
smaller id. Strings are brought together by anchors: of the grams in a string, the one
with the smallest hash, the leftmost of equals. Equal strings have equal anchors at equal
offsets. All strings around one anchor are a segment of the text.

1. Anchors of all documents are dealt by hash, counted beforehand per document; those of
   one document only are put aside, and so are hot ones, whose segments would overfill a
   bucket (SEGMENT_BYTES each, BUCKET_BYTES in all).
2. The segments of the other anchors are dealt by anchor. Of equal segments of a batch
   only the one of the smallest id travels, the others are decided on the spot.
3. The segments of a bucket, lined up at their anchors, are sorted by their suffixes. The
   construction goes column by column from the right: each round reads the next column
   from a file and puts one symbol before every segment's suffix, updates the suffix order
   and the common prefixes of neighbours, both in memory; no transform is formed. Neighbours
   with LENGTH bytes in common hold equal strings, and the smallest id decides.
4. Strings of hot anchors are dealt once more, one by one by their hash, and the smallest
   id of each decides. Of equal strings of a batch only those of the smallest id travel.

Everything of steps 1 to 3 that travels is packed: a row for each batch of texts and bucket, and on the
way back for each bucket and group of documents. Work and memory of a bucket or group
follow BUCKET_BYTES, and their number follows the input.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from sparrowscope.llm.common import Tables, map_texts, mix64, utf8

LENGTH = 50
GRAM = 26
# Grams in a string: as many offsets can an anchor have.
OFFSETS = LENGTH - GRAM + 1
BUCKET_BYTES = 32 << 20
# About what a segment takes while a bucket is sorted.
SEGMENT_BYTES = 256
# Bytes of text handled at a time; longer texts come in pieces. Places take 24 bits.
CHUNK = 4 << 20
_NO_ID = -(1 << 63)
_PLACE = np.uint64((1 << 24) - 1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """Consecutive pieces of documents: number of the document, offset in it, bytes."""

    docs: list[int]
    offsets: list[int]
    data: list[bytes]


def pieces_of(texts: list[str | None]) -> Iterator[Pieces]:
    """Pieces of about CHUNK bytes; a string lies whole in exactly one piece."""
    made, size = Pieces([], [], []), 0
    for number, text in enumerate(texts):
        data = utf8(text)
        for at in range(0, len(data) - LENGTH + 1, CHUNK):
            part = data[at : at + CHUNK + LENGTH - 1]
            made.docs.append(number)
            made.offsets.append(at)
            made.data.append(part)
            size += len(part)
            if size >= CHUNK or len(made.docs) >= 60_000:
                yield made
                made, size = Pieces([], [], []), 0
    if made.docs:
        yield made


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every place, by doubling: 26 = 16 + 8 + 2."""
    with np.errstate(over="ignore"):
        power, step, spans = _FACTOR, 1, {1: data.astype(np.uint64) + np.uint64(1)}
        factors = {1: _FACTOR}
        while step < 16:
            short = spans[step]
            spans[2 * step] = short[:-step] * power + short[step:]
            power = power * power
            step *= 2
            factors[step] = power
        n = len(data) - GRAM + 1
        out = spans[16][:n] * factors[8] + spans[8][16 : 16 + n]
        return mix64(out * factors[2] + spans[2][24 : 24 + n])


def anchors_of(pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per segment: piece, first string, number of strings, anchor place (places in the
    joined bytes) and the hash of the anchor."""
    joined = np.frombuffer(b"".join(pieces.data), np.uint8)
    hashes = _gram_hashes(joined)
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    two = np.minimum(keys[:-1], keys[1:])
    four = np.minimum(two[:-2], two[2:])
    eight = np.minimum(four[:-4], four[4:])
    least = np.minimum(eight[:-8], eight[8:])
    least = np.minimum(least[: len(keys) - OFFSETS + 1], least[OFFSETS - 16 :])
    place = (least & _PLACE).astype(np.int64)
    ends = np.cumsum([len(d) for d in pieces.data])
    starts = np.concatenate([[0], ends[:-1]])
    piece = np.repeat(np.arange(len(ends)), [len(d) for d in pieces.data])[: len(place)]
    valid = np.arange(len(place)) + LENGTH <= ends[piece]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(new & valid)
    # Strings of one anchor stand side by side up to the next anchor or the piece's end.
    last = np.minimum(np.concatenate([first[1:], [len(place)]]), ends[piece[first]] - LENGTH + 1)
    anchor = place[first]
    return piece[first], first, last - first, anchor, mix64(hashes[anchor] + _FACTOR)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _print(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.uint32)


def _anchor_rows(rows: DataFrame, buckets: int) -> DataFrame:
    """Step 1, sending: per batch and bucket the documents, and each anchor's document,
    fingerprint and number of segments there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for pieces in pieces_of(batch.column(2).to_pylist()):
                piece, _, _, _, hashes = anchors_of(pieces)
                number = np.array(pieces.docs)[piece]
                used, local = np.unique(number, return_inverse=True)
                keys = (local.astype(np.uint64) << np.uint64(32)) | _print(hashes)
                _, key, counts = np.unique(keys, return_index=True, return_counts=True)
                local, hashes, counts = local[key].astype(np.uint16), hashes[key], counts.astype(np.uint32)
                bucket = _bucket(hashes, buckets)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                who, what = ids[used].tobytes(), marks[used].tobytes()
                rows = [
                    (b, who, what, local[part].tobytes(), _print(hashes[part]).tobytes(), counts[part].tobytes())
                    for b in range(buckets)
                    if len(part := order[edges[b] : edges[b + 1]])
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32())]
                    + [pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 6)],
                    names=["bucket", "ids", "marks", "docs", "prints", "counts"],
                )

    return map_texts(rows, run, "bucket int, ids binary, marks binary, docs binary, prints binary, counts binary")


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one bucket after another, from batches sorted by bucket."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if held and held[-1][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _shared_prints(rows: DataFrame, buckets: int, most: int) -> DataFrame:
    """Step 1, deciding: per document the fingerprints of anchors that other documents
    have as well, apart for those with more than `most` segments (hot)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _by_bucket(batches):
            ids = [np.frombuffer(r[1], np.int64) for r in held]
            docs = [np.frombuffer(r[3], np.uint16) for r in held]
            prints = [np.frombuffer(r[4], np.uint32) for r in held]
            known = np.unique(np.concatenate(ids))
            owner = np.concatenate([np.searchsorted(known, i)[d] for i, d in zip(ids, docs)])
            every = np.concatenate(prints)
            key = (every.astype(np.uint64) << np.uint64(32)) | owner.astype(np.uint64)
            key.sort()
            key = key[np.concatenate([[True], key[1:] != key[:-1]])] >> np.uint64(32)
            shared = key[1:][key[1:] == key[:-1]].astype(np.uint32)
            shared = shared[np.concatenate([[True], shared[1:] != shared[:-1]])] if len(shared) else shared
            del key, every, owner
            found, places, sums = [], [], np.zeros(len(shared), np.int64)
            for r, i, d, p in zip(held, ids, docs, prints):
                at = np.searchsorted(shared, p)
                kept = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == p) if len(shared) else at[:0]
                made = np.zeros(len(kept), _PRINT)
                made["id"], made["mark"] = i[d[kept]], np.frombuffer(r[2], np.int64)[d[kept]]
                made["print"] = p[kept]
                found.append(made)
                places.append(at[kept])
                np.add.at(sums, at[kept], np.frombuffer(r[5], np.uint32)[kept])
            table, hot = np.concatenate(found), (sums > most)[np.concatenate(places)]
            for is_hot in (False, True):
                made = _group_rows(table[hot == is_hot], buckets)
                yield made.append_column("hot", pa.array([is_hot] * made.num_rows, pa.bool_()))

    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return map_texts(dealt, run, "group bigint, packed binary, hot boolean")


# What goes back to documents: a shared fingerprint, or a range of bytes to remove.
_PRINT = np.dtype([("id", "<i8"), ("mark", "<i8"), ("print", "<u4")])
_RANGE = np.dtype([("id", "<i8"), ("mark", "<i8"), ("begin", "<i8"), ("end", "<i8")])


def _group_rows(table: np.ndarray, groups: int) -> pa.RecordBatch:
    """A packed row for each group of documents."""
    group = np.mod(table["id"] ^ table["mark"], groups)
    order = np.lexsort((table["mark"], table["id"], group))
    edges = np.searchsorted(group[order], np.arange(groups + 1))
    packer = zstandard.ZstdCompressor(level=3)
    rows = [
        (g, packer.compress(table[order[edges[g] : edges[g + 1]]].tobytes()))
        for g in range(groups)
        if edges[g] < edges[g + 1]
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
        names=["group", "packed"],
    )


def _of_documents(packed: pa.Table, kind: np.dtype) -> dict[tuple[int, int], np.ndarray]:
    """The unpacked rows of a group by document."""
    unpacker = zstandard.ZstdDecompressor()
    blobs = [unpacker.decompress(blob) for blob in packed.column("packed").to_pylist()]
    table = np.concatenate([np.zeros(0, kind), *(np.frombuffer(blob, kind) for blob in blobs)])
    table = table[np.lexsort((table["mark"], table["id"]))]
    new = np.ones(len(table) + 1, bool)
    new[1:-1] = (table["id"][1:] != table["id"][:-1]) | (table["mark"][1:] != table["mark"][:-1])
    edges = np.flatnonzero(new)
    return {
        (int(table["id"][a]), int(table["mark"][a])): table[a:b] for a, b in zip(edges[:-1], edges[1:]) if a < b
    }


def _group(groups: int):
    return F.pmod(F.col("id").bitwiseXOR(F.col("mark")), F.lit(groups)).alias("group")


# A segment that travels: id, mark, offset of the anchor in the text, columns before the
# anchor, number of strings, hash of content and columns, length of the bytes.
_SEGMENT = np.dtype(
    [("id", "<i8"), ("mark", "<i8"), ("anchor", "<i8"), ("content", "<u8"), ("before", "u1"), ("strings", "u1")]
)


def _found_segments(texts: pa.Table, packed: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """Per batch of a group's documents the segments of the anchors in `packed` (content not
    filled in), the place of their first string in the joined bytes, the anchors' hashes
    and the joined bytes."""
    shared = _of_documents(packed, _PRINT)
    ids, marks = texts.column("id").to_numpy(), texts.column("mark").to_numpy()
    rows = [k for k, key in enumerate(zip(ids.tolist(), marks.tolist())) if key in shared]
    for at in range(0, len(rows), 256):
        part = rows[at : at + 256]
        wanted = [np.unique(shared[int(ids[k]), int(marks[k])]["print"]) for k in part]
        values = texts.column("text").take(pa.array(part)).to_pylist()
        # Nothing of a batch is held here while the next one is made.
        yield from filter(None, (_wanted_segments(pieces, ids[part], marks[part], wanted) for pieces in pieces_of(values)))


def _wanted_segments(pieces: Pieces, ids: np.ndarray, marks: np.ndarray, wanted: list[np.ndarray]) -> tuple | None:
    piece, first, strings, anchor, hashes = anchors_of(pieces)
    number = np.array(pieces.docs)[piece]
    prints = _print(hashes)
    keep = np.zeros(len(prints), bool)
    edges = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1], [True]]))
    for a, b in zip(edges[:-1], edges[1:]):
        keep[a:b] = np.isin(prints[a:b], wanted[number[a]])
    kept = np.flatnonzero(keep)
    if not len(kept):
        return None
    starts = np.cumsum([0] + [len(d) for d in pieces.data[:-1]])
    shift = np.array(pieces.offsets) - starts
    table = np.zeros(len(kept), _SEGMENT)
    table["id"], table["mark"] = ids[number[kept]], marks[number[kept]]
    table["anchor"] = anchor[kept] + shift[piece[kept]]
    table["before"], table["strings"] = anchor[kept] - first[kept], strings[kept]
    return table, first[kept], hashes[kept], b"".join(pieces.data)


def _segment_rows(docs: DataFrame, prints: DataFrame, buckets: int) -> DataFrame:
    """Step 2: rows of buckets with the segments still to sort, their bytes compressed, and
    rows with what is decided (ranges of removed bytes), without bytes."""

    def run(texts: pa.Table, packed: pa.Table) -> pa.Table:
        made = []
        for found in _found_segments(texts, packed):
            made.extend(_of_pieces(*found))
            del found
        kinds = (pa.int32(), pa.binary(), pa.binary())
        return pa.Table.from_arrays(
            [pa.array([r[k] for r in made], kind) for k, kind in enumerate(kinds)], names=["bucket", "packed", "bytes"]
        )

    def _of_pieces(table, first, hashes, joined):
        strings = table["strings"].astype(np.int64)
        content = [joined[a : a + s + LENGTH - 1] for a, s in zip(first.tolist(), strings.tolist())]
        table["content"] = np.fromiter(map(xxhash.xxh3_64_intdigest, content), np.uint64, len(content))
        table["content"] = mix64(table["content"] ^ (table["before"].astype(np.uint64) * _FACTOR))
        sent, decided = split_equal(table)
        bucket = _bucket(hashes[sent], buckets)
        order = np.argsort(bucket, kind="stable")
        at = np.searchsorted(bucket[order], np.arange(buckets + 1))
        packer = zstandard.ZstdCompressor(level=3)
        for b in range(buckets):
            part = sent[order[at[b] : at[b + 1]]]
            if len(part):
                packed = packer.compress(b"".join([content[k] for k in part.tolist()]))
                yield b, table[part].tobytes(), packed
        if len(decided):
            ranges = removed_ranges(table[decided], None)
            yield int(ranges["id"][0] % buckets), packer.compress(ranges.tobytes()), None

    left = docs.select("id", "mark", "text", _group(buckets)).groupBy("group")
    return left.cogroup(prints.groupBy("group")).applyInArrow(run, "bucket int, packed binary, bytes binary")


def split_equal(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of segments with equal content: one of the smallest id, which has to travel, and
    those of larger ids, of which every string also starts in a smaller document. Equal
    segments of the smallest id itself travel too, as they depend on other segments."""
    order = np.lexsort((table["anchor"], table["mark"], table["id"], table["content"]))
    content, ids = table["content"][order], table["id"][order]
    head = np.concatenate([[True], content[1:] != content[:-1]])
    least = ids[np.maximum.accumulate(np.where(head, np.arange(len(ids)), 0))]
    return order[ids == least], order[ids != least]


def removed_ranges(table: np.ndarray, strings: np.ndarray | None) -> np.ndarray:
    """Ranges of the bytes under the marked strings: all of a segment, or those of
    `strings` (a column per offset of the anchor), runs of neighbours as one."""
    if strings is None:
        row = np.arange(len(table))
        begin = table["anchor"] - table["before"]
        end = begin + table["strings"] + (LENGTH - 1)
    else:
        wide = np.zeros((len(table), OFFSETS + 2), np.int8)
        wide[:, 1:-1] = strings
        step = np.diff(wide, axis=1)
        row, first = np.nonzero(step == 1)
        last = np.nonzero(step == -1)[1]
        begin = table["anchor"][row] + first - (OFFSETS - 1)
        end = begin + (last - first) + (LENGTH - 1)
    out = np.zeros(len(row), _RANGE)
    out["id"], out["mark"], out["begin"], out["end"] = table["id"][row], table["mark"][row], begin, end
    return out


def sort_columns(columns: Iterator[np.ndarray], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """After each column, read from right to left: the order of the rows by their bytes
    from that column on, and the bytes each has in common with the one before it (at most
    255). A round puts one symbol before every row's suffix: a stable sort by the symbol
    keeps the order of the last round among equals, and the common prefix of two that are
    now neighbours is one more than the least between them before."""
    order, common = np.arange(rows), np.full(rows, 255, np.uint8)
    if rows:
        common[0] = 0
    length = 0
    for column in columns:
        symbols = column[order]
        moved = np.argsort(symbols, kind="stable")
        same = np.zeros(rows, bool)
        ranked = symbols[moved]
        same[1:] = ranked[1:] == ranked[:-1]
        least = _least_between(common if length else np.full(rows, 0, np.uint8), moved, same)
        common = np.where(same, np.minimum(least, 254) + np.uint8(1), np.uint8(0)).astype(np.uint8)
        order = order[moved]
        length += 1
        yield order, common


def _least_between(values: np.ndarray, places: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For every k with wanted[k] the least of values after place k - 1 up to place k."""
    out = np.zeros(len(places), np.uint8)
    at = np.flatnonzero(wanted)
    if not len(at):
        return out
    low, high = places[at - 1] + 1, places[at]
    span = high - low + 1
    level = (np.frexp(span.astype(np.float64))[1] - 1).astype(np.int64)
    table, found = values, np.zeros(len(at), np.uint8)
    for k in range(int(level.max()) + 1):
        use = np.flatnonzero(level == k)
        if len(use):
            found[use] = np.minimum(table[low[use]], table[high[use] - (1 << k) + 1])
        if len(table) > 1 << k:
            table = np.minimum(table[: len(table) - (1 << k)], table[1 << k :])
    out[at] = found
    return out


def marked_strings(table: np.ndarray, content: bytes) -> np.ndarray:
    """Per segment and offset, whether the string there also starts in a document with a
    smaller id."""
    rows, width = len(table), 2 * OFFSETS - 1 + GRAM - 1
    sizes = table["strings"].astype(np.int64) + (LENGTH - 1)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(content, np.uint8)
    left = (OFFSETS - 1) - table["before"].astype(np.int64)
    with tempfile.TemporaryFile() as file:
        for c in range(width):
            inside = (c >= left) & (c < left + sizes)
            column = np.zeros(rows, np.uint8)
            column[inside] = data[(starts + c - left)[inside]]
            file.write(column.tobytes())

        def columns() -> Iterator[np.ndarray]:
            for c in range(width - 1, -1, -1):
                file.seek(c * rows)
                yield np.frombuffer(file.read(rows), np.uint8)

        marked = np.zeros((rows, OFFSETS), bool)
        nobody = np.iinfo(np.int64).max
        for c, (order, common) in zip(range(width - 1, -1, -1), sort_columns(columns(), rows)):
            if c >= OFFSETS:
                continue
            real = (c >= left) & (c < left + table["strings"])
            ids = np.where(real, table["id"], nobody)[order]
            heads = np.flatnonzero(common < LENGTH)
            least = np.repeat(np.minimum.reduceat(ids, heads), np.diff(np.append(heads, rows)))
            marked[order, c] = (least < ids) & (ids != nobody)
    return marked


def _sorted_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    """Step 3: ranges of removed bytes per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for held in _by_bucket(batches):
            made = [np.frombuffer(unpacker.decompress(r[1]), _RANGE) for r in held if r[2] is None]
            held = [r for r in held if r[2] is not None]
            if held:
                table = np.concatenate([np.frombuffer(r[1], _SEGMENT) for r in held])
                content = b"".join([unpacker.decompress(r[2]) for r in held])
                held.clear()
                sizes = table["strings"].astype(np.int64) + (LENGTH - 1)
                starts = np.cumsum(sizes) - sizes
                kept, decided = split_equal(table)
                made.append(removed_ranges(table[decided], None))
                content = b"".join(
                    [content[a : a + s] for a, s in zip(starts[kept].tolist(), sizes[kept].tolist())]
                )
                table = table[kept]
                made.append(removed_ranges(table, marked_strings(table, content)))
            yield _group_rows(np.concatenate(made), buckets)

    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return map_texts(dealt, run, "group bigint, packed binary")


_STRING = np.dtype([("h", "<i8"), ("g", "<i8"), ("id", "<i8"), ("mark", "<i8"), ("begin", "<i8")])


def _hot_strings(docs: DataFrame, prints: DataFrame, groups: int) -> DataFrame:
    """Step 4, sending: both halves of the hash and the place of every string of a hot
    anchor. Of equal strings of a batch only those of the smallest id; the others are
    decided, with null for the hash."""

    def run(texts: pa.Table, packed: pa.Table) -> pa.Table:
        sent, decided = [np.zeros(0, _STRING)], [np.zeros(0, _STRING)]
        for table, first, _, joined in _found_segments(texts, packed):
            strings = table["strings"].astype(np.int64)
            row = np.repeat(np.arange(len(table)), strings)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
            digests = b"".join(xxhash.xxh3_128_digest(joined[a : a + LENGTH]) for a in (first[row] + nth).tolist())
            out = np.zeros(len(row), _STRING)
            out["h"], out["g"] = np.frombuffer(digests, "<i8").reshape(-1, 2).T
            out["id"], out["mark"] = table["id"][row], table["mark"][row]
            out["begin"] = (table["anchor"] - table["before"])[row] + nth
            out = out[np.lexsort((out["begin"], out["mark"], out["id"], out["g"], out["h"]))]
            head = np.ones(len(out), bool)
            head[1:] = (out["h"][1:] != out["h"][:-1]) | (out["g"][1:] != out["g"][:-1])
            least = out["id"][np.maximum.accumulate(np.where(head, np.arange(len(out)), 0))]
            sent.append(out[out["id"] == least])
            decided.append(out[out["id"] != least])
        sent, decided = np.concatenate(sent), np.concatenate(decided)
        every, known = np.concatenate([sent, decided]), np.arange(len(sent) + len(decided)) >= len(sent)
        columns = [pa.array(every[k], pa.int64(), mask=known if k in "hg" else None) for k in _STRING.names]
        return pa.Table.from_arrays(columns, names=list(_STRING.names))

    left = docs.select("id", "mark", "text", _group(groups)).groupBy("group")
    schema = ", ".join(f"{k} bigint" for k in _STRING.names)
    return left.cogroup(prints.groupBy("group")).applyInArrow(run, schema)


def _hot_ranges(docs: DataFrame, prints: DataFrame, groups: int, tables: Tables) -> DataFrame:
    """Step 4: ranges of removed bytes per document, as those of step 3."""
    strings = tables.store(_hot_strings(docs, prints, groups), "hot-strings")
    least = strings.where("h IS NOT NULL").groupBy("h", "g").agg(F.min("id").alias("least"))
    least = tables.store(least, "least-ids")  # apart, so that a hot string can be split in the join
    place = ["id", "mark", "begin"]
    later = strings.join(least, ["h", "g"]).where("least < id").select(place)
    every = later.union(strings.where("h IS NULL").select(place)).withColumn("group", _group(groups))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 1 << 16:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        ids, marks, begin = (table.column(k).to_numpy() for k in place)
        new = np.ones(len(ids) + 1, bool)
        new[1:-1] = (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1]) | (begin[1:] > begin[:-1] + 1)
        edges = np.flatnonzero(new)
        out = np.zeros(len(edges) - 1, _RANGE)
        out["id"], out["mark"] = ids[edges[:-1]], marks[edges[:-1]]
        out["begin"], out["end"] = begin[edges[:-1]], begin[edges[1:] - 1] + LENGTH
        return _group_rows(out, groups)

    dealt = every.repartition(groups, "group").sortWithinPartitions(*place)
    found = tables.store(map_texts(dealt, run, "group bigint, packed binary"), "hot-ranges")
    tables.drop(strings, least)
    return found


def repeated_ranges(docs: DataFrame, tables: Tables, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """For the rows (id, mark, text) of `docs`: packed ranges to remove by group of
    documents, as written tables, and the number of groups."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    anchors = _anchor_rows(docs, buckets)
    shared = tables.store(_shared_prints(anchors, buckets, bucket_bytes // SEGMENT_BYTES), "shared-anchors")
    cold, hot = (shared.where(c).drop("hot") for c in ("NOT hot", "hot"))
    ranges = tables.store(_sorted_buckets(_segment_rows(docs, cold, buckets), buckets), "ranges")
    if not hot.isEmpty():
        ranges = ranges.union(_hot_ranges(docs, hot, buckets, tables))
    tables.drop(shared)
    return ranges, buckets


def remaining(text: str | None, ranges: np.ndarray | None) -> tuple[bytes, int, int]:
    """Remaining bytes, removed bytes and maximal removed runs."""
    data = utf8(text)
    if ranges is None:
        return data, 0, 0
    depth = np.zeros(len(data) + 1, np.int64)
    np.add.at(depth, ranges["begin"], 1)
    np.add.at(depth, ranges["end"], -1)
    gone = np.cumsum(depth)[:-1] > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def remove_substrings(docs: DataFrame, id: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row of `docs`: its id, n_bytes, n_removed, n_spans and kept_sha256 of the bytes
    that stay.

    Null texts are empty; texts of fewer than LENGTH bytes stay whole. A null id counts as
    smaller than every other. Rows with one id never remove each other's bytes, and equal
    rows have equal results. An empty table gives an empty result. Other columns are not
    read.
    """
    tables = Tables(docs.sparkSession)
    rows = docs.select(
        docs[id].alias("own"), F.coalesce(docs[id].cast("bigint"), F.lit(_NO_ID)).alias("id"),
        F.xxhash64(docs[text]).alias("mark"), docs[text].alias("text"),
    )
    ranges, groups = repeated_ranges(rows.select("id", "mark", "text"), tables, bucket_bytes)

    def run(texts: pa.Table, packed: pa.Table) -> pa.Table:
        gone = _of_documents(packed, _RANGE)
        made = []
        for batch in texts.select(["id", "mark", "text"]).to_batches(max_chunksize=256):
            for i, mark, value in zip(*(column.to_pylist() for column in batch.columns)):
                kept, removed, runs = remaining(value, gone.get((i, mark)))
                made.append((len(kept) + removed, removed, runs, hashlib.sha256(kept).hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.Table.from_arrays(
            [texts.column("own"), *[pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)]],
            names=["own", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    kind = rows.schema["own"].dataType.simpleString()
    schema = f"own {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    left = rows.select("own", "id", "mark", "text", _group(groups)).groupBy("group")
    found = left.cogroup(ranges.groupBy("group")).applyInArrow(run, schema)
    return found.withColumnRenamed("own", id)
