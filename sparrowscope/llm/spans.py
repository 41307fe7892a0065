"""Substring de-duplication by sliding sentence spans.

A sentence ends at . ! ? , ; or : before white space, or at a line break. Where WINDOW
word ends in a row have none of these, the one with the smallest hash of the GRAM bytes
before it is a cut as well; in stretches without white space, ends of characters stand for
those of words. So a cut comes within WINDOW words, and depends only on the WINDOW - 1 words
to either side: a passage is cut alike in all surroundings. From every sentence a span of consecutive sentences is hashed:
the fewest that are at least SENTENCES and BYTES long. All spans of all documents are
joined on the hash; where a span occurs more than once, all occurrences but the first
(smallest id, then position) are marked, and every sentence inside a marked span goes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sparrowscope.llm.common import map_texts, mix64, store, utf8

SENTENCES = 3
BYTES = 60
WINDOW = 8
GRAM = 8
# Characters count as words from so many bytes after white space to so many before the next.
FAR = 16

_MARK = np.isin(np.arange(256), list(b".!?,;:"))
# Between texts that are looked at together.
_GAP = b" \x00 "
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\f\v"))
# Bytes of a text that are hashed at a time.
_BLOCK = 1 << 20
# Stands for a null id, which comes first.
_NO_ID = -(1 << 63)


def sentence_bounds(data: bytes) -> np.ndarray:
    """Offsets at which sentences begin, and the length of the text."""
    return all_bounds([data])[0]


def all_bounds(texts: list[bytes]) -> list[np.ndarray]:
    """The bounds of several texts, found in one go: they are put one after the other, with
    a gap that no sentence end, word or window reaches across."""
    joined = _GAP.join(texts)
    sizes = np.array([len(text) for text in texts], np.int64)
    starts = np.cumsum(np.concatenate([[0], sizes[:-1] + len(_GAP)]))
    if not joined:
        return [np.zeros(1, np.int64)]
    data = np.frombuffer(joined, np.uint8)
    kinds = np.zeros(len(joined) + 1, np.uint8)
    kinds[_word_ends(data)] = 1
    for ends in (_sentence_ends(data), starts, starts + sizes):
        kinds[ends] = 2
    places = np.flatnonzero(kinds)
    grams = np.ndarray(len(joined) + 1, "<u8", bytes(GRAM) + joined, strides=(1,))[places]
    # Bytes before a text's first are as if there were none.
    inside = places - starts[np.searchsorted(starts, places, "right") - 1]
    near = inside < GRAM
    grams[near] &= ~np.uint64(0) << (np.uint64(8) * (GRAM - inside[near]).astype(np.uint64) % np.uint64(64))
    grams[inside == 0] = 0
    # Sentence ends are smaller than all others, and so is what lies outside the texts.
    keys = np.zeros(len(places) + 2 * (WINDOW - 1), np.uint64)
    inner = keys[WINDOW - 1 : WINDOW - 1 + len(places)]
    inner[:] = mix64(grams) | np.uint64(1)
    inner[kinds[places] == 2] = 0
    least = _over_windows(np.minimum, keys)
    cuts = places[_over_windows(np.maximum, least) == inner]
    first, last = np.searchsorted(cuts, starts), np.searchsorted(cuts, starts + sizes, "right")
    return [cuts[i:j] - start for i, j, start in zip(first, last, starts)]


def _over_windows(pick: np.ufunc, values: np.ndarray) -> np.ndarray:
    """The least or greatest of every WINDOW values in a row."""
    step, rest = 1, WINDOW - 1
    while rest:
        step = min(step, rest)
        values = pick(values[:-step], values[step:])
        rest, step = rest - step, 2 * step
    return values


def _sentence_ends(data: np.ndarray) -> np.ndarray:
    """Ends of white space that has a line break, and, after . ! ? , ; or :, ends of white
    space before any line break."""
    space = _SPACE[data]
    edges = np.flatnonzero(np.diff(space, prepend=False, append=False))
    begins, stops = edges[::2], edges[1::2]
    breaks = np.flatnonzero(data == 10)
    next_break = np.append(breaks, len(data))[np.searchsorted(breaks, begins)]
    broken = next_break < stops
    marked = _MARK[data[begins - 1]] & (begins > 0)
    plain = np.minimum(next_break, stops)
    return np.concatenate([stops[broken], plain[marked & (plain > begins)]])


def _word_ends(data: np.ndarray) -> np.ndarray:
    """Where words begin after white space, and characters far from white space."""
    space = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, stops = edges[~space[edges]], edges[space[edges]]
    first = starts if space[0] else np.append(0, starts)
    last = stops if space[-1] else np.append(stops, len(data))
    far = [
        a + FAR + np.flatnonzero((data[a + FAR : b - FAR + 1] & 0xC0) != 0x80)
        for k in np.flatnonzero(last - first >= 2 * FAR)
        for a, b in [(first[k], last[k])]
    ]
    return np.concatenate([starts, *far])


def span_ends(bounds: np.ndarray, sentences: int = SENTENCES, size: int = BYTES) -> np.ndarray:
    """For every sentence that begins a span, the number of the sentence after it."""
    places = np.arange(len(bounds))
    ends = np.maximum(places + sentences, np.searchsorted(bounds, bounds + size))
    return ends[ends < len(bounds)]


def _signs(seed: int) -> np.ndarray:
    """A 64-bit number for every byte."""
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


# Odd bases of the two halves of a hash, and the numbers that stand for bytes in each.
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_SIGNS = (_signs(0x1234567), _signs(0x7654321))


@cache
def _powers(base: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, base, np.uint64)]))


def _powers_to(base: int, length: int) -> np.ndarray:
    return _powers(base, 1 << max(12, length.bit_length()))


def span_hashes(data: bytes, begins: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the hashes of the spans, from rising places to others, without the
    space after.

    A half is the sum of sign(byte) * base ** place, modulo 2 ** 64, over the bytes of the
    span: a difference of one running sum over the text, so that spans that overlap cost no
    more than their text. The span's length goes into the hash as well."""
    raw, parts, at = np.frombuffer(data, np.uint8), [], 0
    while at < len(begins):
        # Spans are short, so a block of the text and what the last of them reaches into.
        to = int(np.searchsorted(begins, begins[at] + _BLOCK))
        start = begins[at]
        parts.append(_block_hashes(raw[start : stops[at:to].max()], begins[at:to] - start, stops[at:to] - start))
        at = to
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _block_hashes(raw: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
    # The end of the last byte before each stop that is no white space.
    solid = np.maximum.accumulate(np.where(_SPACE[raw], 0, np.arange(1, len(raw) + 1)))
    stops = np.maximum(solid[stops - 1], begins)
    halves = []
    with np.errstate(over="ignore"):
        lengths = mix64((stops - begins).astype(np.uint64))
        for base, signs in zip(_BASES, _SIGNS):
            powers, backwards = _powers_to(base, len(raw)), _powers_to(pow(base, -1, 1 << 64), len(raw))
            running = np.concatenate([[np.uint64(0)], np.cumsum(signs[raw] * powers[: len(raw)])])
            value = (running[stops] - running[begins]) * backwards[begins]
            halves.append(mix64(value + lengths).view(np.int64))
    return halves


class all_spans:
    """Bounds, ends of spans and hashes (of all texts, one after the other) of some texts."""

    def __init__(self, texts: list[bytes]):
        self.bounds = all_bounds(texts)
        self.ends = [span_ends(bounds) for bounds in self.bounds]
        starts = np.cumsum([0, *[len(text) + len(_GAP) for text in texts[:-1]]])
        begins = np.concatenate([b[: len(e)] + s for b, e, s in zip(self.bounds, self.ends, starts)])
        stops = np.concatenate([b[e] + s for b, e, s in zip(self.bounds, self.ends, starts)])
        self.high, self.low = span_hashes(_GAP.join(texts), begins, stops)


def _groups(texts: list[bytes], size: int = 1 << 17) -> Iterator[tuple[int, int]]:
    """Runs of texts of about `size` bytes."""
    at, filled = 0, 0
    for to, text in enumerate(texts, 1):
        filled += len(text)
        if filled >= size or to == len(texts):
            yield at, to
            at, filled = to, 0


def _spans(rows: DataFrame, whole: bool) -> DataFrame:
    """A row per span: its hash, and with `whole` the other half, id and position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [utf8(text) for text in batch.column(1).to_pylist()]
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, to in _groups(texts):
                yield _rows(ids[at:to], texts[at:to])

    def _rows(ids: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
        found = all_spans(texts)
        columns, names = [pa.array(found.high)], ["h"]
        if whole:
            counts = np.array([len(ends) for ends in found.ends], np.int64)
            at = np.concatenate([np.arange(count, dtype=np.int32) for count in counts])
            columns += [pa.array(found.low), pa.array(np.repeat(ids, counts)), pa.array(at)]
            names += ["g", "__id", "at"]
        return pa.record_batch(columns, names=names)

    schema = "h bigint, g bigint, __id bigint, at int" if whole else "h bigint"
    return map_texts(rows, run, schema)


def repeated_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """__id (the id; the smallest integer for null), at and h of every span that occurs
    before: the first sentence of the span and one half of its hash."""
    rows = docs.select(
        F.coalesce(docs[id].cast("bigint"), F.lit(_NO_ID)).alias("__id"), docs[text].alias("text")
    )
    # One half of the hash tells which spans may repeat; only those travel whole.
    counts = _spans(rows, whole=False).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    repeated = store(counts.where("n > 1").select("h"), "repeated-hashes")
    spans = store(_spans(rows, whole=True).join(repeated, "h", "left_semi"), "repeated-spans")
    first = spans.groupBy("h", "g").agg(
        F.min(F.struct("__id", "at")).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    first = store(first, "first-spans")  # apart, so that a hot span can be split in the join
    again = spans.join(first, ["h", "g"]).where(F.struct("__id", "at") != F.col("first"))
    return again.select("__id", "at", "h").distinct()


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", counts: bool = False) -> DataFrame:
    """The rows of `docs` without the sentences inside repeated spans, all columns kept;
    with `counts` also n_sentences and n_removed (long).

    Texts that lose nothing stay as they are, null and empty ones included; a text may
    become empty. Rows with equal ids count as one document, so equal rows with one id do
    not repeat each other. An empty table gives an empty result.
    """
    columns = docs.columns
    marks = repeated_spans(docs, id, text)
    marks = marks.groupBy("__id").agg(F.collect_list(F.struct("at", "h")).alias("__marks"))
    # The columns of `docs` travel in one, so that no name of theirs can clash.
    key = F.coalesce(docs[id].cast("bigint"), F.lit(_NO_ID))
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("__row"), key.alias("__key"))
    joined = rows.join(marks, F.col("__key") == F.col("__id"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            texts = row.field(place)
            made = []
            marks = list(zip(*_marked(batch.column(batch.num_columns - 1))))
            values = texts.to_pylist()
            data = [utf8(text) for text in values]
            for a, b in _groups(data):
                made += _remaining(values[a:b], data[a:b], marks[a:b])
            fields = [row.field(k) for k in range(len(columns))]
            fields[place] = pa.array([m[0] for m in made], texts.type)
            if counts:
                fields += [pa.array([m[k] for m in made], pa.int64()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, names=inner)], names=["__row"])

    place = columns.index(text)
    inner = [f"c{k}" for k in range(len(columns) + 2 * counts)]
    fields = [(field.dataType, field.name) for field in docs.schema.fields]
    if counts:
        fields += [(T.LongType(), "n_sentences"), (T.LongType(), "n_removed")]
    schema = T.StructType([T.StructField("__row", T.StructType([T.StructField(n, f[0]) for n, f in zip(inner, fields)]))])
    found = map_texts(joined.select("__row", "__marks"), run, schema)
    return found.select(*[F.col(f"__row.{n}").alias(f[1]) for n, f in zip(inner, fields)])


def _marked(marks: pa.ListArray) -> tuple[list, list]:
    """Sentences and hashes of the marks of every row, None for rows without."""
    offsets = marks.offsets.to_numpy()
    at, h = (marks.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    cut = [(a, b) if b > a else None for a, b in zip(offsets[:-1], offsets[1:])]
    return [c and at[c[0] : c[1]] for c in cut], [c and h[c[0] : c[1]] for c in cut]


def _remaining(values: list, texts: list[bytes], marks: list[tuple]) -> list[tuple[str | None, int, int]]:
    """Remaining text, number of sentences and of those removed."""
    found, out, past = all_spans(texts), [], 0
    for value, data, (at, h), bounds, ends in zip(values, texts, marks, found.bounds, found.ends):
        hashes = found.high[past : past + len(ends)]
        past += len(ends)
        total = len(bounds) - 1
        if at is None:
            out.append((value, total, 0))
            continue
        # Marks may belong to another text of the same id.
        inside = at < len(ends)
        own = at[inside][hashes[at[inside]] == h[inside]]
        gone = np.zeros(total + 1, np.int64)
        np.add.at(gone, own, 1)
        np.add.at(gone, ends[own], -1)
        removed = np.cumsum(gone)[:total] > 0
        if not removed.any():
            out.append((value, total, 0))
            continue
        kept = b"".join(data[bounds[k] : bounds[k + 1]] for k in np.flatnonzero(~removed).tolist())
        out.append((kept.decode("utf-8", "surrogatepass"), total, int(removed.sum())))
    return out
