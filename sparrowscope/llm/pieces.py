"""SentencePiece encoding by sampling segmentations without replacement, and decoding.

The segmentations of a text are the paths of a lattice whose edges are vocabulary pieces.
Each path has the probability of its pieces, normalised over all paths. Every path gets an
independent Gumbel perturbation of its log probability, and the k paths with the largest
perturbed values are k draws without replacement (Gumbel top-k).

They are found by A-star search without walking all paths. The total mass of the suffixes
of every node is exact, so the largest perturbed value below a set of paths can be drawn
before any of its paths is known: a Gumbel variable at the log mass of the set, cut off at
the value of the set it was split from. The search pops the set with the largest value,
completes it to a path by drawing edges, and pushes what is left: for every token of the
new path the paths that agree up to there and differ in that token. The value of a set is
the value of its best path, so paths come out in order. The value of the set that would be
popped next gives the inclusion scores of the k paths.

No piece crosses a place whose two bytes stand together in no piece. The lattice falls
apart there into short units, and equal units share their part of the lattice. All random
numbers are hashes of seed, row key, draw, unit and step, so results do not depend on
partitions or retries.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, types as T

from sparrowscope.llm.common import map_texts, mix64, utf8

SAMPLES = 2
SEED = 20_240
# Zipf's law stands in for the probabilities that a merge-ranked vocabulary lacks:
# a piece of rank r has a share of 1 / (r + OFFSET).
OFFSET = 10.0
# Bytes of text, and rows, whose lattices are built together: a worker holds some 300 bytes
# for each of them, and lattices of more text share hardly more units.
CHUNK = 1 << 20
ROWS = 2048
_GOLD, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_MASK = (1 << 64) - 1
# A Gumbel variable of this module lies within 38 of its log mass, and no more below it.
_REACH = 45.0


@dataclass
class Vocabulary:
    """Pieces as bytes (a space for the visible space), byte pieces, log shares, and a
    byte trie: `step[row_of[node], byte]` is the next node or -1, `piece_at[node]` an id."""

    pieces: list[bytes]
    byte_id: np.ndarray
    share: np.ndarray
    byte_share: float
    row_of: np.ndarray
    step: np.ndarray
    piece_at: np.ndarray
    together: np.ndarray
    longest: int
    as_arrow: pa.Array


@cache
def vocabulary(path: str) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces, byte_id = [b""] * size, np.full(256, -1, np.int64)
    ranked = []
    for k in range(size):
        if model.is_byte(k):
            value = int(model.id_to_piece(k)[3:5], 16)
            byte_id[value], pieces[k] = k, bytes([value])
        elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
            pieces[k] = model.id_to_piece(k).replace("▁", " ").encode()
            ranked.append(k)
    if (byte_id < 0).any():
        raise ValueError("the vocabulary has no byte pieces for unknown characters")
    weight = np.full(size, 1 / (len(ranked) + OFFSET))
    weight[ranked] = 1 / (np.arange(len(ranked)) + OFFSET)
    total = np.log(weight[ranked].sum() + weight[byte_id].sum())
    share = np.log(weight) - total
    children: list[dict[int, int]] = [{}]
    piece_at = [-1]
    together = np.zeros((256, 256), bool)
    for k in ranked:
        node = 0
        for byte in pieces[k]:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                piece_at.append(-1)
            node = children[node][byte]
        piece_at[node] = k
        data = np.frombuffer(pieces[k], np.uint8)
        together[data[:-1], data[1:]] = True
    row_of = np.full(len(children), -1, np.int32)
    inner = [node for node, below in enumerate(children) if below]
    row_of[inner] = np.arange(len(inner))
    step = np.full((len(inner), 256), -1, np.int32)
    for row, node in enumerate(inner):
        for byte, child in children[node].items():
            step[row, byte] = child
    together[:, 0x80:0xC0] = True  # never inside a character
    return Vocabulary(
        pieces, byte_id, share, float(share[byte_id[0]]), row_of, step, np.array(piece_at, np.int32), together,
        max(map(len, pieces)), pa.array(pieces, pa.binary()),
    )


@dataclass
class Lattice:
    """Edges of all units, those of a node side by side, nodes numbered by place. Place 0
    of unit u is `begin[u]`; a unit of n bytes has n + 1 places."""

    begin: np.ndarray
    last: np.ndarray
    first_edge: np.ndarray
    edges: np.ndarray
    target: np.ndarray
    piece: np.ndarray
    log: np.ndarray
    upto: np.ndarray


def build_lattice(vocab: Vocabulary, units: pa.Array) -> Lattice:
    offsets = np.frombuffer(units.buffers()[1], np.int32)[units.offset : units.offset + len(units) + 1].astype(np.int64)
    data = np.frombuffer(units.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    number = np.repeat(np.arange(len(sizes)), sizes)
    end = offsets[1:][number]
    lead = (data & 0xC0) != 0x80
    starts = np.flatnonzero(lead)
    width = np.diff(np.append(starts, len(data)))  # bytes of each character
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at, node = starts, np.zeros(len(starts), np.int32)
    single = np.zeros(len(data), bool)
    char_width = np.zeros(len(data), np.int64)
    char_width[starts] = width
    for length in range(1, vocab.longest + 1):
        row = vocab.row_of[node]
        alive = (row >= 0) & (at + length <= end[at])
        at, row = at[alive], row[alive]
        node = vocab.step[row, data[at + (length - 1)]]
        alive = node >= 0
        at, node = at[alive], node[alive]
        if not len(at):
            break
        piece = vocab.piece_at[node]
        hit = piece >= 0
        found.append((at[hit], np.full(int(hit.sum()), length), piece[hit]))
        if length <= 4:  # a character is no longer
            single[at[hit][char_width[at[hit]] == length]] = True
    lone = starts[~single[starts]]
    found.append((lone, char_width[lone], np.full(len(lone), -1)))
    # Edges by place, the longest first: those of one length start from places that differ.
    free = np.cumsum(sum((np.bincount(f[0], minlength=len(data)) for f in found), np.zeros(len(data), np.int64)))
    place = np.repeat(np.arange(len(data)), np.diff(free, prepend=0))
    length, piece = np.empty(len(place), np.int64), np.empty(len(place), np.int32)
    for at, size, ids in found:
        free[at] -= 1
        length[free[at]], piece[free[at]] = size, ids
    # Nodes by distance to the end of their unit, so that suffix masses come level by level.
    left = end[place] - place
    narrow = len(left) and left.max() < 1 << 16  # such numbers sort by their digits
    order = np.argsort(left.astype(np.uint16) if narrow else left, kind="stable")
    place, length, piece, left = place[order], length[order], piece[order], left[order]
    weight = np.where(piece >= 0, vocab.share[np.maximum(piece, 0)], length * vocab.byte_share)
    slot = place + number[place]
    target = slot + length
    mass = np.zeros(len(data) + len(sizes))
    new = np.ones(len(slot), bool)
    new[1:] = slot[1:] != slot[:-1]
    heads = np.flatnonzero(new)
    levels = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]])) if len(left) else np.zeros(0, np.int64)
    bounds = np.append(levels, len(slot))
    value = np.empty(len(slot))
    spans = np.diff(np.append(heads, len(slot)))
    cuts = np.searchsorted(heads, bounds)
    for a, b, h, i in zip(bounds[:-1].tolist(), bounds[1:].tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
        through = weight[a:b] + mass[target[a:b]]
        local = heads[h:i] - a
        top = np.maximum.reduceat(through, local)
        total = top + np.log(np.add.reduceat(np.exp(through - np.repeat(top, spans[h:i])), local))
        mass[slot[heads[h:i]]] = total
        value[a:b] = through - np.repeat(total, spans[h:i])
    sums = np.cumsum(np.exp(value))
    upto = sums - np.repeat(sums[heads] - np.exp(value[heads]), spans) if len(heads) else sums
    first_edge = np.zeros(len(data) + len(sizes), np.int64)
    edges = np.zeros(len(data) + len(sizes), np.int64)
    first_edge[slot[heads]], edges[slot[heads]] = heads, spans
    begin = offsets[:-1] + np.arange(len(sizes))
    return Lattice(begin, begin + sizes, first_edge, edges, target, piece, value, upto)


def _mix(value: int) -> int:
    """mix64 of one number."""
    value &= _MASK
    value ^= value >> 33
    value = value * 0xFF51AFD7ED558CCD & _MASK
    value ^= value >> 33
    value = value * 0xC4CEB9FE1A85EC53 & _MASK
    return value ^ (value >> 33)


def _uniform(base: np.ndarray, step: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) for the given streams and step."""
    with np.errstate(over="ignore"):
        bits = mix64(base + np.asarray(step, np.uint64) * _ODD)
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def draw(lattice: Lattice, place: np.ndarray, last: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every walk from a place to the end of its unit: edges of all walks one after
    another, and how many each has."""
    active = np.flatnonzero(place < last)
    at = place[active].copy()
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    counts = np.zeros(len(place), np.int64)
    step = 0
    while len(active):
        u = _uniform(base[active], step)
        edge = lattice.first_edge[at].copy()
        end = edge + lattice.edges[at] - 1
        search = np.flatnonzero((u >= lattice.upto[edge]) & (edge < end))
        while len(search):
            edge[search] += 1
            more = (u[search] >= lattice.upto[edge[search]]) & (edge[search] < end[search])
            search = search[more]
        parts.append((active, edge))
        counts[active] += 1
        at = lattice.target[edge]
        going = at < last[active]
        active, at = active[going], at[going]
        step += 1
    first = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int64)
    for k, (walk, edge) in enumerate(parts):
        out[first[walk] + k] = edge
    return out, counts


@dataclass
class Sample:
    """A path: its edges, the places they start from, the unit of each, log probability,
    perturbed value, and the inclusion score that the search adds at its end."""

    edges: np.ndarray
    places: np.ndarray
    units: np.ndarray
    log: float
    value: float
    inclusion: float = 0.0


def _gumbel(u: float) -> float:
    return float(-np.log(-np.log(u)))


def _cut_gumbel(mass, bound: float, u):
    """Gumbel variables at the given log masses, conditioned to lie below the bound."""
    with np.errstate(divide="ignore", over="ignore"):
        return mass - np.logaddexp(mass - bound, np.log(-np.log(u)))


class Search:
    """A-star search over one text: the agenda holds sets of paths, best value first."""

    def __init__(self, lattice: Lattice, units: np.ndarray, key: int, keep: int):
        self.lattice, self.units, self.key, self.keep = lattice, units, key, keep
        self.agenda: list[tuple[float, int, int, int, tuple[int, ...], float]] = []
        self.paths: list[Sample] = []

    def stream(self, draw: int) -> int:
        """Start of the random numbers of one draw."""
        return _mix(self.key + draw * int(_GOLD))

    def noise(self, draw: int, what: int) -> float:
        bits = _mix(_mix(self.stream(draw) + (what + 1 << 40) * int(_GOLD)))
        return ((bits >> 11) + 0.5) * 2.0**-53

    def add(self, edges: np.ndarray, places: np.ndarray, units: np.ndarray, value: float, fixed: int) -> None:
        """A new path, of which the first `fixed` tokens are those of its set. What is left
        beside it are the sets that leave it at one of the other tokens."""
        number = len(self.paths)
        logs = self.lattice.log[edges]
        self.paths.append(Sample(edges, places, units, float(logs.sum()), value))
        before = np.cumsum(logs[:fixed + 64]) - logs[: fixed + 64]
        mass = self._beside(places, logs, before, fixed)
        best = mass.max() if len(mass) else -np.inf
        if len(logs) > fixed + 64:
            # The prefix gets less likely with every token. What lies too far below the
            # best set cannot come near it, whatever is drawn.
            whole = np.cumsum(logs) - logs
            end = len(whole) if best == -np.inf else int(np.searchsorted(-whole, -best + 2 * _REACH))
            before = whole[: max(end, fixed + 64)]
            mass = self._beside(places, logs, before, fixed)
        open_sets = np.flatnonzero(mass > -np.inf)
        if not len(open_sets):
            return
        if len(open_sets) > self.keep:
            least = np.partition(mass[open_sets], -self.keep)[-self.keep]
            open_sets = open_sets[mass[open_sets] >= min(least, value) - _REACH]
        base = np.array([_mix(self.stream(number) + int(_ODD))], np.uint64)
        values = _cut_gumbel(mass[open_sets], value, _uniform(base, open_sets + fixed))
        for k in np.argsort(-values, kind="stable")[: self.keep].tolist():
            token = int(open_sets[k]) + fixed
            heapq.heappush(self.agenda, (-float(values[k]), number, token, 0, (int(edges[token]),), float(before[token])))

    def _beside(self, places: np.ndarray, logs: np.ndarray, before: np.ndarray, fixed: int) -> np.ndarray:
        """Log masses of the sets that leave a path at the tokens from `fixed` on."""
        end = len(before)
        with np.errstate(divide="ignore"):
            mass = before[fixed:] + np.log(np.maximum(-np.expm1(logs[fixed:end]), 0))
        mass[self.lattice.edges[places[fixed:end]] < 2] = -np.inf
        return mass

    def split(self) -> tuple[int, float, int, int, tuple[int, ...], float] | None:
        """Pop the best set: path and token it branches from, and the edge it takes."""
        if not self.agenda:
            return None
        value, source, token, depth, used, before = heapq.heappop(self.agenda)
        value = -value
        place = int(self.paths[source].places[token])
        first = int(self.lattice.first_edge[place])
        left = [e for e in range(first, first + int(self.lattice.edges[place])) if e not in used]
        chance = np.exp(self.lattice.log[left])
        number = len(self.paths)
        u = self.noise(number, 1)
        edge = left[min(int(np.searchsorted(np.cumsum(chance), u * chance.sum(), side="right")), len(left) - 1)]
        others = [e for e in left if e != edge]
        if others:
            mass = before + float(np.log(np.exp(self.lattice.log[others]).sum()))
            again = float(_cut_gumbel(mass, value, self.noise(number, 2)))
            heapq.heappush(self.agenda, (-again, source, token, depth + 1, (*used, edge), before))
        return source, value, token, place, edge

    def finish(self) -> list[Sample]:
        """Inclusion scores: log of the chance that the perturbed value of a path exceeds
        the value of the best set left; 0 when none is left."""
        bound = -self.agenda[0][0] if self.agenda else None
        for path in self.paths:
            if bound is not None:
                x = path.log - bound
                path.inclusion = float(np.log(-np.expm1(-np.exp(x)))) if x > -30 else x
        return self.paths


def cut_units(vocab: Vocabulary, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Units of all texts, and the bounds of each text's units."""
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = ~vocab.together[data[:-1], data[1:]]
    ends = np.cumsum([len(t) for t in texts])
    cut[ends] = True
    if not len(data):
        cut[:] = True
        return pa.array([], pa.binary()), np.zeros(len(texts) + 1, np.int64)
    bounds = np.flatnonzero(cut)
    array = pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(joined)]
    )
    return array, np.searchsorted(bounds, np.concatenate([[0], ends]))


def sample_texts(vocab: Vocabulary, texts: list[str | None], keys: list[bytes], k: int, seed: int) -> list[tuple[Search, bytes]]:
    """A finished search for every text."""
    data = [b" " + utf8(t) if t else b"" for t in texts]
    units, bounds = cut_units(vocab, data)
    coded = units.dictionary_encode()
    lattice = build_lattice(vocab, coded.dictionary)
    unit = coded.indices.to_numpy().astype(np.int64)
    searches = [
        Search(lattice, unit[a:b], xxhash.xxh64_intdigest(key, seed), k)
        for a, b, key in zip(bounds[:-1], bounds[1:], keys)
    ]
    sizes = np.diff(bounds)
    inner = np.arange(len(unit)) - np.repeat(bounds[:-1], sizes)
    base = _streams([s.stream(0) for s in searches], sizes, inner)
    edges, counts = draw(lattice, lattice.begin[unit], lattice.last[unit], base)
    places = _places(lattice, edges, counts, lattice.begin[unit])
    of_unit = np.repeat(inner, counts)
    ends = np.concatenate([[0], np.cumsum(counts)])[bounds]
    for s, a, b in zip(searches, ends[:-1], ends[1:]):
        s.add(edges[a:b], places[a:b], of_unit[a:b], _gumbel(s.noise(0, 3)), 0)
    for _ in range(k - 1):
        _next_paths(lattice, searches)
    for s in searches:
        s.finish()
    return list(zip(searches, data))


def _streams(starts: list[int], sizes: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Random streams of the units of several texts, one start for each text."""
    with np.errstate(over="ignore"):
        return mix64(np.repeat(np.array(starts, np.uint64), sizes) + units.astype(np.uint64) * _GOLD)


def _places(lattice: Lattice, edges: np.ndarray, counts: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Place each edge starts from: that of its walk, then the target of the one before."""
    places = np.empty(len(edges), np.int64)
    places[1:] = lattice.target[edges[:-1]]
    first = (np.cumsum(counts) - counts)[counts > 0]
    places[first] = begin[counts > 0]
    return places


def _next_paths(lattice: Lattice, searches: list[Search]) -> None:
    """One more path for every text that has one, the walks of all texts together."""
    found = [(s, made) for s in searches if (made := s.split()) is not None]
    if not found:
        return
    starts, lasts, streams, inner, sizes = [], [], [], [], []
    for s, (source, _, token, _, edge) in found:
        here = int(s.paths[source].units[token])
        rest = s.units[here:]
        start = lattice.begin[rest].copy()
        start[0] = lattice.target[edge]
        starts.append(start)
        lasts.append(lattice.last[rest])
        streams.append(s.stream(len(s.paths)))
        inner.append(np.arange(here, len(s.units)))
        sizes.append(len(rest))
    start = np.concatenate(starts)
    edges, counts = draw(lattice, start, np.concatenate(lasts), _streams(streams, np.array(sizes), np.concatenate(inner)))
    places = _places(lattice, edges, counts, start)
    ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])]
    walks = np.concatenate([[0], np.cumsum(sizes)])
    for k, (s, (source, value, token, place, edge)) in enumerate(found):
        old = s.paths[source]
        a, b = ends[k], ends[k + 1]
        here = int(old.units[token])
        later = np.repeat(np.arange(here, len(s.units)), counts[walks[k] : walks[k + 1]])
        s.add(
            np.concatenate([old.edges[:token], [edge], edges[a:b]]),
            np.concatenate([old.places[:token], [place], places[a:b]]),
            np.concatenate([old.units[:token], [here], later]),
            value, token + 1,
        )


def path_ids(vocab: Vocabulary, lattice: Lattice, path: Sample, data: bytes) -> np.ndarray:
    """Token ids of a path; characters without a piece become their bytes."""
    piece = lattice.piece[path.edges].astype(np.int64)
    if (piece >= 0).all():
        return piece
    length = lattice.target[path.edges] - path.places
    counts = np.where(piece >= 0, 1, length)
    out = np.repeat(piece, counts)
    raw = out < 0
    content = np.frombuffer(data, np.uint8)
    spread = np.repeat(np.cumsum(length) - length, counts) + np.arange(len(out)) - np.repeat(np.cumsum(counts) - counts, counts)
    out[raw] = vocab.byte_id[content[spread[raw]]]
    return out


def decode(vocab: Vocabulary, ids: np.ndarray) -> str:
    """Text of the ids, without the space that encoding puts before it."""
    taken = vocab.as_arrow.take(pa.array(ids))
    data = taken.buffers()[2].to_pybytes() if len(taken) else b""
    return data[1:].decode("utf-8", "surrogatepass")


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str | None]]]:
    """Ids and texts of the rows (id, text), in order, by up to CHUNK bytes of text and ROWS
    rows across batches. A longer text is one chunk."""
    ids, texts, held = [], [], 0
    for batch in batches:
        sizes = pc.binary_length(batch.column(1)).fill_null(0).to_pylist()
        for i, value, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sizes):
            if texts and (held + size > CHUNK or len(texts) == ROWS):
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(i)
            texts.append(value)
            held += size
    if texts:
        yield ids, texts


def encode(
    docs: DataFrame, model: str, k: int = SAMPLES, seed: int = SEED, id: str = "doc_id", text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Up to `k` sampled segmentations per row of `docs`: id, rank (1 is the largest
    perturbed value), n_ids, ids_crc32 (of the ids as little-endian 32-bit integers),
    round_trip (whether the ids decode to the text), log_prob, log_inclusion (log of the
    inclusion score, 0 when all segmentations are out) and, with `with_ids`, ids.

    Segmentations of a row are distinct; a text with fewer than `k` has fewer rows. Null
    and empty texts have one empty segmentation. The row key is the id, so rows with equal
    id and text have equal results and a null id is a key like any other. An empty table
    gives an empty result. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        for ids, texts in chunks(batches):
            yield rows_of(vocab, ids, texts)

    def rows_of(vocab: Vocabulary, ids: list, texts: list) -> pa.RecordBatch:
        keys = [str(i).encode() for i in ids]
        rows = []
        for i, value, (search, data) in zip(ids, texts, sample_texts(vocab, texts, keys, k, seed)):
            for rank, path in enumerate(search.paths):
                found = path_ids(vocab, search.lattice, path, data)
                same = decode(vocab, found) == (value or "")
                packed = found.astype("<u4")
                rows.append((i, rank + 1, len(found), zlib.crc32(packed.tobytes()), same, path.log, path.inclusion, packed))
        names = ["id", "rank", "n_ids", "ids_crc32", "round_trip", "log_prob", "log_inclusion"]
        kinds = [batch_kind, pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.float64()]
        columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
        if with_ids:
            bounds = np.concatenate([[0], np.cumsum([len(r[7]) for r in rows])]).astype(np.int32)
            flat = np.concatenate([r[7] for r in rows]) if rows else np.zeros(0, "<u4")
            columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.astype(np.int32))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(docs[id].cast("bigint").alias("id"), docs[text].alias("text"))
    batch_kind = pa.int64()
    schema = "id bigint, rank int, n_ids bigint, ids_crc32 bigint, round_trip boolean, log_prob double, log_inclusion double"
    found = map_texts(source, run, schema + (", ids array<int>" if with_ids else ""))
    return found.withColumnRenamed("id", id)


def digests(rows: DataFrame, ids: str = "ids") -> DataFrame:
    """The columns of `rows`, with n_ids and ids_crc32 (as in `encode`) made anew from the
    token ids in `ids` instead of that column.

    Null ids give nulls, no ids 0 and 0. Elements are not null, as in the ids of `encode`.
    Repeated rows are taken each on its own, and an empty table gives an empty one.
    """
    names = [name for name in rows.columns if name not in (ids, "n_ids", "ids_crc32")]
    kept = rows.select(*[rows[name] for name in names], rows[ids].cast("array<int>").alias("ids"))
    made = [T.StructField("n_ids", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    schema = T.StructType([*kept.schema.fields[:-1], *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(names))
            bounds, flat = lists.offsets.to_numpy().tolist(), lists.values.to_numpy().astype("<u4", copy=False)
            spans = [(a, b) if there else None for a, b, there in zip(bounds[:-1], bounds[1:], lists.is_valid().to_pylist())]
            sizes = [s and s[1] - s[0] for s in spans]
            sums = [s and zlib.crc32(flat[s[0] : s[1]]) for s in spans]
            columns = [*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_ids", "ids_crc32"])

    order = [name for name in rows.columns if name != ids]
    return map_texts(kept, run, schema).select(*dict.fromkeys([*order, "n_ids", "ids_crc32"]))


_UNKNOWN = "\N{REPLACEMENT CHARACTER}".encode()


def decode_ids(rows: DataFrame, model: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """The columns of `rows` with `text`, the text of the token ids in `ids`, added or
    replaced.

    Null ids give a null text, no ids an empty one. Null elements, ids that the vocabulary
    does not have and bytes that are no UTF-8 give the replacement character; control pieces
    give nothing. The space that encoding puts before a text is left out, so ids from
    `encode` give the text they were made of. Arrays are decoded whole, repeated rows each
    on their own, and an empty table gives an empty one.
    """
    names = [name for name in rows.columns if name != text]
    place = names.index(ids)
    kept = rows.select(*[rows[name] for name in names])
    schema = T.StructType([*kept.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        size = len(vocab.pieces)
        for batch in batches:
            made = []
            for array in batch.column(place):
                if not array.is_valid:
                    made.append(None)
                    continue
                found = [vocab.pieces[i] if i is not None and 0 <= i < size else _UNKNOWN for i in array.as_py()]
                data = b"".join(found)
                made.append(data.removeprefix(b" ").decode("utf-8", "replace"))
            columns = [batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.string())], names=[*names, text])

    return map_texts(kept, run, schema)
