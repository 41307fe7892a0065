"""N-gram Jaccard join with token-combination prefixes.

Texts are sets of hashed word shingles; two link when their Jaccard similarity reaches
`percent`. Equal sets are one from the start. A set that differs from every other one in
more tokens than the threshold allows is put aside by its lowest hashes: of any m tokens
of a set all but `slack` have to occur in a partner. In a large corpus single tokens occur
elsewhere by chance, so a second test looks at many at a time: hashes are cut into more
segments than linked sets have differing tokens, so some hold the same tokens in both.

The sets left are ordered by token frequency, rarest first. The first slack + 1 tokens
(the prefix) of linked sets share a token. If tokens of the frequent class stand in the
prefix, it is extended by one, which makes two shared tokens certain; then rare tokens
are indexed singly and frequent ones in combinations of two. Sets of more than LONG
tokens index frequent tokens singly, as their combinations would be too many; sets near
that size do both, so no link is lost.

Every set makes its entries once for each size class that partners may have: the more is
known of the sizes, the more tokens have to be shared, and the shorter is the prefix.

Sets with an index entry in common are candidates. At most FEW of them are compared with
each other. Of larger entries all sets are compared with its pivot (the set with the fewest
tokens of its own, as the original of a family of edited copies has). Two sets that are not
both linked with the pivot can only link when they share tokens in which they differ from
it, and by the prefix argument one of the rarest such tokens. So the sets of a pivot, if some
do not link with it, get entries for (pivot, differing token), and sets with such an entry in
common are compared. Comparisons use the whole sets.

Of a pivot with more than MORE sets the differences are no help: in a large family any two
sets share some. Such a group is cut into blocks, and the tokens that sets have in common
are counted for all pairs of two blocks at once, by a matrix product.

Only components matter. So after the first round the sets linked so far are one part, pairs
inside a part are not compared, and entries and pivots whose sets are all in one part are
closed: of a family around an original little is left to the second round but the sets
that are not in it. There is no third.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparrowscope.llm.common import Tables, map_texts, mix64, ship_package
from sparrowscope.llm.components import components
from sparrowscope.llm.shingles import digest, shingle_sets

# A token is of the frequent class if it occurs in this share of all sets, and in FREQUENT.
FREQUENT_SHARE = 1 / 500
FREQUENT = 16
LONG = 400
# Sets of an entry that are compared with each other at once; larger entries go by pivot.
# Groups of a pivot with up to MORE sets go by difference from it, larger ones in blocks.
FEW = 24
MORE = 512
# Tokens of a block; a set counts as SMALL of them at least, so a block has 512 sets at
# most or so. Tokens are counted by matrix product if one in RARE pairs of sets shares them.
BLOCK, SMALL, RARE = 1 << 18, 512, 100
COLUMNS, PAIRS = 256, 1 << 18
# Bounds of the size classes whose sets have the same segments grow by this factor, and
# this share of the segments is spare: they have to be equal whatever differs.
WIDTH, SPARE = 1.5, 0.2
# Bits of the filter that leaves rows out before they are dealt: 4 MB, powers of two.
SLOTS, WORDS = 1 << 14, 32


def slack(n: int, percent: int) -> int:
    """How many of n tokens may be missing in a linked set."""
    return n - -(-percent * n // 100)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _lists(values: list[np.ndarray]) -> pa.Array:
    sizes = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(_signed(flat.astype(np.uint64)) if flat.dtype != np.int64 else flat))


def _sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, mark, set (digest), n and the lowest hashes of every row (doc_id, text,
    mark)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, counts, low = [], [], []
            for tokens in shingle_sets(batch.column(1).to_pylist(), size):
                free = slack(len(tokens), percent)
                names.append(digest(tokens))
                counts.append(len(tokens))
                low.append(tokens[: free + free // 2 + 1] if len(tokens) > 1 else tokens[:0])
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(names, pa.int64()), pa.array(counts, pa.int64()), _lists(low)],
                names=["doc_id", "mark", "set", "n", "low"],
            )

    return map_texts(docs, run, "doc_id bigint, mark bigint, set bigint, n bigint, low array<bigint>")


def _whole_sets(rows: DataFrame, size: int) -> DataFrame:
    """set, n and all tokens of the rows (set, text) whose text has that set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, kept = [], []
            for name, tokens in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist(), size)):
                if digest(tokens) == name:
                    names.append(name)
                    kept.append(tokens)
            yield pa.record_batch(
                [pa.array(names, pa.int64()), pa.array([len(k) for k in kept], pa.int64()), _lists(kept)],
                names=["set", "n", "tokens"],
            )

    return map_texts(rows, run, "set bigint, n bigint, tokens array<bigint>")


def _ratio(percent: int) -> float:
    """Sizes of one class differ by this factor at most: that of the smallest partner."""
    return max(100 / percent, 1.03)


def size_bin(n: int, percent: int) -> int:
    """Number of the size class."""
    return int(math.log(n) / math.log(_ratio(percent)) + 1e-9)


def _least_of_bin(number: int, percent: int) -> int:
    size = max(1, int(_ratio(percent) ** number) - 1)
    while size_bin(size, percent) < number:
        size += 1
    return size


@cache
def partner_bins(n: int, percent: int) -> list[tuple[int, int]]:
    """Size classes of possible partners, and how many of n tokens may be missing in a
    partner of that class: similar sets share percent / (100 + percent) of both sizes."""
    low, high = -(-percent * n // 100), 100 * n // percent
    out = []
    for number in range(size_bin(low, percent), size_bin(high, percent) + 1):
        least = max(low, _least_of_bin(number, percent))
        if least <= high and size_bin(least, percent) == number:
            out.append((number, n - -(-percent * (n + least) // (100 + percent))))
    return out


def index_entries(
    n: int, tokens: np.ndarray, counts: np.ndarray, percent: int, frequent: int, long: int
) -> np.ndarray:
    """Entries of a set of `n` tokens, of which `tokens` are the first slack + 2 or more,
    rarest first; `counts` are the sets that have them. Tokens of no other set need no
    entry. Entries are made for every size class of partners, and name both classes."""
    own, made = size_bin(n, percent), []
    for other, free in partner_bins(n, percent):
        entries = _class_entries(n, tokens[: free + 2], counts[: free + 2], free, percent, frequent, long)
        if len(entries):
            low, high = min(own, other), max(own, other)
            made.append(mix64(entries ^ mix64(np.array([(low << 32) + high + 1], np.uint64))))
    return np.unique(np.concatenate(made)) if made else tokens[:0]


def _class_entries(
    n: int, wide: np.ndarray, counts: np.ndarray, free: int, percent: int, frequent: int, long: int
) -> np.ndarray:
    base = wide[: free + 1]
    often, shared = counts >= frequent, counts > 1
    if not often[: free + 1].any():
        return base[shared[: free + 1]]
    entries = [wide[shared & ~often]]
    if 100 * n > percent * long:
        entries.append(base[often[: free + 1]])
    if n <= long:
        common = np.sort(wide[often])
        first, second = np.triu_indices(len(common), 1)
        entries.append(mix64(mix64(common[first]) ^ (common[second] + np.uint64(0x9E3779B97F4A7C15))))
    return np.concatenate(entries)


def _index(ordered: DataFrame, percent: int, frequent: int, long: int) -> DataFrame:
    """entry, set and alone (tokens of no other set) for every index entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch.columns))
            entries, names, alone = [], [], []
            for name, n, tokens, counts in rows:
                made = index_entries(
                    n, np.array(tokens, np.int64).view(np.uint64), np.array(counts, np.int64), percent, frequent, long
                )
                entries.append(_signed(made))
                names.append(np.full(len(made), name))
                alone.append(np.full(len(made), counts.count(1), np.int32))
            yield pa.record_batch(
                [
                    pa.array(np.concatenate(c) if c else [], kind)
                    for c, kind in ((entries, pa.int64()), (names, pa.int64()), (alone, pa.int32()))
                ],
                names=["entry", "set", "alone"],
            )

    return map_texts(ordered, run, "entry bigint, set bigint, alone int")


def difference_entries(
    x: np.ndarray, counts: np.ndarray, y: np.ndarray, other_counts: np.ndarray, percent: int
) -> tuple[bool, np.ndarray]:
    """Whether a set x (tokens with the sets that have them) links with the pivot y, and
    entries from their symmetric difference X. Of another set z with the difference Z,
    entries meet if x and z link, unless both link with y.

    Linked x and z differ in at most `bound` tokens, and they differ in X and Z but for
    twice the tokens that X and Z share. So (|X| + |Z| - bound) / 2 are shared, and at
    least one. Ordered rarest first, the prefixes of X and Z share one then. Entries are
    made for every class of |Z|; tokens of x alone need none."""
    inside, found = np.isin(x, y, assume_unique=True), np.isin(y, x, assume_unique=True)
    both = int(inside.sum())
    linked = 100 * both >= percent * (len(x) + len(y) - both)
    apart = np.concatenate([x[~inside], y[~found]])
    held = np.concatenate([counts[~inside], other_counts[~found]])
    # Tokens of the pivot alone are missing in every other set: they come last.
    only = np.concatenate([np.zeros(len(x) - both, bool), other_counts[~found] == 1])
    order = np.lexsort((apart, held, only))
    apart, useful = apart[order], (held > 1)[order] | only[order]
    bound = (len(x) + 100 * len(x) // percent) * (100 - percent) // (100 + percent)
    width = max(1, len(y) * (100 - percent) // (100 + percent) // 2)
    size, own, made = len(apart), len(apart) // width, []
    least = max(0, size - bound)
    if linked:  # then only a z that does not link with y matters, and it differs by more
        least = max(least, (-(-percent * len(x) // 100) + len(y)) * (100 - percent) // (100 + percent) + 1)
    for other in range(least // width, (size + bound) // width + 1):
        shared = max(1, -(-(size + other * width - bound) // 2))
        entries = apart[: size - shared + 1][useful[: size - shared + 1]] if shared <= size else apart[:0]
        if len(entries):
            low, high = min(own, other), max(own, other)
            made.append(mix64(entries.view(np.uint64) ^ mix64(np.array([(low << 32) + high + 1], np.uint64))))
    return linked, np.unique(np.concatenate(made)) if made else np.zeros(0, np.uint64)


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """set, pivot, last, alone, linked and, unless last, the difference entries of the pairs."""
    left = sets.select("set", "n", "tokens", "counts")
    right = sets.select(F.col("set").alias("pivot"), F.col("tokens").alias("y"), F.col("counts").alias("m"))
    joined = pairs.join(left, "set").join(right, "pivot").select(
        "set", "pivot", "tokens", "counts", "y", "m", "last"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, counts, y, m = (batch.column(k) for k in range(2, 6))
            last, made = batch.column(6).to_pylist(), []
            for k in range(batch.num_rows):
                a, b = np.asarray(x[k].values), np.asarray(y[k].values)
                if last[k]:
                    made.append((_similar(a, b, percent), np.zeros(0, np.uint64)))
                else:
                    made.append(difference_entries(a, np.asarray(counts[k].values), b, np.asarray(m[k].values), percent))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(6),
                    pa.array([int((np.asarray(counts[k].values) == 1).sum()) for k in range(batch.num_rows)], pa.int32()),
                    pa.array([linked for linked, _ in made], pa.bool_()),
                    _lists([apart for _, apart in made]),
                ],
                names=["set", "pivot", "last", "alone", "linked", "apart"],
            )

    schema = "set bigint, pivot bigint, last boolean, alone int, linked boolean, apart array<bigint>"
    return map_texts(joined, run, schema)


def may_have(rows: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    """The rows whose columns `names` may stand in `keys`: all that do, and some others.

    Every key sets one bit of a filter of fixed size, which goes to all tasks. With a
    million keys 3 % of the other rows pass, with 100 million nearly all."""
    own = F.xxhash64(*names).alias("key")
    slot = F.expr(f"key & {SLOTS - 1}").alias("slot")
    word = F.expr(f"CAST(shiftright(key, {SLOTS.bit_length() - 1}) & {WORDS - 1} AS int)").alias("word")
    bit = F.expr(f"shiftleft(1L, CAST(shiftright(key, {(SLOTS * WORDS).bit_length() - 1}) & 63 AS int))").alias("bit")
    words = keys.select(own).select(slot, word, bit).groupBy("slot", "word").agg(F.bit_or("bit").alias("bits"))
    entries = words.groupBy("slot").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("of"))
    filled = entries.select("slot", F.transform(
        F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda k: F.coalesce(F.col("of")[k], F.lit(0))
    ).alias("words"))
    placed = rows.select(F.struct(*rows.columns).alias("row"), own).select("row", slot, word, bit)
    held = placed.join(F.broadcast(filled), "slot").where(F.col("words")[F.col("word")].bitwiseAND(F.col("bit")) != 0)
    return held.select("row.*")


def _candidates(docs: DataFrame, members: DataFrame, tables: Tables, size: int, percent: int) -> DataFrame:
    """set, n and tokens of the sets that may have a partner."""
    sets = members.where("n > 1").groupBy("set").agg(
        F.min(F.struct("doc_id", "mark")).alias("from"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies")
    )
    low = members.where("n > 1").select("set", F.explode("low").alias("token"))
    shared = low.groupBy("token").agg(F.min("set").alias("a"), F.max("set").alias("b"))
    shared = tables.store(shared.where("a != b").select("token"), "shared-tokens")
    # Every copy of a set brings the same tokens.
    held = low.join(shared, "token", "left_semi").groupBy("set").agg(F.count(F.lit(1)).alias("held"))
    free = F.col("n") - F.ceil(F.col("n") * percent / 100)
    wanted = (F.floor(free / 2) + 1) * F.col("copies")
    chosen = tables.store(
        sets.join(held, "set").where(F.col("held") >= wanted).select("set", "from.doc_id", "from.mark"), "chosen-sets"
    )
    tables.drop(shared)
    # Of most rows no text is dealt. Repeated rows meet in the join already, so their texts
    # need not be dealt again.
    rows = may_have(docs, chosen, ["doc_id", "mark"]).join(chosen, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"]).select("set", "text")
    whole = tables.store(_whole_sets(rows, size), "sets")
    tables.drop(chosen)
    found = sets_with_equal_segments(whole, tables, percent)
    tables.drop(whole)
    return found


@cache
def _class_bounds() -> list[int]:
    """Smallest sizes of the classes."""
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * WIDTH)))
    return bounds


def _differing(n: int, m: int, percent: int) -> int:
    """In how many tokens linked sets of these sizes differ at most."""
    return (100 - percent) * (n + m) // (100 + percent)


@cache
def segment_plans(n: int, percent: int) -> list[tuple[int, int, int]]:
    """For the size class of the smaller set of a pair: its number, how many segments the
    hashes are cut into, and how many of those a set of `n` has in common with a partner."""
    bounds, plans = _class_bounds(), []
    own = bisect_right(bounds, n) - 1
    for kind in range(bisect_right(bounds, -(-percent * n // 100)) - 1, own + 1):
        most = bounds[kind + 1] - 1
        differing = _differing(most, 100 * most // percent, percent)
        free = min(differing, _differing(n, 100 * n // percent if kind == own else most, percent))
        number = differing + int(differing * SPARE) + 1
        plans.append((kind, number, number - free))
    return plans


def segment_signs(tokens: np.ndarray, percent: int) -> list[tuple[int, int, np.ndarray]]:
    """Per size class of a pair: its number, hashes of the set's segments that are not
    empty, and how many of them a partner has at least. `tokens` are sorted."""
    mixed, made = mix64(tokens), []
    for kind, number, equal in segment_plans(len(tokens), percent):
        segment = ((tokens >> np.uint64(32)) * np.uint64(number)) >> np.uint64(32)
        heads = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        place = mix64(segment[heads] + np.uint64(kind + 1 << 32))
        empty = number - len(heads)
        made.append((kind, equal - empty, mix64(np.add.reduceat(mixed, heads) ^ place)))
    return made


def _segments(sets: DataFrame, percent: int) -> DataFrame:
    """set, kind, need (how many signs a partner has) and sign for every segment; a null
    sign where a partner may have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, rows = batch.column(0).to_pylist(), []
            for k, name in enumerate(names):
                tokens = np.asarray(batch.column(1)[k].values).view(np.uint64)
                for kind, need, signs in segment_signs(tokens, percent):
                    found = pa.array(_signed(signs)) if need > 0 else pa.nulls(1, pa.int64())
                    rows.append((name, kind, max(need, 0), found))
            sizes = [len(r[3]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array([r[0] for r in rows], np.int64), sizes)),
                    pa.array(np.repeat(np.array([r[1] for r in rows], np.int32), sizes)),
                    pa.array(np.repeat(np.array([r[2] for r in rows], np.int32), sizes)),
                    pa.concat_arrays([r[3] for r in rows]) if rows else pa.nulls(0, pa.int64()),
                ],
                names=["set", "kind", "need", "sign"],
            )

    return map_texts(sets.select("set", "tokens"), run, "set bigint, kind int, need int, sign bigint")


def sets_with_equal_segments(sets: DataFrame, tables: Tables, percent: int) -> DataFrame:
    """The rows of `sets` (set, n, tokens) that may link with another one: as many of their
    segments as a partner has to have occur in other sets."""
    segments = _segments(sets, percent)
    shared = segments.where("sign IS NOT NULL").groupBy("sign").agg(F.min("set").alias("a"), F.max("set").alias("b"))
    shared = tables.store(shared.where("a != b").select("sign"), "shared-segments")
    held = segments.join(shared, "sign", "left_semi").groupBy("set", "kind", "need").agg(
        F.count(F.lit(1)).alias("held")
    )
    kept = held.where("held >= need").select("set").union(segments.where("sign IS NULL").select("set")).distinct()
    kept = tables.store(kept, "kept-sets")
    tables.drop(shared)
    found = tables.store(sets.join(kept, "set", "left_semi"), "sets")
    tables.drop(kept)
    return found


def linked_sets(sets: DataFrame, tables: Tables, percent: int, frequent: int, long: int) -> DataFrame:
    """node and root of every set that links with another one."""
    tokens = sets.select("set", "n", F.explode("tokens").alias("token"))
    counts = tables.store(
        tokens.groupBy("token").agg(F.count(F.lit(1)).alias("count")).where("count > 1"), "token-counts"
    )
    ranked = tokens.join(counts, "token", "left").select(
        "set", "n", F.struct(F.coalesce("count", F.lit(1)).alias("count"), "token").alias("t")
    )
    ranked = ranked.groupBy("set", "n").agg(F.sort_array(F.collect_list("t")).alias("t"))
    ordered = ranked.select(
        "set", "n", F.transform("t", lambda t: t["token"]).alias("tokens"),
        F.transform("t", lambda t: t["count"]).alias("counts"),
    )
    ordered = tables.store(ordered, "ordered-sets")
    tables.drop(counts)
    head = F.lit(1), F.greatest(F.lit(1), F.col("n") - F.ceil(F.col("n") * percent / 100) + 2).cast("int")
    heads = ordered.select("set", "n", F.slice("tokens", *head).alias("tokens"), F.slice("counts", *head).alias("counts"))
    often = max(frequent, math.ceil(ordered.count() * FREQUENT_SHARE))
    index = tables.store(_index(heads, percent, often, long).withColumn("part", F.col("set")), "index")
    found = _round(index, ordered, tables, percent, FEW)
    links, going = _pairs_of(found), found.where("NOT last")
    nodes = components(links, tables)
    if not going.limit(1).count():
        return nodes
    groups = _open_groups(going, nodes, tables)
    index = groups.where(F.col("sets") <= MORE).select(
        F.explode("apart").alias("token"), "pivot", "set", "alone", "part"
    )
    index = index.select(F.xxhash64("pivot", "token").alias("entry"), "set", "alone", "part").distinct()
    # No group has more than MORE sets, so no entry goes by pivot again.
    more = _pairs_of(_round(tables.store(index, "index"), ordered, tables, percent, MORE))
    large = groups.where(F.col("sets") > MORE)
    if large.limit(1).count():
        more = more.union(tables.store(_links_in_blocks(large, ordered, percent), "block-links"))
    tables.drop(groups, ordered)
    return components(links.union(more), tables) if more.limit(1).count() else nodes


def _round(index: DataFrame, sets: DataFrame, tables: Tables, percent: int, few: int) -> DataFrame:
    """The comparisons of the sets that have entries of `index` in common."""
    held = index.groupBy("entry").agg(
        F.count(F.lit(1)).alias("held"), F.min(F.struct("alone", "set")).alias("first"),
        F.min("part").alias("low"), F.max("part").alias("high"),
    )
    # Sets of one component have nothing left to find.
    held = held.where("low != high").select("entry", "held", F.col("first.set").alias("pivot"))
    held = tables.store(held, "open-entries")
    rows = index.select("entry", "set", "part")
    small = rows.join(held.where(F.col("held") <= few).select("entry"), "entry")
    other = small.select("entry", F.col("set").alias("pivot"), F.col("part").alias("its"))
    inside = small.join(other, "entry").where("set > pivot AND part != its")
    to_pivot = rows.join(held.where(F.col("held") > few).select("entry", "pivot"), "entry").where("set != pivot")
    pairs = inside.select("set", "pivot", F.lit(True).alias("last")).union(
        to_pivot.select("set", "pivot", F.lit(False).alias("last"))
    )
    pairs = pairs.groupBy("set", "pivot").agg(F.bool_and("last").alias("last"))
    found = tables.store(_compared(pairs, sets, percent), "compared")
    tables.drop(index, held)
    return found


def _open_groups(going: DataFrame, nodes: DataFrame, tables: Tables) -> DataFrame:
    """The sets by pivot, with the component each is in by now (`part`), entries by what they
    differ in from the pivot (`apart`), and how many the pivot has (`sets`). Pivots that
    are in one component with all their sets are left out."""
    part = nodes.select(F.col("node").alias("set"), F.col("root").alias("part"))
    its = nodes.select(F.col("node").alias("pivot"), F.col("root").alias("its"))
    known = going.join(part, "set", "left").join(its, "pivot", "left").select(
        "pivot", "set", "alone", "apart", F.coalesce("part", "set").alias("part"), F.coalesce("its", "pivot").alias("its")
    )
    known = tables.store(known, "known-parts")
    sizes = known.groupBy("pivot").agg(F.count(F.lit(1)).alias("sets"), F.bool_or(F.expr("part != its")).alias("open"))
    groups = tables.store(known.join(sizes.where("open").drop("open"), "pivot").drop("its"), "open-groups")
    tables.drop(known)
    return groups


def _links_in_blocks(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a and b for the links between sets of one pivot (pivot, set, part) that are in different
    parts: as many as connect what all of them connect. A block holds sets of the group's
    largest part only, or none of it; two blocks of that part have nothing left to find."""
    rows = groups.select("pivot", "set", "part").join(sets.select("set", "n"), "set")
    sums = rows.groupBy("pivot", "part").agg(F.sum(F.greatest("n", F.lit(SMALL))).alias("tokens"))
    cut = sums.groupBy("pivot").agg(F.max(F.struct("tokens", "part")).alias("main"), F.sum("tokens").alias("all"))
    cut = cut.where("all > main.tokens").select(
        "pivot", F.col("main.part").alias("main"), F.ceil(F.col("main.tokens") / BLOCK).alias("mains"),
        F.ceil((F.col("all") - F.col("main.tokens")) / BLOCK).alias("others"),
    )
    placed = groups.select("pivot", "set", "part").join(cut, "pivot").withColumn("block", F.expr(
        "IF(part = main, pmod(xxhash64(set), mains), mains + pmod(xxhash64(set), others))"
    ))
    met = F.explode(F.expr("sequence(IF(part = main, mains, 0L), mains + others - 1)")).alias("met")
    dealt = placed.join(sets.select("set", "tokens"), "set").select("pivot", "set", "part", "block", "tokens", met).select(
        "pivot", F.least("block", "met").alias("i"), F.greatest("block", "met").alias("j"), "block", "set", "part", "tokens"
    )

    def run(table: pa.Table) -> pa.Table:
        at, tokens = table.column("block").to_numpy(), table.column("tokens").combine_chunks()
        names, parts = table.column("set").to_numpy(), table.column("part").to_numpy()
        values, offsets = tokens.values.to_numpy(), tokens.offsets.to_numpy()
        left = np.flatnonzero(at == table.column("i")[0].as_py())
        right = np.flatnonzero(at == table.column("j")[0].as_py())
        x, y = ([values[offsets[k] : offsets[k + 1]] for k in side] for side in (left, right))
        if not x or not y:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        both, sizes = overlaps(x, y), np.diff(offsets).astype(np.int32)
        linked = 100 * both >= percent * (sizes[left][:, None] + sizes[right][None, :] - both)
        linked &= parts[left][:, None] != parts[right][None, :]
        a, b = spanning(linked)
        named = np.concatenate([names[left], names[right]])
        return pa.table({"a": pa.array(named[a], pa.int64()), "b": pa.array(named[b], pa.int64())})

    ship_package(groups.sparkSession)
    return dealt.groupBy("pivot", "i", "j").applyInArrow(run, "a bigint, b bigint")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of `left` has in common with each one of `right`."""
    shape, sides = (len(left), len(right)), []
    for sets in (left, right):
        flat, rows = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(flat, kind="stable")
        sides.append((flat[order], rows[order]))
    (x, of_x), (y, of_y) = sides
    tokens = np.intersect1d(x, y)
    x_at, y_at = np.searchsorted(x, tokens), np.searchsorted(y, tokens)
    x_held, y_held = np.searchsorted(x, tokens, "right") - x_at, np.searchsorted(y, tokens, "right") - y_at
    pairs = x_held * y_held
    common = pairs * RARE > shape[0] * shape[1]
    often, rare = np.flatnonzero(common), np.flatnonzero(~common)
    out = np.zeros(shape, np.float32)
    for start in range(0, len(often), COLUMNS):
        some = often[start : start + COLUMNS]
        a, b = np.zeros((shape[0], len(some)), np.float32), np.zeros((shape[1], len(some)), np.float32)
        for k, t in enumerate(some):
            a[of_x[x_at[t] : x_at[t] + x_held[t]], k] = 1
            b[of_y[y_at[t] : y_at[t] + y_held[t]], k] = 1
        out += a @ b.T
    counts, total = out.astype(np.int32).ravel(), np.cumsum(pairs[rare])
    del out
    start = 0
    while start < len(rare):
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + PAIRS, "right")))
        some = rare[start:end]
        t = np.repeat(some, pairs[some])
        nth = np.arange(len(t)) - np.repeat(np.cumsum(pairs[some]) - pairs[some], pairs[some])
        found = of_x[x_at[t] + nth // y_held[t]] * shape[1] + of_y[y_at[t] + nth % y_held[t]]
        at, more = np.unique(found, return_counts=True)
        counts[at] += more.astype(np.int32)
        start = end
    return counts.reshape(shape)


def spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes that connect what the links between rows and columns connect, one for
    each node at most. Rows are numbered first, then columns."""
    rows, columns = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
    links, none = linked[np.ix_(rows, columns)], sum(linked.shape)
    at, low, none = (columns + linked.shape[0]).astype(np.int32), rows.astype(np.int32), np.int32(none)
    while len(rows):
        high = np.minimum(at, np.where(links, low[:, None], none).min(0))
        lowered = np.minimum(low, np.where(links, high[None, :], none).min(1))
        at, same = high, bool((lowered == low).all())
        low = lowered
        if same:
            break
    nodes, least = np.concatenate([rows, columns + linked.shape[0]]), np.concatenate([low, at])
    return nodes[nodes != least], least[nodes != least]


def _pairs_of(found: DataFrame) -> DataFrame:
    return found.where("linked").select(F.col("set").alias("a"), F.col("pivot").alias("b"))


def _placed_rows(
    docs: DataFrame, size: int, percent: int, id: str, text: str, frequent: int, long: int
) -> DataFrame:
    """doc_id, mark (hash of the text), n and component_id of every row."""
    if percent <= 50:  # sets of one token have no entries: only below could they link
        raise ValueError(f"percent has to be above 50, not {percent}")
    tables = Tables(docs.sparkSession)
    rows = docs.select(
        docs[id].cast("bigint").alias("doc_id"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("mark")
    )
    members = tables.store(_sets(rows, size, percent), "members")
    known = members.where("doc_id IS NOT NULL")
    sets = _candidates(rows, known, tables, size, percent)
    nodes = linked_sets(sets, tables, percent, frequent, long)
    least = known.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("least"))
    placed = least.join(nodes, F.col("set") == F.col("node"), "left").withColumn(
        "at", F.coalesce("root", "set")
    )
    placed = tables.store(placed.select("set", "at", "least"), "placed-sets")
    lowest = placed.groupBy("at").agg(F.min("least").alias("component_id"))
    named = placed.join(lowest, "at").select("set", "component_id")
    component = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return members.select("doc_id", "mark", "set", "n").join(named, "set", "left").select(
        "doc_id", "mark", "n", component.alias("component_id")
    )


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text",
    frequent: int = FREQUENT, long: int = LONG,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    component_id is the smallest id that links lead to, the own one included. Null and
    empty texts have no shingles and link with nothing; texts of fewer than `size` words
    are one shingle. Rows with a null id link with nothing and have a null component.
    Repeated rows have equal results; rows of one id with other texts link each by its own
    text. An empty table gives an empty result. Other columns are not read. `percent` has
    to be above 50.
    """
    placed = _placed_rows(docs, size, percent, id, text, frequent, long)
    return placed.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(
    docs: DataFrame, size: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text",
    frequent: int = FREQUENT, long: int = LONG,
) -> DataFrame:
    """The rows of `docs`, all columns as they are, but of each component only one: that
    of the smallest id. Rows with a null id stay, and so does one row of every id whose
    text has no word; of repeated rows one stays. Columns may have any names. An empty table
    gives an empty one. `percent` has to be above 50."""
    tables = Tables(docs.sparkSession)
    placed = _placed_rows(docs, size, percent, id, text, frequent, long)
    kept = placed.where("doc_id IS NOT NULL").groupBy("component_id", F.col("n") == 0).agg(
        F.min(F.struct("doc_id", "mark")).alias("kept")
    )
    kept = tables.store(kept.select(F.col("kept.doc_id").alias("__id"), F.col("kept.mark").alias("__mark")), "kept")
    # The columns of `docs` travel in one, so that no name of theirs can clash.
    marked = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("__row"),
        docs[id].cast("bigint").alias("__own"), F.xxhash64(docs[text]).alias("__text"),
    )
    stay = marked.where("__own IS NOT NULL").join(
        kept.distinct(), (F.col("__own") == F.col("__id")) & (F.col("__text") == F.col("__mark")), "left_semi"
    ).dropDuplicates(["__own", "__text"])
    return stay.union(marked.where("__own IS NULL")).select("__row.*")
