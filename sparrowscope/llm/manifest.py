"""Merkle manifest of a dataset, built by a butterfly exchange.

Every row is a leaf. The leaves of a group (a source) ascend by key and form a tree in
which FANOUT consecutive nodes become one; the roots of the groups form the top tree in
the same way. A partition is an aligned block of FANOUT ** LEVELS leaves of one group.
Rounds follow: in each one, the partitions whose numbers differ in one base-FANOUT digit
only form a group, swap the roots of the subtrees they stand for, and every one of them
hashes the common ancestor itself. So a partition holds its siblings on all upper levels
when the last round ends, and no pass leads down again. Where the last subtree of a run
has fewer partitions than the others, its partitions also send on behalf of those missing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sparrowscope.llm.common import Tables, crc_mod, map_texts

FANOUT = 16
LEVELS = 2
# Rows with tampered text are those whose key has this divisor of its checksum.
TAMPERED = 5

_STEP = "struct<slot:int,siblings:array<string>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW_MASK = (1 << 33) - 1


def leaf_hash(*columns: Column) -> Column:
    """SHA-256 of the values, each as UTF-8 byte count, colon and value, `-` for null."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _blocks(nodes: DataFrame, size: int, tables: Tables) -> DataFrame:
    """Nodes (g, k, h, x, salt) as one row per block: g, block, blocks (of the group) and
    the nodes in order. Equal nodes differ in `salt`, so that they too can be split
    between tasks."""
    order = [F.col("g").asc_nulls_first(), F.col("k").asc_nulls_first(), "h", "salt"]
    ranged = nodes.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.drop("salt").withColumn("part", F.spark_partition_id()).withColumn(
        "row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))
    )
    ranged = tables.store(ranged, "ranged")
    counts = ranged.groupBy("g", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("g")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("g").alias("gg"), F.col("part").alias("pp"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.ceil(F.sum("n").over(whole) / size).alias("blocks"),
    )
    same = ranged["g"].eqNullSafe(starts["gg"]) & (ranged["part"] == starts["pp"])
    placed = ranged.join(starts, same).withColumn("place", F.col("row") + F.col("shift"))
    member = F.struct((F.col("place") % size).alias("i"), "k", "h", "x")
    blocks = placed.groupBy("g", F.floor(F.col("place") / size).alias("block"), "blocks").agg(
        F.array_sort(F.collect_list(member)).alias("nodes")
    )
    blocks = tables.store(blocks, "blocks")
    tables.drop(ranged)
    return blocks


def _hash(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _subtree(leaves: list[str], more: bool, fanout: int, levels: int) -> list[list[str]]:
    """The levels of a block's tree, the last one its root. A block among others has all
    levels, also where it holds few leaves; a lone one stops at a single node."""
    out = [leaves]
    while len(out) <= levels and (more or len(out[-1]) > 1):
        last = out[-1]
        out.append([_hash(last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return out


def _block_roots(fanout: int, levels: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.to_pydict()
            roots = [
                _subtree([h.hex() for h in hashes], blocks > 1, fanout, levels)[-1][0]
                for hashes, blocks in zip(columns["h"], columns["blocks"])
            ]
            yield pa.RecordBatch.from_pydict(
                {"g": batch.column("g"), "block": batch.column("block"), "blocks": batch.column("blocks"),
                 "root": pa.array(roots, pa.string())}
            )

    return make


def _swap(state: DataFrame, round_: int, fanout: int) -> DataFrame:
    """One round: every partition gets the roots of the sibling subtrees from the partners
    with its own lower digits, and hashes their common ancestor."""
    below = fanout**round_
    block, blocks = F.col("block"), F.col("blocks")
    node, low = F.floor(block / below), block % below
    parent = F.floor(block / (below * fanout))
    nodes = F.ceil(blocks / below)
    own = F.least(F.lit(below), blocks - node * below)
    siblings = F.least(F.lit(fanout), nodes - parent * fanout)
    alone = (siblings == 1) | (own == below)
    sent = state.select(
        "g", block, blocks, "root", "upper", parent.alias("parent"), (node % fanout).cast("int").alias("slot"),
        low.alias("low"), nodes.alias("nodes"),
        F.explode(F.when(alone, F.array(low)).otherwise(F.sequence(low, F.lit(below - 1), own))).alias("to"),
    )
    # A copy sent for a missing partner carries its root only.
    real = F.when(F.col("to") == F.col("low"), F.struct("block", "upper")).alias("real")
    met = sent.groupBy("g", "blocks", "nodes", "parent", "to").agg(
        F.array_sort(F.collect_list(F.struct("slot", "root", real))).alias("run")
    )
    here = met.select("g", "blocks", "nodes", "run", F.explode(F.filter("run", lambda m: m["real"].isNotNull())).alias("me"))
    others = F.transform(F.filter("run", lambda m: m["slot"] != F.col("me.slot")), lambda m: m["root"])
    step = F.struct(F.col("me.slot").alias("slot"), others.alias("siblings"))
    goes_on = F.col("nodes") > 1
    ancestor = F.sha2(F.array_join(F.transform("run", lambda m: m["root"]), "").cast("binary"), 256)
    return here.select(
        "g", F.col("me.real.block").alias("block"), "blocks",
        F.when(goes_on, ancestor).otherwise(F.col("me.root")).alias("root"),
        F.when(goes_on, F.array_append("me.real.upper", step)).otherwise(F.col("me.real.upper")).alias("upper"),
    )


def _grown(blocks: DataFrame, fanout: int, levels: int, tables: Tables) -> DataFrame:
    """g, block, root (of the whole group) and the steps above every block."""
    schema = f"g {blocks.schema['g'].dataType.simpleString()}, block bigint, blocks bigint, root string"
    roots = map_texts(blocks.select("g", "block", "blocks", F.col("nodes.h").alias("h")), _block_roots(fanout, levels), schema)
    state = tables.store(roots.withColumn("upper", F.array().cast(f"array<{_STEP}>")), "subtrees")
    most = state.agg(F.max("blocks")).first()[0] or 0
    round_ = 0
    while fanout**round_ < most:
        before, state = state, tables.store(_swap(state, round_, fanout), "subtrees")
        tables.drop(before)
        round_ += 1
    return state


def _steps(levels: list[list[str]], place: int, fanout: int) -> list[tuple[int, list[str]]]:
    """Slot and siblings of a leaf on every level of its block."""
    out = []
    for nodes in levels[:-1]:
        start, slot = place - place % fanout, place % fanout
        out.append((slot, nodes[start:place] + nodes[place + 1 : start + fanout]))
        place //= fanout
    return out


def fold(leaf: str, steps: list[tuple[int, list[str]]]) -> str:
    """Root that a leaf and its siblings, level by level, lead to."""
    for slot, siblings in steps:
        leaf = _hash([*siblings[:slot], leaf, *siblings[slot:]])
    return leaf


def _pairs(steps: list[dict]) -> list[tuple[int, list[str]]]:
    return [(step["slot"], step["siblings"]) for step in steps]


def _leaves(fanout: int, levels: int, digests: bool, key: pa.DataType):
    """Blocks with their upper steps to one row per leaf."""

    def rows(block: dict) -> Iterator[tuple]:
        leaves = [h.hex() for h in block["h"]]
        tree, upper = _subtree(leaves, block["blocks"] > 1, fanout, levels), _pairs(block["upper"])
        above = "".join("".join(siblings) for _, siblings in upper)
        for place, leaf in enumerate(leaves):
            steps = _steps(tree, place, fanout)
            if not digests:
                proof = [{"slot": slot, "siblings": siblings} for slot, siblings in steps + upper]
                yield block["k"][place], leaf, block["subroot"], block["root"], proof
                continue
            changed = block["x"][place]
            proof = _hash(["".join(siblings) for _, siblings in steps] + [above])
            folded = fold(leaf if changed is None else changed.hex(), steps + upper)
            yield block["k"][place], leaf, block["subroot"], block["root"], proof, folded, folded == block["root"]

    types = [key, pa.string(), pa.string(), pa.string()]
    if digests:
        types += [pa.string(), pa.string(), pa.bool_()]
        names = ["k", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    else:
        types.append(pa.list_(pa.struct([("slot", pa.int32()), ("siblings", pa.list_(pa.string()))])))
        names = ["k", "leaf", "subroot", "root", "proof"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                columns = list(zip(*rows(batch.slice(i, 1).to_pylist()[0])))
                arrays = [pa.array(column, kind) for column, kind in zip(columns, types)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return make


def _expanded(blocks: DataFrame, upper: DataFrame, digests: bool, fanout: int, levels: int) -> DataFrame:
    """Rows of the leaves of `blocks`; `upper` has g, block, subroot, root and the steps
    above the block."""
    upper = upper.select(F.col("g").alias("gg"), F.col("block").alias("bb"), "subroot", "root", "upper")
    same = blocks["g"].eqNullSafe(upper["gg"]) & (blocks["block"] == upper["bb"])
    key = blocks.schema["nodes"].dataType.elementType["k"].dataType.simpleString()
    frame = blocks.join(upper, same).select(
        "blocks", "subroot", "root", "upper", F.col("nodes.k").alias("k"), F.col("nodes.h").alias("h"),
        F.col("nodes.x").alias("x"),
    )
    schema = f"k {key}, leaf string, subroot string, root string, "
    schema += "proof_sha256 string, folded_root string, verified boolean" if digests else f"proof array<{_STEP}>"
    arrow = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[key]
    # A row is a block with thousands of hashes, so that few make a batch.
    return map_texts(frame, _leaves(fanout, levels, digests, arrow), schema)


def manifest(
    docs: DataFrame,
    id: str = "doc_id",
    group: str = "source",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    text: str = "text",
    proofs: bool = False,
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> DataFrame:
    """Per row of `docs` its id, leaf, subroot (of its group) and root (of all).

    With `proofs`, also `proof`: per level, from the leaf up to the root, the slot of the
    node in its run and its siblings. `fold` and `verify` lead from them to the root.
    Otherwise proof_sha256 (of all siblings), folded_root and verified: a check in which
    the rows that TAMPERED chooses by checksum of the id have A-Z of their text lowered
    and are folded up with the siblings of the original.

    Leaves of a group ascend by id, null first; rows with one id ascend by leaf, so
    repeated rows have a place each. Null values, ids and groups count as such (a null
    group is the first), empty texts are values of no bytes, texts are hashed whole. An
    empty table has no rows. Other columns are not read.
    """
    tables = Tables(docs.sparkSession)
    size = fanout**levels
    lowered = F.translate(docs[text], _UPPER, _LOWER)
    parts = {c: docs[c] for c in columns}
    changed = leaf_hash(*(parts | {text: lowered}).values())
    nodes = docs.select(
        docs[group].cast("string").alias("g"), docs[id].alias("k"),
        F.unhex(leaf_hash(*parts.values())).alias("h"),
        F.when(crc_mod(docs[id], TAMPERED) == 0, F.unhex(changed)).alias("x"),
        F.monotonically_increasing_id().alias("salt"),
    )
    nodes = tables.store(nodes, "leaves")
    blocks = _blocks(nodes, size, tables)
    tables.drop(nodes)
    state = _grown(blocks, fanout, levels, tables)

    no = F.lit(None).cast("binary")
    subroots = state.where("block = 0").select(
        F.lit(0).alias("g"), F.col("g").alias("k"), F.unhex("root").alias("h"), no.alias("x"), F.lit(0).alias("salt")
    )
    top_blocks = _blocks(subroots, size, tables)
    top_state = _grown(top_blocks, fanout, levels, tables)
    top = _expanded(top_blocks, top_state.withColumn("subroot", F.col("root")), False, fanout, levels)
    top = tables.store(top.select(F.col("k").alias("source"), F.col("root").alias("top"), "proof"), "top")
    tables.drop(top_blocks, top_state)

    upper = state.join(top, state["g"].eqNullSafe(top["source"])).select(
        "g", "block", F.col("root").alias("subroot"), F.col("top").alias("root"),
        F.concat("upper", "proof").alias("upper"),
    )
    return _expanded(blocks, upper, not proofs, fanout, levels).withColumnRenamed("k", id)


def verify(proofs: DataFrame, leaf: str = "leaf", proof: str = "proof", root: str = "root") -> DataFrame:
    """Adds verified: whether a leaf and its proof lead to the root. A null leaf, proof or
    root does not."""
    joined = F.aggregate(
        proofs[proof], proofs[leaf].cast("string"),
        lambda node, step: F.sha2(
            F.concat(
                F.array_join(F.slice(step["siblings"], F.lit(1), step["slot"]), ""), node,
                F.array_join(F.slice(step["siblings"], step["slot"] + 1, F.size(step["siblings"])), ""),
            ).cast("binary"),
            256,
        ),
    )
    return proofs.withColumn("verified", F.coalesce(joined == proofs[root], F.lit(False)))
