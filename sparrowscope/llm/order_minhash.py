"""Order MinHash: fingerprints of texts that follow edit distance, with DataFrame
functions only.

A text's k-mers are runs of K tokens (pieces of at most 12 characters of its words). Equal
k-mers are numbered by occurrence, so that repetition counts. Each numbered k-mer has one
39-bit hash; signature j orders the hashes cyclically from its own starting point, the
SIGNATURES points lying at equal distances, and takes the TUPLE k-mers that come first in
that order. They are put back into the order in which they stand in the text, and the
tuple is hashed. Two texts share a signature if they share the k-mers chosen and have them
in the same order, so moving a passage costs likeness as an edit does, which plain
MinHash does not see. One sort of a text's hashes serves all signatures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparrowscope.llm.common import Tables

TOKEN = r"[^\x20\x09-\x0D]{1,12}"
K = 3
TUPLE = 2
SIGNATURES = 64

# A packed k-mer: 39 bits of hash above 24 bits of place, which counts from 1.
PLACE_BITS = 24
HASH_BITS = 63 - PLACE_BITS
_PLACES = (1 << PLACE_BITS) - 1
_HASHES = ((1 << HASH_BITS) - 1) << PLACE_BITS
_STARTS = [(j << 63) // SIGNATURES for j in range(SIGNATURES)]


def _packed(hash: Column, place: Column) -> Column:
    return hash.bitwiseAND(F.lit(_HASHES)).bitwiseOR(place)


def _hash_part(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _kmers(tokens: Column) -> Column:
    """Packed k-mers of an array of token hashes, in text order. Texts of fewer than K
    tokens have one k-mer of all of them, texts without tokens none."""
    place = lambda i: (i % F.lit(_PLACES) + 1).cast("long")
    runs = F.transform(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - (K - 1), F.lit(0))),
        lambda h, i: _packed(F.xxhash64(h, *[F.get(tokens, i + k) for k in range(1, K)]), place(i)),
    )
    whole = F.array(_packed(F.xxhash64(tokens), F.lit(1).cast("long")))
    return F.when((F.size(tokens) > 0) & (F.size(tokens) < K), whole).otherwise(runs)


def _first_of_runs(ordered: Column) -> Column:
    """Places in the sorted array at which another k-mer begins."""
    places = F.when(F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.filter(
        places,
        lambda j: (j == 0) | (_hash_part(F.get(ordered, j)) != _hash_part(F.get(ordered, j - 1))),
    )


def _numbered(ordered: Column, firsts: Column) -> Column:
    """The sorted k-mers with the second and later occurrences hashed anew with their
    number, sorted again."""
    size = F.size(ordered)
    numbers = F.flatten(
        F.transform(firsts, lambda f, q: F.sequence(F.lit(1), F.coalesce(F.get(firsts, q + 1), size) - f))
    )
    again = F.zip_with(
        ordered, numbers,
        lambda x, o: F.when(o == 1, x).otherwise(
            _packed(F.xxhash64(_hash_part(x), o), x.bitwiseAND(F.lit(_PLACES)))
        ),
    )
    return F.when(F.size(firsts) == size, ordered).otherwise(F.sort_array(again))


def _signature_starts(ordered: Column) -> Column:
    """Place of every starting point among the sorted k-mers and starting points."""
    points = F.array(*[F.lit(s).cast("long") for s in _STARTS])
    return F.sort_array(F.concat(points, ordered))


def _signatures(ordered: Column, merged: Column) -> Column:
    size = F.size(ordered)
    at = F.filter(
        F.sequence(F.lit(0), F.size(merged) - 1),
        lambda i: F.get(merged, i).bitwiseAND(F.lit(_PLACES)) == 0,
    )

    def one(place: Column, j: Column) -> Column:
        # By place first, so that sorting brings the chosen k-mers into text order.
        chosen = [F.get(ordered, (place - j + t) % size) for t in range(TUPLE)]
        turned = [
            F.shiftleft(c.bitwiseAND(F.lit(_PLACES)), HASH_BITS).bitwiseOR(_hash_part(c)) for c in chosen
        ]
        in_order = F.sort_array(F.array_distinct(F.array(*turned)))
        tuple_ = F.transform(in_order, lambda x: x.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))
        return F.shiftrightunsigned(F.xxhash64(tuple_), 33).cast("int")

    nothing = F.array_repeat(F.lit(0), SIGNATURES)
    return F.when(size == 0, nothing).otherwise(F.transform(at, one))


def with_signatures(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds `name`, the array of SIGNATURES integers of the text; null is as empty."""
    tokens, ordered, firsts, merged = (f"__{name}_{part}" for part in ("tokens", "ordered", "firsts", "merged"))
    pieces = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), F.lit(0))
    out = df.withColumn(tokens, F.transform(pieces, lambda w: F.xxhash64(w)))
    out = out.withColumn(ordered, F.sort_array(_kmers(F.col(tokens))))
    out = out.withColumn(firsts, _first_of_runs(F.col(ordered)))
    out = out.withColumn(ordered, _numbered(F.col(ordered), F.col(firsts)))
    out = out.withColumn(merged, _signature_starts(F.col(ordered)))
    out = out.withColumn(name, _signatures(F.col(ordered), F.col(merged)))
    return out.drop(tokens, ordered, firsts, merged)


def as_text(signatures: Column) -> Column:
    """A fingerprint as a string: eight hexadecimal digits a signature."""
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures, 0 to 1."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda equal: equal)
    return F.size(same) / F.lit(float(SIGNATURES))


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id and fingerprint of every row. Null and empty texts, and those of white space
    alone, have the same fingerprint of zeros; equal texts have equal fingerprints, in
    whatever rows; texts are read whole. Of a text beyond 16 million tokens the places
    start again at 1. Other columns are not read."""
    rows = docs.select(docs[id].alias("__id"), docs[text].alias("__text"))
    rows = with_signatures(rows, "__text", "__print")
    return rows.select(F.col("__id").alias(id), as_text(F.col("__print")).alias("fingerprint"))


def _successors(rows: DataFrame, tables: Tables) -> DataFrame:
    """Of the distinct (id, mark), each with the one that follows by descending id, null
    last, then mark; after the last comes the first."""
    order = [F.col("id").desc_nulls_last(), F.col("mark")]
    ranged = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = tables.store(ranged, "ranged")
    within = Window.partitionBy("part").orderBy(*order)
    ranked = ranged.select(
        "id", "mark", "need", "part",
        F.lead(F.struct("id", "mark")).over(within).alias("next"),
        F.row_number().over(within).alias("rank"),
    )
    # One row a partition, so this window stays as small as their number.
    parts = Window.orderBy("p")
    firsts = ranked.where("rank = 1").select(F.col("part").alias("p"), F.struct("id", "mark").alias("first"))
    chain = firsts.select(
        "p",
        F.coalesce(
            F.lead("first").over(parts),
            F.first("first").over(parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("follows"),
    )
    linked = ranked.join(chain, F.col("part") == F.col("p")).withColumn("next", F.coalesce("next", "follows"))
    linked = tables.store(
        linked.select("id", "mark", "need", F.col("next.id").alias("next_id"), F.col("next.mark").alias("next_mark")),
        "successors",
    )
    tables.drop(ranged)
    return linked


def compare_with_edited(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: its id, n_chars, the SHA-256 of the edited text, both
    fingerprints, near_edited and near_next.

    The edited text has the last third of the code points (rounded down) replaced by the
    first as many, or all, of the text that follows by descending id; after the last row
    comes the first, so a lone row follows itself. Rows with one id follow by hash of the
    text; repeated rows count as one there and have the same result each. A null id comes
    last, a null text is empty. An empty table has no rows. Other columns are not read.
    """
    tables = Tables(docs.sparkSession)
    value = F.coalesce(docs[text].cast("string"), F.lit(""))
    base = docs.select(docs[id].alias("id"), F.xxhash64(value).alias("mark"), value.alias("text"))
    third = F.floor(F.char_length("text") / 3).cast("int")
    linked = _successors(base.select("id", "mark", third.alias("need")).distinct(), tables)

    # Both joins deal the texts out by the same keys, so they are shuffled once.
    follows = base["id"].eqNullSafe(linked["next_id"]) & (base["mark"] == linked["next_mark"])
    sent = base.join(linked, follows).select(
        linked["id"].alias("to"), linked["mark"].alias("to_mark"), "next_id", "next_mark", "need",
        F.expr("substring(text, 1, need)").alias("head"),
    ).dropDuplicates(["to", "to_mark"])
    mine = base["id"].eqNullSafe(sent["to"]) & (base["mark"] == sent["to_mark"])
    both = base.join(sent, mine).select(
        "id", "mark", "next_id", "next_mark", "text",
        F.char_length("text").cast("long").alias("n_chars"),
        F.expr("concat(substring(text, 1, char_length(text) - need), head)").alias("edited"),
    )
    signed = with_signatures(with_signatures(both, "text", "own"), "edited", "other")
    signed = tables.store(
        signed.select(
            "id", "mark", "next_id", "next_mark", "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "own", "other",
        ),
        "order-prints",
    )
    tables.drop(linked)
    after = signed.select(F.col("id").alias("i"), F.col("mark").alias("m"), F.col("own").alias("after"))
    after = after.dropDuplicates(["i", "m"])
    same = signed["next_id"].eqNullSafe(after["i"]) & (signed["next_mark"] == after["m"])
    return signed.join(after, same).select(
        F.col("id").alias(id), "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("after")).alias("near_next"),
    )
