"""Benchmark decontamination by winnowing, with DataFrame functions only.

A window is WINDOW consecutive words of an item; an item with fewer words is one window.
Documents and items are cut into hashed grams of GRAM words, and of every run of
WINDOW - GRAM + 1 grams the smallest hash is kept as fingerprint. Equal windows have
equal runs, so they share a fingerprint: no shared window can be missed. Documents and
items are joined on fingerprints; from each place of a shared gram the match is then
extended word by word to both sides, which makes the result exact. Items shorter than a
window have all grams of their own length as fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparrowscope.llm.common import store

WINDOW = 10
GRAM = 5
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words after lower-casing A to Z alone; null has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _prefix(array: Column, length: Column) -> Column:
    return F.slice(array, F.lit(1), F.greatest(length, F.lit(0)))


def _with_grams(df: DataFrame, length: int) -> DataFrame:
    """Adds __g, the gram hashes of the window class `length`, to a frame with the word
    hashes __h."""
    size = _gram(length)
    grams = F.transform(
        F.col("__h"),
        lambda h, i: F.xxhash64(F.lit(length), h, *[F.get(F.col("__h"), i + k) for k in range(1, size)]),
    )
    return df.withColumn("__all", grams).withColumn(
        "__g", _prefix(F.col("__all"), F.size("__h") - (size - 1))
    ).drop("__all")


def _gram(length: int) -> int:
    return GRAM if length == WINDOW else length


def _run(length: int) -> int:
    return length - _gram(length) + 1


def _minima(length: int) -> Column:
    """Smallest hash of every run of grams in __g."""
    run, grams = _run(length), F.col("__g")
    if run == 1:
        return grams
    least = F.transform(
        grams, lambda g, i: F.least(g, *[F.get(grams, i + k) for k in range(1, run)])
    )
    return _prefix(least, F.size(grams) - (run - 1))


def _surroundings(place: Column, length: int) -> Column:
    """The words of the gram at `place` and as many on both sides as a window can reach;
    null beyond the text."""
    reach = length - _gram(length)
    around = F.sequence(F.lit(-reach), F.lit(_gram(length) - 1 + reach))
    return F.transform(around, lambda o: F.get(F.col("__w"), place + o))


def _places(chosen) -> Column:
    """Places of __g for which `chosen(place)` holds."""
    places = F.sequence(F.lit(0), F.size("__g") - 1)
    places = F.when(F.size("__g") > 0, places).otherwise(F.array().cast("array<int>"))
    return F.filter(places, chosen)


def item_fingerprints(items: DataFrame, length: int, id: str, text: str) -> DataFrame:
    """v, item_id and the words around of every fingerprint of the items whose windows
    have `length` words."""
    words = items.select(items[id].alias("item_id"), words_of(items[text]).alias("__w"))
    fits = F.size("__w") >= length if length == WINDOW else F.size("__w") == length
    words = words.where(fits).withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w)))
    found = _with_grams(words, length).withColumn("__m", _minima(length))
    run = _run(length)
    kept = _places(
        lambda i: F.exists(
            F.sequence(i - (run - 1), i), lambda j: F.coalesce(F.get("__m", j) == F.get("__g", i), F.lit(False))
        )
    )
    found = found.withColumn("__p", F.explode(kept))
    return found.select(
        F.get("__g", F.col("__p")).alias("v"), "item_id", _surroundings(F.col("__p"), length).alias("item_words")
    ).distinct()


def _matches(hits: DataFrame, length: int) -> DataFrame:
    """Rows whose gram and its extension reach a whole window: from and to (exclusive)."""
    size = _gram(length)
    reach = length - size

    def equal(o: int) -> Column:
        return F.coalesce(F.get("__words", F.lit(o)) == F.get("item_words", F.lit(o)), F.lit(False))

    same = F.lit(True)
    for o in range(reach, reach + size):
        same = same & equal(o)
    left = _consecutive([equal(reach - 1 - k) for k in range(reach)])
    right = _consecutive([equal(reach + size + k) for k in range(reach)])
    found = hits.where(same).withColumn("__left", left).withColumn("__right", right)
    return found.where(F.col("__left") + F.col("__right") + size >= length).select(
        "__id", "__t", "item_id", (F.col("__p") - F.col("__left")).alias("from"),
        (F.col("__p") + size + F.col("__right")).alias("to"),
    )


def _consecutive(tests: list[Column]) -> Column:
    """How many of the tests hold before the first that does not."""
    out = F.lit(len(tests))
    for k in range(len(tests) - 1, -1, -1):
        out = F.when(~tests[k], F.lit(k)).otherwise(out)
    return out


def contaminated_spans(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(texts, spans). texts: __id, __t (hash of id and text) and n_words of every row.
    spans: per distinct contaminated row __id, __t, the merged word ranges `spans`
    (array of from, to exclusive) and the sorted `items` as strings."""
    spark = docs.sparkSession
    counted = items.select(F.least(F.size(words_of(items[item_text])), F.lit(WINDOW)).alias("n"))
    lengths = sorted(r["n"] for r in counted.where("n > 0").distinct().collect())  # ten at most
    tables = {
        length: store(item_fingerprints(items, length, item_id, item_text), f"item-prints-{length}")
        for length in lengths
    }

    rows = docs.select(docs[id].alias("__id"), docs[text].alias("__text"))
    rows = rows.withColumn("__t", F.xxhash64(F.lit(1), "__id", F.lit(2), "__text"))
    hashed = rows.select("__id", "__t", words_of(F.col("__text")).alias("__w"))
    hashed = hashed.withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w)))
    prints = hashed.withColumn("n_words", F.size("__w").cast("long")).select("__id", "__t", "n_words", "__h")
    kept = []
    for length in lengths:
        prints = _with_grams(prints, length).withColumn(f"__m{length}", _minima(length)).drop("__g")
        kept.append(F.col(f"__m{length}"))
    fingerprints = F.array_distinct(F.concat(*kept)) if kept else F.array().cast("array<bigint>")
    prints = store(prints.select("__id", "__t", "n_words", fingerprints.alias("prints")), "doc-prints")
    texts = prints.select("__id", "__t", "n_words")
    if not lengths:
        nothing = "__id bigint, __t bigint, spans array<struct<from:int,to:int>>, items array<string>"
        return texts, spark.createDataFrame([], nothing)

    values = tables[lengths[0]].select("v")
    for length in lengths[1:]:
        values = values.union(tables[length].select("v"))
    values = store(values.distinct(), "item-values")
    shared = prints.select("__id", "__t", F.explode("prints").alias("v")).join(values, "v", "left_semi")
    shared = shared.groupBy("__id", "__t").agg(F.collect_set("v").alias("__v"))
    shared = store(shared, "shared-prints").select(F.col("__id").alias("__i"), F.col("__t").alias("__s"), "__v")

    same_row = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__t") == F.col("__s"))
    candidates = rows.join(shared, same_row).select("__id", "__t", "__text", "__v")
    candidates = candidates.withColumn("__w", words_of(F.col("__text")))
    candidates = candidates.withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w))).drop("__text")
    found = None
    for length in lengths:
        places = _places(lambda i: F.array_contains(F.col("__v"), F.get("__g", i)))
        hits = _with_grams(candidates, length).withColumn("__p", F.explode(places))
        hits = hits.select(
            "__id", "__t", "__p", F.get("__g", F.col("__p")).alias("v"),
            _surroundings(F.col("__p"), length).alias("__words"),
        )
        part = _matches(hits.join(tables[length], "v"), length)
        found = part if found is None else found.union(part)
    grouped = found.groupBy("__id", "__t").agg(
        F.array_sort(F.collect_set(F.struct("from", "to"))).alias("ranges"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    return texts, grouped.select("__id", "__t", _merged(F.col("ranges")).alias("spans"), "items")


def _merged(ranges: Column) -> Column:
    """Sorted ranges with the overlapping and adjoining ones united."""

    def add(done: Column, r: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        united = F.struct(last["from"].alias("from"), F.greatest(last["to"], r["to"]).alias("to"))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(united))
        return F.when((F.size(done) > 0) & (r["from"] <= last["to"]), joined).otherwise(
            F.concat(done, F.array(r))
        )

    return F.aggregate(ranges, F.array().cast("array<struct<from:int,to:int>>"), add)


def decontaminate(docs: DataFrame, items: DataFrame, **names: str) -> DataFrame:
    """Per row of `docs`: its id, n_words, n_hit (words inside an occurrence of an item's
    window), n_items, items_sha256 (of the item ids, sorted as strings and joined by
    commas) and contaminated.

    Null and empty texts have no words and are clean; so is everything when `items` is
    empty. Repeated rows have the same result each. Items with a null id mark words but
    are not listed. Other columns are not read.
    """
    id = names.get("id", "doc_id")
    texts, spans = contaminated_spans(docs, items, **names)
    spans = spans.select(
        F.col("__id").alias("__i"), F.col("__t").alias("__s"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, r: n + r["to"] - r["from"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.concat_ws(",", "items").alias("__items"),
    )
    same_row = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__t") == F.col("__s"))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return texts.join(spans, same_row, "left").select(
        F.col("__id").alias(id), "n_words", hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("__items", F.lit("")), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, **names: str) -> DataFrame:
    """The rows of `docs` without an occurrence of an item's window, all columns as they
    are, whatever their names. Null and empty texts stay, repeated rows stay or go together;
    an empty table gives an empty one, and without items every row stays."""
    id, text = names.get("id", "doc_id"), names.get("text", "text")
    _, spans = contaminated_spans(docs, items, **names)
    hit = spans.select(F.col("__id").alias("__i"), F.col("__t").alias("__s"))
    # The columns of `docs` travel in one, so that no name of theirs can clash.
    marked = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("__row"), docs[id].alias("__own"),
        F.xxhash64(F.lit(1), docs[id], F.lit(2), docs[text]).alias("__mark"),
    )
    same_row = F.col("__own").eqNullSafe(F.col("__i")) & (F.col("__mark") == F.col("__s"))
    return marked.join(hit, same_row, "left_anti").select("__row.*")
