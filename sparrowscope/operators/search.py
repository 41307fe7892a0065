"""Keyword search with engagement floors, account timelines, language filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import path_column
from ..sources.shared import stored

# Default search floors and page size.
MIN_FAVES = 100
MIN_RETWEETS = 10

# Characters of a gram of the keyword index, and size of the table that grams pass first:
# with a thousand keywords one gram in a thousand passes it by chance.
GRAM = 4
TABLE_BYTES = 1 << 20

# Partial rankings per keyword before the final one.
RANKING_GROUPS = 512


def filter_lang(df: DataFrame, lang: str = "en", column: str = "lang") -> DataFrame:
    """Keep posts of one language; posts without a language are dropped."""
    return df.filter(path_column(column) == lang)


def engagement_search(
    posts: DataFrame,
    keywords: Sequence[str],
    *,
    min_faves: int = MIN_FAVES,
    min_retweets: int = MIN_RETWEETS,
    text: str = "text",
    likes: str = "favorite_count",
    reposts: str = "retweet_count",
) -> DataFrame:
    """Posts that contain a keyword (any case) and reach both floors.

    A post appears once per keyword it contains. The keywords are expressions,
    so the posts are read once and nothing is joined or shuffled; the floors
    reach the scan, and text is lowered once per post that passes them.
    """
    popular = posts.filter((F.col(likes) >= min_faves) & (F.col(reposts) >= min_retweets))
    hits = [
        F.when(F.contains("_lowered", F.lower(F.lit(word))), F.lit(word))
        for word in dict.fromkeys(keywords)
    ]
    lowered = popular.withColumn("_lowered", F.lower(F.col(text)))
    found = F.array_compact(F.array(*hits))
    return lowered.select(F.explode(found).alias("keyword"), "*").drop("_lowered")


def _grams(chars: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` characters of an array of characters."""
    starts = F.slice(chars, F.lit(1), F.greatest(F.size(chars) - (length - 1), F.lit(0)))
    return F.transform(starts, lambda c, i: F.xxhash64(c, *[F.get(chars, i + k) for k in range(1, length)]))


def keyword_index(spark: SparkSession, keywords: Sequence[str]) -> DataFrame:
    """``gram``, ``length`` and the ``keywords`` (as given, and lowered) that go by it: each
    by that of its grams which the fewest keywords have. Grams have GRAM characters, those
    of shorter keywords all of theirs; an empty keyword has the gram 0."""
    words = spark.createDataFrame([(word,) for word in dict.fromkeys(keywords)], "word string")
    lowered = words.withColumn("lowered", F.lower("word"))
    chars = lowered.withColumn("chars", F.split("lowered", "")).withColumn("n", F.char_length("lowered"))
    by_length = F.when(F.col("n") == 0, F.array(F.lit(0).cast("long")))
    for length in range(1, GRAM):
        by_length = by_length.when(F.col("n") == length, _grams(F.col("chars"), length))
    grams = chars.withColumn("gram", F.explode(F.array_distinct(by_length.otherwise(_grams(F.col("chars"), GRAM)))))
    shared = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    chosen = grams.join(shared, "gram").groupBy("word", "lowered", "n").agg(
        F.min(F.struct("held", "gram")).getField("gram").alias("gram")
    )
    length = F.least("n", F.lit(GRAM)).alias("length")
    return chosen.groupBy("gram", length).agg(F.collect_list(F.struct("word", "lowered")).alias("keywords"))


def indexed_search(
    posts: DataFrame,
    keywords: Sequence[str],
    *,
    min_faves: int = MIN_FAVES,
    min_retweets: int = MIN_RETWEETS,
    text: str = "text",
    likes: str = "favorite_count",
    reposts: str = "retweet_count",
) -> DataFrame:
    """Rows of ``engagement_search``, for keywords by the thousand: the work on a post
    depends on its length and on the keywords it nearly contains, not on their number.

    The grams of a post that pass a table of bytes (TABLE_BYTES, set for the grams of the
    index) are looked up in the index, and only the keywords that go by them are searched
    for. The grams of the index, one a keyword at most, pass through the driver; the join
    with it is left to its measured size.
    """
    spark = posts.sparkSession
    index = stored(keyword_index(spark, keywords))
    table, lengths = bytearray(TABLE_BYTES), set()
    for row in index.select("gram", "length").toLocalIterator():
        table[row["gram"] % TABLE_BYTES] = 1
        lengths.add(row["length"])
    popular = posts.filter((F.col(likes) >= min_faves) & (F.col(reposts) >= min_retweets) & F.col(text).isNotNull())
    lowered = popular.select(F.struct("*").alias("_post"), F.lower(F.col(text)).alias("_lowered"))
    chars = lowered.withColumn("_chars", F.split("_lowered", ""))
    made = [F.array(F.lit(0).cast("long")) if n == 0 else _grams(F.col("_chars"), n) for n in sorted(lengths)]
    marks = F.lit(bytes(table))
    known = F.filter(
        F.array_distinct(F.concat(*made)) if made else F.array().cast("array<bigint>"),
        lambda g: F.substring(marks, F.pmod(g, F.lit(TABLE_BYTES)).cast("int") + 1, F.lit(1)) == F.lit(b"\x01"),
    )
    asked = chars.select("_post", "_lowered", F.explode(known).alias("_gram"))
    near = asked.join(index.select(F.col("gram").alias("_gram"), "keywords"), "_gram")
    near = near.select("_post", "_lowered", F.explode("keywords").alias("_keyword"))
    found = near.filter(F.contains("_lowered", F.col("_keyword.lowered")))
    return found.select(F.col("_keyword.word").alias("keyword"), "_post.*")


def top_posts_per_keyword(
    hits: DataFrame,
    n: int,
    *,
    keyword: str = "keyword",
    likes: str = "favorite_count",
    tie: str = "id",
    groups: int = RANKING_GROUPS,
) -> DataFrame:
    """The ``n`` most liked posts of every keyword.

    Ranked twice: first per keyword and group of input partitions, then per
    keyword, so that the candidates of a frequent keyword never come together
    in one task. Both rankings also prune inside the map tasks.
    """
    best = [F.desc(likes), F.col(tie)]
    grouped = hits.withColumn("_group", F.spark_partition_id() % groups)
    local = Window.partitionBy(keyword, "_group").orderBy(*best)
    candidates = (
        grouped.withColumn("_rank", F.row_number().over(local))
        .filter(F.col("_rank") <= n)
        .drop("_group", "_rank")
    )
    overall = Window.partitionBy(keyword).orderBy(*best)
    return candidates.withColumn("rank", F.row_number().over(overall)).filter(F.col("rank") <= n)


def account_timeline(
    posts: DataFrame, accounts: Sequence[str] | DataFrame, *, key: str = "screen_name"
) -> DataFrame:
    """Posts of the given accounts.

    A list becomes a filter that reaches the scan. A frame with the key column
    becomes a semi join, for which Spark picks the strategy by size.
    """
    if isinstance(accounts, DataFrame):
        return posts.join(accounts.select(key), key, "left_semi")
    return posts.filter(F.col(key).isin(*accounts))
