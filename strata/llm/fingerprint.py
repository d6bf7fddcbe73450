"""Bottom-k sketches of word-shingle hashes, in DataFrame functions only.

A sketch is the ``k`` least distinct 64-bit hashes of a text's shingles, in
order.  The sketch of a union is the bottom k of the sketches' union, so
sketches merge across parts.  From two sketches: resemblance is the share of
the bottom k of their union that both hold; the distinct shingle count is
``(k - 1) / (k-th least hash as a fraction of the range)``, exact while a
sketch is not full; containment follows from resemblance and the two counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import partitions, range_bounds, range_bucket

K = 128
SHINGLE = 5
_BLANKS = r"[\x09-\x0D\x20]+"


def shingle_hashes(text: Column, words: int = SHINGLE) -> Column:
    """Hashes of every ``words`` consecutive words (A-Z lower-cased, split at
    ASCII blanks); a text of fewer words has one, of all its words; null or a
    text without words has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hashed = F.transform(F.filter(F.split(lower, _BLANKS), lambda w: w != ""), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        n = F.size(h)
        # The bound keeps the sequence valid where the branch isn't taken.
        rolled = F.transform(F.sequence(F.lit(0), F.greatest(n - words, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)]))
        return F.when(n == 0, F.array().cast("array<bigint>")).when(n < words, F.array(F.xxhash64(h))).otherwise(rolled)

    # The one-element array binds the words' hashes, which are then computed once.
    return F.flatten(F.transform(F.array(hashed), shingles))


def sketch(text: Column, k: int = K, words: int = SHINGLE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, words))), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of what ``a`` and ``b`` are sketches of."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1; two empty sketches are alike."""

    def share(u: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(u, a), b))
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(both / F.size(u).cast("double"))

    return F.get(F.transform(F.array(merged(a, b, k)), share), F.lit(0))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    last = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / last)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1; an empty a: 1."""
    r, n = resemblance(a, b, k), distinct_count(a, k)
    both = r / (1 + r) * (n + distinct_count(b, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / n))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def merge_sketches(df: DataFrame, by: list[str], column: str, k: int = K) -> DataFrame:
    """One sketch for each group of sketches: the least ``k`` distinct hashes.

    Groups are reduced twice, first within salted parts, so that a group may
    hold any share of the rows: hashes are made distinct before the shuffle and
    each part sends on at most ``k``.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(partitions(df.sparkSession)))
    flat = df.select(*by, part.alias("__part"), F.explode(column).alias("__hash")).distinct()
    order = Window.partitionBy(*by, "__part").orderBy("__hash")
    least = flat.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= k)
    return least.groupBy(*by).agg(F.slice(F.sort_array(F.collect_set("__hash")), 1, k).alias(column))


def fingerprints(docs: DataFrame, k: int = K, words: int = SHINGLE) -> DataFrame:
    """doc_id, text and ``sketch`` of each row of ``docs`` (doc_id, text)."""
    return docs.select("doc_id", "text", sketch(F.col("text"), k, words).alias("sketch"))


def with_next(docs: DataFrame) -> tuple[DataFrame, Column]:
    """Rows of ``docs`` (doc_id, text), dealt so that ``lead`` over the returned
    window gives the next document in descending doc_id order (after the last:
    the first).  Rows marked ``guest`` are copies that only serve as next.

    Each range of doc_id also gets a copy of the row that follows it, so texts
    are shuffled once and no task sees more than a range.  Rows of equal doc_id
    are ordered by text; null ids come after all others; null text is empty.
    """
    spark = docs.sparkSession
    lowest = F.lit(-(2**63)).cast("long")
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("place", F.coalesce("doc_id", lowest))
    bounds = range_bounds(docs, "place", 3 * partitions(spark))
    docs = docs.withColumn("range", range_bucket(F.col("place"), bounds))
    # The id that each range begins with: as many rows as there are ranges.
    heads = sorted(docs.groupBy("range").agg(F.max("place").alias("place")).collect(), key=lambda r: -r["range"])
    guests = [(h["place"], heads[i - 1]["range"]) for i, h in enumerate(heads)]  # what follows the last range: the first
    guests = F.broadcast(spark.createDataFrame(guests, "place long, guest_range int"))
    dealt = docs.join(guests, "place", "left")
    home = F.struct(F.col("range"), F.lit(False).alias("guest"))
    away = F.struct(F.col("guest_range").alias("range"), F.lit(True).alias("guest"))
    dealt = dealt.withColumn("at", F.explode(F.when(F.col("guest_range").isNull(), F.array(home)).otherwise(F.array(home, away))))
    dealt = dealt.select("doc_id", "text", "place", F.col("at.range").alias("range"), F.col("at.guest").alias("guest"))
    return dealt.repartition(partitions(spark), "range"), Window.partitionBy("range").orderBy("guest", F.desc("place"), "text")


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points (rounded down) replaced by the first as
    many, or all, of the following text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def edited_fingerprints(docs: DataFrame, k: int = K, words: int = SHINGLE) -> DataFrame:
    """Each document beside its edited text and the next document: doc_id, text,
    edited, sketch, edited_sketch, next_sketch.  Empty table: no rows."""
    dealt, order = with_next(docs)
    dealt = dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("sketch", sketch(F.col("text"), k, words))
    dealt = dealt.withColumn("next_sketch", F.lead("sketch").over(order)).where("not guest")
    dealt = dealt.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    return dealt.withColumn("edited_sketch", sketch(F.col("edited"), k, words)).select("doc_id", "text", "edited", "sketch", "edited_sketch", "next_sketch")
