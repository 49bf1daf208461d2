"""Document fingerprints: threshold-scaled sketches, in DataFrame functions only.

A sketch keeps every hash of a five-word shingle below a fixed share (``1 / SCALE``) of
the hash range.  The kept hashes of a union are the union of the kept hashes, so
sketches merge, and the share of one sketch found in another estimates containment even
between very unequal documents.

Definitions: words are the runs of characters above U+0020 after lower-casing A-Z; a
text of fewer than five words, but not none, is one shingle.  Null counts as the empty
text.  The fingerprint is the text's own 64-bit hash and the kept hashes in order, in
hexadecimal.  Equal fingerprints have likeness 1; otherwise it is the share of the
common ones among all kept hashes of both.  If there are none, it is 1 for equal words
(texts that differ in case or spacing only) and else 0, which is exact for texts of one
shingle.  Documents are in
descending ``doc_id`` (nulls last), repeated ones by text; the next of the last is the
first, which of a single row is the row itself.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmarts.llm.common import lower_ascii

WORDS, SCALE = 5, 2
_LIMIT = -(1 << 63) + (1 << 64) // SCALE


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), "[\\x00-\\x20]+"), lambda w: w != "")


def sketch(text: Column) -> Column:
    """Kept hashes, distinct and sorted."""
    words = words_of(text)

    def shingles(w):
        whole = F.when(F.size(w) > 0, F.array(F.xxhash64(F.concat_ws(" ", w)))).otherwise(F.array().cast("array<long>"))
        many = F.transform(F.sequence(F.lit(0), F.size(w) - WORDS),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WORDS)]))
        return F.when(F.size(w) >= WORDS, many).otherwise(whole)

    # One-element arrays bind the words once for all that reads them.
    kept = F.transform(F.array(words), lambda w: F.filter(shingles(w), lambda h: h < _LIMIT))
    return F.array_sort(F.array_distinct(F.element_at(kept, 1)))


def fingerprint(text: Column, hashes: Column) -> Column:
    return F.concat_ws(",", F.concat(F.array(F.xxhash64(text)), hashes).cast("array<string>"))


def likeness(text_a: Column, hashes_a: Column, text_b: Column, hashes_b: Column) -> Column:
    """Share of common hashes (sketches are sets, so the union's size follows)."""
    common = F.size(F.array_intersect(hashes_a, hashes_b))
    union = F.size(hashes_a) + F.size(hashes_b) - common
    same = (words_of(text_a) == words_of(text_b)).cast("double")
    return F.when(text_a == text_b, F.lit(1.0)).when(union == 0, same).otherwise(common / union)


def containment(hashes_a: Column, hashes_b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has; null for an empty sketch."""
    return F.size(F.array_intersect(hashes_a, hashes_b)) / F.nullif(F.size(hashes_a), F.lit(0))


def range_number(key: Column, bounds: list) -> Column:
    """How many of ``bounds`` (falling) are above ``key``, by binary search; nulls after all."""
    steps = [1 << k for k in reversed(range(max(1, len(bounds)).bit_length()))]
    table = F.array(*[F.lit(b) for b in bounds]).cast("array<long>")
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(
        (at + s <= len(bounds)) & (F.get(table, at + s - 1) > key), at + s).otherwise(at))
    return F.when(key.isNull(), len(bounds) + 1).otherwise(found)


def with_next(docs: DataFrame, partitions: int) -> DataFrame:
    """(doc_id, text, hashes) with struct ``next`` of text and hashes of the document that
    follows by falling ``doc_id`` (nulls last), then by text; cyclic.

    The driver gets ``partitions`` percentiles of the ids.  One shuffle puts each of
    their ranges in one place; the first text of a range, for the last row of the one
    before, comes from a partly aggregated minimum."""
    cuts = [i / partitions for i in range(1, partitions)]
    bounds = docs.agg(F.percentile_approx("doc_id", cuts, 10 * max(partitions, 1000)).alias("b")).first()["b"] if cuts else None
    ranged = docs.withColumn("_range", range_number(F.col("doc_id"), sorted(set(bounds or []), reverse=True)))
    place = F.struct(F.col("doc_id").isNull(), F.bitwise_not("doc_id"), F.xxhash64("text"), F.col("text"))
    heads = (ranged.groupBy("_range").agg(F.min_by("text", place).alias("text"))
             .select("_range", F.struct("text", sketch(F.col("text")).alias("hashes")).alias("head")))
    whole = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("_range", F.coalesce(F.lead("head").over(Window.orderBy("_range")),
                                              F.first("head").over(whole)).alias("head"))
    inside = Window.partitionBy("_range").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text"))
    # Sketched after the shuffle, which so moves texts alone.
    placed = ranged.repartition(partitions, "_range").withColumn("hashes", sketch(F.col("text"))).withColumn(
        "next", F.lead(F.struct("text", "hashes")).over(inside))
    return placed.join(heads, "_range").select("doc_id", "text", "hashes", F.coalesce("next", "head").alias("next"))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    paired = with_next(rows, partitions)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    paired = paired.select("doc_id", "text", "hashes", "next", n.cast("long").alias("n_chars"), edited.alias("edited"))
    # The edited sketch is used three times: a generator keeps the optimizer from repeating it.
    paired = paired.select("*", F.explode(F.array(sketch(F.col("edited")))).alias("edited_hashes"))
    return paired.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), F.col("hashes")).alias("fingerprint"),
        fingerprint(F.col("edited"), F.col("edited_hashes")).alias("edited_fingerprint"),
        likeness(F.col("text"), F.col("hashes"), F.col("edited"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("text"), F.col("hashes"), F.col("next.text"), F.col("next.hashes")).alias("near_next"))
