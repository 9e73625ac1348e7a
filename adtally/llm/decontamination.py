"""Benchmark decontamination over a distributed positional index, in DataFrame functions only.

Test texts are cut into windows of consecutive words. One pass over the training texts
counts the windows' terms, so that each window knows its rarest one. A second pass
stores postings of these rarest terms only: document, position, and the words around
it, which are the offset-adjusted postings of the window's other terms. A posting and
a window meet on the term; they are an exact phrase match if every other term stands
at its own offset, and a proximity match if some span of the window's length and ``slop``
words more holds the posting and every term as often as the window does.
Frequent terms are never looked up unless a window has no rarer one.

The test side is broadcast only while its texts stay below ``BROADCAST_MB``; above it,
Spark shuffles postings and windows by term. Up to ``LISTED_TERMS`` rarest terms are
written into the plan, so that a text is searched for them in place; more are joined.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.store import written

BROADCAST_MB = 16
LISTED_TERMS = 20_000
#: Fixed value: what stands between words, once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: Column) -> Column:
    """Lower-cased words; an empty text has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _windows(tests: DataFrame, length: int) -> DataFrame:
    """Distinct word sequences with the items they come from, as sorted strings."""
    words = tests.select("item", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(length))
    each = words.select("item", "words", size.alias("size"), F.explode(F.sequence(F.lit(1), F.size("words") - size + 1)).alias("at"))
    return each.select("item", F.slice("words", F.col("at"), F.col("size")).alias("seq")).groupBy("seq").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _rarest(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``term`` and ``offset`` of the rarest term of each window; windows with a term that never occurs go."""
    terms = windows.select("seq", F.posexplode("seq").alias("offset", "term")).join(counts, "term", "left")
    best = terms.groupBy("seq").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "offset")).alias("best")
    )
    return windows.join(best, "seq").where("best.n > 0").select(F.col("best.term").alias("term"), F.col("best.offset").alias("offset"), "seq", "items")


def find_leaks(
    docs: DataFrame, tests: DataFrame, length: int = 10, slop: int = 10,
    id_column: str = "doc_id", text_column: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per row: id, ``key``, ``n_words``, ``n_hit``, ``n_items``, ``items``, ``contaminated`` and ``n_near``.

    A word is hit if it lies in an occurrence of a window: ``length`` consecutive words of an item,
    or all words of a shorter one. ``items``: ids of items with a window that occurs, as sorted
    strings. ``n_near``: occurrences of rarest terms in a span of at most ``slop`` words more than their
    window that holds all its terms, repeated ones as often as the window.
    Defined cases: null and empty texts have no words on either side; items without an id can hit
    words but are not listed; repeated rows and null ids stay one row each; very long texts are
    read whole; without documents or items there are no rows or no hits; other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(id_column, text_column).alias("key"), F.col(text_column).alias("text"))
    tests = tests.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    small = (tests.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0) < BROADCAST_MB * 1e6
    sized = F.broadcast if small else (lambda df: df)

    windows = written(_windows(tests, length), "windows")
    vocabulary = windows.select(F.explode("seq").alias("term")).distinct()
    tokens = rows.select(F.explode(words_of(F.col("text"))).alias("term"))
    counts = tokens.join(sized(vocabulary), "term").groupBy("term").agg(F.count("*").alias("n"))
    anchors = written(_rarest(windows, counts), "anchors")

    # Postings: the words around a rarest term, wide enough for any window and the slop.
    reach = length - 1 + slop
    known = [r["term"] for r in anchors.select("term").distinct().limit(LISTED_TERMS + 1).collect()]
    texts = rows.select("id", "key", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    places = F.sequence(F.lit(1), F.size("words"))
    if len(known) <= LISTED_TERMS:
        places = F.filter(places, lambda i: F.element_at("words", i).isin(known))

    def posting(i: Column) -> Column:
        first = F.greatest(i - reach, F.lit(1))
        return F.struct((i - 1).alias("pos"), F.element_at("words", i).alias("term"), (first - 1).alias("begin"), F.slice("words", first, F.lit(2 * reach + 1)).alias("around"))

    listed = texts.select("id", "key", F.inline(F.transform(places, posting)))
    met = listed.join(sized(anchors), "term").select("id", "key", "pos", "offset", "seq", "items", "begin", "around")
    met = met.withColumn("start", F.col("pos") - F.col("offset"))
    exact = (F.col("start") >= 0) & (F.slice("around", F.greatest(F.col("start") - F.col("begin") + 1, F.lit(1)), F.size("seq")) == F.col("seq"))
    wide = F.size("seq") + slop
    first = F.greatest(F.col("pos") - wide + 1, F.col("begin"))

    def holds_all(start: Column) -> Column:
        span = F.slice("around", start - F.col("begin") + 1, wide)
        often = lambda words, term: F.size(F.filter(words, lambda w: w == term))
        return F.forall(F.array_distinct("seq"), lambda term: often(span, term) >= often(F.col("seq"), term))

    # Spans are only tried where no term is missing altogether.
    near = F.when(F.size(F.array_except("seq", "around")) > 0, False).otherwise(F.exists(F.sequence(first, F.col("pos")), holds_all))
    met = met.withColumn("exact", exact).where(F.when(F.col("exact"), True).otherwise(near))
    hit = F.when(F.col("exact"), F.struct("start", F.size("seq").alias("size")))
    found = met.groupBy("id", "key").agg(F.collect_set(hit).alias("hits"), F.collect_set(F.when(F.col("exact"), F.col("items"))).alias("lists"), F.count_distinct("pos").alias("near"))
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1))))
    found = found.select(F.col("id").alias("found_id"), F.col("key").alias("found_key"), F.size(covered).cast("long").alias("hit"), F.array_sort(F.array_distinct(F.flatten("lists"))).alias("listed"), "near")

    sizes = rows.select("id", "key", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    out = sizes.join(found, (sizes["key"] == found["found_key"]) & sizes["id"].eqNullSafe(found["found_id"]), "left")
    n_hit = F.coalesce("hit", F.lit(0).cast("long"))
    items = F.coalesce("listed", F.array().cast("array<string>"))
    return out.select(
        F.col("id").alias(id_column), "key", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"), (n_hit > 0).alias("contaminated"),
        F.coalesce("near", F.lit(0).cast("long")).alias("n_near"),
    )
