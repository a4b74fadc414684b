"""Benchmark decontamination: a prefix-filtered set join with positional checks.

An item gives windows of consecutive words. A document holds a window only if it holds all its words,
so with words ordered by rarity it is enough to join on the prefix of length one: the rarest word of
each window. The place of that word fixes where the window would start; length and position bounds
discard starts outside the document, and the rest is verified word for word. Main path: DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.text import ascii_lower, broadcast_if_small, let, whole
from tracewright.shared_storage import settle

WINDOW = 13

# Letters and digits of ASCII and every character beyond it.
_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def item_words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    return F.regexp_extract_all(ascii_lower(whole(text)), F.lit(_WORD), F.lit(0))


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window_id, n, words): the distinct windows of all items; (window_id, item_id) links them.

    An item with fewer words than a window, but not none, is one window.
    """
    split = items.select("item_id", item_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    return (
        split.select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("words", F.col("start"), size).alias("words"))
        .select("item_id", F.sha2(F.array_join("words", " "), 256).alias("window_id"), "words")
        .distinct()
    )


def anchors(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(word, offset, window_id, words, items): per distinct window its rarest word and its place.

    Rarity is the number of occurrences in all documents; only words of the benchmark are counted.
    """
    distinct = windows.groupBy("window_id").agg(
        F.first("words").alias("words"), F.collect_set(F.col("item_id").cast("string")).alias("items")
    )
    places = distinct.select("*", F.posexplode("words").alias("offset", "word"))
    vocabulary = broadcast_if_small(settle(places.select("word").distinct()))
    counts = settle(
        docs.select(F.explode(item_words(F.col("text"))).alias("word"))
        .join(vocabulary, "word", "left_semi")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_rarity = Window.partitionBy("window_id").orderBy("n", "word", "offset")
    # A window that has a word no document has is held by none: its rarest word joins with nothing.
    return (
        places.join(counts, "word", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("rank", F.row_number().over(by_rarity))
        .where((F.col("rank") == 1) & (F.col("n") > 0))
        .select("word", "offset", "window_id", "words", "items")
    )


def candidate_starts(docs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(doc_id, row, start, window_id): where a window may start, by its rarest word and the position bound.

    ``row`` tells the texts of one document apart.
    """
    keyed = broadcast_if_small(prefixes.select("word", "offset", "window_id"))
    words = docs.select("doc_id", "row", F.posexplode(item_words(F.col("text"))).alias("pos", "word"))
    return (
        words.join(keyed, "word")
        .select("doc_id", "row", (F.col("pos") - F.col("offset")).alias("start"), "window_id")
        .where(F.col("start") >= 0)
    )


def matches(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``item_ids``
    (sorted as text) and ``contaminated`` (at least one word in twenty is hit).

    All columns of ``docs`` stay; columns with the new names are replaced. Null texts have no words.
    Rows that share a doc_id are each checked on their own text. Empty documents or items give no hit.
    """
    windows = settle(item_windows(items.select("item_id", "text"), size))
    prefixes = settle(anchors(docs.select("doc_id", "text"), windows))
    new = ("n_words", "n_hit", "item_ids", "contaminated")
    held = [c for c in docs.columns if c not in new]
    # The input row is one struct, so that no name of it can clash with an inner one.
    rows = docs.select(F.struct(*held).alias("given"), "doc_id", F.xxhash64(whole(F.col("text"))).alias("row"), "text")
    starts = settle(candidate_starts(rows.select("doc_id", "row", "text"), prefixes))
    candidates = (
        starts.join(broadcast_if_small(prefixes.select("window_id", "words", "items")), "window_id")
        .groupBy(F.col("doc_id").alias("of"), F.col("row").alias("of_row"))
        .agg(F.collect_set(F.struct("start", "words", "items")).alias("maybe"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row"))
    joined = rows.join(candidates.hint("shuffle_hash"), same, "left")

    # The slice is cut from the words of the text itself: the positions of a window are verified exactly.
    def holds(w: Column, m: Column) -> Column:
        n = F.size(m["words"])
        return (m["start"] + n <= F.size(w)) & (F.slice(w, m["start"] + 1, n) == m["words"])

    maybe = F.coalesce("maybe", F.expr("cast(array() as array<struct<start:int,words:array<string>,items:array<string>>>)"))
    verified = let(
        item_words(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), F.filter(maybe, lambda m: holds(w, m)).alias("held")
        ),
    )
    checked = joined.select("given", verified.alias("found"))
    held_windows = F.col("found")["held"]
    hit_words = F.array_distinct(
        F.flatten(F.transform(held_windows, lambda m: F.sequence(m["start"], m["start"] + F.size(m["words"]) - 1)))
    )
    counted = checked.select(
        "given",
        F.col("found")["n_words"].alias("n_words"),
        F.size(hit_words).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform(held_windows, lambda m: m["items"])))).alias("item_ids"),
    )
    bad = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return counted.select("given.*", "n_words", "n_hit", "item_ids", bad.alias("contaminated"))
