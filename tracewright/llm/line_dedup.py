"""Line de-duplication across documents, by sorted line hashes and keep bitmaps.

Main path: DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.text import ascii_lower, lines, stripped, whole
from tracewright.shared_storage import settle


@dataclass(frozen=True)
class LineRule:
    """Which lines count as repeated, and from where on a line is treated as hot.

    ``hot_rows`` decides only how a line is grouped, never whether: keys that a sample of one
    line in ``sample_one_in`` shows more often than ``hot_rows`` are aggregated before the
    shuffle, all others are sorted and streamed.
    """

    min_chars: int = 20
    min_documents: int = 3
    hot_rows: int = 20_000
    sample_one_in: int = 16


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(stripped(line))


def row_key() -> Column:
    """Tells the texts of one document apart; equal texts have equal keys and lose the same lines."""
    return F.xxhash64(whole(F.col("text")))


def line_hashes(docs: DataFrame, rule: LineRule = LineRule()) -> DataFrame:
    """(hash, doc_id, row, pos) of every line that is long enough; 128 bits in two integers."""
    digest = F.md5(F.col("key").cast("binary"))
    half = lambda start: F.conv(F.substring(digest, start, 15), 16, 10).cast("long")
    return (
        docs.select("doc_id", row_key().alias("row"), F.posexplode(lines(F.col("text"))).alias("pos", "line"))
        .select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= rule.min_chars)
        .select(half(1).alias("hash"), half(16).alias("hash2"), "doc_id", "row", "pos")
    )


def _dropped_by_sort(hashes: DataFrame, rule: LineRule) -> DataFrame:
    """Range-partition by hash, sort by document (largest first) and position, stream the ranks."""
    ranged = hashes.repartitionByRange("hash", "hash2").sortWithinPartitions(
        "hash", "hash2", F.desc("doc_id"), "pos"
    )
    same = Window.partitionBy("hash", "hash2")
    streamed = ranged.withColumn("nth", F.dense_rank().over(same.orderBy(F.desc("doc_id"))))
    counted = streamed.withColumn("n_docs", F.max("nth").over(same))
    return counted.where((F.col("nth") > 1) & (F.col("n_docs") >= rule.min_documents))


def _dropped_by_sums(hot_lines: DataFrame, rule: LineRule) -> DataFrame:
    """The same for hot lines: sums that combine before the shuffle, then a join with few keys."""
    key = ["hash", "hash2"]
    facts = hot_lines.groupBy(*key, "doc_id").agg(F.lit(1).alias("one")).groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper")
    )
    return hot_lines.join(facts, key).where(
        (F.col("n_docs") >= rule.min_documents) & ~F.col("doc_id").eqNullSafe(F.col("keeper"))
    )


def keep_bitmaps(docs: DataFrame, rule: LineRule = LineRule()) -> DataFrame:
    """(doc_id, row, keep): the keep bitmap of every text that loses lines.

    ``row`` tells the texts of one document apart. ``keep`` maps a word number (position div 64) to the 64 keep bits of those lines. Words in which
    every line stays are left out, as are documents that lose nothing. A key that is found in enough
    documents loses all its lines except those in the largest doc_id holding it. Rows that share a
    doc_id are one document of several texts, each with its own lines; a null doc_id is the smallest.
    Empty input gives no rows.
    """
    hashes = settle(line_hashes(docs.select("doc_id", "text"), rule))
    sampled = hashes.where(F.pmod(F.xxhash64("doc_id", "row", "pos"), F.lit(rule.sample_one_in)) == 0)
    hot = settle(
        sampled.groupBy("hash", "hash2")
        .count()
        .where(F.col("count") * rule.sample_one_in > rule.hot_rows)
        .select("hash", "hash2")
    )
    key = ["hash", "hash2"]
    dropped = (
        _dropped_by_sort(hashes.join(hot, key, "left_anti"), rule)
        .select("doc_id", "row", "pos")
        .union(_dropped_by_sums(hashes.join(hot, key, "left_semi"), rule).select("doc_id", "row", "pos"))
    )
    bit = F.expr("shiftleft(1L, pos % 64)")
    return (
        dropped.groupBy("doc_id", "row", F.expr("pos div 64").cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("lost"))
        .groupBy("doc_id", "row")
        .agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("lost"))))).alias(
                "keep"
            )
        )
    )


def kept_lines(text: Column, keep: Column) -> Column:
    """The lines of a text whose keep bit is set; all lines without a bitmap."""

    def stays(_: Column, pos: Column) -> Column:
        bits = F.coalesce(keep[F.floor(pos / 64).cast("int")], F.lit(-1).cast("long"))
        return F.getbit(bits, pos % 64) == 1

    return F.when(keep.isNull(), lines(text)).otherwise(F.filter(lines(text), stays))


def dedup_lines(docs: DataFrame, rule: LineRule = LineRule()) -> DataFrame:
    """Every row of ``docs`` with ``kept_text``, ``n_lines`` (before) and ``n_dropped``.

    All columns of ``docs`` stay; columns named like the three new ones are replaced. A null text
    that loses nothing has one empty line and ``kept_text`` empty.
    """
    new = ("kept_text", "n_lines", "n_dropped")
    held = [c for c in docs.columns if c not in new]
    # The input row is one struct, so that no name of it can clash with an inner one.
    rows = docs.select(F.struct(*held).alias("given"), "doc_id", row_key().alias("row"), "text")
    bitmaps = keep_bitmaps(docs, rule).select(F.col("doc_id").alias("of"), F.col("row").alias("of_row"), "keep")
    # The bitmaps are the small side: hashed per partition, the texts are never sorted.
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row"))
    joined = rows.join(bitmaps.hint("shuffle_hash"), same, "left")
    text, keep = F.col("text"), F.col("keep")
    return (
        joined.select("given", "text", "keep", kept_lines(text, keep).alias("kept"))
        .select(
            "given",
            F.when(keep.isNull(), whole(text)).otherwise(F.array_join("kept", "\n")).alias("kept_text"),
            F.size(lines(text)).cast("long").alias("n_lines"),
            (F.size(lines(text)) - F.size("kept")).cast("long").alias("n_dropped"),
        )
        .select("given.*", *new)
    )
