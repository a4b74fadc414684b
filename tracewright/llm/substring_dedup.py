"""Substring de-duplication: passages that an earlier document holds too, by FM-indexes of shards.

A window of words is sent to the shard of its anchor, the word group of lowest hash inside it. Equal
windows have equal anchors, so a shard can decide on its windows alone, and each window is in one shard.
Windows in a row with one anchor travel as one segment. Anchors with very many different segments are cut
again by wider anchors, at last by the window itself, so that no shard gets more than its part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm import word_windows
from tracewright.llm.fm_index import FMIndex
from tracewright.llm.text import whole
from tracewright.shared_storage import settle


@dataclass(frozen=True)
class PassageRule:
    """``window`` words in a row are a passage; the rest are sizes that results do not depend on.

    ``anchor_words``: words of an anchor, and of the wider ones for anchors that are too full.
    ``filter_anchors``: up to so many repeated anchors are told to tasks by a bitmap of 16 bits each (64 MB
    at most); beyond that the anchors of each document are joined with them. ``shard_segments``: distinct
    segments an index holds on average; an anchor with more of them is cut again.
    ``broadcast_bytes``: what is found is broadcast up to this size, otherwise joined by a shuffle.
    """

    window: int = 13
    anchor_words: tuple[int, ...] = (6, 10, 13)
    filter_anchors: int = 1 << 25
    shard_segments: int = 20_000
    broadcast_bytes: int = 32 << 20


def _runs(texts: pa.Array, rule: PassageRule, level: int = 0):
    """(row of the first text, words, (first window, windows, anchor)) of every part of a column."""
    for row, part in word_windows.parts(texts):
        found = word_windows.words(part)
        hashes = word_windows.word_hashes(found)
        yield row, found, word_windows.anchored_runs(found, hashes, rule.window, rule.anchor_words[level])


def document_anchors(docs: DataFrame, rule: PassageRule) -> DataFrame:
    """(anchor, doc_id) of every run of windows."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, found, (first, _, anchors) in _runs(batch.column(1), rule):
                of = ids[row + found.text[first]]
                yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(of)], ["anchor", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(keys, "anchor bigint, doc_id bigint")


def repeated_anchors(docs: DataFrame, rule: PassageRule) -> DataFrame:
    """Anchors that occur in more than one document. Smallest and largest id combine before the shuffle."""
    return (
        document_anchors(docs, rule)
        .groupBy("anchor")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where(F.col("low") < F.col("high"))
        .select("anchor")
    )


def anchor_bitmap(repeated: DataFrame, n_anchors: int) -> np.ndarray:
    """A bitmap of at least 16 bits an anchor with the bit of every repeated anchor set."""
    bits = 1 << max(16, (16 * max(n_anchors, 1) - 1).bit_length())
    words = (
        repeated.select(F.pmod("anchor", F.lit(bits)).alias("bit"))
        .groupBy(F.expr("bit div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bitmap.view(np.uint64)


def with_repeated(docs: DataFrame, repeated: DataFrame, rule: PassageRule) -> DataFrame:
    """``docs`` (doc_id, row, text) with ``repeated``: the repeated anchors of the document."""
    held = document_anchors(docs, rule).join(repeated, "anchor", "left_semi")
    lists = held.groupBy("doc_id").agg(F.collect_set("anchor").alias("repeated"))
    return docs.join(lists, "doc_id")


def segments(docs: DataFrame, bitmap: np.ndarray | None, rule: PassageRule, *, with_text: bool) -> DataFrame:
    """(doc_id, row, at, windows, anchor, digest, text): runs of windows with an anchor that may be repeated.

    ``at`` is the first word's position, ``text`` the words of all windows of the run, joined by blanks.
    Which anchors may be is told by the bitmap, or by the column ``repeated`` of ``docs``.
    """
    shared = None if bitmap is None else docs.sparkSession.sparkContext.broadcast(bitmap)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.string()]
    names = ["doc_id", "row", "at", "windows", "anchor", "digest", "text"]

    def hits(batch: pa.RecordBatch, of: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        if shared is not None:
            bits = shared.value
            slot = anchors & (len(bits) * 64 - 1)
            return (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
        known = batch.column(3)
        found = [np.isin(anchors[of == r], known[r].values.to_numpy()) for r in np.unique(of).tolist()]
        return np.concatenate([*found, np.zeros(0, bool)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, found, (first, windows, anchors) in _runs(batch.column(2), rule):
                of = row + found.text[first]
                hit = np.flatnonzero(hits(batch, of, anchors))
                first, windows, anchors, of = first[hit], windows[hit], anchors[hit], of[hit]
                at = first - found.first_of_text[of - row]
                texts = [
                    found.joined(a, a + n + rule.window - 1) for a, n in zip(first.tolist(), windows.tolist())
                ]
                columns = [
                    ids[of], keys[of], at, windows, anchors,
                    [blake2b(t, digest_size=16).digest() for t in texts],
                    pa.array(texts, pa.binary()).cast(pa.string()) if with_text else [None] * len(texts),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    columns = ["doc_id", "row", "text"] + (["repeated"] if bitmap is None else [])
    return docs.select(*columns).mapInArrow(
        cut, "doc_id bigint, row bigint, at int, windows int, anchor bigint, digest binary, text string"
    )


def first_holders(pieces: pd.DataFrame, rule: PassageRule) -> pd.DataFrame:
    """(digest, first): per window of each segment the smallest document of the shard that holds it.

    A segment that is alone with its anchor shares no window with another one.
    """
    alone = ~pieces["anchor"].duplicated(keep=False)
    first: dict[bytes, np.ndarray] = {}
    for digest, doc_id, text in pieces.loc[alone, ["digest", "doc_id", "text"]].itertuples(index=False):
        first[digest] = np.full(text.count(" ") + 2 - rule.window, doc_id, np.int64)
    rest = pieces[~alone].sort_values(["doc_id", "digest"], kind="stable")
    if len(rest):
        first |= zip(rest["digest"], _searched(rest, rule))
    return pd.DataFrame({"digest": list(first), "first": list(first.values())})


def _searched(pieces: pd.DataFrame, rule: PassageRule) -> list[np.ndarray]:
    """Smallest holder of every window of each segment, by backward search in one index of all of them."""
    number: dict[str, int] = {}
    split = [[number.setdefault(w, len(number) + 2) for w in t.split(" ")] for t in pieces["text"]]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    # Segments are parted by 1, so that no match runs from one into the next.
    text = np.fromiter((w for s in split for w in (*s, 1)), np.int64, int(sizes.sum()) + len(split))
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    holders = np.repeat(pieces["doc_id"].to_numpy(np.int64), sizes + 1)
    index = FMIndex(text, rule.window, holders)
    n_windows = sizes - rule.window + 1
    offsets = np.arange(int(n_windows.sum())) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    places = np.repeat(begins, n_windows) + offsets
    first = holders[places]
    for k in range(0, len(places), 1 << 18):
        part = places[k : k + (1 << 18)]
        matched, low, high = index.search(np.lib.stride_tricks.sliding_window_view(text, rule.window)[part])
        full = np.flatnonzero(matched >= rule.window)
        if len(full):
            spans, which = np.unique(np.stack((low[full], high[full])), axis=1, return_inverse=True)
            first[k + full] = index.least_holder(*spans)[which.reshape(-1)]
    return np.split(first, np.cumsum(n_windows)[:-1])


def holders(classes: DataFrame, rule: PassageRule, level: int = 0) -> DataFrame:
    """(digest, first) of all segments (digest, anchor, doc_id, text), one index per shard of anchors."""
    shards = classes.count() // rule.shard_segments + 1
    crowded = F.broadcast(
        settle(classes.groupBy("anchor").count().where(F.col("count") > rule.shard_segments).select("anchor"))
    )  # at most one row per shard_segments rows
    deeper = level + 1 < len(rule.anchor_words) and not crowded.isEmpty()

    def indexed(pieces: pd.DataFrame) -> pd.DataFrame:
        return first_holders(pieces, rule)

    calm = classes.join(crowded, "anchor", "left_anti") if deeper else classes
    found = (
        calm.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "digest", "anchor", "doc_id", "text")
        .groupBy("shard")
        .applyInPandas(indexed, "digest binary, first array<bigint>")
    )
    if not deeper:
        return found
    return found.union(_cut_again(classes.join(crowded, "anchor", "left_semi"), rule, level + 1))


def _cut_again(crowded: DataFrame, rule: PassageRule, level: int) -> DataFrame:
    """The same for segments of anchors that are too full: cut by wider anchors and put together again."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, found, (first, windows, anchors) in _runs(batch.column(2), rule, level):
                of = pa.array(row + found.text[first])
                at = first - found.first_of_text[found.text[first]]
                texts = [
                    found.joined(a, a + n + rule.window - 1) for a, n in zip(first.tolist(), windows.tolist())
                ]
                digests = [blake2b(t, digest_size=16).digest() for t in texts]
                columns = [
                    batch.column(0).take(of), batch.column(1).take(of), pa.array(at, pa.int32()), pa.array(anchors),
                    pa.array(digests, pa.binary()), pa.array(texts, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["parent", "doc_id", "at", "anchor", "digest", "text"])

    pieces = settle(
        crowded.select("digest", "doc_id", "text").mapInArrow(
            cut, "parent binary, doc_id bigint, at int, anchor bigint, digest binary, text string"
        )
    )
    decided = holders(segment_classes(pieces), rule, level)
    parts = F.array_sort(F.collect_list(F.struct("at", "first")))
    return (
        pieces.select("parent", "at", "digest")
        .join(decided, "digest")
        .groupBy(F.col("parent").alias("digest"))
        .agg(F.flatten(F.transform(parts, lambda x: x["first"])).alias("first"))
    )


def segment_classes(pieces: DataFrame) -> DataFrame:
    """Equal segments are one class, held by the smallest id."""
    return settle(
        pieces.groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"), F.first("anchor").alias("anchor"), F.first("text").alias("text")
        )
    )


def repeated_spans(docs: DataFrame, rule: PassageRule = PassageRule()) -> DataFrame:
    """(doc_id, row, spans): stretches of first words of windows that a document with a smaller id holds as well.

    ``docs`` has doc_id, row and text; ``row`` tells the texts of one document apart. A span is (start, end)
    with the end exclusive.
    """
    repeated = settle(repeated_anchors(docs, rule))
    n_anchors = repeated.count()
    bitmap = anchor_bitmap(repeated, n_anchors) if n_anchors <= rule.filter_anchors else None
    given = docs if bitmap is not None else settle(with_repeated(docs, repeated, rule))
    classes = segment_classes(segments(given, bitmap, rule, with_text=True))
    places = segments(given, bitmap, rule, with_text=False).select("doc_id", "row", "at", "digest")
    # A window is lost if its first holder is an earlier document; neighbours that are lost make one span.
    lost = F.transform("first", lambda x: x < F.col("doc_id"))
    edges = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.size("lost") - 1),
            lambda k: F.when(
                F.col("lost")[k] & ((k == 0) | ~F.coalesce(F.get("lost", k - 1), F.lit(False))),
                F.struct(
                    (F.col("at") + k).alias("start"),
                    (F.col("at") + k + _run_length(F.col("lost"), k)).alias("end"),
                ),
            ),
        ),
        lambda x: x.isNotNull(),
    )
    # Every window is in one segment, so the spans of a text are apart; those that meet become one.
    spans = F.col("spans")
    opens = F.filter(spans, lambda x, k: (k == 0) | (F.get(spans, k - 1)["end"] < x["start"]))
    closes = F.filter(spans, lambda x, k: (k == F.size(spans) - 1) | (F.get(spans, k + 1)["start"] > x["end"]))
    joined = F.zip_with(opens, closes, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))
    return (
        places.join(settle(holders(classes, rule)), "digest")
        .select("doc_id", "row", "at", lost.alias("lost"))
        .where(F.exists("lost", lambda x: x))
        .groupBy("doc_id", "row")
        .agg(F.array_sort(F.flatten(F.collect_list(edges))).alias("spans"))
        .select("doc_id", "row", joined.alias("spans"))
    )


def _run_length(flags: Column, start: Column) -> Column:
    """How many flags from ``start`` on hold."""
    end = F.array_position(F.slice(flags, start + 1, F.size(flags) - start), F.lit(False)).cast("int")
    return F.when(end == 0, F.size(flags) - start).otherwise(end - 1)


def dedup_passages(docs: DataFrame, rule: PassageRule = PassageRule()) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (kept words, one blank between).

    A word goes if a window that covers it is also in a document with a smaller doc_id. Null texts have
    no words. Rows without doc_id keep all words and take none from others; rows that share a doc_id are
    one document, and none of them takes words from another. All columns stay; columns with the new names
    are replaced. Empty input gives no rows.
    """
    width = rule.window
    new = ("n_words", "n_removed", "kept_text")

    @F.arrow_udf("struct<n_words:bigint,n_removed:bigint,kept_text:string>")
    def kept(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lost in batches:
            for k in range(0, len(texts), 500):
                rows = []
                for text, spans in zip(texts[k : k + 500].to_pylist(), lost[k : k + 500].to_pylist()):
                    words = (text or "").encode("utf-8", "surrogatepass").split()
                    left = words
                    if spans:
                        left, at = [], 0
                        for span in spans:
                            left += words[at : max(at, span["start"])]
                            at = max(at, span["end"] + width - 1)
                        left += words[at:]
                    rows.append((len(words), len(words) - len(left), b" ".join(left)))
                columns = list(zip(*rows))
                yield pa.StructArray.from_arrays(
                    [
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.binary()).cast(pa.string()),
                    ],
                    list(new),
                )

    held = [c for c in docs.columns if c not in new]
    text = F.col("text")
    # The input row is one struct, so that no name of it can clash with an inner one.
    rows = docs.select(F.struct(*held).alias("given"), "doc_id", F.xxhash64(whole(text)).alias("row"), "text")
    texts = rows.where(F.col("doc_id").isNotNull()).select("doc_id", "row", "text")
    spans = settle(repeated_spans(texts, rule))
    size = spans.agg(F.coalesce(F.sum(F.size("spans") * 8 + 40), F.lit(0)).alias("bytes")).first()["bytes"]
    joined = rows.join(F.broadcast(spans) if size <= rule.broadcast_bytes else spans, ["doc_id", "row"], "left")
    return joined.select("given", kept("text", "spans").alias("kept")).select("given.*", "kept.*")
