"""Near-duplicate documents: circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.llm import word_windows
from tracewright.llm.components import components
from tracewright.llm.shingles import mixed, shingle_hashes
from tracewright.llm.text import broadcast_if_small, drop_worker_table, whole
from tracewright.shared_storage import settle


#: Pairs of texts that are compared before their verdicts are handed on.
PART = 200

#: Rows handed to a Python worker at once. Two texts a row are held by the JVM and the worker at the same time.
BATCH_ROWS = 1000
_BATCH_LIMIT = "spark.sql.execution.arrow.maxRecordsPerBatch"

@dataclass(frozen=True)
class NearRule:
    """Linked: ``100 * intersection >= percent * union`` of the sets of word shingles.

    ``bands`` bands of ``rows`` coordinates find a pair of similarity s with probability
    1 - (1 - s ** rows) ** bands: all but 2 in 10 million pairs at 0.8, 1 in 10 billion at 0.85.
    """

    shingle_words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


_BLOCK = 4096
_INITIAL = np.uint64(0x5851F42D4C957F2D)


def circulant_minhash(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Signature from two permutations of 32-bit integers.

    The first scatters the shingles. The second, shifted circularly by k places, gives coordinate k:
    the smallest value of second(first(x) + k) over the set.
    """
    scattered = (mixed(shingles ^ _INITIAL) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    lowest = np.full(coordinates, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(scattered), _BLOCK):
        x = scattered[None, k : k + _BLOCK] + shifts
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(lowest, x.min(axis=1), out=lowest)
    return lowest


def band_hashes(signature: np.ndarray, rule: NearRule) -> np.ndarray:
    """One integer per band, different bands never alike on purpose."""
    rows = signature.reshape(rule.bands, rule.rows).astype(np.uint64)
    folded = mixed(np.arange(rule.bands, dtype=np.uint64))
    for k in range(rule.rows):
        folded = mixed(folded ^ rows[:, k])
    return folded.view(np.int64)


def shingle_sets(texts: pa.Array, rule: NearRule) -> Iterator[list[np.ndarray]]:
    """The sorted shingle hashes of texts, in small parts, so that a batch is never held whole."""
    for _, part in word_windows.parts(texts):
        found = word_windows.words(part, lower=True)
        hashes = word_windows.word_hashes(found)
        ends = [*found.first_of_text[1:].tolist(), len(hashes)]
        yield [
            np.unique(shingle_hashes(hashes[a:b], rule.shingle_words)) for a, b in zip(found.first_of_text.tolist(), ends)
        ]


def signatures(docs: DataFrame, rule: NearRule) -> DataFrame:
    """(doc_id, row, n_shingles, digest, bands): set size, digest of the set, one hash per band."""

    kinds = {"n_shingles": pa.int64(), "digest": pa.binary(), "bands": pa.list_(pa.int64())}

    @F.arrow_udf("struct<n_shingles:bigint,digest:binary,bands:array<bigint>>")
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        drop_worker_table()
        for batch in batches:
            for sets in shingle_sets(batch, rule):
                columns = [
                    [len(found) for found in sets],
                    [blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets],
                    [band_hashes(circulant_minhash(x, rule.coordinates), rule) if len(x) else None for x in sets],
                ]
                yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))

    return docs.select("doc_id", "row", signed(F.col("text")).alias("s")).select("doc_id", "row", "s.*")


def text_classes(signed: DataFrame) -> DataFrame:
    """(rep, digest, doc_id, row, n, bands): texts with equal sets are one class, numbered by ``rep``.

    Its text is that of the smallest doc_id (and ``row``). Settled, so that numbers stay.
    """
    usable = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = usable.groupBy("digest").agg(
        F.min(F.struct("doc_id", "row")).alias("of"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    return settle(
        classes.select(
            F.monotonically_increasing_id().alias("rep"), "digest", "of.doc_id", "of.row", "n", "bands"
        )
    )


def class_texts(reps: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, text) of the classes ``rep``."""
    places = settle(classes.join(reps, "rep", "left_semi").select("rep", "doc_id", "row"))
    return docs.join(broadcast_if_small(places), ["doc_id", "row"]).select("rep", "text").dropDuplicates(["rep"])


def links_of_documents(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): classes that one document has texts of. Most tables have no such document."""
    usable = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).select("doc_id", "digest")
    several = settle(
        usable.groupBy("doc_id")
        .agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
        .where(F.col("low") < F.col("high"))
        .select("doc_id", "low")
    )
    rep = lambda digest, name: classes.select(F.col("digest").alias(digest), F.col("rep").alias(name))
    return (
        usable.join(several, "doc_id")
        .where(F.col("digest") != F.col("low"))
        .join(rep("digest", "a"), "digest")
        .join(rep("low", "b"), "low")
        .select("a", "b")
        .distinct()
    )


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, rule: NearRule) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""

    def shingles(text: str | None) -> np.ndarray:
        return next(shingle_sets(pa.array([text], pa.string()), rule))[0]

    @F.arrow_udf("boolean")
    def similar(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        drop_worker_table()
        last, held = None, None
        for firsts, seconds in batches:
            for k in range(0, len(firsts), PART):
                verdicts = []
                for first, second in zip(firsts[k : k + PART].to_pylist(), seconds[k : k + PART].to_pylist()):
                    if held is None or last != first:
                        last, held = first, shingles(first)
                    other = shingles(second)
                    both = len(np.intersect1d(held, other, assume_unique=True))
                    verdicts.append(100 * both >= rule.percent * (len(held) + len(other) - both))
                yield pa.array(verdicts, pa.bool_())

    pairs = settle(pairs)
    ids = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    texts = settle(class_texts(ids, classes, docs))
    sided = lambda side: texts.select(F.col("rep").alias(side), F.col("text").alias(f"{side}_text"))
    return (
        pairs.join(sided("a"), "a")
        .join(sided("b"), "b")
        .where(similar(F.col("a_text"), F.col("b_text")))
        .select("a", "b")
    )


def _may_link(n: str, m: str, rule: NearRule) -> Column:
    """Sets whose sizes are too far apart can't reach the similarity."""
    return 100 * F.least(n, m) >= rule.percent * F.greatest(n, m)


def prefix_entries(open_reps: DataFrame, classes: DataFrame, docs: DataFrame, rule: NearRule) -> DataFrame:
    """(rep, n, component, token, at): the rarest shingles of every set, as many as can decide a link.

    Two similar sets share one of the rarest shingles of each. Shingles that a single set holds take
    their places in the order, but join with nothing and are left out.
    """

    @F.arrow_udf("array<bigint>")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        drop_worker_table()
        for batch in batches:
            for sets in shingle_sets(batch, rule):
                offsets = np.cumsum([0, *map(len, sets)])
                values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))

    texts = class_texts(open_reps.select("rep"), classes, docs)
    held = settle(texts.select("rep", tokens(F.col("text")).alias("tokens"))).select("rep", F.explode("tokens").alias("token"))
    frequent = held.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1)
    of_set = Window.partitionBy("rep")
    placed = (
        held.join(frequent, "token")
        .join(open_reps, "rep")
        .withColumn("nth", F.row_number().over(of_set.orderBy("df", "token")))
        .withColumn("at", F.col("n") - F.count(F.lit(1)).over(of_set) + F.col("nth"))
    )
    longest = F.col("n") - F.ceil(F.col("n") * rule.percent / 100) + 1
    return placed.where(F.col("at") <= longest).select("rep", "n", "component", "token", "at")


def prefix_pairs(entries: DataFrame, rule: NearRule) -> DataFrame:
    """Pairs (a, b) of different components that share a prefix shingle at places that leave enough."""
    side = lambda s: entries.select("token", *[F.col(c).alias(f"{s}_{c}") for c in ("rep", "n", "component", "at")])
    needed = F.ceil(rule.percent * (F.col("a_n") + F.col("b_n")) / (100 + rule.percent))
    left = 1 + F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    a, b = side("a"), side("b")
    can_link = (
        (a["token"] == b["token"])
        & (F.col("a_rep") < F.col("b_rep"))
        & (F.col("a_component") != F.col("b_component"))
        & _may_link("a_n", "b_n", rule)
        & (left >= needed)
    )
    return a.join(b, can_link).select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b")).distinct()


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Plans that are made inside hand at most so many rows at once to Python, and not more than the session's."""
    before = spark.conf.get(_BATCH_LIMIT)
    least = min(rows, int(before)) if int(before) > 0 else rows
    spark.conf.set(_BATCH_LIMIT, str(least))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_LIMIT, before)


def near_groups(docs: DataFrame, rule: NearRule = NearRule()) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id that links lead to, itself included.

    1. Texts with equal sets are one class; from here on only classes are compared. Classes that one
       document has texts of are linked.
    2. In each bucket of a band every member is compared with one hub: the member whose buckets are the
       fullest, which is the most typical text of its group. Confirmed links join members into components.
    3. What is left are buckets with more than one component. Members of different components are compared
       if they share one of their rarest shingles at a place that can still make them similar, which
       every similar pair does. Members of one component need no further link.

    So the pairs within a group of copies are not spelled out, and every candidate pair that could still
    join two groups is verified on full sets. Texts without words, and rows without doc_id, are linked with
    nothing; their component is their own doc_id. Rows that share a doc_id are one document: each is
    compared with its own text, and what is linked with one of them is linked with all. No other column
    of ``docs`` is returned. Empty input gives no rows.
    """
    with small_batches(docs.sparkSession):
        return _near_groups(docs, rule)


def _near_groups(docs: DataFrame, rule: NearRule) -> DataFrame:
    """:func:`near_groups`; all steps in Python run before it returns."""
    docs = docs.select("doc_id", F.xxhash64(whole(F.col("text"))).alias("row"), "text")
    signed = settle(signatures(docs, rule))
    classes = text_classes(signed)
    buckets = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    shared = settle(
        buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    )
    members = settle(buckets.join(shared, "bucket"))
    typical = members.groupBy("rep").agg(F.sum("members").alias("fullness"))
    hubs = (
        members.join(typical, "rep")
        .groupBy("bucket")
        .agg(F.max(F.struct("fullness", (-F.col("rep")).alias("order"), "rep", "n")).alias("hub"))
        .select("bucket", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n"))
    )
    stars = settle(
        members.join(hubs, "bucket")
        .where((F.col("rep") != F.col("hub")) & _may_link("n", "hub_n", rule))
        .select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b"))
        .distinct()
    )
    links = settle(confirmed(stars, classes, docs, rule).union(links_of_documents(signed, classes)))
    grouped = components(links)
    labelled = members.join(
        grouped.select(F.col("node").alias("rep"), F.col("component").alias("found")), "rep", "left"
    ).select("bucket", "rep", "n", F.coalesce("found", "rep").alias("component"))
    mixed_buckets = (
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where(F.col("low") != F.col("high"))
        .select("bucket")
    )
    open_reps = settle(
        labelled.join(mixed_buckets, "bucket", "left_semi").select("rep", "n", "component").distinct()
    )
    entries = settle(prefix_entries(open_reps, classes, docs, rule))
    rest = prefix_pairs(entries, rule).join(stars, ["a", "b"], "left_anti")
    every = links.union(confirmed(rest, classes, docs, rule))
    final = components(every)
    grouped_classes = (
        classes.select("digest", "rep", "doc_id")
        .join(final.select(F.col("node").alias("rep"), F.col("component").alias("found")), "rep", "left")
        .select("digest", "doc_id", F.coalesce("found", "rep").alias("component"))
    )
    least = grouped_classes.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    reps = grouped_classes.join(least, "component").select("digest", "component_id")
    return signed.join(reps, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, rule: NearRule = NearRule()) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its group; all columns stay.

    Rows without doc_id stay.
    """
    others = (
        near_groups(docs, rule)
        .where(F.col("doc_id") != F.col("component_id"))
        .select("doc_id")
        .distinct()
    )
    return docs.join(others, "doc_id", "left_anti")
