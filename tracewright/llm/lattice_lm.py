"""Subword lattice likelihood: the probability of a text summed over all segmentations of its words.

The pieces are those of an existing vocabulary file. Their unigram probabilities are learned from the
training documents; the forward recursion over the lattice of a word runs once per distinct word.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.text import bucket_of
from tracewright.shared_storage import settle

HELD_OUT_BUCKET = 1
SMOOTHING = 0.5

#: Most frequent words that every worker holds in a table; all others are joined. A size bound for
#: the broadcast only: results do not depend on it.
HEAD_WORDS = 100_000

#: Distinct words that a task gathers before it hands them on.
GATHERED_WORDS = 400_000

_SPACE = "▁"


def split_words(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased (on bytes, where both concern ASCII alone)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, train, total): occurrences in training documents and in all documents."""

    def gathered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        train, other = Counter(), Counter()

        def table() -> pd.DataFrame:
            words = list(train.keys() | other.keys())
            counts = [train[w] for w in words]
            rows = {
                "word": [w.decode("utf-8", "replace") for w in words],
                "train": counts,
                "total": [n + other[w] for n, w in zip(counts, words)],
            }
            train.clear()
            other.clear()
            return pd.DataFrame(rows)

        for frame in frames:
            for text, learns in zip(frame["text"], frame["learns"]):
                (train if learns else other).update(split_words(text))
                if len(train) + len(other) > GATHERED_WORDS:
                    yield table()
        if train or other:
            yield table()

    flagged = docs.select("text", (bucket_of(F.col("doc_id")) != HELD_OUT_BUCKET).alias("learns"))
    return (
        flagged.mapInPandas(gathered, "word string, train bigint, total bigint")
        .groupBy("word")
        .agg(F.sum("train").alias("train"), F.sum("total").alias("total"))
    )


@dataclass(frozen=True)
class Lattice:
    """log10 probabilities of pieces, and of the end of a text."""

    pieces: dict[str, float]
    byte_pieces: tuple[float, ...]
    end: float
    longest: int

    def word(self, word: str) -> float:
        """log10 of the sum over all segmentations: forward recursion in log space.

        A character that is no piece of its own is spelled by its bytes.
        """
        spelled = _SPACE + word
        forward = [0.0] + [-math.inf] * len(spelled)
        for stop in range(1, len(spelled) + 1):
            ways = []
            for start in range(max(0, stop - self.longest), stop):
                score = self.pieces.get(spelled[start:stop])
                if score is not None:
                    ways.append(forward[start] + score)
            if spelled[stop - 1] not in self.pieces:
                data = spelled[stop - 1].encode("utf-8", "surrogatepass")
                ways.append(forward[stop - 1] + sum(self.byte_pieces[b] for b in data))
            best = max(ways)
            forward[stop] = best + (math.log10(sum(10 ** (w - best) for w in ways)) if len(ways) > 1 else 0.0)
        return forward[-1]


def piece_counts(words: DataFrame, model_file: str) -> DataFrame:
    """(piece, n): how often the segmentation of the training words uses each piece of the vocabulary."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        totals = np.zeros(library.get_piece_size(), np.int64)
        for frame in frames:
            found = library.encode(frame["word"].tolist(), num_threads=1)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for ids in found for i in ids), np.int64, int(lengths.sum()))
            np.add.at(totals, flat, np.repeat(frame["train"].to_numpy(np.int64), lengths))
        used = np.flatnonzero(totals)
        yield pd.DataFrame({"piece": used, "n": totals[used]})

    return (
        words.where(F.col("train") > 0)
        .select("word", "train")
        .mapInPandas(counted, "piece bigint, n bigint")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
    )


def fit_lattice(words: DataFrame, train_docs: int, model_file: str) -> Lattice:
    """Smoothed unigram scores; at most one row per piece of the vocabulary reaches the driver."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model_file)
    counts = {r["piece"]: r["n"] for r in piece_counts(words, model_file).collect()}
    size = library.get_piece_size()
    total = sum(counts.values()) + train_docs + SMOOTHING * (size + 1)
    score = lambda n: math.log10((n + SMOOTHING) / total)
    pieces, of_bytes = {}, [score(0)] * 256
    for i in range(size):
        if library.is_byte(i):
            of_bytes[int(library.id_to_piece(i)[3:5], 16)] = score(counts.get(i, 0))
        elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
            pieces[library.id_to_piece(i)] = score(counts.get(i, 0))
    return Lattice(pieces, tuple(of_bytes), score(train_docs), max(map(len, pieces), default=1))


def scored_words(words: DataFrame, lattice: Lattice, train_tokens: int, distinct: int) -> DataFrame:
    """``words`` with ``base`` (log10 of the smoothed word unigram) and ``marginal`` (the lattice's)."""
    shared = words.sparkSession.sparkContext.broadcast(lattice)

    @F.pandas_udf("double")
    def marginal(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = shared.value
        for batch in batches:
            yield pd.Series([table.word(w) for w in batch], dtype=float)

    floor = train_tokens + SMOOTHING * (distinct + 1)
    return words.select(
        "word",
        "train",
        "total",
        F.log10((F.col("train") + SMOOTHING) / F.lit(floor)).alias("base"),
        marginal(F.col("word")).alias("marginal"),
    )


def most_frequent(words: DataFrame, limit: int) -> DataFrame:
    """The words whose total is above all but about ``limit`` of them: at most ``limit`` rows.

    The least total comes from how many words have each total, which is a small table, so that no task
    sends its own best words on. Words that are equally frequent come in all or not at all.
    """
    totals = words.groupBy("total").agg(F.count(F.lit(1)).alias("n"))
    most_first = Window.orderBy(F.desc("total")).rowsBetween(Window.unboundedPreceding, 0)
    fitting = totals.withColumn("so_far", F.sum("n").over(most_first)).where(F.col("so_far") <= limit)
    least = fitting.agg(F.min("total")).first()[0]
    return words.where(F.col("total") >= F.lit(least).cast("bigint"))


def scores(docs: DataFrame, model_file: str, head_words: int = HEAD_WORDS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words and one end. ``base_score`` is the smoothed unigram score of the tokens,
    ``score`` the log10 probability of the text under the lattice model. The word table of the corpus
    stays distributed: the most frequent words are looked up in place, the others joined by word.
    A null text is an empty one; a null doc_id trains; empty input gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    words = settle(word_counts(docs))
    train_docs = docs.where(bucket_of(F.col("doc_id")) != HELD_OUT_BUCKET).count()
    facts = words.agg(
        F.coalesce(F.sum("train"), F.lit(0)).alias("n"), F.count_if(F.col("train") > 0).alias("v")
    ).first()
    train_tokens, distinct = facts["n"] + train_docs, facts["v"] + (train_docs > 0)
    lattice = fit_lattice(words, train_docs, model_file)
    table = settle(scored_words(words, lattice, train_tokens, distinct))
    head = {
        r["word"].encode("utf-8"): (r["train"] > 0, r["base"], r["marginal"])
        for r in most_frequent(table, head_words).collect()
    }
    shared = spark.sparkContext.broadcast(head)
    end_known = int(train_docs > 0)
    end_base = math.log10((train_docs + SMOOTHING) / (train_tokens + SMOOTHING * (distinct + 1)))
    end_score = lattice.end

    @F.pandas_udf("struct<n:bigint,known:bigint,base:double,marginal:double,rest:array<string>>")
    def looked_up(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        find = shared.value.get
        for texts in batches:
            rows = []
            for text in texts:
                split = split_words(text)
                found = [(w, find(w)) for w in split]
                hits = [f for _, f in found if f is not None]
                rows.append(
                    (
                        len(split) + 1,
                        sum(f[0] for f in hits) + end_known,
                        math.fsum(f[1] for f in hits) + end_base,
                        math.fsum(f[2] for f in hits) + end_score,
                        [w.decode("utf-8", "replace") for w, f in found if f is None],
                    )
                )
            yield pd.DataFrame(rows, columns=["n", "known", "base", "marginal", "rest"])

    rows = settle(
        docs.select(
            "doc_id", F.monotonically_increasing_id().alias("_row"), looked_up(F.col("text")).alias("s")
        ).select("doc_id", "_row", "s.*")
    )
    rest = (
        rows.select("_row", F.explode("rest").alias("word"))
        .join(table, "word")
        .groupBy(F.col("_row").alias("_of"))
        .agg(
            F.count_if(F.col("train") > 0).alias("_known"),
            F.sum("base").alias("_base"),
            F.sum("marginal").alias("_marginal"),
        )
    )
    added = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return rows.join(rest, F.col("_row") == F.col("_of"), "left").select(
        "doc_id",
        (bucket_of(F.col("doc_id")) == HELD_OUT_BUCKET).alias("held_out"),
        F.col("n").alias("n_tokens"),
        added("known", "_known").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        added("base", "_base").alias("base_score"),
        added("marginal", "_marginal").alias("score"),
    )
