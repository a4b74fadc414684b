"""Phrase collocation mining: exact counts of word sequences, and phrases that hold together.

No sequence is frequent with a part that is not. Hashes of words, and then of pairs of frequent words, are
counted first, which leaves few sequences to be counted exactly: words that may be frequent, two and
three words of which every pair may be, and at last four words of which both threes are. A hash counts for
all that share it, so nothing frequent is left out.

A task counts sequences in a trie of hash containers, packs what is too much for it into tables that are added up
as they meet, and spills whole subtrees as sorted runs; runs are
range-partitioned by their words, so that equal prefixes lie together and a prefix with very many sequences
is still dealt to several tasks, and merged there in sorted order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.hat_trie import HatTrie
from tracewright.llm.shingles import mixed
from tracewright.llm.word_windows import word_hashes, words_of
from tracewright.shared_storage import settle

NO_LANGUAGE = "und"
LONGEST = 4

#: Words that are numbered and counted together; sequences that start in them may end behind them.
STEP = 200_000

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_STOP = b"."
#: A-Z are lower-cased, and all characters that end a piece become one.
_TABLE = bytes.maketrans(_UPPER + b",;:!?\n\x0b\x0c\r", _UPPER.lower() + _STOP * 9)


@dataclass(frozen=True)
class PhraseRule:
    """Which phrases count, and sizes that results do not depend on.

    ``min_count``: least number of occurrences. ``cover_percent``: a phrase goes if a longer one around it
    has at least this part of its occurrences. ``top``: phrases listed per language. ``trie_entries``,
    ``packed_entries``, ``vocabulary`` and ``hashes``: what a task holds before it packs or spills. ``most_bits``: bound of a table of hashes
    (32 MB); it has 16 bits a hash up to that, and lets more sequences be counted in vain beyond. ``salts``: parts of a language that are ranked on their own first.
    """

    min_count: int = 30
    cover_percent: int = 80
    top: int = 2000
    trie_entries: int = 400_000
    packed_entries: int = 1_500_000
    vocabulary: int = 300_000
    hashes: int = 1 << 20
    most_bits: int = 1 << 28
    salts: int = 64


class Vocabulary(dict):
    """Numbers of words as they come, from 1; a full stop is 0 and parts pieces."""

    def __init__(self) -> None:
        super().__init__({_STOP: 0})
        self.words: list[bytes] = [_STOP]
        self._hashes = np.zeros(1, np.uint64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word, by number."""
        new = self.words[len(self._hashes) :]
        self._hashes = np.concatenate((self._hashes, word_hashes(words_of(b" ".join(new)))))
        return self._hashes

    def numbers(self, words: list[bytes], kept: np.ndarray | None = None, at: int = 0) -> np.ndarray:
        """Numbers of the words; 0 for those that ``kept``, from place ``at``, leaves out."""
        if kept is None:
            return np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        kept = kept[at : at + len(words)]
        found = np.zeros(len(words), np.int64)
        found[kept] = np.fromiter(map(self.__getitem__, compress(words, kept.tolist())), np.int64, int(kept.sum()))
        return found


def marked(texts: list[str]) -> bytes:
    """Texts with a full stop of its own between pieces and around every text."""
    data = _STOP.join(t.encode("utf-8", "surrogatepass") for t in texts)
    return (_STOP + data.translate(_TABLE) + _STOP).replace(_STOP, b" . ")


def sequence_hash(language: str, words: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence from those of its words, for many sequences at once."""
    seed = word_hashes(words_of(b"_" + language.encode("utf-8", "surrogatepass").replace(b" ", b"_")))[0]
    found = np.full(len(words[0]), seed, np.uint64)
    for w in words:
        found = mixed(found ^ w)
    return found


class FrequentTable:
    """A bit table of hashes; its number of bits is a power of two."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.mask = np.uint64(len(table) * 64 - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in (hashes & self.mask, (hashes >> np.uint64(32)) & self.mask):
            found &= (self.table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def frequent_table(hashes: DataFrame, rule: PhraseRule) -> FrequentTable:
    """The bit table of the hashes in column ``hash``, of bounded size."""
    bits = min(1 << max(12, (16 * hashes.count()).bit_length()), rule.most_bits)
    places = F.array(*[F.expr(f"{x} & {bits - 1}L") for x in ("hash", "shiftrightunsigned(hash, 32)")])
    words = (
        hashes.select(F.explode(places).alias("place"))
        .groupBy(F.expr("place div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("set"))
        .toArrow()
    )
    table = np.zeros(bits // 64, np.int64)
    table[words["word"].to_numpy()] = words["set"].to_numpy()
    return FrequentTable(table.view(np.uint64))


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    """Texts of one language in parts of about a million characters."""
    texts: dict[str, list[str]] = {}
    for language, text in zip(*(c.to_pylist() for c in batch.columns)):
        texts.setdefault(language, []).append(text)
    for language, of in texts.items():
        for part in _parts(of):
            yield language, part


def hash_counts(texts: DataFrame, words: FrequentTable | None, rule: PhraseRule) -> DataFrame:
    """(hash, f) of every word, or of every pair of words that ``words`` holds; f is at most the count.

    Rows with a ``lang`` have no hash: they tell how many words it has. A task adds up what it has seen
    before it hands it on.
    """
    shared = None if words is None else texts.sparkSession.sparkContext.broadcast(words.table)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if shared is None else FrequentTable(shared.value)
        held, totals = _HashCounts(), {}
        for batch in batches:
            for language, part in _by_language(batch):
                found = words_of(marked(part))
                hashes = word_hashes(found)
                inside = (found.ends - found.starts > 1) | (found.data[found.starts] != _STOP[0])
                if table is None:
                    held.add(sequence_hash(language, [hashes[inside]]))
                    totals[language] = totals.get(language, 0) + int(inside.sum())
                else:
                    good = inside & table.holds(sequence_hash(language, [hashes]))
                    first = np.flatnonzero(good[:-1] & good[1:])
                    held.add(sequence_hash(language, [hashes[first], hashes[first + 1]]))
                if held.size > rule.hashes:
                    yield _counts([None] * held.merge(), held.hashes, held.counts)
                    held = _HashCounts()
        yield _counts([None] * held.merge(), held.hashes, held.counts)
        yield _counts(list(totals), [None] * len(totals), list(totals.values()))

    return texts.mapInArrow(counted, "lang string, hash bigint, f bigint")


def _counts(languages: list, hashes, counts) -> pa.RecordBatch:
    columns = [pa.array(languages, pa.string()), pa.array(hashes, pa.int64()), pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "hash", "f"])


class _HashCounts:
    """Counts of hashes, added up whenever the new ones are as many as the known."""

    def __init__(self) -> None:
        self.hashes = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.new: list[np.ndarray] = []
        self.n_new = 0

    @property
    def size(self) -> int:
        """Different hashes, after adding up what is new if it might be too much."""
        if self.n_new > max(len(self.hashes), 1 << 18):
            self.merge()
        return len(self.hashes)

    def add(self, hashes: np.ndarray) -> None:
        self.new.append(hashes.view(np.int64))
        self.n_new += len(hashes)

    def merge(self) -> int:
        every = np.concatenate([self.hashes, *self.new])
        counts = np.concatenate((self.counts, np.ones(self.n_new, np.int64)))
        order = np.argsort(every)
        every, counts = every[order], counts[order]
        begins = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))[: len(every)])
        self.hashes = every[begins]
        self.counts = np.add.reduceat(counts, begins) if len(begins) else counts[:0]
        self.new, self.n_new = [], 0
        return len(self.hashes)


def _filled(numbers: np.ndarray, keep: np.ndarray, n: int) -> np.ndarray:
    """A table of four word numbers (zeros at the end) of the sequences of ``n`` words that are kept."""
    starts = np.flatnonzero(keep[:STEP])
    columns = [numbers[starts + k] if k < n else np.zeros(len(starts), np.int64) for k in range(LONGEST)]
    return np.stack(columns, axis=1)


def _held(numbers: np.ndarray, language: str, known: Vocabulary, inside: np.ndarray, n: int, table: FrequentTable):
    """Where ``n`` words in a row, all of them ``inside``, are in the table."""
    found = np.zeros(max(len(numbers) - n + 1, 0), bool)
    starts = np.flatnonzero(np.logical_and.reduce([inside[k : len(numbers) - n + 1 + k] for k in range(n)]))
    hashes = known.hashes()
    found[starts] = table.holds(sequence_hash(language, [hashes[numbers[starts + k]] for k in range(n)]))
    return found


def _short(numbers: np.ndarray, language: str, known: Vocabulary, words: FrequentTable, pairs: FrequentTable):
    """Tables of the words, twos and threes that may be frequent."""
    single = _held(numbers, language, known, numbers > 0, 1, words)
    pair = _held(numbers, language, known, single, 2, pairs)
    yield _filled(numbers, single, 1)
    yield _filled(numbers, pair, 2)
    yield _filled(numbers, pair[:-1] & pair[1:], 3)


def _fours(numbers: np.ndarray, language: str, known: Vocabulary, threes: FrequentTable):
    """The table of four words of which both threes may be frequent."""
    three = _held(numbers, language, known, numbers > 0, 3, threes)
    yield _filled(numbers, three[:-1] & three[1:], 4)


def with_hash(sequences: DataFrame, n: int) -> DataFrame:
    """(hash) of (lang, phrase) rows of ``n`` words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for language, phrases in _by_language(batch):
                words = word_hashes(words_of(" ".join(phrases).encode("utf-8", "surrogatepass"))).reshape(-1, n)
                found = sequence_hash(language, list(words.T))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["hash"])

    return sequences.select("lang", "phrase").mapInArrow(hashed, "hash bigint")


def counted_runs(texts: DataFrame, tables: tuple[FrequentTable, ...], rule: PhraseRule) -> DataFrame:
    """(lang, phrase, f) of every task: sorted runs of whole subtrees, to be merged.

    ``tables``: those of words and of twos, for sequences of up to three words, or that of threes, for four.
    """
    shared = texts.sparkSession.sparkContext.broadcast([t.table for t in tables])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = list(map(FrequentTable, shared.value))
        found_in = _short if len(tables) == 2 else _fours
        known, trie = Vocabulary(), HatTrie()

        def spilled(keep: int) -> Iterator[pa.RecordBatch]:
            languages, named = [], []
            for language, items in trie.spill(keep):
                named += sorted((b" ".join(known.words[w] for w in words), n) for words, n in items)
                languages += [language] * (len(named) - len(languages))
                if len(named) > 20_000:
                    yield _run(languages, named)
                    languages, named = [], []
            yield _run(languages, named)

        for batch in batches:
            for language, part in _by_language(batch):
                data = marked(part)
                found = data.split()
                # A word that is not frequent is in no sequence that counts, so it parts them and needs no number.
                kept = None
                if len(tables) == 2:
                    kept = tables[0].holds(sequence_hash(language, [word_hashes(words_of(data))]))
                for k in range(0, len(found), STEP):
                    numbers = known.numbers(found[k : k + STEP + LONGEST - 1], kept, k)
                    for sequences in found_in(numbers, language, known, *tables):
                        trie.add(language, sequences)
                    if len(known.words) > rule.vocabulary:
                        yield from spilled(0)
                        known = Vocabulary()
                    elif trie.size > rule.trie_entries:
                        trie.pack(rule.trie_entries // 2)
                        if trie.packed_size > rule.packed_entries:
                            yield from spilled(rule.trie_entries // 2)
        yield from spilled(0)

    return texts.mapInArrow(runs, "lang string, phrase string, f bigint")


def _run(languages: list[str], named: list[tuple[bytes, int]]) -> pa.RecordBatch:
    phrases = pa.array([p for p, _ in named], pa.binary()).cast(pa.string())
    columns = [pa.array(languages, pa.string()), phrases, pa.array([n for _, n in named], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f"])


def _parts(texts: list[str], chars: int = 1 << 20) -> Iterator[list[str]]:
    """Texts in groups of about so many characters."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size > chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def merged(runs: DataFrame) -> DataFrame:
    """Runs merged per range of (language, words): equal prefixes are neighbours, a hot one is split."""
    ranged = settle(runs).repartitionByRange("lang", "phrase").sortWithinPartitions("lang", "phrase")
    # A text among the aggregates makes Spark add up in sort order: one sequence in memory at a time.
    sums = ranged.groupBy("lang", "phrase").agg(F.min("phrase").alias("same"), F.sum("f").alias("f"))
    return sums.select("lang", F.col("same").alias("phrase"), "f")


def frequent_sequences(docs: DataFrame, rule: PhraseRule = PhraseRule()) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of all sequences of one to four words that are frequent, (lang, n))."""
    texts = docs.select(
        F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    counted = settle(hash_counts(texts, None, rule).groupBy("lang", "hash").agg(F.sum("f").alias("f")))
    totals = counted.where(F.col("lang").isNotNull() & (F.col("f") > 0)).select("lang", F.col("f").alias("n"))
    enough = F.col("f") >= rule.min_count
    words = frequent_table(counted.where(F.col("hash").isNotNull() & enough), rule)
    pairs = hash_counts(texts, words, rule).groupBy("hash").agg(F.sum("f").alias("f")).where(enough)
    table = frequent_table(settle(pairs.select("hash")), rule)
    size = F.size(F.split("phrase", " "))
    short = settle(merged(counted_runs(texts, (words, table), rule)).where(enough).withColumn("size", size))
    threes = frequent_table(settle(with_hash(short.where("size = 3"), 3)), rule)
    fours = settle(merged(counted_runs(texts, (threes,), rule)).where(enough).withColumn("size", size))
    return short.union(fours), totals


def _exact(number: Column) -> Column:
    return number.cast("decimal(20,0)")


def _scored(frequent: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: (lang, phrase, size, a, l, r, score)."""
    words = F.split("phrase", " ")
    side = lambda start, length: F.array_join(F.slice(words, start, length), " ")
    cuts = (
        frequent.where("size > 1")
        .select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
        .select("*", side(F.lit(1), F.col("k")).alias("first"), side(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    )
    part = lambda name, f: frequent.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    both = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return (
        both.groupBy("lang", "phrase", "size", "a")
        .agg(best)
        .select("lang", "phrase", "size", "a", "best.l", "best.r", "best.score")
    )


def _covered(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, around): the count of the most frequent longer candidate around a phrase."""
    words = F.split("phrase", " ")
    lengths = F.sequence(F.lit(2), F.col("size") - 1)
    places = F.flatten(
        F.transform(
            lengths,
            lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice(words, i, n), " ")),
        )
    )
    return (
        frequent.where("size > 2")
        .select("lang", F.explode(places).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("around"))
    )


def collocations(docs: DataFrame, rule: PhraseRule = PhraseRule()) -> DataFrame:
    """The best phrases of two to four words per language.

    (lang, rank, phrase, a, l, r, n, score): a phrase's occurrences, those of the two parts of its
    lowest-scoring cut (of equal ones the earliest), all words of the language, and the score
    floor(2000000 a / (l + r)), all exact. A null language is ``und``; null, empty and blank texts have no
    words, repeated rows count again, ties are ranked by count and then the phrase's bytes. No other
    column than text and lang is read. Empty input gives no rows.
    """
    frequent, totals = frequent_sequences(docs, rule)
    a, around = _exact(F.col("a")), _exact(F.coalesce("around", F.lit(0)))
    left = (
        _scored(frequent)
        .join(_covered(frequent), ["lang", "phrase"], "left")
        .where(around * 100 < a * rule.cover_percent)
    )
    best_first = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(rule.salts))
    # Ranked in parts first, so that a language never brings more rows to one task than parts times top.
    listed = left.withColumn("part", salt).withColumn(
        "nth", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best_first))
    )
    ranked = listed.where(F.col("nth") <= rule.top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best_first)).cast("bigint")
    )
    return (
        ranked.where(F.col("rank") <= rule.top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
