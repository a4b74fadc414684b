"""Phrase mining against plain Python."""

import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import corpus
from tracewright.llm import phrases
from tracewright.llm.hat_trie import HatTrie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NEW = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, rule):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            totals[lang or "und"] += len(w)
            for k in range(1, 5):
                counts[lang or "und"].update(zip(*(w[i:] for i in range(k))))
    found = []
    for lang, f in counts.items():
        wanted = {p: a for p, a in f.items() if len(p) > 1 and a >= rule.min_count}
        gone = set()
        for p, around in wanted.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * around >= rule.cover_percent * wanted[p[i : i + k]]:
                        gone.add(p[i : i + k])
        scored = []
        for p in wanted.keys() - gone:
            cuts = [(2000000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[: rule.top], 1):  # noqa: E741
            found.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(found)


def texts():
    rng = random.Random(2)
    common = ["in the end", "on the other hand", "as well as", "Straße nach Süden", "of the", "a b c d", "ÉTÉ été"]
    rows = []
    for k in range(150):
        words = []
        for _ in range(40):
            words.append(rng.choice(common) if rng.random() < 0.4 else rng.choice(corpus._EN))
            words.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "! ", "\xa0"]))
        rows.append((k, "".join(words), ("en", "de", None)[k % 3], "s", 0))
    return rows + corpus.rows() + corpus.odd_rows()


RULES = [
    phrases.PhraseRule(min_count=3),
    phrases.PhraseRule(min_count=2, top=25, salts=3, trie_entries=40, vocabulary=60, hashes=50),
    phrases.PhraseRule(min_count=4, most_bits=64, cover_percent=50),
]


@pytest.mark.parametrize("rule", RULES)
def test_against_brute_force(spark, rule):
    rows = texts()
    docs = corpus.table(spark, rows).withColumns({c: F.lit("mine") for c in ("phrase", "f", "n", "a", "word", "size")})
    found = phrases.collocations(docs, rule)
    assert found.columns == list(NEW)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, rule)


def test_long_texts_are_counted_across_steps(spark, monkeypatch):
    rows = [(1, "one two three four five " * 400, "en", "s", 0), (2, "x" * 100_000 + " y" * 3_000, "en", "s", 0)]
    rule = phrases.PhraseRule(min_count=5)
    assert sorted(map(tuple, phrases.collocations(corpus.table(spark, rows), rule).collect())) == brute(rows, rule)
    known = phrases.Vocabulary()
    words = phrases.marked([rows[0][1]]).split()
    monkeypatch.setattr(phrases, "STEP", 7)
    parts = [known.numbers(words[k : k + 10]) for k in range(0, len(words), 7)]
    tables = [[*phrases._short(p, "en", known, _All(), _All()), *phrases._fours(p, "en", known, _All())] for p in parts]
    assert [sum(len(t[k]) for t in tables) for k in range(4)] == [2000, 1999, 1998, 1997]


class _All:
    def holds(self, hashes):
        return np.ones(len(hashes), bool)


def test_no_rows_and_no_words(spark):
    none = corpus.table(spark, [])
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(corpus.table(spark, [(1, None, None, None, None), (2, "", "en", None, None)])).count() == 0


def test_a_hot_phrase_is_counted_once_per_task(spark):
    docs = corpus.table(spark, [(k, "again and again and", "en", "s", 0) for k in range(2000)]).repartition(8)
    texts = docs.select("lang", "text")
    counts = phrases.hash_counts(texts, None, phrases.PhraseRule())
    assert counts.count() <= 3 * 8
    words = phrases.frequent_table(counts.where("hash is not null").select("hash"), phrases.PhraseRule())
    pairs = phrases.hash_counts(texts, words, phrases.PhraseRule())
    assert sorted((r.hash, r.f) for r in pairs.groupBy("hash").sum("f").toDF("hash", "f").collect() if r.f)[0][1] in (2000, 4000)
    table = phrases.frequent_table(pairs.where("hash is not null").select("hash"), phrases.PhraseRule())
    runs = phrases.counted_runs(texts, (words, table), phrases.PhraseRule())
    assert runs.count() <= 6 * 8
    threes = phrases.frequent_table(phrases.with_hash(runs.where("size(split(phrase, ' ')) = 3"), 3), phrases.PhraseRule())
    assert {(r.phrase, r.f) for r in phrases.merged(phrases.counted_runs(texts, (threes,), phrases.PhraseRule())).collect()} == {
        ("again and again and", 2000)
    }
    top = {r.phrase: r for r in phrases.collocations(docs).collect()}
    assert top["again and again and"].a == 2000 and top["again and again and"].n == 8000


def test_hashes_are_the_same_wherever_a_word_stands():
    known = phrases.Vocabulary()
    text = "ein Wort, zwei  wort\tEin.é ein\n" * 5
    words = phrases.marked([text]).split()
    numbers = known.numbers(words)
    found = phrases.words_of(phrases.marked([text]))
    assert (known.hashes()[numbers] == phrases.word_hashes(found))[numbers > 0].all()
    assert len(set(known.hashes()[1:].tolist())) == len(known.words) - 1


def test_the_trie_counts_and_spills_whole_subtrees():
    rng = np.random.default_rng(1)
    trie, plain = HatTrie(burst=5), Counter()
    runs = []
    for _ in range(20):
        part = rng.integers(1, 9, (300, 4))
        part[rng.random(300) < 0.4, 3] = 0
        trie.add("g", part)
        plain.update(map(tuple, part.tolist()))
        runs += [[(w, n) for w, n in items] for _, items in trie.spill(60)]
        assert trie.size <= 60
    runs += [items for _, items in trie.spill(0)]
    assert trie.size == 0 and not trie.subtrees
    assert all(len({w[0] for w, _ in run}) == 1 for run in runs)
    total = Counter()
    for run in runs:
        for w, n in run:
            total[(*w, *[0] * (4 - len(w)))] += n
    assert total == plain


def test_runs_are_merged_in_sort_order_without_another_shuffle(spark):
    runs = spark.createDataFrame([("en", "a b", 1), ("en", "a b", 2)], "lang string, phrase string, f bigint")
    plan = phrases.merged(runs)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan


def test_the_query_reads_a_written_folder(spark, tmp_path):
    from tracewright.llm.queries import llm_queries

    rows = texts()
    corpus.table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = llm_queries()["op12_phrases"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == brute(rows, phrases.PhraseRule())


class _OneTask:
    """A table whose task runs here."""

    def __init__(self, batch):
        self.batch = batch
        self.sparkSession = self.sparkContext = self

    def broadcast(self, value):
        return SimpleNamespace(value=value)

    def mapInArrow(self, function, schema):
        return [row for part in function(iter([self.batch])) for row in part.to_pylist()]


def test_a_task_hands_a_sequence_on_once_though_its_trie_is_full_many_times(monkeypatch):
    monkeypatch.setattr(phrases, "STEP", 1000)
    words = [f"w{k}" for k in range(40)]
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(words, 60)) for _ in range(400)]
    task = _OneTask(pa.RecordBatch.from_arrays([pa.array(["en", "de"] * 200), pa.array(texts)], ["lang", "text"]))
    full = phrases.FrequentTable(np.full(64, -1, np.int64).view(np.uint64))
    plain = Counter()
    for k, text in enumerate(texts):
        w = text.split()
        plain.update((("en", "de")[k % 2], " ".join(w[i : i + n])) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    runs = phrases.counted_runs(task, (full, full), phrases.PhraseRule(trie_entries=500))
    assert len(runs) == len(plain) and {(r["lang"], r["phrase"]): r["f"] for r in runs} == plain
    few = phrases.counted_runs(task, (full, full), phrases.PhraseRule(trie_entries=500, packed_entries=2000))
    added = Counter()
    for r in few:
        added[r["lang"], r["phrase"]] += r["f"]
    assert added == plain and len(few) > len(plain)


def test_rare_words_fill_no_vocabulary(monkeypatch):
    rare = iter(range(10**6))
    texts = [" ".join(f"often now x{next(rare)}" for _ in range(50)) + " é." for _ in range(20)]
    task = _OneTask(pa.RecordBatch.from_arrays([pa.array(["en"] * 20), pa.array(texts)], ["lang", "text"]))
    hashes = [phrases.sequence_hash("en", [phrases.word_hashes(phrases.words_of(w))])[0] for w in (b"often", b"now", "é".encode())]
    table = np.zeros(1 << 14, np.uint64)
    for h in hashes:
        for place in (int(h), int(h) >> 32):
            table[place % (1 << 20) >> 6] |= np.uint64(1 << (place & 63))
    full = phrases.FrequentTable(np.full(64, -1, np.int64).view(np.uint64))
    runs = phrases.counted_runs(task, (phrases.FrequentTable(table), full), phrases.PhraseRule(vocabulary=10))
    assert sorted((r["phrase"], r["f"]) for r in runs) == [("now", 1000), ("often", 1000), ("often now", 1000), ("é", 20)]
