"""What Python workers hold from task to task, and how much is handed to them at once."""

import gc
import weakref

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracewright.llm import bpe_automaton, language_id, near_dedup, token_files
from tracewright.llm.text import drop_worker_table, worker_table


def test_a_worker_keeps_one_table_until_other_work_drops_it():
    drop_worker_table()
    first = worker_table(("a", "x"), lambda: ["x"])
    assert worker_table(("a", "x"), lambda: ["new"]) is first
    assert worker_table(("a", "y"), lambda: ["y"]) == ["y"]
    assert worker_table(("a", "x"), lambda: ["again"]) == ["again"]
    drop_worker_table()
    assert worker_table(("a", "x"), lambda: ["last"]) == ["last"]
    drop_worker_table()


def test_near_dedup_hands_small_batches_to_python_and_restores_the_limit(spark, monkeypatch):
    limit, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(limit)
    signatures = near_dedup.signatures
    monkeypatch.setattr(near_dedup, "signatures", lambda *a: seen.append(int(spark.conf.get(limit))) or signatures(*a))
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "h i j k l m n"), (None, "a b c d e f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.component_id) for r in near_dedup.near_groups(docs).collect()}
    assert found == {(1, 1), (2, 1), (3, 3), (None, None)}
    assert seen == [near_dedup.BATCH_ROWS] and spark.conf.get(limit) == before
    with near_dedup.small_batches(spark, 10), near_dedup.small_batches(spark):
        assert spark.conf.get(limit) == "10"


def test_a_dropped_table_is_freed_at_once_though_its_parts_know_each_other():
    class Table:
        def __init__(self):
            self.function = self.__init__

    gc.disable()
    try:
        for drop in (drop_worker_table, lambda: worker_table(("b",), list)):
            held = weakref.ref(worker_table(("a",), Table))
            assert held() is not None
            drop()
            assert held() is None
    finally:
        gc.enable()
        drop_worker_table()


def test_language_identification_drops_the_table_of_another_stage(spark, monkeypatch):
    rows = [(1, "ein Wort", "de"), (2, "one word", "en"), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, made, udf = language_id.fit(docs), [], F.pandas_udf
    monkeypatch.setattr(F, "pandas_udf", lambda kind: lambda f: made.append(f) or udf(kind)(f))
    found = language_id.identify(docs, model).select("doc_id", "lang_pred")
    assert sorted(map(tuple, found.collect())) == [(1, "de"), (2, "en"), (3, "und")]
    drop_worker_table()
    worker_table(("a",), lambda: "old")
    assert list(made[0](iter([]))) == []
    assert worker_table(("a",), lambda: "new") == "new"
    drop_worker_table()


def test_a_word_is_remembered_once_whatever_stands_beside_it():
    file = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(file)
    table = bpe_automaton.WordTokenizer(file)
    texts = [f"{a}{w}{b}" for w in ("Überfahrt", "tide", "TIDE", "don't") for a in ("", "(", '"') for b in ("", ",", "..", "!)", "7")]
    texts += ["a\x1cb\x85c\u2003d\xa0e ΑΣ ΣΑΣ e\u0301 \u0301x", "x<|endoftext|>y <| z<|ENDOFTEXT|>", "<|startoftext|>", " \n", "ab" * 500, "1234.5"]
    for text in [" ".join(texts), *texts]:
        ids, decoded = table.encode(text)
        expected = library.encode(text, add_special_tokens=False).ids
        assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == expected, text
        assert decoded == library.decode(expected, skip_special_tokens=False)
    remembered = sum(len(x) for x in vars(table).values() if isinstance(x, bpe_automaton.Memory))
    assert remembered <= 45


def test_a_chunk_of_many_texts_is_looked_up_once_a_group():
    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    file = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(file)
    encoder = token_files.ChunkEncoder(file)
    encoder.known = Counted()
    odd = ["", " ", "\n", "one", " one", "one  two", "a\n\nb c", "a \n\n b", "<|endoftext|> x", "x <|y", "Ü, é.\nz\n", "one two"]
    texts = ["one two, three.\nfour one two" * 3] * 200 + odd
    found = encoder.encode(texts, b"\2\0\0\0")
    expected = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert [[int.from_bytes(x[k : k + 4], "little") for k in range(0, len(x), 4)] for x in found] == expected
    assert encoder.encode([], b"") == [] and encoder.encode(["one"], b"") == [found[odd.index("one") + 200][:-4]]
    assert Counted.asked < 200
