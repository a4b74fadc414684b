import random

import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import corpus
from tracewright.llm import language_id
from tracewright.llm.text import bucket_of


def test_first_stage_rejects_by_score_and_keeps_clean_documents(spark):
    rng = random.Random(3)
    clean = [(k, corpus.prose(rng, lang := "en de fr es".split()[k % 4], 40), lang, "s", k) for k in range(400)]
    foreign = [(1000 + k, "中文字符測試" * 20 + "日本語" * k, None, "s", 0) for k in range(10)]
    no_letter = [(2000, "123 %%%", "en", "s", 7), (2001, None, "en", "s", None)]
    docs = corpus.table(spark, clean + foreign + no_letter).withColumns({c: F.lit("mine") for c in ("score", "lang_pred")})
    rows = corpus_pipeline.identify_language(spark, docs, "").collect()
    assert {r.doc_id for r in rows} == set(range(400))
    assert {(r.score, r.lang_pred) for r in rows} == {("mine", "mine")}
    held_out = bucket_of(F.col("doc_id")) == 0
    model = language_id.fit(docs.where(~held_out))
    assert language_id.least_score(docs.where(held_out), model) > 0
    assert language_id.least_score(docs.where("doc_id < 40"), model) == 0


def test_least_score_is_that_of_all_known_documents(spark):
    rng = random.Random(4)
    prose = [(k, corpus.prose(rng, lang := "en de fr es".split()[k % 4], 5 + k % 30), lang, "s", k) for k in range(400)]
    docs = corpus.table(spark, prose + [(900, "...", "en", "s", 3), (901, None, "und", "s", 3), (902, "!", "und", "s", 1)])
    rule = language_id.LanguageRule(per_language=20)
    model = language_id.fit(docs.where("doc_id % 2 = 0"), rule)
    found = language_id.identify(docs.where("doc_id < 400"), model).where("lang_pred = lang")
    assert found.count() > 4 * rule.per_language
    lowest = found.agg(F.min("score")).first()[0]
    assert language_id.least_score(docs, model, rule) == rule.slack * lowest > 0


def test_first_stage_keeps_an_unlabelled_corpus(spark):
    docs = corpus.table(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, docs, "")
    lettered = [t for _, t, *_ in corpus.rows() + corpus.odd_rows() if t and any(c.isalpha() for c in t)]
    assert sorted(r.text for r in kept.collect()) == sorted(lettered)
    assert corpus_pipeline.identify_language(spark, docs.limit(0), "").count() == 0


def test_all_stages_on_a_written_folder(spark, tmp_path):
    rng = random.Random(8)
    flat = lambda n: " ".join(corpus.prose(rng, "en", n).split())
    item = " ".join(f"passage{k}" for k in range(20))
    line = "this line stands in three documents"
    alone = {k: flat(80) for k in range(12)}
    clean = {k: f"{t}\n{line}" if k < 3 else t for k, t in alone.items()}
    data = [(k, t, None, "s", len(t)) for k, t in clean.items()]
    data += [(50, clean[3] + " more", None, "s", 0), (51, f"{flat(40)} {item}", None, "s", 0)]
    data += [(52, "12 34", None, "s", 5), (53, None, None, None, None)]
    docs = corpus.table(spark, data).withColumn("topic", F.concat(F.lit("t"), F.col("doc_id")))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    for name, table in (("all", docs), ("none", docs.limit(0))):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        items.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    deduped = clean | {k: alone[k] for k in (0, 1)}
    expected = {k: tokenizer.encode(t, add_special_tokens=False).ids for k, t in deduped.items()}
    rows = corpus_pipeline.run(spark, f"{tmp_path}/all").collect()
    assert len(rows) == 12
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == expected
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    left, lost = docs, [{52, 53}, set(), {50}, {51}]
    for (name, stage), gone in zip(corpus_pipeline.STAGES, lost):
        after = {r.doc_id: tuple(r) for r in left.collect() if r.doc_id not in gone}
        if name == "line_dedup":
            after |= {k: (k, alone[k], None, "s", len(alone[k]), f"t{k}") for k in (0, 1)}
        left = stage(spark, left, f"{tmp_path}/all")
        assert left.columns == docs.columns
        assert {r.doc_id: tuple(r) for r in left.collect()} == after
