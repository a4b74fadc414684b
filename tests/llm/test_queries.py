"""The registered queries on a written folder, with all columns they return, against plain Python."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import corpus
from tests.llm.test_operators import ITEM_WORD, LOWER, base_spans, sha, without_passages
from tracewright.llm.queries import llm_queries

DATA = [r for r in corpus.rows() + corpus.odd_rows() if r[0] is not None and r[0] not in (104, 105, 107)]
TEXTS = {r[0]: r[1] or "" for r in DATA}
ITEMS = [(1, corpus.PASSAGE.upper()), (12, TEXTS[9][:400]), (5, "x"), (2, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    corpus.table(spark, DATA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def rows(spark, folder, name):
    found = {r.doc_id: tuple(r)[1:] for r in llm_queries()[name](spark, folder).collect()}
    assert found.keys() == TEXTS.keys()
    return found


def library(file):
    found = Tokenizer.from_file(public_tokenizers.path(file))
    found.no_truncation()
    found.no_padding()
    return found


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_op2(spark, folder):
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for d, t in TEXTS.items():
        for line in t.split("\n"):
            holders[key(line)].add(d)
    gone = lambda d, line: len(key(line)) >= 20 and len(holders[key(line)]) >= 3 and max(holders[key(line)]) != d
    expected = {}
    for d, t in TEXTS.items():
        kept = [x for x in t.split("\n") if not gone(d, x)]
        expected[d] = (t.count("\n") + 1, t.count("\n") + 1 - len(kept), sha("\n".join(kept)))
    assert rows(spark, folder, "op2_line_dedup") == expected
    assert any(e[1] for e in expected.values())


def test_op3(spark, folder):
    encode, at, expected = library("byte_bpe_50k.json"), 0, {}
    for d in sorted(TEXTS):
        ids = encode.encode(TEXTS[d], add_special_tokens=False).ids + [2]
        expected[d] = (at, len(ids), zlib.crc32(packed(ids)))
        at += len(ids)
    assert rows(spark, folder, "op3_token_files") == expected


def test_op5(spark, folder):
    kinds = ("email", "ip", "card", "phone")
    for d, (*counts, digest, spans) in rows(spark, folder, "op5_pii").items():
        base = [f"{kinds[k]}:{a}:{b}" for k, a, b in base_spans(TEXTS[d])]
        assert counts == [sum(s.startswith(k) for s in base) for k in kinds]
        assert digest == sha(",".join(base)) and set(base) <= set(filter(None, spans.split(",")))


def test_op6(spark, folder):
    windows = defaultdict(set)
    for item, text in ITEMS:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(str(item))
    expected = {}
    for d, t in TEXTS.items():
        w = ITEM_WORD.findall(t.translate(LOWER))
        at = [(k, g) for g in windows for k in range(len(w) - len(g) + 1) if tuple(w[k : k + len(g)]) == g]
        hit = {k + j for k, g in at for j in range(len(g))}
        items = sorted({i for _, g in at for i in windows[g]})
        expected[d] = (len(w), len(hit), len(items), sha(",".join(items)), bool(hit) and 20 * len(hit) >= len(w))
    assert rows(spark, folder, "op6_decontamination") == expected


def test_op8(spark, folder):
    bpe, expected = library("word_bpe_49k.json"), {}
    for d, t in TEXTS.items():
        ids = bpe.encode(t, add_special_tokens=False).ids
        decoded = bpe.decode(ids, skip_special_tokens=False)
        expected[d] = (len(ids), hashlib.sha256(packed(ids)).hexdigest(), sha(decoded))
    assert rows(spark, folder, "op8_bpe_automaton") == expected


def test_op9(spark, folder):
    sets = {}
    for d, t in TEXTS.items():
        w = re.findall("[^\x20\x09-\x0d]+", t.translate(LOWER))
        sets[d] = {tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} if w else set()
    group = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    assert rows(spark, folder, "op9_near_dedup") == {d: (len(s), group[d], group[d] == d) for d, s in sets.items()}


def test_op10(spark, folder):
    expected = {d: (n, lost, sha(kept)) for d, n, lost, kept in without_passages(list(TEXTS.items()))}
    assert rows(spark, folder, "op10_substring_dedup") == expected
    assert any(e[1] for e in expected.values())
