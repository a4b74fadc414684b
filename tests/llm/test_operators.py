"""Each operator against a brute-force version, with odd rows, clashing columns and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import corpus
from tracewright.llm import (
    bpe_automaton,
    decontamination,
    language_id,
    lattice_lm,
    line_dedup,
    near_dedup,
    pii,
    quality_rules,
    substring_dedup,
    token_files,
)
from tracewright.llm.queries import llm_queries

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DATA = corpus.rows() + corpus.odd_rows()
CLASHES = (
    "keep", "hash", "word", "words", "pos", "line", "key", "digest", "starts", "rank", "n", "x", "row", "given", "of",
    "of_row", "found", "maybe", "repeated", "anchor", "at", "encoded", "s", "rep", "row_number", "w", "l",
    "_id", "_w", "_l", "_keep", "_kept", "_maybe", "_v", "_starts", "_row", "_m", "_n_words", "_encoded", "_part",
)


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """The corpus with extra columns that are named like inner and new ones, on disk."""
    path = str(tmp_path_factory.mktemp("docs"))
    new = ("kept_text", "n_words", "spans", "base", "score", "lang_pred", "n_tokens", "quality", "kept", "start")
    wide = corpus.table(spark).withColumns({c: F.lit("mine") for c in CLASHES + new})
    wide.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return corpus.table(spark, [])


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def results(df, *columns):
    """Rows as a bag of tuples."""
    return Counter(tuple(r) for r in df.select(*columns).collect())


def untouched(df):
    assert {c: df.first()[c] for c in CLASHES} == dict.fromkeys(CLASHES, "mine")


def test_languages(docs, none):
    labelled = docs.where("lang <> 'xx'")
    model = language_id.fit(labelled)
    found = language_id.identify(docs, model)
    untouched(found)
    rows = found.collect()
    assert len(rows) == len(DATA)
    for r in rows:
        lettered = re.search(r"[^\W\d_]", r.text or "")
        assert (r.lang_pred == "und") == (lettered is None) and 0 <= r.score <= 1
    prose = [r for r in rows if r.doc_id is not None and r.doc_id < 60 and r.doc_id != 31]
    assert sum(r.lang_pred == r.lang for r in prose) >= 0.95 * len(prose)
    assert set(model.families) == {"germanic", "romance"} and ("es", "fr") in model.machines
    nothing = language_id.fit(none)
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(none, nothing).count() == 0


def test_lines(docs, none):
    keys, holders = [], defaultdict(set)
    for doc_id, text, *_ in DATA:
        lines = (text or "").split("\n")
        keys.append([x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in lines])
        for key in keys[-1]:
            holders[key].add(-1 if doc_id is None else doc_id)
    expected = Counter()
    for (doc_id, text, *_), row in zip(DATA, keys):
        me = -1 if doc_id is None else doc_id
        stays = [not (len(k) >= 20 and len(holders[k]) >= 3 and max(holders[k]) != me) for k in row]
        kept = "\n".join(x for x, s in zip((text or "").split("\n"), stays) if s)
        expected[doc_id, len(row), stays.count(False), kept] += 1
    for rule in (line_dedup.LineRule(), line_dedup.LineRule(hot_rows=2, sample_one_in=1)):
        found = line_dedup.dedup_lines(docs, rule)
        untouched(found)
        assert results(found, "doc_id", "n_lines", "n_dropped", "kept_text") == expected
    assert line_dedup.dedup_lines(none).count() == 0
    bitmaps = line_dedup.keep_bitmaps(docs).collect()
    assert bitmaps and all("text" not in r for r in bitmaps)


def test_a_line_count_beyond_one_bitmap_word(spark):
    many = "\n".join(f"this is the repeated line {k}" for k in range(200))
    small = spark.createDataFrame([(1, many), (2, many), (3, many)], "doc_id long, text string")
    assert results(line_dedup.dedup_lines(small), "doc_id", "n_dropped") == Counter([(1, 200), (2, 200), (3, 0)])


def test_token_files(spark, docs, none, tmp_path):
    file = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(docs, str(tmp_path / "t"), file)
    read = token_files.with_starts(token_files.read_tokens(spark, str(tmp_path / "t")))
    rows = read.withColumn("crc", token_files.ids_crc32(F.col("ids"))).orderBy("start").collect()
    library = Tokenizer.from_file(file)
    whole = Counter(
        (d, tuple(library.encode(t or "", add_special_tokens=False).ids) + (2,)) for d, t, *_ in DATA
    )
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == whole
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.crc == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda d: -1 if d is None else d)
    token_files.write_tokens(none, str(tmp_path / "e"), file)
    assert token_files.with_starts(token_files.read_tokens(spark, str(tmp_path / "e"))).count() == 0


def test_a_look_up_reads_few_rows_of_the_token_files(spark, tmp_path):
    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    token_files.write_tokens(docs.coalesce(1), str(tmp_path / "t"), public_tokenizers.path("byte_bpe_50k.json"))
    found = token_files.read_tokens(spark, str(tmp_path / "t")).where("doc_id = 4321")
    assert [r.doc_id for r in found.collect()] == [4321]
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert 0 < scan.metrics().apply("numOutputRows").value() <= 1_000


def test_quality_rules(docs, none):
    expected = Counter()
    for doc_id, text, *_ in DATA:
        text = text or ""
        w = WORD.findall(text)
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i in range(len(w) - 2) if grams[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        base = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        symbols = len(re.findall("[#*$%&|<>]", text))
        expected[doc_id, len(w), sum(map(len, w)), symbols, dup, len(covered), base] += 1
    found = quality_rules.judged(docs)
    untouched(found)
    counts = [F.col("quality")[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    assert results(found, "doc_id", *counts, "base_failed") == expected
    kept = {r.doc_id: r.kept for r in found.collect()}
    assert kept[31] is False and kept[100] is False and all(kept[k] for k in range(10, 20))
    assert quality_rules.judged(none).count() == 0


_KINDS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def base_spans(text):
    def ok(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == 1:
            return all(int(p) <= 255 for p in found.split("."))
        if kind == 2:
            doubled = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
            return 12 <= len(digits) <= 19 and doubled % 10 == 0
        return kind != 3 or 9 <= len(digits) <= 15

    found = [(m.start(), k, m.end()) for k, p in enumerate(_KINDS) for m in p.finditer(text) if ok(k, m[0])]
    return [(k, a, b) for a, k, b in sorted(found)]


PRIVATE = [
    (i, t)
    for i, t in enumerate(
        [
            "x@y.z%q@r.st a@b@c.d.e @no.at x@y .a@b-c.d", "1.2.3.4.5 256.1.1.1 0001.2.3.255 1.2.3", "++1 234 567 890 x +12(34)5-6.789 1",
            "4111-1111-1111-1111 4111  1111 1111 1111 4111 1111 1111 1112", "é😀 a@b.coé +49 30 1234567", "1 " * 5_000, "9" * 20_000,
            "+1 " + "(" * 20_000, "a." * 20_000, ".1" * 20_000, None, "",
        ]
    )
]


def test_personal_data(spark, docs, none):
    texts = spark.createDataFrame(PRIVATE, "doc_id long, text string")
    for df, data in ((docs, DATA), (texts, PRIVATE)):
        found = pii.find(df, pii.SpanSelector((), (None,) * 4))
        expected = Counter((d, str(base_spans(t or ""))) for d, t, *_ in data)
        got = Counter((r.doc_id, str([tuple(s) for s in r.base])) for r in found.collect())
        assert got == expected
    untouched(pii.find(docs, pii.fit(none)))
    assert pii.find(none, pii.fit(none)).count() == 0


def test_selected_spans_add_to_the_base(spark):
    data = [(k, f"call +1 640 555 {1000 + k} or pay 4111 1111 1111 {1000 + k}, order {k}{k + 17}-{k} tel 640 555 {1000 + k}") for k in range(200)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    selector = pii.fit(df)
    assert selector.trees
    rows = pii.find(df, selector).collect()
    for r in rows:
        assert [tuple(s) for s in r.base] == base_spans(r.text)
        assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans}
    text = pii.find(df, selector).select(pii.redacted(F.col("text"), F.col("spans"))).first()[0]
    assert "[phone]" in text and "+1 640" not in text


def test_every_candidate_counts_for_the_trees(spark):
    texts = "concat('call +1 640 555 ', cast(1000 + id % 9000 as string), ' or 640 555 ', cast(1000 + id % 9000 as string))"
    df = spark.range(22_000).selectExpr("id as doc_id", f"{texts} as text")
    counted = pii.counted_candidates(df).collect()
    assert sum(r.n for r in counted) >= 44_000 and len(counted) < 100


EXTRA = [("email", "{w}.{k} [at] mail{d} [dot] org"), ("phone", "({a}) 555-{n}"), ("ip", "10[.]{d}[.]0[.]{d}")]
DECOYS = ["order 4111.1111.1111.1112", "at 2021-03-04 the 10", "id 123456789012", "v [at] home", "300[.]1[.]2[.]9"]


@pytest.mark.parametrize("n_extra", [20, 600])
def test_personal_data_in_other_spellings_is_added(spark, n_extra):
    data, wanted = [], {}
    for k in range(400 + n_extra):
        known = f"river {k % 90} stone +1 ({200 + k % 700}) 555-{1000 + k} or 10.{k % 9}.0.{k % 9} house w.{k}@mail{k % 9}.org"
        if k < 400:
            data.append((k, f"{known} {DECOYS[k % 5]} end"))
            continue
        kind, form = EXTRA[k % 3]
        spelled = form.format(w="w", k=k, d=k % 9, a=200 + k % 700, n=1000 + k)
        wanted[k] = (pii.KINDS.index(kind), 6, 6 + len(spelled))
        data.append((k, f"stone {spelled} house"))
    df = spark.createDataFrame(data, "doc_id long, text string")
    for r in pii.find(df, pii.fit(df)).collect():
        expected = base_spans(r.text) + ([wanted[r.doc_id]] if r.doc_id in wanted else [])
        assert [tuple(s) for s in r.spans] == sorted(expected, key=lambda s: (s[1], s[0], s[2])), r.text


ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def test_contamination(spark, docs, none):
    items = [(1, corpus.PASSAGE.upper()), (2, "short item only"), (3, None), (4, "..."), (5, "x"), (5, "x"), (12, DATA[9][1][:400])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(item)
    expected = Counter()
    for doc_id, text, *_ in DATA:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, held = set(), set()
        for g, of in windows.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    held |= of
        bad = len(hit) > 0 and 20 * len(hit) >= len(w)
        expected[doc_id, len(w), len(hit), ",".join(sorted(map(str, held))), bad] += 1
    found = decontamination.matches(docs, bench)
    untouched(found)
    assert results(found, "doc_id", "n_words", "n_hit", F.array_join("item_ids", ","), "contaminated") == expected
    assert any(c[4] for c in expected)
    assert decontamination.matches(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.matches(none, bench).count() == 0


def test_language_model(docs, none):
    file = public_tokenizers.path("piece_bpe_32k.model")
    tokens = [(d, (t or "").encode().lower().split()) for d, t, *_ in DATA]
    bucket = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5
    counts, ends = Counter(), 0
    for d, w in tokens:
        if bucket(d) != 1:
            counts.update(w)
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    score = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    expected = sorted(
        (str(d), bucket(d) == 1, len(w) + 1, sum(counts[x] > 0 for x in w) + 1, n, round(sum(score(counts[x]) for x in w) + score(ends), 4))
        for d, w in tokens
    )
    by_head = []
    for head in (100_000, 3):
        rows = lattice_lm.scores(docs, file, head).collect()
        got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows]
        assert sorted(got) == expected
        assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
        by_head.append(sorted((str(r.doc_id), round(r.score, 4)) for r in rows))
    assert by_head[0] == by_head[1]
    assert lattice_lm.scores(none, file).count() == 0


def test_the_lattice_sums_all_segmentations():
    pieces = {"▁": 0.1, "a": 0.2, "b": 0.1, "▁a": 0.05, "ab": 0.3, "▁ab": 0.02}
    lattice = lattice_lm.Lattice({k: math.log10(p) for k, p in pieces.items()}, (math.log10(0.01),) * 256, -1.0, 3)

    def every(text):
        if not text:
            return 1.0
        total = sum(p * every(text[len(k) :]) for k, p in pieces.items() if text.startswith(k))
        return total + (0 if text[0] in pieces else 0.01 ** len(text[0].encode()) * every(text[1:]))

    for word in ("ab", "abab", "aé", "b"):
        assert math.isclose(lattice.word(word), math.log10(every("▁" + word)))


def test_bpe(docs, none):
    file = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(file)
    library.no_truncation()
    library.no_padding()
    expected = Counter()
    for d, t, *_ in DATA:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected[d, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)] += 1
    found = bpe_automaton.encode(docs, file, keep_decoded=True)
    untouched(found)
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in found.collect()) == expected
    assert bpe_automaton.encode(none, file).count() == 0


def test_left_to_right_merges_in_the_automaton():
    vocabulary = {"a": 0, "b": 1, "aa": 2, "ab": 3, "aaa": 4, "bab": 5}
    automaton = bpe_automaton.Automaton(vocabulary, [("a", "a"), ("a", "b"), ("aa", "a"), ("b", "ab")])

    def merged(symbols):
        order = [("a", "a"), ("a", "b"), ("aa", "a"), ("b", "ab")]
        for a, b in order:
            out = []
            for s in symbols:
                if out and out[-1] == a and s == b:
                    out[-1] = a + b
                else:
                    out.append(s)
            symbols = out
        return [vocabulary[s] for s in symbols]

    for k in range(2, 9):
        for n in range(2**k):
            word = [("a", "b")[n >> i & 1] for i in range(k)]
            assert automaton.path(word) == merged(word), word


def test_near_duplicates(docs, none):
    for rule in (near_dedup.NearRule(3, 85), near_dedup.NearRule()):
        size = rule.shingle_words
        sets = {}
        for d, t, *_ in DATA:
            w = (t or "").encode().lower().split()
            sets[d] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
        ids = sorted(d for d in sets if d is not None)
        group = {d: d for d in ids}
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= rule.percent * len(sets[a] | sets[b]):
                    low, high = sorted((group[a], group[b]))
                    group = {d: low if g == high else g for d, g in group.items()}
        found = near_dedup.near_groups(docs, rule).collect()
        assert len(found) == len(DATA)
        assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == group
        assert all(r.n_shingles == len(sets[r.doc_id]) for r in found if r.doc_id is not None)
        kept = near_dedup.one_of_each(docs, rule)
        untouched(kept)
        assert {r.doc_id for r in kept.collect()} == {d for d, g in group.items() if d == g} | {None}
    assert near_dedup.near_groups(none).count() == 0


def test_a_chain_of_links_is_one_group(spark):
    from tracewright.llm.components import components

    links = [(k, k + 1) for k in range(40)] + [(100, 200), (200, 100), (7, 7)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(k, 0) for k in range(41)} | {(100, 100), (200, 100)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


PASSAGE_RULES = [
    substring_dedup.PassageRule(),
    substring_dedup.PassageRule(filter_anchors=0, shard_segments=1, broadcast_bytes=0),
    substring_dedup.PassageRule(shard_segments=3, anchor_words=(2, 7, 13)),
    substring_dedup.PassageRule(shard_segments=2, anchor_words=(1, 2)),
]


def without_passages(rows):
    """(doc_id, words, removed, kept) of every row; rows of one document take nothing from each other."""
    first, found = {}, Counter()
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode().split()
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), d)
    for d, t in rows:
        w = (t or "").encode().split()
        stays = [True] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < d:
                stays[k : k + 13] = [False] * 13
        found[d, len(w), stays.count(False), b" ".join(x for x, s in zip(w, stays) if s).decode()] += 1
    return found


@pytest.mark.parametrize("rule", PASSAGE_RULES[:2])
def test_passages(docs, none, rule):
    expected = without_passages([r[:2] for r in DATA if r[0] is not None])
    found = substring_dedup.dedup_passages(docs, rule)
    untouched(found)
    held = found.where("doc_id is not null")
    assert results(held, "doc_id", "n_words", "n_removed", "kept_text") == expected
    assert found.where("doc_id is null and n_removed = 0").count() == 2
    assert substring_dedup.dedup_passages(none, rule).count() == 0


@pytest.mark.parametrize("rule", PASSAGE_RULES[1:])
def test_passages_in_several_texts_of_a_document_and_hot_anchors(spark, rule):
    rng = random.Random(7)
    long, other = " ".join(f"p{k}" for k in range(40)), " ".join(f"q{k}" for k in range(20))
    rows = [(1, long), (5, " ".join(f"w{k}" for k in range(60)) + "\t" + long), (5, "three words only"), (5, long), (6, other), (6, other)]
    rows += [(7, f"{long}  x {long}"), (8, other + "\n" + other), (9, None)]
    # One pair of words in all windows: its anchor is in every document, with other words around it.
    rows += [(20 + k, " ".join(rng.choice(["aa bb", "cc", "dd", f"e{k % 3}"]) for _ in range(80))) for k in range(25)]
    rows += [(60 + k, rows[12 + k][1]) for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring_dedup.dedup_passages(df, rule)
    assert results(found, "doc_id", "n_words", "n_removed", "kept_text") == without_passages(rows)
    texts = df.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), "text").where("doc_id in (1, 5, 6, 7)")
    spans = {(r.doc_id, len(r.spans)): [tuple(x) for x in r.spans] for r in substring_dedup.repeated_spans(texts, rule).collect()}
    assert spans[5, 1] in ([(60, 88)], [(0, 28)]) and spans[7, 2] == [(0, 28), (41, 69)]


def test_an_anchor_that_is_too_full_is_cut_by_wider_ones(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice("abc") for _ in range(13))
    pieces = [(hashlib.md5(t.encode()).digest(), k, 7, t) for k, t in enumerate({text() for _ in range(300)})]
    classes = spark.createDataFrame(pieces, "digest binary, doc_id long, anchor long, text string")
    rule = substring_dedup.PassageRule(shard_segments=20)
    found = {bytes(r.digest): r["first"] for r in substring_dedup.holders(classes, rule).collect()}
    assert found == {d: [k] for d, k, _, _ in pieces}


def test_the_bitmap_of_anchors_holds_all_of_them(spark):
    anchors = spark.range(10_000).select((F.col("id") * 7919 * 104729 - 5).alias("anchor"))
    bitmap = substring_dedup.anchor_bitmap(anchors, 10_000)
    assert len(bitmap) * 64 == 1 << 18
    known = np.array([r.anchor for r in anchors.collect()])
    slot = known & (len(bitmap) * 64 - 1)
    assert ((bitmap[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)).all()


def test_fm_index_finds_every_pattern_and_its_least_holder():
    from tracewright.llm.fm_index import FMIndex

    rng = np.random.default_rng(3)
    text = rng.integers(1, 5, 400)
    holders = rng.integers(0, 90, 400)
    index = FMIndex(text, 4, holders)
    patterns = np.lib.stride_tricks.sliding_window_view(text, 4)
    matched, low, high = index.search(patterns)
    least = index.least_holder(low, high)
    for p, m, a, b, h in zip(patterns, matched, low, high, least):
        places = [k for k in range(len(text) - m + 1) if (text[k : k + m] == p[4 - m :]).all()]
        assert b - a == len(places) and (m == 0 or h == min(holders[k] for k in places))
        assert m == 4 or sum((patterns[:, 4 - m - 1 :][:, : m + 1] == p[4 - m - 1 :]).all(axis=1)) <= 1


def test_words_of_a_batch_are_those_of_each_text():
    import pyarrow as pa

    from tracewright.llm import word_windows as ww

    texts = ["a b  c\t" * 9, None, "", " x", "y" * 5 + " é\n" * 20, "a b c " * 9 + "z", "\x1c \x0b\x0c", "a b c"]
    array = pa.concat_arrays([pa.array(["skipped", *texts[:3]])[1:], pa.array(texts[3:])])
    flat = [(k, w) for k, t in enumerate(texts) for w in (t or "").encode().split()]
    seen = []
    for row, part in ww.parts(array):
        found = ww.words(part)
        seen += [(row + k, found.data[a:b].tobytes(), h) for k, a, b, h in zip(found.text, found.starts, found.ends, ww.word_hashes(found).tolist())]
        for first, n, _ in zip(*ww.anchored_runs(found, ww.word_hashes(found), 13, 6)):
            assert len(set(found.text[first : first + n + 12].tolist())) == 1
            assert len(found.joined(first, first + n + 12).split(b" ")) == n + 12
    assert [s[:2] for s in seen] == flat
    assert len({(w, h) for _, w, h in seen}) == len({w for _, w, _ in seen}) == len({h for _, _, h in seen})


def test_lines_in_several_texts_of_a_document(spark):
    line, own = "the line that many documents hold", "a line that one row holds alone"
    rows = [(1, line), (2, line), (3, line), (2, own), (2, f"{own}\n{line}"), (None, line), (None, own)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = lambda d, t: "\n".join(x for x in t.split("\n") if x != line or d == 3)
    dropped = Counter((d, t.count("\n") + 1, t.count(line) if d != 3 else 0, kept(d, t)) for d, t in rows)
    for rule in (line_dedup.LineRule(), line_dedup.LineRule(hot_rows=2, sample_one_in=1)):
        found = line_dedup.dedup_lines(df, rule)
        assert results(found, "doc_id", "n_lines", "n_dropped", "kept_text") == dropped


def test_near_duplicates_in_several_texts_of_a_document(spark):
    rng = random.Random(4)
    x, y, z = (corpus.prose(rng, "en", 80) for _ in range(3))
    rows = [(1, y), (1, x), (3, y + " more"), (4, x), (5, z), (6, z + " and"), (6, x + " so"), (7, "alone"), (7, None), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r.doc_id, r.component_id) for r in near_dedup.near_groups(df).collect())
    assert found == Counter([(1, 1)] * 2 + [(3, 1), (4, 1), (5, 1), (6, 1), (6, 1), (7, 7), (7, 7), (8, 8)])
    assert {r.doc_id for r in near_dedup.one_of_each(df).collect()} == {1, 7, 8}


def test_every_operator_has_one_query():
    assert [n.split("_")[0] for n in sorted(llm_queries(), key=lambda n: int(n[2:].split("_")[0]))] == [f"op{k}" for k in range(1, 14)]
