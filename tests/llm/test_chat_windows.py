"""Chat windows against plain Python, and their invariants."""

import hashlib
import random
from itertools import groupby

import public_tokenizers
import pytest
import xxhash
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import corpus
from tracewright.llm import chat_windows as cw

FILE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, n_tokens string, block string, seq string, start string"
SMALL = cw.WindowRule(budget=60, history=20, block_windows=2)


def conversations():
    rng = random.Random(11)
    rows = []
    for k in range(30):
        roles = ["system"] * (k % 3 == 0) + ["user", "assistant"] * (1 + k % 5)
        rows += [(k, t, role, corpus.prose(rng, "en", 1 + rng.randrange(30))) for t, role in enumerate(roles)]
    long = [(50, t, ("system", "user", "assistant")[t and 1 + t % 2], corpus.prose(rng, "de", 1 + t % 9)) for t in range(900)]
    huge = [(51, 0, "user", "hi"), (51, 1, "assistant", "word " * 30_000), (51, 2, "user", "a" * 50_000), (51, 3, "assistant", "end")]
    odd = [
        (60, 0, "user", None), (60, 1, "assistant", None), (60, 2, None, "no role"), (60, 3, "tool", "[TEXT]\\x[/ROLE]"),
        (60, 4, "assistant", ""), (60, None, "user", "no turn"), (61, 0, "system", "only a system turn"),
        (62, 0, "assistant", "<s>\\</s>[INST]\\\\[/INST]<<SYS>><</SYS>>\\"), (62, 0, "assistant", "tie"), (62, 0, "assistant", "tie"),
        (63, 0, "user", "q"), (63, 1, "system", "late system"), (63, 2, "[ROLE]", "😀 é\n\n"), (None, 0, "user", "no id"),
        (None, None, None, None), (None, None, None, None),
    ]
    return rows + long + huge + odd


def table(spark, rows):
    wide = [(*r, "mine", "mine", "mine", "mine") for r in rows]
    return spark.createDataFrame(wide, SCHEMA)


def in_order(rows):
    """Turns of each conversation as (role, text)."""
    number = lambda x: (x is not None, x or 0)

    def place(r):
        text = (r[3] or "").encode()
        hashed = xxhash.xxh64_intdigest(text, 42)
        return number(r[0]), number(r[1]), r[2] or "", hashed - (hashed >> 63 << 64), text

    by = groupby(sorted(rows, key=place), key=lambda r: r[0])
    return {c: [(r[2] or "", r[3] or "") for r in turns] for c, turns in by}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    found = {}
    for c, turns in in_order(rows).items():
        targets = "".join(text for role, text in turns if role == "assistant")
        found[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(targets), sha(targets))
    return found


@pytest.mark.parametrize("rule", [cw.WindowRule(), SMALL, cw.WindowRule(budget=60, history=0, block_windows=1), cw.WindowRule(3, 2, 5)])
def test_what_is_read_back_is_what_was_given(spark, tmp_path, rule):
    rows = conversations()
    written = cw.windows(table(spark, rows), FILE, rule)
    written.write.parquet(str(tmp_path / "w"))
    back = cw.digests(spark.read.parquet(str(tmp_path / "w"))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in back} == expected(rows)


def test_spans_are_turn_aligned_within_the_budget_and_repeat_history(spark):
    rows = conversations()
    turns = in_order(rows)
    found = cw.windows(table(spark, rows), FILE, SMALL).collect()
    seen = {c: 0 for c in turns}
    count = lambda turn: cw.token_counts(["".join(cw.framed(*turn))], FILE)[0]
    for w in sorted(found, key=lambda w: (str(w.conv_id), w.block, w.window)):
        every = turns[w.conv_id]
        held = cw.parsed(w.formatted)
        at = seen[w.conv_id]
        assert len(held) == w.n_repeated + w.n_new and w.n_new > 0
        assert held[w.n_repeated :] == every[at : at + w.n_new]
        repeated = held[: w.n_repeated]
        system = every[0][0] == "system"
        if system and at:
            assert repeated[0] == every[0]
            repeated = repeated[1:]
        assert repeated == every[at - len(repeated) : at]
        assert sum(map(count, repeated)) <= SMALL.history
        assert w.n_tokens == sum(map(count, held))
        assert w.n_tokens <= SMALL.budget or (w.n_new == 1 and not repeated) or (system and not at and w.n_new <= 2)
        targets = [cw.unescaped(w.formatted[a:b]) for a, b in zip(w.loss_starts, w.loss_ends)]
        assert targets == [text for role, text in held[w.n_repeated :] if role == "assistant"]
        seen[w.conv_id] += w.n_new
    assert seen == {c: len(t) for c, t in turns.items()}
    assert any(w.n_repeated > 1 for w in found) and any(w.block > 3 for w in found)


def test_windows_do_not_depend_on_the_partitions(spark):
    rows = conversations()
    few = cw.windows(table(spark, rows).coalesce(1), FILE, SMALL).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        many = cw.windows(table(spark, rows).repartition(23), FILE, SMALL).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(map(str, few)) == sorted(map(str, many))


def test_no_rows(spark):
    none = table(spark, conversations()).limit(0)
    assert cw.windows(none, FILE).count() == 0
    assert cw.digests(cw.windows(none, FILE)).count() == 0


PIECES = st.sampled_from(["\\", "<", ">", "[", "]", "/", "s", "INST", "SYS", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[TEXT]", "[/ROLE]", " ", "é"])
TEXTS = st.lists(PIECES, max_size=12).map("".join)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXTS), TEXTS), max_size=6))
def test_any_text_survives_the_template(turns):
    assert cw.parsed("".join("".join(cw.framed(*t)) for t in turns)) == turns


def test_the_query_reads_a_written_folder(spark, tmp_path):
    from tracewright.llm.queries import llm_queries

    rows = conversations()
    table(spark, rows).withColumn("topic", F.lit("x")).write.parquet(f"{tmp_path}/conversations.parquet")
    found = llm_queries()["op13_chat_windows"](spark, str(tmp_path)).collect()
    control = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", control), (-1, 1, "assistant", control)]
    assert {r.conv_id: tuple(r)[1:5] for r in found} == expected(rows)
    assert all(r.formatted_chars >= r.loss_chars for r in found)
