"""Quality rules: a threshold table compiled into one projection, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.text import let, lines, whole, words

# Frequent function words of the languages at hand.
STOP_WORDS = (
    "the of and to in is that for with be as on it by this are at or an a he not was from have "
    "der die das und in zu den von mit ist des auf ein eine nicht im für sich dem es als auch an "
    "le la les de des et en un une que qui du dans par pour est sur au aux avec ce il elle se pas "
    "el los las y en que del se por con para es un una lo no su al como más pero ja ya o"
).split()


@dataclass(frozen=True)
class Rule:
    """``name``: a measure of :func:`measures`; a document passes within ``low`` and ``high``."""

    name: str
    low: float | None = None
    high: float | None = None


#: The verdict beyond the base rules. Bounds are wide: only texts far from prose fail.
THRESHOLDS = (
    Rule("n_words", high=5_000_000),
    Rule("mean_word_chars", low=2.0, high=20.0),
    Rule("symbol_word_ratio", high=0.3),
    Rule("exclaim_word_ratio", high=0.5),
    Rule("stop_word_ratio", low=0.01),
    Rule("dup_line_ratio", high=0.6),
    Rule("bullet_line_ratio", high=0.95),
    Rule("ellipsis_line_ratio", high=0.5),
)


def repeated_window_words(tokens: Column, size: int = 3) -> Column:
    """How many words lie in windows of ``size`` words that occur twice or more in the array.

    Window hashes are compared in one sort, and only in documents whose hashes are not all distinct.
    """

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - size)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))

    def starts_of_repeats(pairs: Column) -> Column:
        same = lambda p, k: F.get(pairs, k)["h"].eqNullSafe(p["h"])
        return F.transform(
            F.filter(pairs, lambda p, k: same(p, k - 1) | same(p, k + 1)), lambda p: p["i"]
        )

    def spread(at: Column) -> Column:
        window = F.sequence(F.lit(0), F.lit(size - 1))
        words_at = F.transform(at, lambda i: F.transform(window, lambda k: i + k))
        return F.size(F.array_distinct(F.flatten(words_at)))

    def count(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(let(pairs, starts_of_repeats), spread)
        )

    return let(
        tokens, lambda w: F.when(F.size(w) <= size, F.lit(0)).otherwise(let(hashes(w), count))
    )


def with_measures(docs: DataFrame) -> DataFrame:
    """(given, quality): the row as it was, and the counts and ratios over its whole text.

    Null and blank texts have no words: every count is 0 and every ratio is null.
    """
    # The input row is one struct, so that no name of it can clash with an inner one.
    split = docs.select(
        F.struct(*docs.columns).alias("given"),
        "text",
        words(F.col("text")).alias("w"),
        F.filter(lines(F.col("text")), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("l"),
    )
    long = lambda c: c.cast("long")
    counts = split.select(
        "given",
        long(F.size("w")).alias("n_words"),
        long(F.char_length(F.array_join("w", ""))).alias("word_chars"),
        long(F.regexp_count(whole(F.col("text")), F.lit("[#*$%&|<>]"))).alias("n_symbols"),
        F.regexp_count(whole(F.col("text")), F.lit("!")).alias("n_exclaims"),
        long(F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"),
        long(repeated_window_words(F.col("w"))).alias("n_repeat_words"),
        F.size("l").alias("n_lines"),
        F.size(F.filter("l", lambda x: x.rlike("^\\s*[-*•]\\s"))).alias("n_bullets"),
        F.size(F.filter("l", lambda x: x.rlike("(\\.\\.\\.|…)\\s*$"))).alias("n_ellipses"),
        F.size(F.filter("w", lambda x: F.lower(F.rtrim(x, F.lit(".,;:!?"))).isin(*STOP_WORDS))).alias("n_stop"),
    )
    n, per_line = F.col("n_words"), lambda c: F.try_divide(F.col(c), F.col("n_lines"))
    return counts.select(
        "given",
        F.struct(
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            F.try_divide("word_chars", n).alias("mean_word_chars"),
            F.try_divide("n_symbols", n).alias("symbol_word_ratio"),
            F.try_divide("n_exclaims", n).alias("exclaim_word_ratio"),
            F.try_divide("n_stop", n).alias("stop_word_ratio"),
            per_line("n_dup_lines").alias("dup_line_ratio"),
            per_line("n_bullets").alias("bullet_line_ratio"),
            per_line("n_ellipses").alias("ellipsis_line_ratio"),
        ).alias("quality"),
    )


def compiled(table: tuple[Rule, ...], measures: Column) -> Column:
    """One boolean expression for the whole table; a measure that is null does not fail."""
    passes = F.lit(True)
    for rule in table:
        value = measures[rule.name]
        if rule.low is not None:
            passes = passes & F.coalesce(value >= rule.low, F.lit(True))
        if rule.high is not None:
            passes = passes & F.coalesce(value <= rule.high, F.lit(True))
    return passes


def failed_rules(table: tuple[Rule, ...], measures: Column) -> Column:
    """Names of the rules that a document fails, in table order."""
    return F.array_compact(
        F.array(*[F.when(~compiled((rule,), measures), F.lit(rule.name)) for rule in table])
    )


def judged(docs: DataFrame, table: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    """Every row of ``docs`` with ``quality`` (all measures), ``base_failed``, ``failed`` and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated windows. All other
    columns stay; columns with the new names are replaced. Empty input gives no rows.
    """
    new = ("quality", "base_failed", "failed", "kept")
    held = [c for c in docs.columns if c not in new]
    m = F.col("quality")
    failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    return with_measures(docs.select(*held)).select(
        "given.*",
        "quality",
        failed.alias("base_failed"),
        failed_rules(table, m).alias("failed"),
        (~failed & compiled(table, m)).alias("kept"),
    )
