"""Column expressions on literal values."""

import re
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.functions import quantiles as Q
from tracewright.functions.numbers import percentage, ratio
from tracewright.functions.text import blank_to_null, grouped_digits, standard_text
from tracewright.functions.time import elapsed_hours, elapsed_seconds, parse_utc, whole_units

SPACES = ["\t", "\n", "\x0b", "\x0c", "\r", " ", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u3000"]


def values(df):
    return [r[0] for r in df.collect()]


def test_text(spark):
    texts = [f"{c}a b{c}{c}" for c in SPACES] + ["", " \t\u3000", None, "\x1cx\x1f", "ÿ é "]
    df = spark.createDataFrame([(t,) for t in texts], "s string").coalesce(1)
    plain = ["a b"] * len(SPACES)
    assert values(df.select(standard_text(F.col("s")))) == plain + [None, None, None, "x", "ÿ é"]
    assert values(df.select(blank_to_null(F.col("s")))) == plain + [None, None, None, "\x1cx\x1f", "ÿ é"]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "b boolean").coalesce(1)
    assert values(flags.select(standard_text(F.col("b"), T.BooleanType()))) == ["True", "False", None]
    assert spark.range(1).select(grouped_digits(F.lit(1234567))).first()[0] == "1,234,567"


def test_times(spark):
    cases = {
        "2018-01-02T14:53:00.000+01:00": datetime(2018, 1, 2, 13, 53),
        "2018-01-02 14:53:00-0500": datetime(2018, 1, 2, 19, 53),
        "2018-01-02T14:53:00.123456Z": datetime(2018, 1, 2, 14, 53, 0, 123456),
        "2018-01-02 14:53:00 UTC": datetime(2018, 1, 2, 14, 53),
        "2024-03-10 02:30:00": datetime(2024, 3, 10, 2, 30),  # does not exist in New York
        "2018-01-02": datetime(2018, 1, 2),
        "12:30": None,
        "12:30Z": None,
        "unknown": None,
        "2018-13-01": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(c,) for c in cases], "s string").coalesce(1)
    assert values(df.select(parse_utc(F.col("s"), T.StringType()))) == list(cases.values())
    zoned = spark.sql("select timestamp'2024-03-10 06:59:59 UTC' as t")
    assert values(zoned.select(parse_utc(F.col("t"), T.TimestampType()))) == [datetime(2024, 3, 10, 6, 59, 59)]


def test_elapsed(spark):
    df = spark.sql(
        "select * from values"
        " (timestamp_ntz'2024-03-10 01:30:00', timestamp_ntz'2024-03-10 03:30:00'),"
        " (timestamp_ntz'2024-01-01 00:00:01.2', timestamp_ntz'2024-01-01 00:00:00'),"
        " (timestamp_ntz'2024-01-01 00:00:00', timestamp_ntz'2024-01-02 23:59:59.999'),"
        " (timestamp_ntz'2024-01-01 00:00:00', null) as t(a, b)"
    )
    seconds = elapsed_seconds(F.col("b"), F.col("a"))
    got = [tuple(r) for r in df.select(
        seconds, whole_units(seconds, 3600), whole_units(seconds, 86400), elapsed_hours(F.col("b"), F.col("a"))
    ).collect()]
    assert got == [(7200, 2, 0, 2.0), (-1, 0, 0, 0.0), (172799, 47, 1, 48.0), (None,) * 4]


def test_ratios(spark):
    row = spark.range(1).select(
        ratio(F.lit(1), F.lit(0)), ratio(F.lit(1), F.lit(4)), percentage(F.lit(0), F.lit(0), 4),
        percentage(F.lit(1), F.lit(3), 4),
    ).first()
    assert tuple(row) == (None, 0.25, 0.0, 33.3333)


def test_exact_quantiles_equal_the_built_in(spark):
    """Values below zero, far apart, tied, missing; groups of every small size; a NULL group."""
    df = spark.range(4000).selectExpr(
        "case when id % 5 = 0 then null else int(sqrt(id % 450)) end as g",
        "case when id % 7 = 0 then null when id % 3 = 0 then id * 9973 - 3000000 else id % 50 end as v",
    )
    ranks = {"p50": Q.at_percent(50), "p90": Q.at_percent(90)}
    got = Q.ranked_values(Q.value_counts(df, ["g"], "v"), ["g"], "v", ranks)
    wanted = df.groupBy("g").agg(
        Q.exact_small_domain("v", 50).alias("p50"), Q.exact_small_domain("v", 90).alias("p90")
    )
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in wanted.collect()}
    overall = Q.ranked_values(
        Q.value_counts(df, [], "v"), [], "v", {"lo": Q.lower_middle, "hi": Q.upper_middle}
    ).first()
    assert (overall.lo + overall.hi) / 2 == df.agg(F.median("v")).first()[0]


def test_sketch_is_close(spark):
    df = spark.range(100_000).selectExpr("(id * 7919) % 100000 as v")
    got = df.agg(Q.sketch(F.col("v"), 90)).first()[0]
    assert abs(got - 90_000) < 100


def test_standard_text_strips_where_it_must_and_stays_small_in_generated_code(spark, capsys):
    given = ["a", "a b", "é", "~", "!", "\x7f", " a", "a\t", "a\u3000", "\x1ca", "\xa0", "", None, "\u2003é\x1f"]
    kept = ["a", "a b", "é", "~", "!", "\x7f", "a", "a", "a", "a", None, None, None, "é"]
    df = spark.createDataFrame([(t,) for t in given], "s string").coalesce(1)
    assert values(df.select(standard_text(F.col("s")))) == kept
    wide = spark.range(1).select(*[F.concat(F.lit(" "), F.col("id").cast("string")).alias(f"c{k}") for k in range(60)])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        wide.select(*[standard_text(F.col(c)).alias(c) for c in wide.columns]).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:\s*(\d+)", capsys.readouterr().out)]
    assert max(sizes, default=0) < 8000
