"""A small corpus with copies, shared passages, repeated lines, personal data and odd rows."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

_EN = "the of and to in is that for with thing water river stone house moving reading ending".split()
_DE = "der die und das ist nicht für über mit straße häuser gehen wollen zwischen schön größe".split()
_FR = "le la les de et que dans pour été forêt maison rivière très garçon où déjà".split()
_ES = "el los las que por para niño casa río mañana señor también aquí después año".split()
LANGS = {"en": _EN, "de": _DE, "fr": _FR, "es": _ES}

BOILERPLATE = "  Subscribe to our Newsletter for more of this. \t"
PASSAGE = " ".join(f"passage{k}" for k in range(30))


def prose(rng: random.Random, lang: str, n: int) -> str:
    base = LANGS[lang]
    words = [rng.choice(base) + rng.choice(["", "", rng.choice(base)]) for _ in range(n)]
    return "".join(w + (rng.choice([".\n", " ", " ", " ", ", "])) for w in words).strip()


def rows() -> list[tuple]:
    rng = random.Random(5)
    found = []
    for k in range(60):
        lang = ("en", "de", "fr", "es")[k % 4]
        found.append([k, prose(rng, lang, 40 + 5 * k), lang, f"src{k % 3}"])
    for k in (3, 7, 11, 15):
        found[k][1] += "\n" + BOILERPLATE + "\n" + PASSAGE
    found[20][1] = found[5][1]
    found[21][1] = found[50][1].replace("the", "th", 1) + " more"
    found[22][1] = found[50][1]
    found[30][1] += "\nmail a.b@c-d.org, 10.0.0.255 or +1 (640) 555-0953; card 4111 1111 1111 1111, 999.1.1.1"
    found[31][1] = "%%% $$$ ### word %%% $$$ " * 30
    return [(i, t, lang, s, len(t)) for i, t, lang, s in found]


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, repeated rows and strange characters."""
    return [
        (100, None, "en", None, None),
        (101, "", None, "s", 0),
        (102, " \t\n\r\x0b ", "de", "s", 6),
        (103, "x", "en", "s", 1),
        (104, "1234 5678 " * 30_000, "en", "s", 300_000),
        (105, "a" * 200_000, None, "s", 200_000),
        (106, "İ Σας \x1c <|endoftext|> 中文 😀 é ﬁ x　y\n\n\n" * 3, "fr", "s", 1),
        (107, "one two", "xx", "s", 7),
        (107, "one two", "xx", "s", 7),
        (None, "a row without an id but with words " * 3, "en", "s", 1),
        (None, None, None, None, None),
    ]


def table(spark: SparkSession, data: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(rows() + odd_rows() if data is None else data, SCHEMA)
