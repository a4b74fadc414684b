"""Text expressions that several operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of the word rules: the blank and code points 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    The built-in lower-casing is the same on pure ASCII and much faster, so only other texts are
    translated letter by letter.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )


def stripped(text: Column) -> Column:
    """The text without white space at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def words(text: Column) -> Column:
    """Maximal runs without white space, as an array; empty for null or blank texts."""
    trimmed = stripped(whole(text))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK_RUN)
    )


def lines(text: Column) -> Column:
    """The text split at newlines; null or empty gives one empty line."""
    return F.split(whole(text), "\n")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def bucket_of(doc_id: Column, modulus: int = 5) -> Column:
    """crc32 of the id's decimal digits, modulo ``modulus``; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once.

    Inside a lambda of a higher-order function an outer expression would be evaluated again for
    every element, as the optimizer puts expressions in place of the columns that name them.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def broadcast_if_small(settled: DataFrame, max_rows: int = 500_000, max_bytes: int = 64 << 20) -> DataFrame:
    """The table with a broadcast hint if its counted rows and bytes are few, otherwise as it is."""
    if settled.limit(max_rows + 1).count() > max_rows:
        return settled
    size = settled.agg(F.sum(F.octet_length(F.to_json(F.struct(*settled.columns))))).first()[0]
    return F.broadcast(settled) if (size or 0) <= max_bytes else settled


_TABLE: dict = {}


def worker_table(key: tuple, build: Callable[[], object]) -> object:
    """The one large table that a Python worker keeps from task to task; another one takes its place."""
    if key not in _TABLE:
        drop_worker_table()
        _TABLE[key] = build()
    return _TABLE[key]


def drop_worker_table() -> None:
    """For work that needs the memory of a worker that had other tasks before."""
    if _TABLE:
        _TABLE.clear()
        # A table whose parts know each other is not freed by counting references.
        gc.collect()
