"""Text clean-up as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters of the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The information separators, which only the standardising step strips as well.
INFORMATION_SEPARATORS = "\x1c\x1d\x1e\x1f"


def as_text(column: Column, data_type: T.DataType | None = None) -> Column:
    """Cast to string; booleans read ``True``/``False``."""
    if isinstance(data_type, T.BooleanType):
        return F.when(column, "True").when(~column, "False")
    return column.cast("string")


def blank_to_null(column: Column, strip: str = WHITE_SPACE) -> Column:
    """Strip ``strip`` characters on both ends and turn the empty text into NULL.

    ``btrim`` with an explicit character list, because plain ``trim`` only knows U+0020; unlike a
    regular expression it stays a cheap byte scan inside generated code.
    """
    return F.nullif(F.btrim(column, F.lit(strip)), F.lit(""))


def _clean_ends(text: Column) -> Column:
    """Whether a text begins and ends with an ASCII character that no step strips."""
    last = F.substring(text, -1, 1)
    return (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")


def standard_text(column: Column, data_type: T.DataType | None = None) -> Column:
    """Strip white space and information separators on both ends and turn the empty text into NULL.

    Stripping searches a list of characters and is left out where neither end needs it. It is a function
    over an array, so that it is not spelled out in generated code: for some twenty columns in one
    step that would be near the size that the JVM no longer compiles.
    """
    text = as_text(column, data_type)
    stripped = F.transform(F.array(text), lambda t: F.btrim(t, F.lit(WHITE_SPACE + INFORMATION_SEPARATORS)))
    return F.when(_clean_ends(text), text).otherwise(F.transform(stripped, lambda t: F.when(t != "", t))[0])


def grouped_digits(number: Column) -> Column:
    """Integer with thousands separators."""
    return F.format_number(number, 0)
