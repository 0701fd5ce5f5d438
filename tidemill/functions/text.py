"""String helpers: words, delimited records, defaults for missing keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiters of the word inputs (tab, comma, blank) and line ends inside a text value.
WORD_DELIMITERS = "[\\t, \\r\\n]+"


def word_array(text: Column, pattern: str = WORD_DELIMITERS, lowercase: bool = True) -> Column:
    """The words of a text as an array; a text that starts or ends with a delimiter has an empty word there."""
    return F.split(F.lower(text) if lowercase else text, pattern)


def fields(line: Column, separator: str, drop_trailing_empty: bool = True) -> Column:
    """The fields of a delimited line. ``separator`` is literal text.

    Trailing empty fields are dropped unless asked for, so a line ending in its separator has no extra field.
    """
    literal = re.escape(separator)
    if drop_trailing_empty:
        single = len(separator) == 1
        line = F.rtrim(line, F.lit(separator)) if single else F.regexp_replace(line, f"({literal})+$", "")
    return F.split(line, literal)


def field(parts: Column, index: int) -> Column:
    """Field ``index`` counted from 0; null when the record is too short."""
    return F.get(parts, F.lit(index))


def joined(separator: str, *columns: Column) -> Column:
    """Values joined with a separator; a null counts as empty text, so field positions stay fixed."""
    return F.concat_ws(separator, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def map_value(mapping: Column, key: Column, default: str | int | float) -> Column:
    """The map's value for a key, or the default."""
    return F.coalesce(F.try_element_at(mapping, key), F.lit(default))
