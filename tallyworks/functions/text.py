"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character that Python's str.split() takes as white space. \p{Z}
# are the Unicode separators; a class of listed ranges would take twice the time.
WHITESPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\p{Z}]+"


def words(text: Column) -> Column:
    """Array of the words of a text; leading and trailing blanks give none."""
    return F.array_remove(F.split(text, WHITESPACE), "")


def padded_code(prefix: str, number: Column, digits: int = 5) -> Column:
    """``ORDER-00042`` style codes; longer numbers are kept whole."""
    return F.format_string(f"{prefix}-%0{digits}d", number)
