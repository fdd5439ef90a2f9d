"""String predicates and transforms used by the statement-text operators.

All are built-in Spark expressions (JVM side, codegen'd); none is a UDF.
Python's ``str`` methods are Unicode-aware, Java regex classes are not unless
the ``(?U)`` flag is set, so every pattern that stands in for a Python test
carries it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_upper(s) -> Column:
    """Python ``str.isupper()``: at least one cased character, and no
    lower-case one."""
    s = _c(s)
    return (F.upper(s) == s) & (F.lower(s) != s)


def starts_with_digit(s) -> Column:
    """First character is a digit; the empty string gives False (not an error)."""
    return F.coalesce(_c(s).rlike(r"(?U)^\d"), F.lit(False))


def strip_leading_number(s) -> Column:
    """Drop leading ASCII digits (``str.lstrip('0123456789')``), then the
    blank that separated them from the text."""
    return F.trim(F.regexp_replace(_c(s), r"^[0-9]+", ""))


#: Unicode white space (the characters of ``(?U)`` and ``\s``).
WHITE_SPACE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"


def py_strip(s) -> Column:
    """Python ``str.strip()``: trim Unicode white space on both ends
    (Spark's ``trim`` removes only the space character unless told others)."""
    return F.trim(_c(s), F.lit(WHITE_SPACE))


def starts_with_dollar(s) -> Column:
    """First non-blank character is ``$``; blank or empty gives False."""
    return F.coalesce(_c(s).startswith("$") | py_strip(s).startswith("$"), F.lit(False))


def file_name(path) -> Column:
    """Base name of a path or URI (``os.path.basename``)."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def file_stem(path) -> Column:
    """Base name without its last extension (``os.path.splitext``)."""
    return F.regexp_extract(file_name(path), r"^(.+?)(\.[^.]*)?$", 1)


def parse_amount(s) -> Column:
    """Chilean-style amount text to ``decimal(18,2)``: drop ``$`` and the
    thousands dots, decimal comma to point.  Unparsable text gives NULL."""
    cleaned = F.replace(F.translate(py_strip(s), "$.", ""), F.lit(","), F.lit("."))
    return cleaned.try_cast("decimal(18,2)")


def format_amount(x) -> Column:
    """Number to Chilean-style text with two decimals, e.g. 1234.5 -> '1.234,50'."""
    return F.translate(F.format_number(_c(x), 2), ",.", ".,")


def join_words(*cols) -> Column:
    """Text fields joined by one blank (NULL fields are skipped)."""
    return F.concat_ws(" ", *[_c(c) for c in cols])
