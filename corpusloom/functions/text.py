"""Text expressions: Unicode strip, blank test, whitespace tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points Python's str.isspace() accepts and str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_text(col: Column) -> Column:
    """Both-ends strip over all of Unicode whitespace (``F.trim`` knows only U+0020)."""
    return F.btrim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    """True for null, empty and all-whitespace text."""
    return F.coalesce(strip_text(col) == "", F.lit(True))


def tokens(col: Column) -> Column:
    """Lower-cased whitespace tokens, empty pieces removed."""
    return F.filter(F.split(F.lower(col), f"[{WHITESPACE}]+"), lambda t: t != "")


def truncate_tokens(toks: Column, max_tokens: int) -> Column:
    """The model window: the first ``max_tokens`` tokens."""
    return F.slice(toks, 1, max_tokens)


def truncate_chars(col: Column, max_chars: int | None) -> Column:
    """Optional character cap before tokenising; off when ``None``."""
    return col if max_chars is None else F.substring(col, 1, max_chars)
