"""Text column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters treated as whitespace when deciding that a
# value is blank (the characters for which Python's ``str.isspace`` is true).
WHITESPACE_CLASS = (
    "\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F} \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
)
BLANK_PATTERN = f"^[{WHITESPACE_CLASS}]*$"

# Fixed value: timestamp text written for comment dates.
COMMENT_DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'-00:00'"

# Fixed value: a token is a maximal run of letters and digits.
TOKEN_PATTERN = "[\\p{L}\\p{N}]+"


def blank_to_null(c: Column) -> Column:
    """NULL when the value (as text) is empty or whitespace only."""
    s = c.cast("string")
    return F.when(~s.rlike(BLANK_PATTERN), c)


def drop_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\n", "")


def tokens(text: Column) -> Column:
    """Lower-cased tokens of the whole text (one regex pass, no empty tokens)."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)
