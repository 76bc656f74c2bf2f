"""Regex capture, blank-line test and response-prefix removal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length of the marker line that code-review servers put before JSON responses.
RESPONSE_PREFIX_LENGTH = 5


def matches(col: Column, pattern: str) -> Column:
    """True when the pattern is found anywhere in the text."""
    return col.rlike(pattern)


def capture(col: Column, pattern: str, may_be_empty: bool = False) -> Column:
    """Group 1 of the first match, or null when there is none.

    `regexp_extract` returns '' both for "no match" and for "matched nothing". A pattern whose
    group needs at least one character can drop '' and so runs a single regex pass; a group
    that may be empty needs the extra test.
    """
    group = F.regexp_extract(col, pattern, 1)
    if may_be_empty:
        return F.when(col.rlike(pattern), group)
    return F.nullif(group, F.lit(""))


def capture_or_else(col: Column, pattern: str, default: Column, may_be_empty: bool = False) -> Column:
    return F.coalesce(capture(col, pattern, may_be_empty), default)


def is_not_blank(col: Column) -> Column:
    """True when the text has any character above U+0020."""
    return col.rlike(r"[^\x00-\x20]")


def drop_response_prefix(col: Column) -> Column:
    """Remove the first five characters, whatever they are."""
    return F.substr(col, F.lit(RESPONSE_PREFIX_LENGTH + 1))


def drop_trailing_commas(col: Column) -> Column:
    """Remove commas that stand before a closing bracket, leaving quoted strings untouched."""
    quoted_or_comma = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|,(?=\s*[}\]])'
    return F.regexp_replace(col, quoted_or_comma, "$1")
