"""Column expressions for company names. All are JVM built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpreg.params import SUFFIX_REGEX


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalized_name(name: Column | str, suffix_regex: str = SUFFIX_REGEX) -> Column:
    """Lower-case, strip legal suffixes and ``. , _``, trim the ends.

    Interior runs of spaces are kept; only spaces (not tabs) are trimmed.
    """
    return F.trim(F.regexp_replace(F.lower(_col(name)), suffix_regex, ""))


def corporate_id(name: Column | str, suffix_regex: str = SUFFIX_REGEX) -> Column:
    """MD5 hex of the normalized name."""
    return F.md5(normalized_name(name, suffix_regex))


def canonical_name(s1_name: Column | str, s2_name: Column | str) -> Column:
    """Source-1 raw name when present, else the Source-2 raw name."""
    return F.coalesce(_col(s1_name), _col(s2_name))


# Whitespace as Python's str.split() sees it: Unicode White_Space plus the
# four information separators U+001C..U+001F.
_WS = r"[\s\x{1c}-\x{1f}]"
_NON_WS = r"[^\s\x{1c}-\x{1f}]"


def first_token(name: Column | str) -> Column:
    """First whitespace-separated token of the lower-cased name; "" when blank."""
    return F.regexp_extract(F.lower(_col(name)), f"(?U)^{_WS}*({_NON_WS}+)", 1)


def blank(c: Column | str) -> Column:
    """NULL or the empty string (a whitespace-only value is not blank)."""
    c = _col(c)
    return c.isNull() | (c == "")
