"""Text helpers with Java ``String`` semantics.

Java ``trim`` removes every character up to U+0020 (tabs, newlines, control
characters), while Spark's ``trim`` removes spaces only; Java ``split`` drops
trailing empty strings. Both are reproduced with built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Java ``trim`` removes.
_CTRL = "".join(map(chr, range(0x21)))
_FIRST = "!"  # the first character that it does not


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """Null, or empty after Java ``trim``. Never null itself."""
    c = _c(c)
    return c.isNull() | ((c < _FIRST) & (F.btrim(c, F.lit(_CTRL)) == ""))  # most texts start with a character that stays


def java_trim(c) -> Column:
    """Java ``String.trim``: drop characters <= U+0020 at both ends."""
    c = _c(c)
    clean = (c >= _FIRST) & (F.substring(c, -1, 1) >= _FIRST)  # most texts: nothing to trim
    return F.when(clean, c).otherwise(F.btrim(c, F.lit(_CTRL)))


def first_non_blank(*cols, default: str = "default") -> Column:
    """SC-6: first argument that is not blank, returned untrimmed; else ``default``."""
    picks = [F.when(~is_blank(c), _c(c)) for c in cols]
    return F.coalesce(*picks, F.lit(default))


def strip_token(c, token: str) -> Column:
    """SC-7: remove every occurrence of ``token`` (a plain string, not a pattern)."""
    return F.replace(_c(c), F.lit(token), F.lit(""))


def _drop_trailing(c: Column, sep: str) -> Column:
    """Without the separators at the very end of the text (a line end after
    them is text like any other)."""
    if len(sep) == 1:
        return F.rtrim(c, F.lit(sep))
    return F.regexp_replace(c, "(?:" + _escape(sep) + ")+\\z", "")


def _escape(sep: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)


def first_part(c, sep: str) -> Column:
    """SC-8: first element of a Java ``split`` on the literal ``sep``.

    Java drops trailing empty strings, so ``'Y66|X69|'`` gives ``Y66``,
    ``'|Y66'`` gives ``''`` and text made only of separators has no element at
    all: the result is then null (see :func:`split_is_empty`).
    """
    rest = _drop_trailing(_c(c), sep)
    return F.when(rest != "", F.substring_index(rest, sep, 1))


def split_is_empty(c, sep: str) -> Column:
    """True when a Java ``split`` on ``sep`` yields no element (non-empty text
    that consists of separators only). Null input gives false."""
    c = _c(c)
    return F.coalesce((c != "") & (_drop_trailing(c, sep) == ""), F.lit(False))


def area_parts(c, sep: str = "|") -> Column:
    """SC-9: array of the parts of a Java ``split`` (trailing empties dropped)."""
    return F.split(_drop_trailing(_c(c), sep), _escape(sep))
