"""Number reads of payload text.

Payload values arrive as text (``from_json`` into a string map keeps numbers
as their JSON text). ANSI mode is on, so every cast is a ``try_cast`` and a
failed cast is reported by the caller as an error, never raised inside a task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditpulse.functions.text import is_blank, java_trim


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_long(c) -> Column:
    """SC-4: Java ``Long.parseLong(s.trim)`` with blank -> 0.

    Null input stays null (the caller treats a missing field as an error);
    text that is not an integer also gives null: ``'12.5'`` and ``'abc'`` are
    null, ``' +5 '`` is 5.
    """
    c = _c(c)
    return F.when(c.isNull(), F.lit(None).cast("bigint")).when(is_blank(c), F.lit(0).cast("bigint")).otherwise(
        java_trim(c).try_cast("bigint")
    )


def strict_long_error(c) -> Column:
    """True when :func:`strict_long` would fail: missing, or not an integer."""
    c = _c(c)
    return c.isNull() | (~is_blank(c) & strict_long(c).isNull())


def _via_decimal(c: Column, to: str) -> Column:
    return java_trim(c).try_cast("decimal(38,10)").try_cast(to)


def opt_long(c) -> Column:
    """SC-5: nullable long: missing or blank -> null; decimals truncate
    (``'12.7'`` -> 12); text that is not a number -> null (see ``opt_error``)."""
    c = _c(c)
    plain = c.rlike(r"\A[0-9]{1,18}\z")  # most numbers: no decimal is made of them
    return F.when(plain, c.try_cast("bigint")).when(~is_blank(c), _via_decimal(c, "bigint"))


def opt_int(c) -> Column:
    c = _c(c)
    return F.when(~is_blank(c), _via_decimal(c, "int"))


def opt_float(c) -> Column:
    c = _c(c)
    return F.when(~is_blank(c), java_trim(c).try_cast("float"))


def opt_double(c) -> Column:
    c = _c(c)
    return F.when(~is_blank(c), java_trim(c).try_cast("double"))


def opt_error(raw, parsed: Column) -> Column:
    """A present, non-blank value that did not parse."""
    raw = _c(raw)
    return ~is_blank(raw) & parsed.isNull()
