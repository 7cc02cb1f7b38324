"""Time rules, independent of the session time zone.

Epoch milliseconds become a ``TIMESTAMP_NTZ`` at UTC, then are moved to the
business zone ``tz`` with ``convert_timezone``; formatting an NTZ value never
applies the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Fixed value: the live job's curve step, two minutes in milliseconds.
TWO_MINUTES_MS = 120_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ms_to_ntz(ms) -> Column:
    """Epoch millis -> UTC wall clock as ``TIMESTAMP_NTZ``."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(EPOCH_NTZ))


def ms_of_ntz(ts) -> Column:
    """UTC wall clock (``TIMESTAMP_NTZ``) -> epoch millis.

    Built from calendar fields, which need no zone for NTZ values (a
    difference of timestamps would pass through the session zone).
    """
    ts = _c(ts)
    days = F.unix_date(ts.cast("date")).cast("bigint")
    millis_of_second = F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("bigint")
    return days * 86_400_000 + F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000 + millis_of_second


#: Epoch millis that every time function takes: the years 0001 to 9999, less
#: two days at each end for zones and buckets.
FIRST_MS, LAST_MS = -62_135_424_000_000, 253_402_128_000_000


def in_range(ms) -> Column:
    """Whether ``ms`` is a time that the functions here can express."""
    return _c(ms).between(FIRST_MS, LAST_MS)


def local_ntz(ms, tz: str = "UTC") -> Column:
    ntz = ms_to_ntz(ms)
    if tz == "UTC":
        return ntz
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ntz)


def day_of(ms, tz: str = "UTC") -> Column:
    """SC-10: epoch millis -> ``yyyy-MM-dd`` in the business zone."""
    return local_ntz(ms, tz).cast("date").cast("string")


def bucket_end(ms, width_ms: int = TWO_MINUTES_MS) -> Column:
    """SC-11: end of the ``width_ms`` bucket holding ``ms``, in epoch millis.

    The live job's curve labels a bucket by its end. Integer arithmetic on
    UTC millis equals flooring the local wall clock for every zone whose
    offset is a multiple of the width (all real zones, for two minutes).
    """
    ms = _c(ms)
    w = F.lit(width_ms).cast("bigint")
    return ms - F.pmod(ms, w) + w


def prev_day(d) -> Column:
    """``yyyy-MM-dd`` text -> the day before, as text."""
    return F.date_format(F.date_sub(F.to_date(_c(d)), 1), "yyyy-MM-dd")


def text_to_ms(text, tz: str = "UTC") -> Column:
    """SC-13: ``yyyy-MM-dd HH:mm:ss`` in the business zone -> epoch millis."""
    ntz = F.to_timestamp_ntz(_c(text), F.lit("yyyy-MM-dd HH:mm:ss"))
    if tz != "UTC":
        ntz = F.convert_timezone(F.lit(tz), F.lit("UTC"), ntz)
    return ms_of_ntz(ntz)


def ms_to_text(ms, tz: str = "UTC") -> Column:
    """SC-13: epoch millis -> ``yyyy-MM-dd HH:mm:ss`` in the business zone."""
    whole_seconds = F.floor(_c(ms) / 1000).cast("bigint") * 1000
    return local_ntz(whole_seconds, tz).cast("string")


def date_prefix(c) -> Column:
    """SC-14: first ten characters (the day of a ``yyyy-MM-dd ...`` text)."""
    return F.substring(_c(c), 1, 10)


def drop_fraction(c) -> Column:
    """SC-14: drop a trailing ``.0`` style fraction that JDBC adds to DATETIME text."""
    return F.regexp_replace(_c(c), r"\.\d+\z", "")
