"""Column expressions shared by the operators.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none of them needs a Python worker.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.config import AMOUNT_TYPE, UNKNOWN_COUNTRY

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_micros(duration: str) -> int:
    """Parse a fixed-length duration such as ``"10 minutes"`` or ``"1 day"``."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+?)s?\s*", duration)
    if not m or m.group(2).lower() not in _UNIT_MICROS:
        raise ValueError(f"unsupported window duration: {duration!r}")
    micros = int(m.group(1)) * _UNIT_MICROS[m.group(2).lower()]
    if micros <= 0:
        raise ValueError(f"window duration must be positive: {duration!r}")
    return micros


def bucket_start(ts: Column | str, duration: str) -> Column:
    """Start of the epoch-aligned tumbling window holding ``ts``.

    Same buckets as ``F.window(ts, duration).start`` but without the
    ``isnotnull(ts)`` filter that ``F.window`` adds to a projection: a null
    timestamp yields a null bucket and the row is kept.
    """
    us = F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(duration_micros(duration))))


def bucket_end(start: Column, duration: str) -> Column:
    return F.timestamp_micros(F.unix_micros(start) + F.lit(duration_micros(duration)))


def parse_event_time(ts_event: Column | str, fmt: str) -> Column:
    """Strict parse; anything that does not match ``fmt`` becomes null."""
    c = F.col(ts_event) if isinstance(ts_event, str) else ts_event
    return F.try_to_timestamp(c, F.lit(fmt))


def country_of(location: Column | str) -> Column:
    """Last comma segment, trimmed, if there are at least two segments.

    A location without a comma, an empty or a null location gives
    ``UNKNOWN``; a trailing comma gives ``''``.
    """
    loc = F.col(location) if isinstance(location, str) else location
    after_last_comma = F.trim(F.substring_index(loc, ",", -1))
    return F.when(F.contains(loc, F.lit(",")), after_last_comma).otherwise(F.lit(UNKNOWN_COUNTRY))


def blank_to_null(c: Column) -> Column:
    """``trim(c)``, with the empty string turned into null."""
    t = F.trim(c)
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def to_amount(c: Column) -> Column:
    """Double to decimal(18,2), half-up; overflow or junk gives null."""
    return c.try_cast(AMOUNT_TYPE)


def date_key(ts: Column | str) -> Column:
    """``yyyyMMdd`` of the timestamp as an int (arithmetic, no formatting)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def any_true(flags: list[Column]) -> Column:
    """SQL three-valued OR of the flags (true wins over null, null over false)."""
    return reduce(or_, flags)


def reasons_of(pairs: list[tuple[Column, str]], sep: str) -> Column:
    """Reasons of the true flags, in order, joined by ``sep``; none gives ``''``."""
    return F.concat_ws(sep, *[F.when(flag, F.lit(reason)) for flag, reason in pairs])
