"""Time expressions (PRJ6, FN13-FN15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS+00:00"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_utc(ts) -> Column:
    """Timestamp -> ISO-8601 UTC text with microseconds, the record format of the feeds."""
    return F.date_format(_col(ts), ISO_FORMAT)


def parse_ts(s) -> Column:
    """Lenient ISO-8601 parse; unparsable text -> null (the row is kept)."""
    return F.try_to_timestamp(_col(s))


def local_parts(ts, tz: str) -> tuple[Column, Column]:
    """FN13: (hour, weekday Monday=0) of a UTC timestamp in zone ``tz``."""
    local = F.from_utc_timestamp(_col(ts), tz)
    return F.hour(local).cast("long"), F.weekday(local).cast("long")


def target_parts(hour, dow, horizon) -> tuple[Column, Column]:
    """FN14: (hour + h) mod 24 and (dow + floor((hour + h) / 24)) mod 7."""
    total = _col(hour) + _col(horizon)
    return F.pmod(total, F.lit(24)), F.pmod(_col(dow) + F.floor(total / 24), F.lit(7))


def valid_time(ts, horizon) -> Column:
    """FN15: now + h hours."""
    return _col(ts) + F.make_dt_interval(F.lit(0), _col(horizon).cast("int"))
