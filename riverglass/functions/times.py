"""Epoch milliseconds without regard to the session's time zone."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS, HOUR_MS, MINUTE_MS = 86_400_000, 3_600_000, 60_000


def epoch_ms(ts: str) -> Column:
    """A timestamp without zone as epoch milliseconds, cut off below."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    return days * DAY_MS + seconds.cast("long") * 1000 + F.floor(F.expr(f"extract(SECOND FROM {ts})") * 1000).cast("long")


def between(ts: str, start_ms: int | None, end_ms: int | None) -> Column:
    """Whether a timestamp without zone lies in a closed range of epoch milliseconds, as a comparison that reaches the scan."""

    def instant(ms: int) -> Column:
        at = datetime.fromtimestamp(ms / 1000, UTC)
        return F.expr(f"TIMESTAMP_NTZ '{at:%Y-%m-%d %H:%M:%S}.{ms % 1000:03d}'")

    found = F.lit(True) if start_ms is None else F.col(ts) >= instant(start_ms)
    return found if end_ms is None else found & (F.col(ts) < instant(end_ms + 1))


def duration_ms(text: str) -> int:
    """Milliseconds of a length of time such as 24 hours."""
    number, unit = text.split()
    return int(number) * {"millisecond": 1, "second": 1000, "minute": MINUTE_MS, "hour": HOUR_MS, "day": DAY_MS}[unit.removesuffix("s")]


def floor_ms(ms: Column | str, size: int, offset: int = 0) -> Column:
    """The start of the window of a size that holds a time."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return ms - F.pmod(ms - offset, F.lit(size))
