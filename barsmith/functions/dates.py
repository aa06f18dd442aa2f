"""Date parsing and time-of-day expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barsmith.config import BAR_SECONDS, WINDOW_END, WINDOW_START


def parse(text: Column, pattern: str) -> Column:
    """Null where the text does not match the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")


def in_window(ts: Column, start: str = WINDOW_START, end: str = WINDOW_END) -> Column:
    """Time of day between both ends, inclusive; a fraction after the end is outside."""
    second = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    whole = F.date_trunc("second", ts) == ts
    first, last = _seconds(start), _seconds(end)
    return (second >= first) & ((second < last) | ((second == last) & whole))


def _seconds(clock: str) -> int:
    hours, minutes, seconds = map(int, clock.split(":"))
    return hours * 3600 + minutes * 60 + seconds


def on_bar_mark(ts: Column, seconds: int = BAR_SECONDS) -> Column:
    """Whole seconds decide; the fraction of a second is ignored."""
    return F.second(ts) % seconds == 0


def trading_day(ts: Column) -> Column:
    return F.to_date(ts)


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")
