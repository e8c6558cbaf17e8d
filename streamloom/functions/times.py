"""Column functions for clock readings and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def clock(seconds: Column, millis: bool = False) -> Column:
    """hh:mm:ss, rounded down; with millis hh:mm:ss.mmm, rounded half up to the millisecond. Null stays null."""
    ms = F.floor(seconds * 1000 + 0.5) if millis else F.floor(seconds) * 1000
    s = F.floor(ms / 1000)
    two = lambda x: F.lpad(x.cast("long").cast("string"), 2, "0")
    hours = F.floor(s / 3600).cast("long").cast("string")
    out = F.concat(F.when(F.length(hours) < 2, F.lpad(hours, 2, "0")).otherwise(hours), F.lit(":"), two(F.floor(s / 60) % 60), F.lit(":"), two(s % 60))
    return F.concat(out, F.lit("."), F.lpad((ms % 1000).cast("long").cast("string"), 3, "0")) if millis else out


def hour_minute(seconds: Column) -> Column:
    """hh:mm of a day, rounded down and wrapped at midnight."""
    s = F.floor(seconds).cast("long") % 86400
    two = lambda x: F.lpad(x.cast("long").cast("string"), 2, "0")
    return F.concat(two(F.floor(s / 3600)), F.lit(":"), two(F.floor(s / 60) % 60))


def clock_seconds(text: Column) -> Column:
    """Seconds of a reading with any number of ":" parts, base 60; null where a part is no number."""
    parts = F.transform(F.split(F.trim(text), ":"), lambda p: F.trim(p).try_cast("double"))
    total = F.aggregate(parts, F.lit(0.0), lambda a, p: a * 60 + p)
    return F.when(F.exists(parts, lambda p: p.isNull()), F.lit(None).cast("double")).otherwise(total)


def tenths(seconds: Column) -> Column:
    """hh:mm:ss.s of a time, not below 0; seconds may read 60.0, as they are rounded last (half to even on the double)."""
    t = F.greatest(seconds, F.lit(0.0))
    h = F.floor(t / 3600)
    rest = t - h * 3600
    m = F.floor(rest / 60)
    s = F.bround(rest - m * 60, 1)
    two = lambda x: F.lpad(x.cast("long").cast("string"), 2, "0")
    return F.concat(two(h), F.lit(":"), two(m), F.lit(":"), F.lpad(F.format_number(s, 1), 4, "0"))


def week_number(day: Column, start: Column) -> Column:
    """1 for the first seven days from start, 2 for the next."""
    return (F.floor(F.datediff(day, start) / 7) + 1).cast("int")


def weekday(day: Column) -> Column:
    """Mon to Sun."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(day) + 1)


def any_date(text: Column) -> Column:
    """A date written yyyy-mm-dd with any separator, or yyyymmdd; null for anything else."""
    y, m, d = (F.regexp_extract(text, "^\\s*(\\d{4})\\D?(\\d{2})\\D?(\\d{2})\\s*$", k) for k in (1, 2, 3))
    return F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-MM-dd")
