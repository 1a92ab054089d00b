"""Date columns that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def parse_day(c: Column | str) -> Column:
    """``YYYY/MM/DD`` with or without zero padding; anything else is NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}\z"), F.try_to_date(c, "y/M/d"))


def week_start(day: Column | str) -> Column:
    """Monday of the week, as DATE."""
    day = F.col(day) if isinstance(day, str) else day
    return F.date_sub(day, F.weekday(day))


def micros_to_date(micros: Column | str) -> Column:
    """Epoch microseconds to the UTC date, floored before 1970 too."""
    us = F.col(micros) if isinstance(micros, str) else micros
    whole = us - F.pmod(us, F.lit(MICROS_PER_DAY))
    return F.date_from_unix_date((whole / MICROS_PER_DAY).cast("int"))
