"""Column expressions for single fields of a flight. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_quotes(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit('"'), F.lit(""))


def is_airport(c: Column | str) -> Column:
    return F.length(_col(c)) == 3


def is_carrier(c: Column | str) -> Column:
    return F.length(_col(c)) == 2


def delay_minutes(text: Column | str, legacy_len: bool = False) -> Column:
    """Text to minutes; NULL for blank, unreadable, NaN or infinite text.

    ``legacy_len`` also ignores texts of one character, so a bare ``5`` is lost
    while ``5.00`` counts.
    """
    text = _col(text)
    number = text.try_cast("double")
    # Spark orders NaN above infinity, so one comparison rejects both.
    usable = F.abs(number) < F.lit(float("inf"))
    if legacy_len:
        usable = usable & (F.length(text) > 1)
    return F.when(usable, number)


# Fixed value: how the data write midnight at the end of the day.
DAY_END = "2400"


def is_clock_time(c: Column | str) -> Column:
    """``HHMM`` with hours 00 to 23 and minutes 00 to 59, or 2400."""
    c = _col(c)
    return c.rlike("^([01][0-9]|2[0-3])[0-5][0-9]$") | (c == DAY_END)


def clock_time(text: Column | str) -> Column:
    """``HHMM`` with leading zeros; NULL unless the text is a time of one to four digits."""
    text = _col(text)
    padded = F.when(text.rlike("^[0-9]{1,4}$"), F.lpad(text, 4, "0"))
    return F.when(is_clock_time(padded), padded)


def half_day(dep_time: Column | str) -> Column:
    """AM before 12:00, PM from 12:00 to 24:00; NULL without a valid departure time."""
    dep_time = _col(dep_time)
    return F.when(is_clock_time(dep_time), F.when(dep_time < "1200", "AM").otherwise("PM"))


def departure_time(flight_date: Column | str, dep_time: Column | str) -> Column:
    """Event time of a flight, from its date and ``HHMM`` time; 2400 is the next midnight.

    NULL without a date or a valid time.
    """
    dep_time = _col(dep_time)
    day_end = dep_time == DAY_END
    day = F.when(day_end, F.date_add(_col(flight_date), 1)).otherwise(_col(flight_date))
    clock = F.when(day_end, "0000").otherwise(dep_time)
    text = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), clock)
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HHmm"))


def day_first_date(text: Column | str) -> Column:
    """``dd/MM/yyyy`` to a date; NULL when the text is no such date."""
    return F.try_to_timestamp(_col(text), F.lit("dd/MM/yyyy")).cast("date")


def shift_date(date: Column | str, days: int) -> Column:
    return F.date_add(_col(date), days)
