"""Date and time expressions.

Dates travel as ``yyyyMMdd`` or ``yyyy-MM-dd`` strings at the edges and as
``DateType`` inside. Malformed input gives NULL, never an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _month_map() -> Column:
    kv = []
    for i, name in enumerate(config.MONTH_ABBREVIATIONS, start=1):
        kv += [F.lit(name), F.lit(f"{i:02d}")]
    return F.create_map(*kv)


def _en_parts(en: Column) -> tuple[Column, Column, Column, Column]:
    day = F.substring(en, 1, 2)
    month = F.try_element_at(_month_map(), F.substring(en, 4, 3))
    year = F.substring(en, 8, 4)
    time = F.when(F.length(en) >= 12, en.substr(F.lit(13), F.greatest(F.length(en) - 12, F.lit(0))))
    return day, month, F.when(F.length(en) >= 11, year), time


def en_to_cn_datetime(en: Column | str) -> Column:
    """H5: ``dd/MMM/yyyy:HH:mm:ss`` to ``yyyy-MM-dd HH:mm:ss``; text after position 12 kept as is.

    An unknown month, NULL, or text that ends before position 12 gives NULL.
    """
    day, month, year, time = _en_parts(_c(en))
    return F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "), time)


def en_to_cn_date(en: Column | str) -> Column:
    """H6: the date part only, ``yyyy-MM-dd``; NULL where the text ends before its year does."""
    day, month, year, _ = _en_parts(_c(en))
    return F.concat(year, F.lit("-"), month, F.lit("-"), day)


def en_to_cn_array(en: Column | str) -> Column:
    """H7: ``[date, datetime]``, or ``["", ""]`` when the input does not parse."""
    dt = en_to_cn_datetime(en)
    return F.array(F.coalesce(F.substring(dt, 1, 10), F.lit("")), F.coalesce(dt, F.lit("")))


def merge_date_time(date: Column | str, time: Column | str) -> Column:
    """H4: ``date + ' ' + time``."""
    return F.concat(_c(date), F.lit(" "), _c(time))


def parse_day(day: Column | str) -> Column:
    """``yyyyMMdd`` (string or int) to a date; NULL when malformed."""
    return F.try_to_date(_c(day).cast("string"), "yyyyMMdd")


def add_days(day: Column | str, offset: int, out_format: str = "yyyyMMdd") -> Column:
    """``yyyyMMdd`` plus ``offset`` days, formatted (``yyyyMMdd`` or ``yyyy-MM-dd``)."""
    return F.date_format(F.date_add(parse_day(day), offset), out_format)


def date_cn(moment: Column | str, offset: int = 0) -> Column:
    """H8: a date or timestamp plus ``offset`` days as ``yyyy-MM-dd``."""
    return F.date_format(F.date_add(F.to_date(_c(moment)), offset), "yyyy-MM-dd")


def is_sunday(d: Column | str) -> Column:
    """H11."""
    return F.dayofweek(_c(d)) == 1


def is_monday(d: Column | str) -> Column:
    """H11."""
    return F.dayofweek(_c(d)) == 2


def is_weekend(d: Column | str) -> Column:
    """Saturday or Sunday."""
    return F.dayofweek(_c(d)).isin(1, 7)


def week_range(d: Column | str) -> Column:
    """The seven days ending on ``d``, as ``yyyy-MM-dd~yyyy-MM-dd``."""
    day = F.to_date(_c(d))
    return F.concat(F.date_format(F.date_sub(day, 6), "yyyy-MM-dd"), F.lit("~"), F.date_format(day, "yyyy-MM-dd"))


# Moment formats of the original utilities.
DETAIL_FORMAT = "yyyy-MM-dd HH:mm:ss"
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
END_OF_DAY_FORMAT = "yyyy-MM-dd 23:59:59"


def format_moment(ts: Column | str, pattern: str = DETAIL_FORMAT) -> Column:
    """A timestamp as ``yyyy-MM-dd HH:mm:ss`` (or the minute / end-of-day patterns)."""
    return F.date_format(_c(ts), pattern)


def days_gap(d1: Column | str, d2: Column | str) -> Column:
    """Whole days from ``d2`` to ``d1``, both ``yyyyMMdd``."""
    return F.datediff(parse_day(d1), parse_day(d2))


def hour_of(datetime: Column | str) -> Column:
    """Two-digit hour of a ``yyyy-MM-dd HH:mm:ss`` string."""
    return F.substring(_c(datetime), 12, 2)
