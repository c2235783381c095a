"""Row filters.

All are plain ``where`` clauses so Catalyst pushes them into the scan
(parquet ``PushedFilters``, JDBC ``WHERE``) and prunes partitions.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType

from .. import config


def _parse_day(day: str | int | _dt.date) -> _dt.date:
    if isinstance(day, _dt.date):
        return day
    s = str(day).replace("-", "")
    return _dt.date(int(s[:4]), int(s[4:6]), int(s[6:8]))


def day_add(day: str | int | _dt.date, offset: int) -> str:
    """``yyyyMMdd`` of ``day + offset`` days (a job parameter, not a column)."""
    return (_parse_day(day) + _dt.timedelta(days=offset)).strftime("%Y%m%d")


def window_start(as_of: str | int, days: int) -> str:
    """Exclusive start of a trailing window: ``days`` back gives as_of and the days-1 before."""
    return day_add(as_of, -days)


def _day_literal(df: DataFrame, day_col: str, day: str) -> Column:
    dtype = df.schema[day_col].dataType
    if isinstance(dtype, (IntegerType, LongType)):
        return F.lit(int(day))
    if isinstance(dtype, DateType):
        return F.lit(_parse_day(day))
    if isinstance(dtype, StringType):
        return F.lit(day)
    raise TypeError(f"unsupported day column type {dtype}")


def filter_content_type(df: DataFrame, types: Iterable[str], col: str = "content_type") -> DataFrame:
    """Content type in a list (all, long, short, or short and long)."""
    return df.where(F.col(col).isin(list(types)))


def valid_identity(user_col: str = "user_id", account_col: str = "account_id", user_id_length: int = config.USER_ID_LENGTH) -> Column:
    u, a = F.col(user_col), F.col(account_col)
    return (u.isNotNull() & (F.length(u) == user_id_length)) | a.isNotNull()


def filter_identity(df: DataFrame, user_col: str = "user_id", account_col: str = "account_id",
                    user_id_length: int = config.USER_ID_LENGTH) -> DataFrame:
    """User id present with the right length, or account id present."""
    return df.where(valid_identity(user_col, account_col, user_id_length))


def present(col: str) -> Column:
    """Not NULL and not empty; written as ``!= ''`` so the scan can take it as a pushed filter."""
    c = F.col(col)
    return c.isNotNull() & (c != F.lit(""))


def filter_present(df: DataFrame, col: str) -> DataFrame:
    """A string column is not NULL and not empty (video id, search text)."""
    return df.where(present(col))


def filter_window(df: DataFrame, as_of: str | int, days: int, day_col: str = "key_day") -> DataFrame:
    """``day_col > as_of - days`` (start exclusive, no end), compared in the column's own type."""
    return df.where(F.col(day_col) > _day_literal(df, day_col, window_start(as_of, days)))


def filter_since(df: DataFrame, start: str | int, day_col: str = "key_day", inclusive: bool = True) -> DataFrame:
    """C16's day test: ``day_col >= start`` (or ``>``)."""
    lit = _day_literal(df, day_col, str(start).replace("-", ""))
    return df.where(F.col(day_col) >= lit if inclusive else F.col(day_col) > lit)


def valid_play(duration_col: str = "duration", event_col: str | None = "event",
               min_seconds: float = config.MIN_PLAY_SECONDS, max_seconds: float = config.MAX_PLAY_SECONDS,
               events: Iterable[str] = config.VALID_PLAY_EVENTS) -> Column:
    d = F.col(duration_col)
    cond = d.isNotNull() & (d > min_seconds) & (d < max_seconds)
    if event_col is not None:
        cond = cond & F.col(event_col).isin(list(events))
    return cond


def filter_valid_play(df: DataFrame, duration_col: str = "duration", event_col: str | None = "event",
                      min_seconds: float = config.MIN_PLAY_SECONDS, max_seconds: float = config.MAX_PLAY_SECONDS,
                      events: Iterable[str] = config.VALID_PLAY_EVENTS) -> DataFrame:
    """C6 (and C7 with ``event_col=None``): duration strictly inside the bounds, ended by a valid event."""
    return df.where(valid_play(duration_col, event_col, min_seconds, max_seconds, events))


def filter_catalog(df: DataFrame, types: Iterable[str] | None = None, type_values: Iterable[int] = (1,),
                   statuses: Iterable[int] = (1,), video_types: Iterable[int] = (0, 1),
                   app_version_flag: int | None = None, type_col: str = "content_type") -> DataFrame:
    """C8 (and C9 with ``app_version_flag=0``): playable catalog rows."""
    cond = (F.col("type").isin(list(type_values)) & F.col("status").isin(list(statuses))
            & F.col("video_type").isin(list(video_types)))
    if types is not None:
        cond = cond & F.col(type_col).isin(list(types))
    if app_version_flag is not None:
        cond = cond & (F.col("app_version_flag") == app_version_flag)
    return df.where(cond)


def filter_region(df: DataFrame, risk_free: bool, title_col: str = "title") -> DataFrame:
    """Titled rows; with ``risk_free`` also ``risk_flag = 0`` (region block)."""
    cond = F.col(title_col).isNotNull()
    if risk_free:
        cond = cond & (F.col("risk_flag") == 0)
    return df.where(cond)


def filter_account(df: DataFrame, account_col: str = "account_id") -> DataFrame:
    """Account present."""
    return df.where(F.col(account_col).isNotNull())
