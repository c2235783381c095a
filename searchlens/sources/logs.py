"""Log scans (A1, A2).

A log table is any DataFrame (``spark.table`` of a day-partitioned table, or
``spark.read.parquet``). Projection and filters are applied right after the
read so Catalyst pushes them into the scan and prunes day partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators.filters import filter_window


# Days that a table of days may have to be broadcast: a hundred years.
MAX_DAYS = 36_525


def scan_log(
    log: DataFrame,
    columns: Mapping[str, str | Column] | Sequence[str],
    where: Column | str | None = None,
    as_of: str | int | None = None,
    days: int | None = None,
    day_col: str = "key_day",
) -> DataFrame:
    """A1: filter a log (window ``day_col > as_of - days``, then ``where``), then pick and rename columns.

    ``columns`` maps output names to input columns or expressions; a plain
    list keeps names.
    """
    df = log
    if as_of is not None and days is not None:
        df = filter_window(df, as_of, days, day_col=day_col)
    if where is not None:
        df = df.where(where)
    if isinstance(columns, Mapping):
        return df.select(*[(c if isinstance(c, Column) else df[c]).alias(name) for name, c in columns.items()])
    return df.select(*columns)


def read_log_days(spark: SparkSession, source: str, as_of: str | int, days: int, day_col: str = "key_day") -> DataFrame:
    """A2's reader: the last ``days`` days of a day-partitioned log (a table name or a parquet directory).

    The window is a filter on the partition column, so Spark lists and reads
    only the matching day directories (``PartitionFilters`` in the plan).
    """
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return filter_window(df, as_of, days, day_col=day_col)


def read_log_on(log: DataFrame, days: DataFrame, day_col: str = "key_day") -> DataFrame:
    """A1/A2 for days that a table lists: rows of a day-partitioned log whose day is in ``days``.

    ``days`` has the days in ``day_col``, each once, and as a rule a condition
    of its own. The days are counted, and at most ``MAX_DAYS`` are broadcast;
    Spark then reads only their partitions of the log (dynamic pruning).
    """
    days = days.select(day_col)
    if days.limit(MAX_DAYS + 1).count() <= MAX_DAYS:
        days = F.broadcast(days)
    return log.join(days, day_col)


def save_log_days(log: DataFrame, table: str, path: str, day_col: str = "key_day") -> DataFrame:
    """``log`` as a day-partitioned table of the session's catalog, its files under ``path``, read back by its name.

    Rows are dealt by day and salt, so that no task writes a whole day; each
    task writes few days.
    """
    salts = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*log.columns), F.lit(salts))
    log.repartition(F.col(day_col), salt).write.format("parquet").partitionBy(day_col).option("path", path).saveAsTable(table)
    return log.sparkSession.table(table)


def log_retrieval(
    log: DataFrame,
    as_of: str | int,
    days: int,
    condition: str,
    fields: Sequence[str],
    results: Sequence[str],
    day_col: str = "key_day",
) -> DataFrame:
    """A2: last ``days`` days of a log; select ``fields``, keep ``condition``, select ``results``.

    All three lists are SQL expression strings, as the presets of the
    original jobs are. The window filter goes first so it reaches the scan.
    """
    return filter_window(log, as_of, days, day_col=day_col).selectExpr(*fields).where(condition).selectExpr(*results)


# --- C15: presets for ``log_retrieval`` (fields, condition, results), as SQL text ---

def _in_list(types: Sequence[str]) -> str:
    return "(" + ", ".join("'" + t.replace("'", "''") + "'" for t in types) + ")"


def assoc_preset(types: Sequence[str], hour_source: str = "datetime",
                 hour_expr: str = "substring(datetime, 12, 2)") -> tuple[list[str], str, list[str]]:
    """Plays for the association job: user, sid, two-digit hour, account as bigint.

    With a ``datetime`` string source, rows whose datetime is too short to
    hold an hour are dropped, as in the original condition.
    """
    fields = ["user_id", "content_type", "sid", hour_source, "CAST(account_id AS BIGINT) AS account_id"]
    cond = (f"((user_id IS NOT NULL AND length(user_id) = {config.USER_ID_LENGTH}) OR account_id IS NOT NULL) "
            f"AND sid IS NOT NULL AND length(sid) > 0 AND content_type IN {_in_list(types)}")
    if hour_source == "datetime":
        cond += " AND length(datetime) > 14"
    return fields, cond, ["user_id", "sid", f"{hour_expr} AS time", "account_id"]


def search_preset(types: Sequence[str], with_type: bool = True) -> tuple[list[str], str, list[str]]:
    """Search rows with text, counted as 1 each (with or without the log's type)."""
    results = ["search_text", "content_type", "sid", "1 AS num"] if with_type else ["search_text", "sid", "1 AS num"]
    return (["search_text", "content_type", "sid"],
            f"search_text IS NOT NULL AND search_text != '' AND content_type IN {_in_list(types)}", results)


def path_search_preset(types: Sequence[str], home_types: Sequence[str]) -> tuple[list[str], str, list[str]]:
    """Search rows whose text is read from a navigation path (H2)."""
    from ..functions.scalars import home_path_pattern
    code = f"nullif(regexp_extract(path, '{home_path_pattern(home_types)}', 3), '')"
    return (["path", "content_type", "sid"], f"content_type IN {_in_list(types)}",
            [f"{code} AS search_text", "content_type", "sid", "1 AS num"])


def view_preset(types: Sequence[str], with_event: bool = True, min_seconds: int = config.MIN_PLAY_SECONDS,
                max_seconds: int = config.MAX_PLAY_SECONDS,
                events: Sequence[str] = config.VALID_PLAY_EVENTS) -> tuple[list[str], str, list[str]]:
    """Valid views for the heat job (C6, or C7 without the event test)."""
    fields = ["sid", "content_type", "duration"] + (["event"] if with_event else [])
    cond = f"duration IS NOT NULL AND duration < {max_seconds} AND duration > {min_seconds} AND content_type IN {_in_list(types)}"
    if with_event:
        cond += f" AND event IN {_in_list(events)} AND sid IS NOT NULL AND sid != ''"
    return fields, cond, ["sid", "content_type"]
