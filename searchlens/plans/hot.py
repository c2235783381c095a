"""Hot-word jobs (K1-K4): the most searched videos per content type.

Plan of every variant: log scan with pushed filters -> count per
(text, type, sid) with map-side combine -> rollup per video (argmax text,
sum) with map-side combine -> join titles, one row per video by now ->
per-type top-k as a ``WindowGroupLimit``. The overall top-k comes from the
per-type ones, which hold it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import add_days
from ..functions.scalars import joined_line
from ..functions.titles import strip_quotes
from ..operators.aggregates import search_counts, unique_searchers, video_rollup
from ..operators.filters import filter_region, present
from ..operators.ranking import top_k
from ..operators.sets import union_logs
from ..sinks.messages import document_message, message_frame, ranked_document
from ..sources.logs import scan_log

SEARCH_COLUMNS = ("search_text", "content_type", "sid")


def search_rows(log: DataFrame, types: Sequence[str], as_of: str | int, days: int,
                columns: Sequence[str] = SEARCH_COLUMNS) -> DataFrame:
    """Log rows of the given types with search text, in the trailing window."""
    return scan_log(log, list(columns), where=F.col("content_type").isin(list(types)) & present("search_text"),
                    as_of=as_of, days=days)


def catalog_titles(catalog: DataFrame, risk_free: bool) -> DataFrame:
    """D3's right side: titled catalog rows (region-blocked if ``risk_free``), quotes removed."""
    return filter_region(catalog, risk_free).select("sid", strip_quotes("title").alias("title"), "status")


def with_titles(rollup: DataFrame, catalog: DataFrame, risk_free: bool) -> DataFrame:
    """D3 after E5: a row per catalog title and status of each rolled-up video.

    A catalog row that is listed k times with the same title and status
    counts k times, as joining before the rollup would make it.
    """
    titles = catalog_titles(catalog, risk_free).groupBy("sid", "title", "status").agg(F.count(F.lit(1)).alias("_copies"))
    return rollup.join(titles, "sid").withColumn("num", F.col("num") * F.col("_copies")).select(
        "sid", "content_type", "title", "status", "search_code", "num")


def rollup_with_titles(counts: DataFrame, catalog: DataFrame, risk_free: bool) -> DataFrame:
    """E5 + D3: columns sid, content_type, title, status, search_code, num."""
    return with_titles(video_rollup(counts, ("sid", "content_type")), catalog, risk_free)


# Ranking of videos: most searched first, then sid (full tie-break).
def hot_order() -> list[F.Column]:
    return [F.desc("num"), F.asc("sid"), F.asc("title"), F.asc("status"), F.asc("content_type")]


def hot_rollup(play_log: DataFrame, catalog: DataFrame, as_of: str | int, days: int = config.HOT_DAYS,
               types: Sequence[str] = config.SHORT_VIDEO_TYPES + config.LONG_VIDEO_TYPES,
               unique: bool = True, risk_free: bool = True, extra_logs: Sequence[DataFrame] = ()) -> DataFrame:
    """K2/K3 up to the rollup: unique searchers (K2) or all searches (K3).

    ``extra_logs`` (G5) are further logs of the same columns; a user is
    unique within each log, and the logs' counts add up. Their rows are
    tagged with the log, so that one distinct serves all.
    """
    logs = [play_log, *extra_logs]
    if not unique:
        counts = search_counts(union_logs(*[search_rows(log, types, as_of, days) for log in logs]))
        return rollup_with_titles(counts, catalog, risk_free)
    cols = ("user_id",) + SEARCH_COLUMNS
    if len(logs) == 1:
        return rollup_with_titles(unique_searchers(search_rows(play_log, types, as_of, days, cols)), catalog, risk_free)
    tagged = [search_rows(log, types, as_of, days, cols).withColumn("log", F.lit(k)) for k, log in enumerate(logs)]
    return rollup_with_titles(searchers_by_log(union_logs(*tagged)), catalog, risk_free)


def searchers_by_log(tagged: DataFrame) -> DataFrame:
    """E2 within G5: distinct searchers per (text, type, sid), a user once in each log; NULL users of a log count once.

    ``tagged`` has ``log``, ``user_id`` and the search columns. One distinct on all five columns, then a count.
    """
    return search_counts(tagged.select("log", "user_id", *SEARCH_COLUMNS).distinct())


def split_log(log: DataFrame, members: Sequence[tuple[F.Column, F.Column]], user_col: str = "user_id") -> DataFrame:
    """G5 over one table that holds several logs: a row per log that a row of the table belongs to.

    ``members`` gives the condition and the search text of each log. The
    table is read once; rows without text, or in no log, go.
    """
    # An entry per log, without text where the row is not in it.
    entries = [F.struct(F.lit(k).alias("log"), F.when(cond, text).alias("search_text")) for k, (cond, text) in enumerate(members)]
    text = F.col("entry.search_text")
    return (log.select(user_col, "content_type", "sid", F.explode(F.array(*entries)).alias("entry"))
            .where(text.isNotNull() & (F.length(text) > 0))
            .select(F.col("entry.log").alias("log"), F.col(user_col).alias("user_id"), text.alias("search_text"), "content_type", "sid"))


def hot_ranked(rollup: DataFrame, top_n: int = config.TOP_N) -> DataFrame:
    """the top videos of each type, all columns of the rollup and ``rank``."""
    return top_k(rollup, top_n, hot_order(), ["content_type"])


def hot_by_type(rollup: DataFrame, top_n: int = config.TOP_N) -> DataFrame:
    """top videos per type: content_type, rank, sid, search_code, title, num."""
    return hot_ranked(rollup, top_n).select("content_type", "rank", "sid", "search_code", "title", "num")


def hot_total(rollup: DataFrame, top_n: int = config.TOP_N) -> DataFrame:
    """top videos over all types: rank, sid, search_code, title, content_type, num.

    Each is among the top of its own type by the same order, so only those are ranked.
    """
    return top_k(hot_ranked(rollup, top_n).drop("rank"), top_n, hot_order()).select(
        "rank", "sid", "search_code", "title", "content_type", "num")


def hot_entry() -> F.Column:
    return F.struct(F.col("sid"), F.col("search_code").alias("searchCode"), F.col("title"),
                    F.col("content_type").alias("contentType"))


def hot_payload(rollup: DataFrame, topic: str = config.TOPIC_HOT, top_n: int = config.TOP_N) -> DataFrame:
    """K2/K3 message: ``{type: [{sid, searchCode, title, contentType}], ..., total: [...]}``, from one ranking."""
    doc = ranked_document(hot_ranked(rollup, top_n), "content_type", "rank", hot_entry(), hot_order(), top_n)
    return document_message(doc, topic)


def hot_lines_from_rollup(rollup: DataFrame, as_of: str | int, types: Sequence[str] = config.ALL_VIDEO_TYPES,
                          top_n: int = config.TOP_N) -> DataFrame:
    """F3 + H18: top videos of each listed type as ``title||code||sid||type||status||amount||date`` lines.

    A missing status is 0.

    One ranking pass for all types; a type without rows gives no lines.
    """
    top = top_k(rollup.where(F.col("content_type").isin(list(types))), top_n, hot_order(), ["content_type"])
    day = add_days(F.lit(str(as_of).replace("-", "")), 0, "yyyy-MM-dd")
    return top.select("content_type", "rank",
                      joined_line("title", "search_code", "sid", "content_type", F.coalesce("status", F.lit(0)), "num", day).alias("line"))


def hot_lines(detail_log: DataFrame, play_log: DataFrame, catalog: DataFrame, as_of: str | int,
              days: int = config.HOT_DAYS, types: Sequence[str] = config.ALL_VIDEO_TYPES,
              top_n: int = config.TOP_N) -> DataFrame:
    """K1: browse and play rows of all types; the catalog's type replaces the log's; line form."""
    rows = union_logs(search_rows(detail_log, types, as_of, days), search_rows(play_log, types, as_of, days))
    counts = rows.groupBy("search_text", "sid").agg(F.count(F.lit(1)).alias("num"))
    # One row per video meets the catalog: its types, each as often as it is listed, and then its titles.
    kinds = catalog.where(F.col("content_type").isin(list(types))).groupBy("sid", "content_type").agg(
        F.count(F.lit(1)).alias("_listed"))
    typed = video_rollup(counts, ("sid",)).join(kinds, "sid").withColumn("num", F.col("num") * F.col("_listed"))
    return hot_lines_from_rollup(with_titles(typed, catalog, risk_free=False), as_of, types, top_n)


def hot_lines_split_types(detail_log: DataFrame, play_log: DataFrame, catalog: DataFrame, as_of: str | int,
                          days: int = config.HOT_DAYS, long_types: Sequence[str] = config.LONG_VIDEO_TYPES,
                          short_types: Sequence[str] = config.SHORT_VIDEO_TYPES,
                          line_types: Sequence[str] = config.ALL_VIDEO_TYPES, top_n: int = config.TOP_N) -> DataFrame:
    """K4: browse rows of long types plus play rows of short types, the log's own type; line form."""
    rows = union_logs(search_rows(detail_log, long_types, as_of, days), search_rows(play_log, short_types, as_of, days))
    rollup = rollup_with_titles(search_counts(rows), catalog, risk_free=False)
    return hot_lines_from_rollup(rollup, as_of, line_types, top_n)


def hot_lines_payload(lines: DataFrame, topic: str = config.TOPIC_HOT_LINES) -> DataFrame:
    """One message per line."""
    return message_frame(lines, topic, F.col("line"), F.col("content_type"))
