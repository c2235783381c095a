"""Heat (K10) and voice scores.

Heat: view counts per (type, sid) are computed once; the per-type top-k
mean has one row per listed type, so it is broadcast back onto the counts
(the count exchange is reused, not recomputed). Voice: one day of the
score matrix is summed per code and joined to the catalog by numeric id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.scalars import heat_score, json_of
from ..operators.aggregates import play_counts, score_sums, type_means
from ..operators.filters import day_add, present, valid_play
from ..operators.joins import join_scores_by_id, join_type_means
from ..operators.ranking import top_k
from ..sinks.messages import message_frame
from ..sources.catalog import scan_score_matrix
from ..sources.logs import scan_log


def valid_views(play_log: DataFrame, as_of: str | int, days: int = config.HEAT_DAYS,
                types: Sequence[str] = config.LONG_VIDEO_TYPES) -> DataFrame:
    """A1 + C1 + C6 + C3 + C5: valid plays of long types, ``(sid, content_type)``."""
    cond = F.col("content_type").isin(list(types)) & valid_play("duration", "event") & present("sid")
    return scan_log(play_log, ["sid", "content_type"], where=cond, as_of=as_of, days=days)


def view_counts(play_log: DataFrame, as_of: str | int, days: int = config.HEAT_DAYS,
                types: Sequence[str] = config.LONG_VIDEO_TYPES) -> DataFrame:
    """``content_type, sid, n``."""
    return play_counts(valid_views(play_log, as_of, days, types), ["content_type", "sid"])


def top_viewed(counts: DataFrame, base_n: int = config.HEAT_BASE_N) -> DataFrame:
    """``content_type, rank, sid, n`` for the ``base_n`` most viewed of each type."""
    return top_k(counts, base_n, [F.desc("n"), F.asc("sid")], ["content_type"]).select("content_type", "rank", "sid", "n")


def top_mean_views(counts: DataFrame, base_n: int = config.HEAT_BASE_N) -> DataFrame:
    """``content_type, mean_views`` over each type's top ``base_n``."""
    return type_means(top_viewed(counts, base_n))


def heat_scores(counts: DataFrame, base_n: int = config.HEAT_BASE_N) -> DataFrame:
    """H1 after D5: ``sid, content_type, score`` for every counted video."""
    joined = join_type_means(counts, top_mean_views(counts, base_n))
    return joined.select("sid", "content_type", heat_score("n", "mean_views").alias("score"))


def heat_payload(scores: DataFrame, topic: str = config.TOPIC_HEAT) -> DataFrame:
    """One ``{sid, score, type: "vv"}`` message per video."""
    return message_frame(scores, topic, json_of(sid="sid", score="score", type=F.lit("vv")), F.col("sid"))


def voice_scores(score_matrix: DataFrame, catalog: DataFrame, as_of: str | int,
                 types: Sequence[str] = config.LONG_VIDEO_TYPES, days_back: int = 1) -> DataFrame:
    """yesterday's scores of long types, summed per code, with catalog sid, title, type.

    ``catalog`` holds ``(id, sid, title, content_type)``.
    """
    day = scan_score_matrix(score_matrix, day_add(as_of, -days_back))
    sums = score_sums(day.where(F.col("content_type").isin(list(types))))
    cat = catalog.where(F.col("content_type").isin(list(types))).select("id", "sid", "title", "content_type")
    return join_scores_by_id(sums, cat).select("sid", "title", "content_type", "score")


def voice_payload(scores: DataFrame, topic: str = config.TOPIC_VOICE) -> DataFrame:
    """B2: one ``{sid, title, contentType, score}`` message per video."""
    return message_frame(scores, topic, json_of(sid="sid", title="title", contentType="content_type", score="score"),
                         F.col("sid"))
