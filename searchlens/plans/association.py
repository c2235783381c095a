"""Association jobs (K7-K9): most played videos per type, and each user's preferred types by time of day.

Plays are counted before they meet the catalog: per video for the top
lists, per (user, account, hour, video) for the profiles. No play crosses a
join, and a video that a third of all plays are of is spread over its users.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..operators.aggregates import preference_shares, profile_documents
from ..operators.filters import filter_account, filter_catalog, present, valid_identity
from ..operators.joins import join_catalog_type
from ..operators.ranking import top_k
from ..sinks.messages import document_message, message_frame, ranked_document
from ..sources.logs import scan_log


def assoc_plays(play_log: DataFrame, as_of: str | int, days: int = config.ASSOC_DAYS,
                types: Sequence[str] = config.ALL_VIDEO_TYPES, user_id_length: int = config.USER_ID_LENGTH) -> DataFrame:
    """A1 + C1-C3 + C5: plays with a valid identity and a video id, of the listed types."""
    cond = valid_identity("user_id", "account_id", user_id_length) & present("sid") & F.col("content_type").isin(list(types))
    return scan_log(play_log, {"sid": "sid", "account_id": "account_id", "time": "key_hour", "user_id": "user_id",
                               "content_type": "content_type"}, where=cond, as_of=as_of, days=days)


def playable_catalog(catalog: DataFrame, types: Sequence[str] = config.ALL_VIDEO_TYPES,
                     app_version_flag: int | None = None) -> DataFrame:
    """C8 (+ C9): playable catalog rows, ``(id, sid, content_type)``."""
    return filter_catalog(catalog, types, app_version_flag=app_version_flag).select("id", "sid", "content_type")


def joined_plays(plays: DataFrame, catalog: DataFrame, split_heavy: bool = False) -> DataFrame:
    """Plays with the catalog's content type; ``split_heavy`` for raw plays, of which one video may hold a third."""
    return join_catalog_type(plays, catalog.select("sid", "content_type"), split_heavy=split_heavy)


def type_play_counts(plays: DataFrame, catalog: DataFrame, key: str = "sid") -> DataFrame:
    """E3 after D1, combined before the join: ``(content_type, key, n)``.

    ``key`` is ``sid`` or the catalog's numeric ``id`` (H15: the catalog
    maps the string sid to its number).
    """
    per_sid = plays.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))
    joined = per_sid.join(catalog.select("sid", "id", "content_type"), "sid")
    # The catalog id is its primary key (one sid per id), so grouping by sid as
    # well changes nothing but lets the sum reuse the per-sid partitioning.
    keys = ["content_type", "sid"] + ([key] if key != "sid" else [])
    return joined.groupBy(*keys).agg(F.sum("n").alias("n")).select("content_type", key, "n")


def top_videos(counts: DataFrame, key: str = "sid", top_n: int = config.TOP_N) -> DataFrame:
    """``content_type, rank, key, n``; ties by key ascending."""
    return top_k(counts, top_n, [F.desc("n"), F.asc(key)], ["content_type"]).select("content_type", "rank", key, "n")


def assoc_top_videos(play_log: DataFrame, catalog: DataFrame, as_of: str | int, days: int = config.ASSOC_DAYS,
                     types: Sequence[str] = config.ALL_VIDEO_TYPES, app_version_flag: int | None = 0,
                     key: str = "sid", top_n: int = config.TOP_N) -> DataFrame:
    """K9 (``app_version_flag=0``), K8 (``None``), K7 (``key="id"``)."""
    plays = assoc_plays(play_log, as_of, days, types)
    cat = playable_catalog(catalog, types, app_version_flag)
    return top_videos(type_play_counts(plays, cat, key), key, top_n)


def top_videos_payload(top: DataFrame, key: str = "sid", topic: str = config.TOPIC_TOP_VIDEOS) -> DataFrame:
    """Message ``{type: [key, ...]}``, keys in rank order."""
    return document_message(ranked_document(top, "content_type", "rank", F.col(key)), topic)


def preference_rows(play_log: DataFrame, catalog: DataFrame, as_of: str | int, days: int = config.ASSOC_DAYS,
                    types: Sequence[str] = config.ALL_VIDEO_TYPES,
                    bands=config.BANDS, all_time: str = config.ALL_TIME) -> DataFrame:
    """``user_id, account_id, band, content_type, n, score, position`` for all bands."""
    plays = filter_account(assoc_plays(play_log, as_of, days, types))
    counts = plays.groupBy("user_id", "account_id", "time", "sid").agg(F.count(F.lit(1)).alias("n"))
    typed = joined_plays(counts, playable_catalog(catalog, types))
    return preference_shares(typed, "user_id", "account_id", "time", "content_type", bands, all_time, count_col="n")


def profile_payload(shares: DataFrame, topic: str = config.TOPIC_USER_TYPES,
                    band_order: Sequence[str] = (config.ALL_TIME,) + tuple(b for b, _ in config.BANDS)) -> DataFrame:
    """E8 + B2: one message per (user, account): ``{userId, accountId, allTime: [...], noon: ...}``."""
    docs = profile_documents(shares, band_order=band_order)
    value = F.to_json(F.struct(F.col("user_id").alias("userId"), F.col("account_id").alias("accountId"),
                               *[F.col(b) for b in band_order]))
    key = F.concat_ws(":", F.coalesce(F.col("user_id"), F.lit("")), F.col("account_id").cast("string"))
    return message_frame(docs, topic, value, key)
