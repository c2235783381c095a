"""Editorial hot lists (K5, K6) and the kids catalog variants of K6.

Editorial lists are sampled, not ranked: ``k`` rows per type and overall in
a seeded hash order (repeatable, without replacement). The kids variants
attach a title search code computed from a readings table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.titles import search_code, title_readings
from ..operators.filters import filter_since, present
from ..operators.joins import keep_valid
from ..operators.ranking import seeded_order, seeded_sample
from ..operators.sets import union_with_type
from ..sinks.messages import document_message, ranked_document

EDITORIAL_OUT = ("content_type", "rank", "sid", "search_code", "title")


def _named(parsed: DataFrame) -> DataFrame:
    return parsed.withColumnRenamed("search_text", "search_code")


def editorial_sample(parsed: DataFrame, seed: int = 42, k: int = config.TOP_N) -> DataFrame:
    """``k`` rows per content type: content_type, rank, sid, search_code, title."""
    return seeded_sample(_named(parsed), k, seed, "sid", ["content_type"]).select(*EDITORIAL_OUT)


def editorial_sample_total(parsed: DataFrame, seed: int = 42, k: int = config.TOP_N) -> DataFrame:
    """``k`` rows over all types: rank, sid, search_code, title, content_type."""
    return seeded_sample(_named(parsed), k, seed, "sid").select("rank", "sid", "search_code", "title", "content_type")


def editorial_payload(parsed: DataFrame, seed: int = 42, topic: str = config.TOPIC_EDITORIAL,
                      k: int = config.TOP_N) -> DataFrame:
    """``{type: [{sid, searchCode, title, contentType}], ..., total: [...]}``.

    The overall sample takes the first rows of the same seeded order as the
    samples per type, so it is read off those.
    """
    entry = F.struct(F.col("sid"), F.col("search_code").alias("searchCode"), F.col("title"),
                     F.col("content_type").alias("contentType"))
    named = _named(parsed)
    top = seeded_sample(named, k, seed, "sid", ["content_type"])
    return document_message(ranked_document(top, "content_type", "rank", entry, seeded_order(named, seed, "sid"), k), topic)


def with_search_code(df: DataFrame, readings: DataFrame, title_col: str = "title") -> DataFrame:
    """Adds ``search_code`` (initials of the first spelling, at most four)."""
    return title_readings(df, readings, title_col).withColumn("search_code", search_code("readings")).drop("readings")


def kids_catalog_codes(programs: DataFrame, subjects: DataFrame, readings: DataFrame,
                       limit: int | None = None) -> DataFrame:
    """K6, first commented version (G4, F9, H25): ``sid, content_type, title, search_code``.

    ``programs``: ``(id, sid, title, content_type, status)``; ``subjects``:
    ``(sid, title, status)``, typed ``course_subject``. Only status-1 rows
    with sid and title. ``limit`` keeps the first rows by id (the original's
    ``limit 30``); default all.
    """
    p = programs.where(F.col("sid").isNotNull() & F.col("title").isNotNull() & (F.col("status") == 1))
    if limit is not None:
        p = p.orderBy("id").limit(limit)
    p = p.select("sid", "content_type", "title")
    s = subjects.where(F.col("sid").isNotNull() & F.col("title").isNotNull() & (F.col("status") == 1)).select("sid", "title")
    both = union_with_type(p, s, config.COURSE_SUBJECT_TYPE)
    return with_search_code(both, readings)


def kids_play_rank(kids_play: DataFrame, valid_sids: DataFrame, readings: DataFrame, start_day: str | int,
                   day_col: str = "day_p") -> DataFrame:
    """K6, second commented version.

    Distinct (user, video, title, type) plays since ``start_day`` are counted
    per (title, type, video), kept when the video is valid, and given a
    search code; sorted by plays, most first: ``sid, content_type, title,
    search_code, num``. The sort is a distributed range sort, not a rank.
    """
    plays = filter_since(kids_play, start_day, day_col).where(present("parent_sid") & F.col("parent_title").isNotNull())
    distinct = plays.select("user_id", F.col("parent_sid").alias("sid"), F.col("parent_title").alias("title"),
                            "content_type").distinct()
    counts = distinct.groupBy("title", "content_type", "sid").agg(F.count(F.lit(1)).alias("num"))
    valid = keep_valid(counts, valid_sids)
    coded = with_search_code(valid, readings)
    return coded.select("sid", "content_type", "title", "search_code", "num").orderBy(
        F.desc("num"), F.asc("sid"), F.asc("title"), F.asc("content_type"))
