"""Registered queries: one per operator key of the survey, over the stand-in views.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Job
windows are chosen to cover each log's whole day range, so every query
reads and works on whole tables; ``filter_window`` alone tests a real
trailing window. Doubles computed from sums or logarithms are rounded to
6 places, the precision the DuckDB oracle is compared at.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config
from .functions import dates as D
from .functions import scalars as S
from .functions import titles as T
from .functions.sql import register_sql_functions
from .operators import aggregates as A
from .operators import filters as C
from .operators.features import encode_categories, index_categories, vector_columns
from .operators.joins import join_titles
from .operators.sets import union_logs
from .plans import association as assoc
from .plans import editorial as ed
from .plans import heat
from .plans import hot
from .sources import fixtures as fx
from .scratch import scratch_path, written
from .sources.catalog import id_ranges, read_catalog, scan_score_matrix
from .sources.editorial import parse_editorial, short_lines
from .sources.logs import assoc_preset, log_retrieval, path_search_preset, read_log_days, read_log_on, save_log_days
from .streaming.mirror import mirror_messages, mirrored

LONG = fx.FIXTURE_LONG_TYPES
SHORT = fx.FIXTURE_SHORT_TYPES
ALL = fx.FIXTURE_ALL_TYPES
SHORT_LONG = SHORT + LONG

# Windows that cover each stand-in log's whole day range.
SEARCH_AS_OF, SEARCH_DAYS = "20011104", 2600     # search_log: 19950102..20011104
PLAY_AS_OF, PLAY_DAYS = "20240130", 30           # play_log: 20240101..20240130
# A real three-day trailing window, for the window filter itself.
WINDOW_AS_OF, WINDOW_DAYS = "20240120", 3
# The voice job reads yesterday's score partition.
VOICE_AS_OF = "20240131"
SAMPLE_SEED = 42
MIRROR_TOPICS = ("view", "click")
GAP_ORIGIN = "19950101"
CATALOG_PARTS = 5

Query = Callable[[SparkSession, str], DataFrame]


def _search_play(spark, d):
    return fx.search_log(spark, d).where(F.col("log_type") == "play")


def _search_detail(spark, d):
    return fx.search_log(spark, d).where(F.col("log_type") == "detail")


def _readings(spark: SparkSession) -> DataFrame:
    # A small pronunciation table (the dictionary itself is user data).
    rows = [("行", ["hang", "xing"]), ("乐", ["le", "yue"]), ("长", ["chang", "zhang"]), ("重", ["zhong", "chong"])]
    return spark.createDataFrame(rows, "ch string, readings array<string>")


def _subjects(spark, d):
    s = fx.read_table(spark, d, "supplier")
    return s.select(F.concat(F.lit("subject-"), F.col("s_suppkey").cast("string")).alias("sid"),
                    F.col("s_name").alias("title"),
                    F.when(F.col("s_acctbal") >= 0, 1).otherwise(0).alias("status"))


def _kids_play(spark, d):
    plays = fx.play_log(spark, d).select("user_id", "sid", "key_day")
    cat = fx.catalog(spark, d).select("sid", "title", "content_type")
    return plays.join(cat, "sid").select("user_id", F.col("sid").alias("parent_sid"), F.col("title").alias("parent_title"),
                                         "content_type", F.col("key_day").alias("day_p"))


def _r6(col: str) -> F.Column:
    return F.round(F.col(col), 6).alias(col)


# --- sources, filters ---

def q_scan_play_log(spark, d):
    return assoc.assoc_plays(fx.play_log(spark, d), PLAY_AS_OF, PLAY_DAYS, ALL)


def q_scan_catalog(spark, d):
    return read_catalog(fx.catalog(spark, d), ["sid", "content_type"], F.col("content_type").isin(list(ALL)))


def q_scan_score_matrix(spark, d):
    return scan_score_matrix(fx.score_matrix(spark, d), C.day_add(VOICE_AS_OF, -1))


def _play_table(spark, d):
    """The play log as a day-partitioned table of the session's catalog, made anew for each call."""
    name = f"play_log_{uuid.uuid4().hex}"
    save_log_days(fx.play_log(spark, d), name, scratch_path(spark, name))
    return name


def q_table_log_window(spark, d):
    """A7 with C5: the play log from a day on, read by its table's name; earlier partitions are not read."""
    log = read_log_days(spark, _play_table(spark, d), WINDOW_AS_OF, WINDOW_DAYS)
    return log.select("event_id", "user_id", "sid", "content_type", "key_day")


def _weekends(spark, d, day_col):
    """The weekend days of a calendar of all days with an event."""
    day = F.to_date("ts")
    calendar = fx.read_table(spark, d, "events").select(
        F.date_format(day, "yyyyMMdd").cast("int").alias(day_col), day.alias("day")).distinct()
    return written(calendar, "calendar").where(D.is_weekend("day"))


def q_weekend_plays(spark, d):
    """A1/A2 with H11: plays per weekend day and type; the days come from a calendar of all days with an event."""
    plays = read_log_on(spark.table(_play_table(spark, d)), _weekends(spark, d, "key_day"))
    return A.play_counts(plays, ["key_day", "content_type"])


def q_weekend_scores(spark, d):
    """A4: score sums of all weekend days' partitions of a day-partitioned score matrix."""
    name = f"score_matrix_{uuid.uuid4().hex}"
    matrix = save_log_days(fx.score_matrix(spark, d), name, scratch_path(spark, name), "partition_tag")
    scores = read_log_on(matrix, _weekends(spark, d, "partition_tag"), "partition_tag")
    return A.score_sums(scores).select("sid_or_subject_code", _r6("score"))


def q_catalog_id_ranges(spark, d):
    """The id ranges that the catalog is read in, with equally many rows in each."""
    return id_ranges(fx.catalog(spark, d), "id", CATALOG_PARTS)


def q_log_retrieval(spark, d):
    fields, cond, results = assoc_preset(ALL, hour_source="key_hour", hour_expr="lpad(CAST(key_hour AS STRING), 2, '0')")
    return log_retrieval(fx.play_log(spark, d), PLAY_AS_OF, PLAY_DAYS, cond, fields, results)


def q_log_retrieval_paths(spark, d):
    """The preset that reads its search text from paths, over every day of a path log."""
    log = fx.search_log(spark, d).select("sid", "content_type", "key_day").join(fx.path_log(spark, d), "sid")
    fields, cond, results = path_search_preset(SHORT_LONG, config.HOME_PATH_TYPES)
    return log_retrieval(log, SEARCH_AS_OF, SEARCH_DAYS, cond, fields, results)


def q_filter_content_type(spark, d):
    return C.filter_content_type(fx.play_log(spark, d), LONG).select("event_id", "sid", "content_type")


def q_filter_identity(spark, d):
    return C.filter_identity(fx.play_log(spark, d)).select("event_id", "user_id", "account_id")


def q_filter_search_text(spark, d):
    return C.filter_present(fx.search_log(spark, d), "search_text")


def q_filter_window(spark, d):
    return C.filter_window(fx.play_log(spark, d), WINDOW_AS_OF, WINDOW_DAYS).select("event_id", "key_day")


def q_filter_valid_play(spark, d):
    return C.filter_valid_play(fx.play_log(spark, d)).select("event_id", "sid", "content_type", "duration", "event")


def q_filter_valid_play_any_event(spark, d):
    """The duration test alone."""
    return C.filter_valid_play(fx.play_log(spark, d), event_col=None).select("event_id", "sid", "content_type", "duration")


def q_filter_catalog(spark, d):
    return C.filter_catalog(fx.catalog(spark, d), ALL).select("id", "sid", "content_type")


def q_parse_editorial(spark, d):
    return parse_editorial(fx.editorial_lines(spark, d), on_short="drop")


def q_clean_titles(spark, d):
    c = fx.catalog(spark, d)
    return c.select("sid", T.strip_quotes("title").alias("title_unquoted"), T.clean_title("title").alias("title_clean"))


# --- joins, unions, counts ---

def _plays_with_type(spark, d, split_heavy=False):
    plays = assoc.assoc_plays(fx.play_log(spark, d), PLAY_AS_OF, PLAY_DAYS, ALL)
    return assoc.joined_plays(plays, assoc.playable_catalog(fx.catalog(spark, d), ALL), split_heavy)


def q_join_plays_catalog(spark, d):
    """D1 on raw plays, split by heavy sids where the catalog is too large to broadcast."""
    return _plays_with_type(spark, d, split_heavy=True)


def q_join_counts_titles(spark, d):
    rows = hot.search_rows(_search_play(spark, d), SHORT_LONG, SEARCH_AS_OF, SEARCH_DAYS)
    return join_titles(A.search_counts(rows), hot.catalog_titles(fx.catalog(spark, d), risk_free=False), split_heavy=True)


def q_union_logs(spark, d):
    return union_logs(hot.search_rows(_search_detail(spark, d), ALL, SEARCH_AS_OF, SEARCH_DAYS),
                      hot.search_rows(_search_play(spark, d), ALL, SEARCH_AS_OF, SEARCH_DAYS))


def q_search_counts(spark, d):
    return A.search_counts(hot.search_rows(fx.search_log(spark, d), ALL, SEARCH_AS_OF, SEARCH_DAYS))


def q_unique_searchers(spark, d):
    rows = hot.search_rows(fx.search_log(spark, d), ALL, SEARCH_AS_OF, SEARCH_DAYS, ("user_id",) + hot.SEARCH_COLUMNS)
    return A.unique_searchers(rows)


def q_play_counts(spark, d):
    return A.play_counts(_plays_with_type(spark, d), ["content_type", "sid"])


def q_view_counts(spark, d):
    return heat.view_counts(fx.play_log(spark, d), PLAY_AS_OF, PLAY_DAYS, LONG)


def q_score_sums(spark, d):
    m = fx.score_matrix(spark, d).where(F.col("content_type").isin(list(LONG)))
    return A.score_sums(m).select("sid_or_subject_code", _r6("score"))


def q_table_profile(spark, d):
    return A.table_profile(fx.catalog(spark, d))


# --- hot ---

def _rollup(spark, d, unique, risk_free):
    return hot.hot_rollup(_search_play(spark, d), fx.catalog(spark, d), SEARCH_AS_OF, SEARCH_DAYS, SHORT_LONG,
                          unique=unique, risk_free=risk_free)


def q_video_rollup(spark, d):
    return _rollup(spark, d, unique=False, risk_free=False)


def q_hot_by_type(spark, d):
    return hot.hot_by_type(_rollup(spark, d, unique=True, risk_free=True))


def q_hot_by_type_all_regions(spark, d):
    return hot.hot_by_type(_rollup(spark, d, unique=False, risk_free=False))


def q_hot_total(spark, d):
    return hot.hot_total(_rollup(spark, d, unique=True, risk_free=True))


def q_hot_lines(spark, d):
    return hot.hot_lines(_search_detail(spark, d), _search_play(spark, d), fx.catalog(spark, d),
                         SEARCH_AS_OF, SEARCH_DAYS, ALL)


def q_hot_lines_split_types(spark, d):
    return hot.hot_lines_split_types(_search_detail(spark, d), _search_play(spark, d), fx.catalog(spark, d),
                                     SEARCH_AS_OF, SEARCH_DAYS, LONG, SHORT, ALL)


def q_hot_by_type_three_logs(spark, d):
    """Unique searchers of three logs in one pass; the third has all rows, its search text from the sid's path."""
    log = C.filter_window(C.filter_content_type(fx.search_log(spark, d), SHORT_LONG), SEARCH_AS_OF, SEARCH_DAYS)
    codes = fx.path_log(spark, d).select("sid", S.path_code_home("path", config.HOME_PATH_TYPES).alias("path_code"))
    tagged = hot.split_log(log.join(codes, "sid", "left"), [
        (F.col("log_type") == "play", F.col("search_text")),
        (F.col("log_type") == "detail", F.col("search_text")),
        (F.col("path_code").isNotNull(), F.col("path_code"))])
    return hot.hot_by_type(hot.rollup_with_titles(hot.searchers_by_log(tagged), fx.catalog(spark, d), risk_free=True))


def q_hot_payload(spark, d):
    return hot.hot_payload(_rollup(spark, d, unique=True, risk_free=True))


# --- association ---

def q_assoc_top_videos(spark, d):
    return assoc.assoc_top_videos(fx.play_log(spark, d), fx.catalog(spark, d), PLAY_AS_OF, PLAY_DAYS, ALL, app_version_flag=0)


def q_assoc_top_videos_all_versions(spark, d):
    return assoc.assoc_top_videos(fx.play_log(spark, d), fx.catalog(spark, d), PLAY_AS_OF, PLAY_DAYS, ALL, app_version_flag=None)


def q_assoc_top_videos_by_id(spark, d):
    return assoc.assoc_top_videos(fx.play_log(spark, d), fx.catalog(spark, d), PLAY_AS_OF, PLAY_DAYS, ALL,
                                  app_version_flag=None, key="id")


def _prefs(spark, d):
    return assoc.preference_rows(fx.play_log(spark, d), fx.catalog(spark, d), PLAY_AS_OF, PLAY_DAYS, ALL)


def q_preference_share(spark, d):
    return _prefs(spark, d).where(F.col("band") == config.ALL_TIME).select("user_id", "account_id", "content_type", "score")


def q_preference_bands(spark, d):
    return _prefs(spark, d).where(F.col("band") != config.ALL_TIME).select(
        "user_id", "account_id", "band", "content_type", "score")


def q_preference_profile(spark, d):
    return _prefs(spark, d).select("user_id", "account_id", "band", "position", "content_type", "score")


def q_assoc_payload(spark, d):
    return assoc.top_videos_payload(q_assoc_top_videos(spark, d))


def q_pref_payload(spark, d):
    return assoc.profile_payload(_prefs(spark, d))


# --- heat, voice ---

def _views(spark, d):
    return heat.view_counts(fx.play_log(spark, d), PLAY_AS_OF, PLAY_DAYS, LONG)


def q_top_viewed(spark, d):
    return heat.top_viewed(_views(spark, d))


def q_top_mean_views(spark, d):
    return heat.top_mean_views(_views(spark, d)).select("content_type", _r6("mean_views"))


def q_heat_score(spark, d):
    return heat.heat_scores(_views(spark, d)).select("sid", _r6("score"))


def heat_messages(spark, d):
    return heat.heat_payload(heat.heat_scores(_views(spark, d)))


def _read_back(messages: DataFrame, fields: str) -> DataFrame:
    """Messages with the fields of their JSON value, the score at the compared precision."""
    parsed = messages.select("topic", "key", F.from_json("value", fields).alias("m")).select("topic", "key", "m.*")
    return parsed.withColumn("score", _r6("score"))


def q_heat_payload(spark, d):
    return _read_back(heat_messages(spark, d), "sid string, score double, type string")


def q_voice_scores(spark, d):
    out = heat.voice_scores(fx.score_matrix(spark, d), fx.catalog(spark, d), VOICE_AS_OF, LONG)
    return out.select("sid", "title", "content_type", _r6("score"))


def voice_messages(spark, d):
    return heat.voice_payload(heat.voice_scores(fx.score_matrix(spark, d), fx.catalog(spark, d), VOICE_AS_OF, LONG))


def q_voice_payload(spark, d):
    return _read_back(voice_messages(spark, d), "sid string, title string, contentType string, score double")


# --- editorial, kids ---

def _editorial(spark, d):
    return parse_editorial(fx.editorial_lines(spark, d), on_short="drop")


def q_editorial_sample(spark, d):
    return ed.editorial_sample(_editorial(spark, d), SAMPLE_SEED)


def q_editorial_sample_total(spark, d):
    return ed.editorial_sample_total(_editorial(spark, d), SAMPLE_SEED)


def q_editorial_payload(spark, d):
    return ed.editorial_payload(_editorial(spark, d), SAMPLE_SEED)


def q_editorial_rejects(spark, d):
    return short_lines(fx.editorial_lines(spark, d))


def q_kids_catalog_codes(spark, d):
    return ed.kids_catalog_codes(fx.catalog(spark, d), _subjects(spark, d), _readings(spark))


def q_kids_catalog_codes_first(spark, d):
    """the original's limit of 30 programs, first by id."""
    return ed.kids_catalog_codes(fx.catalog(spark, d), _subjects(spark, d), _readings(spark), limit=30)


def q_kids_play_rank(spark, d):
    valid = fx.catalog(spark, d).where((F.col("status") == 1) & (F.col("video_type") == 0)).select("sid")
    return ed.kids_play_rank(_kids_play(spark, d), valid, _readings(spark), "20240101")


# --- text and dates ---

def q_path_code_home(spark, d):
    return fx.path_log(spark, d).select("sid", S.path_code_home("path", config.HOME_PATH_TYPES).alias("search_code"))


def q_path_code_search(spark, d):
    return fx.path_log(spark, d).select("sid", S.path_code_search("path").alias("search_code"))


def q_log_dates(spark, d):
    t = fx.access_log_times(spark, d)
    cn_date = D.en_to_cn_date("en_time")
    return t.select(
        "o_orderkey",
        D.en_to_cn_datetime("en_time").alias("cn_datetime"),
        cn_date.alias("cn_date"),
        D.merge_date_time(cn_date, F.substring("en_time", 13, 8)).alias("merged"),
        F.array_join(D.en_to_cn_array("en_time"), "|").alias("cn_pair"),
    )


def q_calendar(spark, d):
    o = fx.read_table(spark, d, "orders")
    ymd = F.date_format("o_orderdate", "yyyyMMdd")
    return o.select(
        "o_orderkey",
        D.date_cn("o_orderdate").alias("day"),
        D.add_days(ymd, -3).alias("day_minus_3"),
        D.add_days(ymd, 1, "yyyy-MM-dd").alias("day_cn_plus_1"),
        D.is_sunday("o_orderdate").alias("is_sunday"),
        D.is_monday("o_orderdate").alias("is_monday"),
        D.is_weekend("o_orderdate").alias("is_weekend"),
        D.week_range("o_orderdate").alias("week_range"),
        D.days_gap(ymd, F.lit(GAP_ORIGIN)).alias("days_gap"),
        D.format_moment("o_orderdate").alias("moment"),
        D.format_moment("o_orderdate", D.MINUTE_FORMAT).alias("minute"),
        D.format_moment("o_orderdate", D.END_OF_DAY_FORMAT).alias("end_of_day"),
        D.hour_of(D.format_moment("o_orderdate")).alias("hour"),
    )


def q_title_language_flags(spark, d):
    return fx.catalog(spark, d).select("sid", T.has_chinese("title").alias("has_chinese"))


def q_title_tokens(spark, d):
    return fx.catalog(spark, d).select("sid", F.posexplode(T.title_tokens("title")).alias("position", "token"))


def _title_readings(spark, d):
    return T.title_readings(fx.catalog(spark, d).select("sid", "title"), _readings(spark))


def q_title_spellings(spark, d):
    return T.spelling_rows(_title_readings(spark, d)).select("sid", "position", "spelling")


def q_title_search_code(spark, d):
    return _title_readings(spark, d).select("sid", T.search_code("readings").alias("search_code"))


def q_sql_functions(spark, d):
    """The date and score helpers called from SQL text, over every order."""
    register_sql_functions(spark, prefix="sl_")
    return spark.sql(
        "SELECT t.o_orderkey, sl_day_add(date_format(t.o_orderdate, 'yyyyMMdd'), -1) AS day_before, "
        "sl_en_to_cn_date(t.en_time) AS cn_date, sl_en_to_cn_datetime(t.en_time) AS cn_datetime, "
        "sl_hour_of(sl_en_to_cn_datetime(t.en_time)) AS hour, "
        "round(sl_heat_score(CAST(t.o_orderkey AS DOUBLE), 1000.0D), 6) AS heat "
        "FROM {times} t", times=fx.access_log_times(spark, d))


def q_sql_path_functions(spark, d):
    """The path and title helpers called from SQL text, over every path with its catalog titles."""
    register_sql_functions(spark, prefix="sl_")
    return spark.sql(
        "SELECT p.sid, sl_path_code_home(p.path) AS home_code, sl_path_code_search(p.path) AS search_code, "
        "sl_clean_title(c.title) AS clean_title, sl_has_chinese(c.title) AS has_chinese "
        "FROM {paths} p JOIN {titles} c ON c.sid = p.sid",
        paths=fx.path_log(spark, d), titles=fx.catalog(spark, d))


# --- features, stream ---

def q_index_categories(spark, d):
    p = fx.play_log(spark, d).select("event_id", "content_type")
    return index_categories(p, "content_type")


def q_encode_categories(spark, d):
    p = fx.play_log(spark, d).select("event_id", "content_type")
    enc = vector_columns(encode_categories(p, "content_type"), "category_vec")
    return enc.select("event_id", "content_type", "vec_size", "vec_active")


def q_topic_mirror(spark, d):
    return mirror_messages(fx.topic_messages(spark, d), MIRROR_TOPICS)


def q_topic_mirror_stream(spark, d):
    """B4 as it runs: a stream over the table's files, through the mirror into a file sink, and what arrived there."""
    folder = scratch_path(spark, "mirror")
    return mirrored(fx.topic_message_stream(spark, d), MIRROR_TOPICS, f"{folder}/sink", f"{folder}/checkpoint")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
