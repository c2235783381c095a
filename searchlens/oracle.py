"""DuckDB oracle SQL, one statement per registered query.

The stand-in views are inlined as CTEs over the driver's pre-registered
tables. Ranks are cast to INTEGER and sums to BIGINT so types line up with
Spark's; every computed column has the same alias as on the Spark side.
"""

from __future__ import annotations

from . import config
from .registry import ALL, CATALOG_PARTS, GAP_ORIGIN, LONG, MIRROR_TOPICS, SAMPLE_SEED, SEARCH_AS_OF, SHORT, SHORT_LONG

VIEWS = {
    "base_catalog": """SELECT p_partkey AS id, CAST(p_partkey AS STRING) AS sid, lower(p_type) AS content_type,
  CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN concat('"', name, '"') ELSE name END AS title,
  1 AS type, CASE WHEN p_size % 7 = 0 THEN 0 ELSE 1 END AS status, p_size % 3 AS video_type,
  CASE WHEN p_size > 40 THEN 1 ELSE 0 END AS app_version_flag,
  CASE WHEN p_size % 10 = 0 THEN 1 ELSE 0 END AS risk_flag
FROM (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN p_name
    ELSE concat(substr('行乐长重好', CAST(p_partkey % 5 + 1 AS INT), 1), substr('行乐长重好', CAST(p_partkey // 5 % 5 + 1 AS INT), 1), p_name) END AS name FROM part)""",
    "catalog": """SELECT * FROM base_catalog
UNION ALL SELECT id + 1000000000 AS id, sid, content_type, title || ' II' AS title, type, status, video_type, app_version_flag,
  risk_flag FROM base_catalog WHERE id % 50 = 0
UNION ALL SELECT id + 2000000000 AS id, sid, content_type, title, type, status, video_type, app_version_flag, risk_flag
  FROM base_catalog WHERE id % 75 = 0""",
    "play_log": """SELECT e.event_id,
  CASE WHEN e.event_id % 15 = 0 THEN NULL WHEN e.event_id % 7 = 0 THEN substr(md5(CAST(e.user_id AS STRING)), 1, 16)
       ELSE md5(CAST(e.user_id AS STRING)) END AS user_id,
  CASE WHEN e.event_id % 10 = 0 THEN NULL ELSE e.user_id END AS account_id,
  regexp_extract(e.props, '([0-9]+)', 1) AS sid,
  CASE WHEN e.event_id % 9 = 0 THEN 'sports' ELSE lower(p.p_type) END AS content_type,
  e.value * 20 AS duration,
  CASE e.event_type WHEN 'view' THEN 'userexit' WHEN 'click' THEN 'selfend' ELSE e.event_type END AS event,
  e.value AS score,
  CAST(year(e.ts) * 10000 + month(e.ts) * 100 + day(e.ts) AS INT) AS key_day,
  CAST(hour(e.ts) AS INT) AS key_hour
FROM events e JOIN part p ON p.p_partkey = CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT)""",
    "search_log": """SELECT CASE WHEN o.o_custkey % 25 = 0 THEN NULL ELSE CAST(o.o_custkey AS STRING) END AS user_id,
  CASE WHEN l.l_linenumber = 6 THEN NULL WHEN l.l_linenumber = 7 THEN '' ELSE upper(substr(o.o_orderpriority, 3, 4)) END AS search_text,
  CAST(l.l_partkey AS STRING) AS sid, lower(p.p_type) AS content_type,
  CASE WHEN l.l_returnflag = 'R' THEN 'detail' ELSE 'play' END AS log_type,
  CAST(year(l.l_shipdate) * 10000 + month(l.l_shipdate) * 100 + day(l.l_shipdate) AS INT) AS key_day
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey""",
    "path_log": """SELECT CAST(p_partkey AS STRING) AS sid,
  CASE p_partkey % 5 WHEN 0 THEN NULL
    WHEN 1 THEN concat('home-movie-search-', upper(substr(p_name, 1, 3)), '-x')
    WHEN 2 THEN concat('home-tv-', upper(substr(p_name, 1, 2)))
    WHEN 3 THEN concat('home-searc', upper(substr(p_name, 1, 4)))
    ELSE concat('home-sports-', upper(p_name)) END AS path
FROM part""",
    "editorial_lines": """SELECT CASE WHEN p_partkey % 17 = 0 THEN concat(CAST(p_partkey AS STRING), chr(9), lower(p_type))
  ELSE concat(CAST(p_partkey AS STRING), chr(9), lower(p_type), chr(9), p_name, chr(9), upper(substr(p_name, 1, 4))) END AS value
FROM part""",
    "score_matrix": """SELECT regexp_extract(e.props, '([0-9]+)', 1) AS sid_or_subject_code, lower(p.p_type) AS content_type, e.value AS score,
  CAST(year(e.ts) * 10000 + month(e.ts) * 100 + day(e.ts) AS INT) AS partition_tag
FROM events e JOIN part p ON p.p_partkey = CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT)""",
    "readings": """SELECT * FROM (VALUES ('行', ['hang', 'xing']), ('乐', ['le', 'yue']), ('长', ['chang', 'zhang']),
  ('重', ['zhong', 'chong'])) r(ch, readings)""",
    "subjects": """SELECT 'subject-' || CAST(s_suppkey AS STRING) AS sid, s_name AS title,
  CASE WHEN s_acctbal >= 0 THEN 1 ELSE 0 END AS status FROM supplier""",
    "search_play": "SELECT * FROM search_log WHERE log_type = 'play'",
    "search_detail": "SELECT * FROM search_log WHERE log_type = 'detail'",
}
# CTEs that read other CTEs.
DEPENDS = {"search_play": ["search_log"], "search_detail": ["search_log"], "catalog": ["base_catalog"]}


def _in(types) -> str:
    return "(" + ", ".join(f"'{t}'" for t in types) + ")"


def sql(views: list[str], body: str, *ctes: tuple[str, str]) -> str:
    names: list[str] = []
    for v in views:
        for dep in DEPENDS.get(v, []):
            if dep not in names:
                names.append(dep)
        if v not in names:
            names.append(v)
    parts = [f"{v} AS ({VIEWS[v]})" for v in names] + [f"{n} AS ({q})" for n, q in ctes]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body


# Window starts and the voice job's day, written out: 20011104 less 2600 days, 20240130 less 30,
# 20240120 less 3, and the day before 20240131.
SEARCH_START = "19940922"
PLAY_START = "20231231"
WINDOW_START = "20240117"
VOICE_DAY = "20240130"

IDENTITY = "((user_id IS NOT NULL AND length(user_id) = 32) OR account_id IS NOT NULL)"
PRESENT_SID = "sid IS NOT NULL AND length(sid) > 0"
PRESENT_TEXT = "search_text IS NOT NULL AND length(search_text) > 0"
VALID_PLAY = "duration IS NOT NULL AND duration > 300 AND duration < 7200 AND event IN ('userexit', 'selfend')"

ASSOC_PLAYS = (f"SELECT sid, account_id, key_hour AS time, user_id, content_type FROM play_log "
               f"WHERE key_day > {PLAY_START} AND {IDENTITY} AND {PRESENT_SID} AND content_type IN {_in(ALL)}")
PLAYABLE = "SELECT id, sid, content_type FROM catalog WHERE type = 1 AND status = 1 AND video_type IN (0, 1) AND content_type IN " + _in(ALL)
JOINED_PLAYS = "SELECT p.sid, p.account_id, p.time, p.user_id, c.content_type FROM assoc_plays p JOIN playable c ON c.sid = p.sid"


def _search_rows(view: str, types, user: bool = False) -> str:
    cols = ("user_id, " if user else "") + "search_text, content_type, sid"
    return f"SELECT {cols} FROM {view} WHERE content_type IN {_in(types)} AND {PRESENT_TEXT} AND key_day > {SEARCH_START}"


TITLES_ALL = "SELECT sid, replace(title, '\"', '') AS title, status FROM catalog WHERE title IS NOT NULL"
TITLES_RISK_FREE = TITLES_ALL + " AND risk_flag = 0"

ROLLUP = """SELECT sid, content_type, title, status, search_text AS search_code, num FROM (
  SELECT c.sid, c.content_type, t.title, t.status, c.search_text,
    CAST(sum(c.num) OVER (PARTITION BY c.sid, c.content_type, t.title, t.status) AS BIGINT) AS num,
    row_number() OVER (PARTITION BY c.sid, c.content_type, t.title, t.status ORDER BY c.num DESC, c.search_text) AS rn
  FROM counts c JOIN titles t ON t.sid = c.sid) WHERE rn = 1"""

HOT_ORDER = "num DESC, sid, title, status, content_type"


def _hot(unique: bool, risk_free: bool, body: str) -> str:
    rows = _search_rows("search_play", SHORT_LONG, user=unique)
    if unique:
        counts = ("SELECT search_text, content_type, sid, count(*) AS num FROM "
                  "(SELECT DISTINCT user_id, search_text, content_type, sid FROM rows_) GROUP BY ALL")
    else:
        counts = "SELECT search_text, content_type, sid, count(*) AS num FROM rows_ GROUP BY ALL"
    titles = TITLES_RISK_FREE if risk_free else TITLES_ALL
    return sql(["catalog", "search_play"], body, ("rows_", rows), ("counts", counts), ("titles", titles), ("rollup", ROLLUP))


HOT_BY_TYPE = f"""SELECT content_type, rank, sid, search_code, title, num FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY content_type ORDER BY {HOT_ORDER}) AS INTEGER) AS rank FROM rollup)
WHERE rank <= 20"""
HOT_TOTAL = f"""SELECT rank, sid, search_code, title, content_type, num FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY {HOT_ORDER}) AS INTEGER) AS rank FROM rollup) WHERE rank <= 20"""


def _lines(rollup_ctes: list[tuple[str, str]], views: list[str]) -> str:
    body = f"""SELECT content_type, rank,
  concat_ws('||', title, search_code, sid, content_type, CAST(coalesce(status, 0) AS STRING), CAST(num AS STRING), '{SEARCH_AS_OF[:4]}-{SEARCH_AS_OF[4:6]}-{SEARCH_AS_OF[6:]}') AS line
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY content_type ORDER BY {HOT_ORDER}) AS INTEGER) AS rank
      FROM rollup WHERE content_type IN {_in(ALL)}) WHERE rank <= 20"""
    return sql(views, body, *rollup_ctes)


HOT_LINES = _lines([
    ("rows_", _search_rows("search_detail", ALL) + " UNION ALL " + _search_rows("search_play", ALL)),
    ("typed", f"SELECT r.search_text, c.content_type, r.sid FROM rows_ r JOIN (SELECT sid, content_type FROM catalog WHERE content_type IN {_in(ALL)}) c ON c.sid = r.sid"),
    ("counts", "SELECT search_text, content_type, sid, count(*) AS num FROM typed GROUP BY ALL"),
    ("titles", TITLES_ALL), ("rollup", ROLLUP)], ["catalog", "search_detail", "search_play"])

HOT_LINES_SPLIT = _lines([
    ("rows_", _search_rows("search_detail", LONG) + " UNION ALL " + _search_rows("search_play", SHORT)),
    ("counts", "SELECT search_text, content_type, sid, count(*) AS num FROM rows_ GROUP BY ALL"),
    ("titles", TITLES_ALL), ("rollup", ROLLUP)], ["catalog", "search_detail", "search_play"])


def _assoc_top(flag: bool, key: str) -> str:
    playable = PLAYABLE + (" AND app_version_flag = 0" if flag else "")
    body = f"""SELECT content_type, rank, {key}, n FROM (
  SELECT content_type, {key}, n, CAST(row_number() OVER (PARTITION BY content_type ORDER BY n DESC, {key}) AS INTEGER) AS rank
  FROM (SELECT c.content_type, c.{key}, count(*) AS n FROM assoc_plays p JOIN playable c ON c.sid = p.sid GROUP BY ALL))
WHERE rank <= 20"""
    return sql(["catalog", "play_log"], body, ("assoc_plays", ASSOC_PLAYS), ("playable", playable))


PREFS = f"""SELECT user_id, account_id, band, content_type, n,
  CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY user_id, account_id, band) AS score,
  CAST(row_number() OVER (PARTITION BY user_id, account_id, band ORDER BY n DESC, content_type) AS INTEGER) AS position
FROM (
  SELECT user_id, account_id, band, content_type, count(*) AS n FROM (
    SELECT user_id, account_id, 'allTime' AS band, content_type FROM joined WHERE account_id IS NOT NULL
    UNION ALL SELECT user_id, account_id, 'noon', content_type FROM joined WHERE account_id IS NOT NULL AND time IN (11, 12, 13, 14)
    UNION ALL SELECT user_id, account_id, 'afternoon', content_type FROM joined WHERE account_id IS NOT NULL AND time IN (16, 17, 18)
    UNION ALL SELECT user_id, account_id, 'night', content_type FROM joined WHERE account_id IS NOT NULL AND time IN (18, 19, 20, 21)
  ) GROUP BY ALL)"""


def _prefs(body: str) -> str:
    return sql(["catalog", "play_log"], body, ("assoc_plays", ASSOC_PLAYS), ("playable", PLAYABLE),
               ("joined", JOINED_PLAYS), ("prefs", PREFS))


VIEWS_COUNTS = (f"SELECT content_type, sid, count(*) AS n FROM play_log WHERE content_type IN {_in(LONG)} AND {VALID_PLAY} "
                f"AND {PRESENT_SID} AND key_day > {PLAY_START} GROUP BY ALL")
TOP_VIEWED = """SELECT content_type, rank, sid, n FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY content_type ORDER BY n DESC, sid) AS INTEGER) AS rank FROM counts)
WHERE rank <= 50"""
MEANS = "SELECT content_type, avg(CAST(n AS DOUBLE)) AS mean_views FROM top_viewed GROUP BY content_type"


def _heat(body: str) -> str:
    return sql(["play_log"], body, ("counts", VIEWS_COUNTS), ("top_viewed", TOP_VIEWED), ("means", MEANS))


def _code_ctes(src: str) -> list[tuple[str, str]]:
    """Tokens of ``src.title`` with readings; first-reading initials per title."""
    return [
        ("toks", f"""SELECT title, unnest(tokens) AS tok, generate_subscripts(tokens, 1) AS pos FROM (
            SELECT DISTINCT title, regexp_extract_all(regexp_replace(regexp_replace(title, '[^0-9a-zA-Z\\s一-龥]', '', 'g'),
                   '^\\s+|\\s+$', '', 'g'), '([0-9]+|[a-zA-Z]+|[一-龥])', 1) AS tokens FROM {src} WHERE title IS NOT NULL)"""),
        ("tok_r", """SELECT t.title, t.pos, coalesce(r.readings, [lower(t.tok)]) AS opts
            FROM toks t LEFT JOIN readings r ON r.ch = t.tok"""),
        ("codes", """SELECT title, substr(string_agg(substr(lower(opts[1]), 1, 1), '' ORDER BY pos), 1, 4) AS search_code
            FROM tok_r GROUP BY title"""),
    ]


Q: dict[str, str] = {}
_HOME = "home-(" + "|".join(f"{t}-" for t in ("movie", "tv", "zongyi", "comic", "jilu", "hot", "xiqu", "mv", "kids", "game")) + ")(search-)?([A-Z]+)"

Q["scan_play_log"] = sql(["play_log"], ASSOC_PLAYS)
Q["scan_catalog"] = sql(["catalog"], f"SELECT sid, content_type FROM catalog WHERE content_type IN {_in(ALL)}")
Q["scan_score_matrix"] = sql(["score_matrix"], f"SELECT * FROM score_matrix WHERE partition_tag = {VOICE_DAY}")
Q["log_retrieval"] = sql(["play_log"], f"""SELECT user_id, sid, lpad(CAST(key_hour AS STRING), 2, '0') AS time,
  CAST(account_id AS BIGINT) AS account_id FROM play_log
WHERE key_day > {PLAY_START} AND {IDENTITY} AND {PRESENT_SID} AND content_type IN {_in(ALL)}""")
Q["filter_content_type"] = sql(["play_log"], f"SELECT event_id, sid, content_type FROM play_log WHERE content_type IN {_in(LONG)}")
Q["filter_identity"] = sql(["play_log"], f"SELECT event_id, user_id, account_id FROM play_log WHERE {IDENTITY}")
Q["filter_search_text"] = sql(["search_log"], f"SELECT * FROM search_log WHERE {PRESENT_TEXT}")
Q["filter_window"] = sql(["play_log"], f"SELECT event_id, key_day FROM play_log WHERE key_day > {WINDOW_START}")
Q["filter_valid_play"] = sql(["play_log"], f"SELECT event_id, sid, content_type, duration, event FROM play_log WHERE {VALID_PLAY}")
Q["filter_valid_play_any_event"] = sql(["play_log"], """SELECT event_id, sid, content_type, duration FROM play_log
WHERE duration IS NOT NULL AND duration > 300 AND duration < 7200""")
Q["filter_catalog"] = sql(["catalog"], PLAYABLE)
Q["parse_editorial"] = sql(["editorial_lines"], """SELECT parts[1] AS sid, parts[2] AS content_type, parts[3] AS title,
  parts[4] AS search_text FROM (SELECT string_split(value, chr(9)) AS parts FROM editorial_lines) WHERE len(parts) >= 4""")
Q["clean_titles"] = sql(["catalog"], """SELECT sid, replace(title, '"', '') AS title_unquoted,
  regexp_replace(regexp_replace(title, '[^0-9a-zA-Z\\s一-龥]', '', 'g'), '^\\s+|\\s+$', '', 'g') AS title_clean FROM catalog""")

Q["join_plays_catalog"] = sql(["catalog", "play_log"], JOINED_PLAYS, ("assoc_plays", ASSOC_PLAYS), ("playable", PLAYABLE))
Q["join_counts_titles"] = sql(["catalog", "search_play"], """SELECT c.search_text, c.content_type, c.sid, c.num, t.title, t.status
FROM (SELECT search_text, content_type, sid, count(*) AS num FROM rows_ GROUP BY ALL) c JOIN titles t ON t.sid = c.sid""",
                              ("rows_", _search_rows("search_play", SHORT_LONG)), ("titles", TITLES_ALL))
Q["union_logs"] = sql(["search_detail", "search_play"], _search_rows("search_detail", ALL) + " UNION ALL " + _search_rows("search_play", ALL))
Q["search_counts"] = sql(["search_log"], "SELECT search_text, content_type, sid, count(*) AS num FROM rows_ GROUP BY ALL",
                         ("rows_", _search_rows("search_log", ALL)))
Q["unique_searchers"] = sql(["search_log"], """SELECT search_text, content_type, sid, count(*) AS num
FROM (SELECT DISTINCT user_id, search_text, content_type, sid FROM rows_) GROUP BY ALL""", ("rows_", _search_rows("search_log", ALL, user=True)))
Q["play_counts"] = sql(["catalog", "play_log"], "SELECT content_type, sid, count(*) AS n FROM joined GROUP BY ALL",
                       ("assoc_plays", ASSOC_PLAYS), ("playable", PLAYABLE), ("joined", JOINED_PLAYS))
Q["view_counts"] = sql(["play_log"], VIEWS_COUNTS)
Q["score_sums"] = sql(["score_matrix"], f"""SELECT sid_or_subject_code, round(sum(score), 6) AS score FROM score_matrix
WHERE content_type IN {_in(LONG)} GROUP BY sid_or_subject_code""")
_PROFILE_COLS = [("id", "bigint"), ("sid", "string"), ("content_type", "string"), ("title", "string"), ("type", "int"),
                 ("status", "int"), ("video_type", "int"), ("app_version_flag", "int"), ("risk_flag", "int")]
Q["table_profile"] = sql(["catalog"], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls FROM catalog"
    for c, t in _PROFILE_COLS))

Q["video_rollup"] = _hot(False, False, "SELECT * FROM rollup")
Q["hot_by_type"] = _hot(True, True, HOT_BY_TYPE)
Q["hot_by_type_all_regions"] = _hot(False, False, HOT_BY_TYPE)
Q["hot_total"] = _hot(True, True, HOT_TOTAL)
Q["hot_lines"] = HOT_LINES
Q["hot_lines_split_types"] = HOT_LINES_SPLIT

Q["hot_by_type_three_logs"] = sql(["catalog", "search_play", "search_detail", "path_log"], HOT_BY_TYPE,
  ("third", f"""SELECT l.user_id, nullif(regexp_extract(p.path, '{_HOME}', 3), '') AS search_text, l.content_type, l.sid, l.key_day
  FROM search_log l JOIN path_log p ON p.sid = l.sid"""),
  ("rows_", " UNION ALL ".join("SELECT DISTINCT * FROM (" + _search_rows(v, SHORT_LONG, user=True) + ")"
                               for v in ("search_play", "search_detail", "third"))),
  ("counts", "SELECT search_text, content_type, sid, count(*) AS num FROM rows_ GROUP BY ALL"),
  ("titles", TITLES_RISK_FREE), ("rollup", ROLLUP))

Q["assoc_top_videos"] = _assoc_top(True, "sid")
Q["assoc_top_videos_all_versions"] = _assoc_top(False, "sid")
Q["assoc_top_videos_by_id"] = _assoc_top(False, "id")
Q["preference_share"] = _prefs("SELECT user_id, account_id, content_type, score FROM prefs WHERE band = 'allTime'")
Q["preference_bands"] = _prefs("SELECT user_id, account_id, band, content_type, score FROM prefs WHERE band <> 'allTime'")
Q["preference_profile"] = _prefs("SELECT user_id, account_id, band, position, content_type, score FROM prefs")

Q["top_viewed"] = _heat("SELECT * FROM top_viewed")
Q["top_mean_views"] = _heat("SELECT content_type, round(mean_views, 6) AS mean_views FROM means")
Q["heat_score"] = _heat("""SELECT c.sid, round(CASE WHEN m.mean_views = 1 THEN 100.0
  ELSE least(ln(CAST(c.n AS DOUBLE)) / ln(m.mean_views) * 100.0, 100.0) END, 6) AS score
FROM counts c JOIN means m ON m.content_type = c.content_type""")
Q["voice_scores"] = sql(["score_matrix", "catalog"], f"""SELECT c.sid, c.title, c.content_type, round(s.score, 6) AS score
FROM (SELECT sid_or_subject_code, sum(score) AS score FROM score_matrix
      WHERE partition_tag = {VOICE_DAY} AND content_type IN {_in(LONG)} GROUP BY sid_or_subject_code) s
JOIN (SELECT id, sid, title, content_type FROM catalog WHERE content_type IN {_in(LONG)}) c
  ON c.id = TRY_CAST(s.sid_or_subject_code AS BIGINT)""")

_EDITORIAL = """SELECT parts[1] AS sid, parts[2] AS content_type, parts[3] AS title, parts[4] AS search_code
FROM (SELECT string_split(value, chr(9)) AS parts FROM editorial_lines) WHERE len(parts) >= 4"""
_SEED_ORDER = f"md5('{SAMPLE_SEED}:' || sid), sid, content_type, title, search_code"
Q["editorial_sample"] = sql(["editorial_lines"], f"""SELECT content_type, rank, sid, search_code, title FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY content_type ORDER BY {_SEED_ORDER}) AS INTEGER) AS rank FROM parsed)
WHERE rank <= 20""", ("parsed", _EDITORIAL))
Q["editorial_sample_total"] = sql(["editorial_lines"], f"""SELECT rank, sid, search_code, title, content_type FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY {_SEED_ORDER}) AS INTEGER) AS rank FROM parsed) WHERE rank <= 20""",
                                  ("parsed", _EDITORIAL))
Q["kids_catalog_codes"] = sql(["catalog", "subjects", "readings"], """SELECT b.sid, b.content_type, b.title, k.search_code
FROM both_ b LEFT JOIN codes k ON k.title = b.title""",
                              ("both_", """SELECT sid, content_type, title FROM catalog WHERE sid IS NOT NULL AND title IS NOT NULL AND status = 1
                 UNION ALL SELECT sid, 'course_subject', title FROM subjects WHERE sid IS NOT NULL AND title IS NOT NULL AND status = 1"""),
                              *_code_ctes("both_"))
_KIDS_BOTH = """SELECT sid, content_type, title FROM (SELECT * FROM catalog WHERE sid IS NOT NULL AND title IS NOT NULL AND status = 1
                 ORDER BY id LIMIT 30)
                 UNION ALL SELECT sid, 'course_subject', title FROM subjects WHERE sid IS NOT NULL AND title IS NOT NULL AND status = 1"""
Q["kids_catalog_codes_first"] = sql(["catalog", "subjects", "readings"], """SELECT b.sid, b.content_type, b.title, k.search_code
FROM both_ b LEFT JOIN codes k ON k.title = b.title""", ("both_", _KIDS_BOTH), *_code_ctes("both_"))
Q["editorial_rejects"] = sql(["editorial_lines"], """SELECT value, CAST(len(string_split(value, chr(9))) AS INTEGER) AS n_fields
FROM editorial_lines WHERE len(string_split(value, chr(9))) < 4""")
Q["kids_play_rank"] = sql(["catalog", "play_log", "readings"], """SELECT v.sid, v.content_type, v.title, k.search_code, v.num
FROM valid_counts v LEFT JOIN codes k ON k.title = v.title""",
                          ("kids_play", """SELECT p.user_id, p.sid AS parent_sid, c.title AS parent_title, c.content_type, p.key_day AS day_p
                 FROM play_log p JOIN catalog c ON c.sid = p.sid"""),
                          ("counts", """SELECT title, content_type, sid, count(*) AS num FROM (
                 SELECT DISTINCT user_id, parent_sid AS sid, parent_title AS title, content_type FROM kids_play
                 WHERE day_p >= 20240101 AND parent_sid IS NOT NULL AND length(parent_sid) > 0 AND parent_title IS NOT NULL)
                 GROUP BY ALL"""),
                          ("valid_counts", """SELECT * FROM counts WHERE sid IN
                 (SELECT sid FROM catalog WHERE status = 1 AND video_type = 0)"""),
                          *_code_ctes("valid_counts"))

Q["path_code_home"] = sql(["path_log"], f"SELECT sid, nullif(regexp_extract(path, '{_HOME}', 3), '') AS search_code FROM path_log")
Q["path_code_search"] = sql(["path_log"], "SELECT sid, nullif(regexp_extract(path, 'search*([A-Z]+)', 1), '') AS search_code FROM path_log")
Q["log_dates"] = """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS cn_datetime,
  strftime(o_orderdate, '%Y-%m-%d') AS cn_date,
  strftime(o_orderdate, '%Y-%m-%d') || ' ' || strftime(o_orderdate, '%H:%M:%S') AS merged,
  strftime(o_orderdate, '%Y-%m-%d') || '|' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS cn_pair
FROM orders"""
Q["calendar"] = f"""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
  strftime(o_orderdate - INTERVAL 3 DAY, '%Y%m%d') AS day_minus_3,
  strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS day_cn_plus_1,
  dayofweek(o_orderdate) = 0 AS is_sunday, dayofweek(o_orderdate) = 1 AS is_monday,
  dayofweek(o_orderdate) IN (0, 6) AS is_weekend,
  strftime(o_orderdate - INTERVAL 6 DAY, '%Y-%m-%d') || '~' || strftime(o_orderdate, '%Y-%m-%d') AS week_range,
  CAST(date_diff('day', DATE '{GAP_ORIGIN[:4]}-{GAP_ORIGIN[4:6]}-{GAP_ORIGIN[6:]}', CAST(o_orderdate AS DATE)) AS INTEGER) AS days_gap,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS moment, strftime(o_orderdate, '%Y-%m-%d') || ' 23:59:59' AS end_of_day,
  strftime(o_orderdate, '%Y-%m-%d %H:%M') AS minute,
  strftime(o_orderdate, '%H') AS hour
FROM orders"""
Q["title_language_flags"] = sql(["catalog"], "SELECT sid, coalesce(regexp_matches(title, '[一-龥]'), false) AS has_chinese FROM catalog")
_TOKENS = "regexp_extract_all(regexp_replace(regexp_replace(title, '[^0-9a-zA-Z\\s一-龥]', '', 'g'), '^\\s+|\\s+$', '', 'g'), '([0-9]+|[a-zA-Z]+|[一-龥])', 1)"
Q["title_tokens"] = sql(["catalog"], f"""SELECT sid, CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS position, unnest(tokens) AS token
FROM (SELECT sid, {_TOKENS} AS tokens FROM catalog WHERE title IS NOT NULL)""")
Q["title_spellings"] = sql(["catalog", "readings"], """SELECT c.sid, s.idx AS position, s.spelling FROM catalog c
JOIN spelt s ON s.title = c.title JOIN (SELECT title, max(pos) AS last FROM toks GROUP BY title) m ON m.title = s.title AND m.last = s.pos""",
                           *_code_ctes("catalog")[:2],
                           ("options", """SELECT title, pos, len(opts) AS n, unnest(opts) AS opt, generate_subscripts(opts, 1) AS k FROM tok_r"""),
                           ("spelt", """SELECT DISTINCT title, CAST(0 AS BIGINT) AS pos, '' AS spelling, CAST(0 AS BIGINT) AS idx FROM toks
  UNION ALL SELECT s.title, o.pos, s.spelling || lower(o.opt) || ' ', s.idx * o.n + o.k - 1
  FROM spelt s JOIN options o ON o.title = s.title AND o.pos = s.pos + 1"""))
Q["title_search_code"] = sql(["catalog", "readings"], "SELECT c.sid, k.search_code FROM catalog c LEFT JOIN codes k ON k.title = c.title",
                             *_code_ctes("catalog"))
_INDEX = """SELECT content_type, CAST(row_number() OVER (ORDER BY count(*) DESC, content_type) - 1 AS DOUBLE) AS category_index,
  count(*) OVER () AS n_labels FROM play_log GROUP BY content_type"""
Q["index_categories"] = sql(["play_log"], "SELECT p.event_id, p.content_type, i.category_index FROM play_log p JOIN idx i ON i.content_type = p.content_type",
                            ("idx", _INDEX))
Q["encode_categories"] = sql(["play_log"], """SELECT p.event_id, p.content_type, CAST(i.n_labels - 1 AS INTEGER) AS vec_size,
  CASE WHEN i.category_index < i.n_labels - 1 THEN CAST(i.category_index AS INTEGER) END AS vec_active
FROM play_log p JOIN idx i ON i.content_type = p.content_type""", ("idx", _INDEX))
Q["catalog_id_ranges"] = sql(["catalog"], f"""SELECT CAST((place * {CATALOG_PARTS}) // n_rows AS INTEGER) AS part,
  min(id) AS low, max(id) AS high, count(*) AS n
FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS place, count(*) OVER () AS n_rows FROM catalog) GROUP BY ALL""")
Q["table_log_window"] = sql(["play_log"], f"""SELECT event_id, user_id, sid, content_type, key_day FROM play_log
WHERE key_day > {WINDOW_START}""")
Q["weekend_plays"] = sql(["play_log"], """SELECT key_day, content_type, count(*) AS n FROM play_log
WHERE isodow(strptime(CAST(key_day AS STRING), '%Y%m%d')) >= 6 GROUP BY key_day, content_type""")
Q["weekend_scores"] = sql(["score_matrix"], """SELECT sid_or_subject_code, round(sum(score), 6) AS score FROM score_matrix
WHERE isodow(strptime(CAST(partition_tag AS STRING), '%Y%m%d')) >= 6 GROUP BY sid_or_subject_code""")
Q["topic_mirror"] = (f"SELECT event_type AS topic, CAST(event_id AS STRING) AS key, props AS value FROM events "
                     f"WHERE event_type IN {_in(MIRROR_TOPICS)}")

Q["topic_mirror_stream"] = Q["topic_mirror"]

Q["sql_functions"] = """SELECT o_orderkey, strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') AS day_before,
  strftime(o_orderdate, '%Y-%m-%d') AS cn_date, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS cn_datetime,
  strftime(o_orderdate, '%H') AS hour,
  CASE WHEN o_orderkey > 0 THEN round(least(ln(CAST(o_orderkey AS DOUBLE)) / ln(1000.0) * 100.0, 100.0), 6) ELSE 100.0 END AS heat
FROM orders"""
Q["sql_path_functions"] = sql(["path_log", "catalog"], f"""SELECT p.sid, nullif(regexp_extract(p.path, '{_HOME}', 3), '') AS home_code,
  nullif(regexp_extract(p.path, 'search*([A-Z]+)', 1), '') AS search_code,
  regexp_replace(regexp_replace(c.title, '[^0-9a-zA-Z\\s一-龥]', '', 'g'), '^\\s+|\\s+$', '', 'g') AS clean_title,
  coalesce(regexp_matches(c.title, '[一-龥]'), false) AS has_chinese
FROM path_log p JOIN catalog c ON c.sid = p.sid""")
Q["log_retrieval_paths"] = sql(["search_log", "path_log"], f"""SELECT nullif(regexp_extract(p.path, '{_HOME}', 3), '') AS search_text,
  l.content_type, l.sid, 1 AS num FROM search_log l JOIN path_log p ON p.sid = l.sid
WHERE l.key_day > {SEARCH_START} AND l.content_type IN {_in(SHORT_LONG)}""")

# --- payloads: byte for byte where the JSON holds only strings, integers and exact divisions; heat and
# voice messages carry logarithms and long sums, so their fields are compared, the score at 6 places ---

def _split(q: str, head: str) -> tuple[str, str]:
    i = q.index(head)
    return q[:i].rstrip(), q[i:]


def _message(topic: str, key_sql: str, value_sql: str) -> str:
    return f"SELECT '{topic}' AS topic, {key_sql} AS key, {value_sql} AS value"


_ENTRY = "to_json({'sid': sid, 'searchCode': search_code, 'title': title, 'contentType': content_type})::VARCHAR"
_DOC = f"""(SELECT '{{' || string_agg(to_json(k)::VARCHAR || ':' || items, ',' ORDER BY o, k) || '}}' FROM (
  SELECT 0 AS o, content_type AS k, '[' || string_agg({_ENTRY}, ',' ORDER BY rank) || ']' AS items FROM by_type GROUP BY content_type
  UNION ALL SELECT 1, 'total', '[' || string_agg({_ENTRY}, ',' ORDER BY rank) || ']' FROM total))"""

_hot_ctes, _hot_by_type = _split(_hot(True, True, HOT_BY_TYPE), "SELECT content_type, rank, sid, search_code, title, num FROM (")
_, _hot_total = _split(_hot(True, True, HOT_TOTAL), "SELECT rank, sid, search_code, title, content_type, num FROM (")
Q["hot_payload"] = (_hot_ctes + ",\nby_type AS (" + _hot_by_type + "),\ntotal AS (" + _hot_total + ")\n"
                    + _message(config.TOPIC_HOT, "CAST(NULL AS VARCHAR)", _DOC))

_ed_ctes, _ed_by_type = _split(Q["editorial_sample"], "SELECT content_type, rank, sid, search_code, title FROM (")
_, _ed_total = _split(Q["editorial_sample_total"], "SELECT rank, sid, search_code, title, content_type FROM (")
Q["editorial_payload"] = (_ed_ctes + ",\nby_type AS (" + _ed_by_type + "),\ntotal AS (" + _ed_total + ")\n"
                          + _message(config.TOPIC_EDITORIAL, "CAST(NULL AS VARCHAR)", _DOC))

_as_ctes, _as_top = _split(_assoc_top(True, "sid"), "SELECT content_type, rank, sid, n FROM (")
Q["assoc_payload"] = (_as_ctes + ",\ntop AS (" + _as_top + ")\n" + _message(
    config.TOPIC_TOP_VIDEOS, "CAST(NULL AS VARCHAR)",
    """(SELECT '{' || string_agg(to_json(content_type)::VARCHAR || ':' || sids, ',' ORDER BY content_type) || '}' FROM (
  SELECT content_type, to_json(list(sid ORDER BY rank))::VARCHAR AS sids FROM top GROUP BY content_type))"""))


def _band_json(band: str) -> str:
    return (f"CASE WHEN count(*) FILTER (WHERE band = '{band}') > 0 THEN '[' || string_agg(to_json({{'contentType': content_type, "
            f"'score': score}})::VARCHAR, ',' ORDER BY position) FILTER (WHERE band = '{band}') || ']' END")


Q["pref_payload"] = _prefs(f"""SELECT '{config.TOPIC_USER_TYPES}' AS topic,
  coalesce(user_id, '') || ':' || CAST(account_id AS VARCHAR) AS key,
  '{{' || CASE WHEN user_id IS NULL THEN '' ELSE '"userId":' || to_json(user_id)::VARCHAR || ',' END
  || '"accountId":' || CAST(account_id AS VARCHAR)
  || coalesce(',"allTime":' || {_band_json('allTime')}, '') || coalesce(',"noon":' || {_band_json('noon')}, '')
  || coalesce(',"afternoon":' || {_band_json('afternoon')}, '') || coalesce(',"night":' || {_band_json('night')}, '') || '}}' AS value
FROM prefs GROUP BY user_id, account_id""")

_heat_ctes, _heat_scores = _split(Q["heat_score"], "SELECT c.sid, round(")
Q["heat_payload"] = (_heat_ctes + ",\nscores AS (" + _heat_scores + ")\nSELECT '" + config.TOPIC_HEAT
                     + "' AS topic, sid AS key, sid, score, 'vv' AS type FROM scores")
_voice_ctes, _voice_scores = _split(Q["voice_scores"], "SELECT c.sid, c.title")
Q["voice_payload"] = (_voice_ctes + ",\nscores AS (" + _voice_scores + ")\nSELECT '" + config.TOPIC_VOICE
                      + "' AS topic, sid AS key, sid, title, content_type AS \"contentType\", score FROM scores")

ORACLE_SQL = Q
