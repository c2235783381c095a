"""Defaults of the search analytics jobs.

Every value here is only a default: each operator and job takes it as an
argument, because deployments (and the test tables) use other type names,
dates and sizes.
"""

from __future__ import annotations

# --- Fixed values (must equal the original jobs' defaults for equal results) ---
# Long-video content types.
LONG_VIDEO_TYPES = ("movie", "tv", "zongyi", "comic", "kids", "jilu")
# Short-video content types.
SHORT_VIDEO_TYPES = ("hot", "mv", "xiqu", "game")
# All recommended content types, in the order the line-form hot job walks them.
ALL_VIDEO_TYPES = ("movie", "tv", "zongyi", "comic", "jilu", "kids", "mv", "xiqu", "hot", "sports", "game")
# Content types that may appear in a home-page search path.
HOME_PATH_TYPES = ("movie", "tv", "zongyi", "comic", "jilu", "hot", "xiqu", "mv", "kids", "game")
# Videos kept per content type in hot and association lists.
TOP_N = 20
# Videos per content type whose mean view count is the heat base.
HEAT_BASE_N = 50
# Trailing log windows, in days.
HOT_DAYS = 3
ASSOC_DAYS = 3
HEAT_DAYS = 7
# Hour bands of the preference profile (hour 18 is in two bands; 15 in none).
BANDS = (
    ("noon", (11, 12, 13, 14)),
    ("afternoon", (16, 17, 18)),
    ("night", (18, 19, 20, 21)),
)
# Name of the band that has no hour test.
ALL_TIME = "allTime"
# A valid play lasts strictly between these many seconds and ends by one of these events.
MIN_PLAY_SECONDS = 300
MAX_PLAY_SECONDS = 7200
VALID_PLAY_EVENTS = ("userexit", "selfend")
# A user id is valid when it has this length.
USER_ID_LENGTH = 32
# Character range treated as Chinese text (U+4E00 to U+9FA5), as a regex class body.
CJK_CLASS = "一-龥"
# English month abbreviations of access-log timestamps, January first.
MONTH_ABBREVIATIONS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# Length of a title's search code (initials of its first spelling).
SEARCH_CODE_LENGTH = 4
# Constant content type given to course subjects in the kids catalog.
COURSE_SUBJECT_TYPE = "course_subject"
# --- end of fixed values ---

# Message topics (names of our own choosing).
TOPIC_HOT_LINES = "top-searched-lines"
TOPIC_HOT_LINES_SPLIT = "top-searched-lines-split"
TOPIC_HOT = "top-searched-videos"
TOPIC_HOT_ALL_REGIONS = "top-searched-videos-all-regions"
TOPIC_EDITORIAL = "editorial-picks"
TOPIC_KIDS = "editorial-picks-kids"
TOPIC_REJECTS = "editorial-rejects"
TOPIC_TOP_VIDEOS = "top-played-videos"
TOPIC_TOP_VIDEOS_BY_ID = "top-played-videos-by-id"
TOPIC_TOP_VIDEOS_ALL_VERSIONS = "top-played-videos-all-versions"
TOPIC_USER_TYPES = "user-content-types"
TOPIC_HEAT = "video-heat"
TOPIC_VOICE = "video-voice-scores"
