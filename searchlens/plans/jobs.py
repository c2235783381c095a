"""End-to-end jobs K1-K11: inputs in, messages written once.

Each ``run_*`` takes the input DataFrames (a caller reads them with
``spark.table``, ``spark.read.parquet`` or ``read_catalog_jdbc``) and a
``Sink``. A variant of a job has its own topic and outputs. Every output is
one plan from the pruned scans on: logs are never copied or cached, and
nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..sinks.messages import message_frame, write_messages
from ..sources.editorial import parse_editorial, short_lines
from . import association as assoc
from . import editorial as ed
from . import heat
from . import hot


@dataclass(frozen=True)
class Sink:
    """Where payloads go: Kafka (``fmt="kafka"`` plus options) or files under ``path``.

    File sinks append by default; ``mode="overwrite"`` makes a rerun of the
    same day's job replace the files of its own topics instead of adding a
    second copy, and leaves other topics under ``path`` alone.
    """
    fmt: str = "kafka"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    mode: str = "append"

    def write(self, messages: DataFrame) -> None:
        write_messages(messages, self.fmt, self.path, self.options, self.mode)


def run_hot_lines(sink: Sink, detail_log: DataFrame, play_log: DataFrame, catalog: DataFrame, as_of: str,
                  days: int = config.HOT_DAYS, topic: str = config.TOPIC_HOT_LINES,
                  types: Sequence[str] = config.ALL_VIDEO_TYPES) -> None:
    """K1: line-form hot list over browse and play logs, catalog types."""
    sink.write(hot.hot_lines_payload(hot.hot_lines(detail_log, play_log, catalog, as_of, days, types), topic))


def run_hot_lines_split(sink: Sink, detail_log: DataFrame, play_log: DataFrame, catalog: DataFrame, as_of: str,
                        days: int = config.HOT_DAYS, topic: str = config.TOPIC_HOT_LINES_SPLIT,
                        long_types: Sequence[str] = config.LONG_VIDEO_TYPES,
                        short_types: Sequence[str] = config.SHORT_VIDEO_TYPES,
                        line_types: Sequence[str] = config.ALL_VIDEO_TYPES) -> None:
    """K4: line-form hot list, browse rows of long types and play rows of short types."""
    lines = hot.hot_lines_split_types(detail_log, play_log, catalog, as_of, days, long_types, short_types, line_types)
    sink.write(hot.hot_lines_payload(lines, topic))


def run_hot(sink: Sink, play_log: DataFrame, catalog: DataFrame, as_of: str, days: int = config.HOT_DAYS,
            unique: bool = True, risk_free: bool = True, topic: str | None = None,
            types: Sequence[str] = config.SHORT_VIDEO_TYPES + config.LONG_VIDEO_TYPES,
            extra_logs: Sequence[DataFrame] = ()) -> None:
    """K2 (``unique``, ``risk_free``) and K3 (neither): per-type and overall hot videos in one document.

    The topic defaults to the variant's own. ``extra_logs``: G5.
    """
    if topic is None:
        topic = config.TOPIC_HOT if unique and risk_free else config.TOPIC_HOT_ALL_REGIONS
    rollup = hot.hot_rollup(play_log, catalog, as_of, days, types, unique=unique, risk_free=risk_free, extra_logs=extra_logs)
    sink.write(hot.hot_payload(rollup, topic))


def run_editorial(sink: Sink, lines: DataFrame, seed: int, topic: str | None = None,
                  on_short: str = "fail", kids: bool = False, reject_topic: str | None = None) -> None:
    """K5, and K6 with ``kids``: seeded sample of an editorial list, per type and overall.

    With ``on_short="drop"`` and a ``reject_topic``, the lines left out are written as messages of that topic.
    """
    if topic is None:
        topic = config.TOPIC_KIDS if kids else config.TOPIC_EDITORIAL
    sink.write(ed.editorial_payload(parse_editorial(lines, on_short=on_short), seed, topic))
    if on_short == "drop" and reject_topic:
        sink.write(message_frame(short_lines(lines), reject_topic, F.col("value")))


def run_association(sink: Sink, play_log: DataFrame, catalog: DataFrame, as_of: str, days: int = config.ASSOC_DAYS,
                    key: str = "id", app_version_flag: int | None = None, with_profile: bool | None = None,
                    top_topic: str | None = None, profile_topic: str = config.TOPIC_USER_TYPES,
                    types: Sequence[str] = config.ALL_VIDEO_TYPES) -> None:
    """K7 (``key="id"``), K8 (``key="sid"``), K9 (``key="sid"``, ``app_version_flag=0``).

    The top-video topic defaults to the variant's own (by id, older versions,
    all versions), and only K7 publishes the users' profiles unless told
    otherwise. Each output scans the columns of the log that it needs.
    """
    if top_topic is None:
        top_topic = (config.TOPIC_TOP_VIDEOS_BY_ID if key == "id" else
                     config.TOPIC_TOP_VIDEOS if app_version_flag is not None else config.TOPIC_TOP_VIDEOS_ALL_VERSIONS)
    top = assoc.assoc_top_videos(play_log, catalog, as_of, days, types, app_version_flag, key)
    sink.write(assoc.top_videos_payload(top, key, top_topic))
    if with_profile if with_profile is not None else key == "id":
        sink.write(assoc.profile_payload(assoc.preference_rows(play_log, catalog, as_of, days, types), profile_topic))


def run_heat(sink: Sink, play_log: DataFrame, as_of: str, days: int = config.HEAT_DAYS,
             topic: str = config.TOPIC_HEAT, types: Sequence[str] = config.LONG_VIDEO_TYPES) -> None:
    """0-100 heat per video of long types."""
    sink.write(heat.heat_payload(heat.heat_scores(heat.view_counts(play_log, as_of, days, types)), topic))


def run_voice(sink: Sink, score_matrix: DataFrame, catalog: DataFrame, as_of: str,
              topic: str = config.TOPIC_VOICE, types: Sequence[str] = config.LONG_VIDEO_TYPES) -> None:
    """yesterday's summed preference score per video."""
    sink.write(heat.voice_payload(heat.voice_scores(score_matrix, catalog, as_of, types), topic))
