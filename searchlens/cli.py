"""Command line for ``spark-submit``: one sub-command per job, plus the topic mirror.

    spark-submit searchlens/cli.py \\
        association --play-log logs.play --catalog /data/catalog --as-of 20240130 \\
        --sink-format kafka --sink-option kafka.bootstrap.servers=broker:9092

Inputs are table names (``spark.table``) or paths (parquet, or text for the
editorial list). The catalog can also be a table of a database, read over
JDBC in id ranges: ``--catalog`` names the table and ``--catalog-url`` the
database. ``--as-of`` is required: no job reads the clock.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from searchlens import config  # noqa: E402
from searchlens.plans import jobs  # noqa: E402
from searchlens.session import apply_job_conf  # noqa: E402
from searchlens.sources.catalog import read_catalog_jdbc  # noqa: E402
from searchlens.streaming.mirror import start_topic_mirror  # noqa: E402


def _read(spark: SparkSession, ref: str) -> DataFrame:
    if "/" in ref or ref.endswith(".parquet"):
        return spark.read.parquet(ref)
    return spark.table(ref)


# Catalog columns of each job, for a read that names its columns.
CATALOG_COLUMNS = {
    "hot-lines": ("sid", "content_type", "title", "status"),
    "hot-lines-split": ("sid", "title", "status"),
    "hot": ("sid", "title", "status", "risk_flag"),
    "association": ("id", "sid", "content_type", "type", "status", "video_type", "app_version_flag"),
    "voice": ("id", "sid", "title", "content_type"),
}


def _read_catalog(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if not args.catalog_url:
        return _read(spark, args.catalog)
    bounds = tuple(int(x) for x in args.catalog_bounds.split(",")) if args.catalog_bounds else None
    return read_catalog_jdbc(spark, args.catalog_url, args.catalog, CATALOG_COLUMNS[args.job], args.catalog_condition,
                             num_partitions=args.catalog_partitions, bounds=bounds, properties=_options(args.catalog_option))


def _options(pairs: list[str] | None) -> dict[str, str]:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def _types(s: str | None, default):
    return tuple(t for t in s.split(",") if t) if s else default


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="searchlens")
    sub = p.add_subparsers(dest="job", required=True)

    def job(name: str, *inputs: str, window: bool = True):
        sp = sub.add_parser(name)
        for i in inputs:
            sp.add_argument(f"--{i}", required=True)
        if "catalog" in inputs:
            sp.add_argument("--catalog-url", help="JDBC address; --catalog is then a table there")
            sp.add_argument("--catalog-condition", help="SQL condition of the rows to read")
            sp.add_argument("--catalog-bounds", help="smallest and largest id, comma-separated (default: asked for)")
            sp.add_argument("--catalog-partitions", type=int, default=5)
            sp.add_argument("--catalog-option", action="append")
        sp.add_argument("--as-of", required=name != "editorial", help="yyyyMMdd")
        if window:
            sp.add_argument("--days", type=int)
        sp.add_argument("--types", help="comma-separated content types")
        sp.add_argument("--topic")
        sp.add_argument("--sink-format", default="kafka")
        sp.add_argument("--sink-path")
        sp.add_argument("--sink-option", action="append")
        sp.add_argument("--sink-mode", default="append", choices=("append", "overwrite"))
        return sp

    job("hot-lines", "detail-log", "play-log", "catalog")
    hs = job("hot-lines-split", "detail-log", "play-log", "catalog")
    hs.add_argument("--long-types", help="comma-separated types read from the browse log")
    hs.add_argument("--short-types", help="comma-separated types read from the play log")
    h = job("hot", "play-log", "catalog")
    h.add_argument("--all-searches", action="store_true", help="count every search, not unique searchers (K3)")
    h.add_argument("--all-regions", action="store_true", help="no region block (K3)")
    h.add_argument("--extra-log", action="append", help="a further search log of the same columns")
    e = job("editorial", "lines", window=False)
    e.add_argument("--kids", action="store_true", help="the kids list (K6), with its own topic")
    e.add_argument("--reject-topic", help="topic of the short lines that --on-short drop leaves out")
    e.add_argument("--seed", type=int, default=42)
    e.add_argument("--on-short", choices=("fail", "drop"), default="fail")
    a = job("association", "play-log", "catalog")
    a.add_argument("--key", choices=("id", "sid"), default="id")
    a.add_argument("--app-version-flag", type=int)
    a.add_argument("--profile", action=argparse.BooleanOptionalAction, help="publish users' profiles (default: with --key id)")
    job("heat", "play-log")
    job("voice", "score-matrix", "catalog", window=False)

    m = sub.add_parser("mirror")
    m.add_argument("--topics", required=True, help="comma-separated names, or a regex with --topics-regex")
    m.add_argument("--topics-regex", action="store_true")
    m.add_argument("--checkpoint-location", required=True)
    m.add_argument("--source-format", default="kafka")
    m.add_argument("--source-path")
    m.add_argument("--source-option", action="append")
    m.add_argument("--sink-format", default="kafka")
    m.add_argument("--sink-path")
    m.add_argument("--sink-option", action="append")
    m.add_argument("--trigger-seconds", type=int)
    m.add_argument("--available-now", action="store_true")
    return p


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = build_parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"searchlens-{args.job}").getOrCreate()
    apply_job_conf(spark)
    if args.job == "mirror":
        topics = args.topics if args.topics_regex else [t for t in args.topics.split(",") if t]
        trigger = {"availableNow": True} if args.available_now else (
            {"processingTime": f"{args.trigger_seconds} seconds"} if args.trigger_seconds else None)
        q = start_topic_mirror(spark, topics, args.checkpoint_location, args.source_format, args.source_path,
                               _options(args.source_option), args.sink_format, args.sink_path,
                               _options(args.sink_option), trigger)
        q.awaitTermination()
        return
    sink = jobs.Sink(args.sink_format, args.sink_path, _options(args.sink_option), args.sink_mode)
    topic = {"topic": args.topic} if args.topic else {}
    days = {"days": args.days} if getattr(args, "days", None) is not None else {}
    if args.job in ("hot-lines", "hot-lines-split"):
        run_job = jobs.run_hot_lines if args.job == "hot-lines" else jobs.run_hot_lines_split
        if args.job == "hot-lines":
            extra = {"types": _types(args.types, config.ALL_VIDEO_TYPES)}
        else:
            extra = {"long_types": _types(args.long_types, config.LONG_VIDEO_TYPES),
                     "short_types": _types(args.short_types, config.SHORT_VIDEO_TYPES),
                     "line_types": _types(args.types, config.ALL_VIDEO_TYPES)}
        run_job(sink, _read(spark, args.detail_log), _read(spark, args.play_log), _read_catalog(spark, args),
                args.as_of, **days, **topic, **extra)
    elif args.job == "hot":
        jobs.run_hot(sink, _read(spark, args.play_log), _read_catalog(spark, args), args.as_of, **days,
                     extra_logs=[_read(spark, x) for x in args.extra_log or []],
                     unique=not args.all_searches, risk_free=not args.all_regions, **topic,
                     types=_types(args.types, config.SHORT_VIDEO_TYPES + config.LONG_VIDEO_TYPES))
    elif args.job == "editorial":
        jobs.run_editorial(sink, spark.read.text(args.lines), args.seed, **topic, on_short=args.on_short,
                           kids=args.kids, reject_topic=args.reject_topic)
    elif args.job == "association":
        jobs.run_association(sink, _read(spark, args.play_log), _read_catalog(spark, args), args.as_of, **days,
                             key=args.key, app_version_flag=args.app_version_flag, with_profile=args.profile,
                             top_topic=args.topic, types=_types(args.types, config.ALL_VIDEO_TYPES))
    elif args.job == "heat":
        jobs.run_heat(sink, _read(spark, args.play_log), args.as_of, **days, **topic,
                      types=_types(args.types, config.LONG_VIDEO_TYPES))
    elif args.job == "voice":
        jobs.run_voice(sink, _read(spark, args.score_matrix), _read_catalog(spark, args), args.as_of, **topic,
                       types=_types(args.types, config.LONG_VIDEO_TYPES))


if __name__ == "__main__":
    run()
