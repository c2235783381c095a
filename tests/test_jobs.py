"""Jobs write each payload once, through a file sink."""

import json
import os
import tempfile

from searchlens import config
from searchlens import registry as R
from searchlens.plans import jobs
from searchlens.sources import fixtures as fx

from .conftest import SF_SMALL


def _read(spark, path):
    return spark.read.json(path).collect()


def test_run_hot_and_association_write_documents(spark):
    out = tempfile.mkdtemp(prefix="jobs-")
    sink = jobs.Sink(fmt="json", path=os.path.join(out, "msgs"))
    play = fx.search_log(spark, SF_SMALL).where("log_type = 'play'")
    jobs.run_hot(sink, play, fx.catalog(spark, SF_SMALL), R.SEARCH_AS_OF, R.SEARCH_DAYS, types=R.SHORT_LONG)
    jobs.run_association(sink, fx.play_log(spark, SF_SMALL), fx.catalog(spark, SF_SMALL), R.PLAY_AS_OF, R.PLAY_DAYS,
                         types=R.ALL)
    jobs.run_heat(sink, fx.play_log(spark, SF_SMALL), R.PLAY_AS_OF, R.PLAY_DAYS, types=R.LONG)
    msgs = _read(spark, sink.path)
    by_topic = {}
    for m in msgs:
        by_topic.setdefault(m["topic"], []).append(m)
    assert len(by_topic[config.TOPIC_HOT]) == 1
    assert "total" in json.loads(by_topic[config.TOPIC_HOT][0]["value"])
    assert len(by_topic[config.TOPIC_TOP_VIDEOS_BY_ID]) == 1
    assert len(by_topic[config.TOPIC_USER_TYPES]) == R.q_pref_payload(spark, SF_SMALL).count()
    assert len(by_topic[config.TOPIC_HEAT]) == R.q_heat_score(spark, SF_SMALL).count() > 0
    assert all(json.loads(m["value"])["type"] == "vv" for m in by_topic[config.TOPIC_HEAT])


def test_cli_runs_jobs_from_paths(spark):
    from searchlens import cli
    out = tempfile.mkdtemp(prefix="cli-")
    play, cat, views = (os.path.join(out, x) for x in ("play", "catalog", "views"))
    fx.search_log(spark, SF_SMALL).where("log_type = 'play'").write.parquet(play)
    fx.catalog(spark, SF_SMALL).write.parquet(cat)
    fx.play_log(spark, SF_SMALL).write.parquet(views)
    sink = os.path.join(out, "msgs")
    common = ["--sink-format", "json", "--sink-path", sink]
    cli.run(["hot", "--play-log", play, "--catalog", cat, "--as-of", R.SEARCH_AS_OF, "--days", str(R.SEARCH_DAYS),
             "--types", ",".join(R.SHORT_LONG), "--all-searches", "--all-regions", "--topic", "cli-hot", *common], spark)
    cli.run(["heat", "--play-log", views, "--as-of", R.PLAY_AS_OF, "--days", str(R.PLAY_DAYS),
             "--types", ",".join(R.LONG), *common], spark)
    msgs = _read(spark, sink)
    hot_doc = [json.loads(m["value"]) for m in msgs if m["topic"] == "cli-hot"]
    assert len(hot_doc) == 1
    want = R.q_hot_by_type_all_regions(spark, SF_SMALL).collect()
    for t, items in hot_doc[0].items():
        if t != "total":
            assert [e["sid"] for e in items] == [r["sid"] for r in sorted((r for r in want if r["content_type"] == t),
                                                                           key=lambda r: r["rank"])]
    assert sum(m["topic"] == config.TOPIC_HEAT for m in msgs) == R.q_heat_score(spark, SF_SMALL).count()


def test_cli_every_job_writes_messages(spark):
    from searchlens import cli
    out = tempfile.mkdtemp(prefix="cli-all-")
    paths = {n: os.path.join(out, n) for n in ("play", "detail", "catalog", "views", "scores", "lines", "msgs")}
    log = fx.search_log(spark, SF_SMALL)
    log.where("log_type = 'play'").write.parquet(paths["play"])
    log.where("log_type = 'detail'").write.parquet(paths["detail"])
    fx.catalog(spark, SF_SMALL).write.parquet(paths["catalog"])
    fx.play_log(spark, SF_SMALL).write.parquet(paths["views"])
    fx.score_matrix(spark, SF_SMALL).write.parquet(paths["scores"])
    fx.editorial_lines(spark, SF_SMALL).write.text(paths["lines"])
    sink = ["--sink-format", "json", "--sink-path", paths["msgs"]]
    search = ["--as-of", R.SEARCH_AS_OF, "--days", str(R.SEARCH_DAYS)]
    plays = ["--as-of", R.PLAY_AS_OF, "--days", str(R.PLAY_DAYS)]
    cli.run(["hot-lines", "--detail-log", paths["detail"], "--play-log", paths["play"], "--catalog", paths["catalog"],
             *search, "--types", ",".join(R.ALL), *sink], spark)
    cli.run(["hot-lines-split", "--detail-log", paths["detail"], "--play-log", paths["play"], "--catalog", paths["catalog"],
             *search, "--long-types", ",".join(R.LONG), "--short-types", ",".join(R.SHORT), "--types", ",".join(R.ALL),
             *sink], spark)
    cli.run(["editorial", "--lines", paths["lines"], "--on-short", "drop", "--kids", "--reject-topic", config.TOPIC_REJECTS,
             *sink], spark)
    cli.run(["editorial", "--lines", paths["lines"], "--on-short", "drop", *sink], spark)
    cli.run(["association", "--play-log", paths["views"], "--catalog", paths["catalog"], *plays, "--key", "sid",
             "--app-version-flag", "0", "--types", ",".join(R.ALL), *sink], spark)
    cli.run(["voice", "--score-matrix", paths["scores"], "--catalog", paths["catalog"], "--as-of", R.VOICE_AS_OF,
             "--types", ",".join(R.LONG), *sink], spark)
    by_topic = {}
    for m in _read(spark, paths["msgs"]):
        by_topic[m["topic"]] = by_topic.get(m["topic"], 0) + 1
    assert by_topic[config.TOPIC_HOT_LINES] == R.q_hot_lines(spark, SF_SMALL).count()
    assert by_topic[config.TOPIC_EDITORIAL] == by_topic[config.TOPIC_KIDS] == 1
    assert by_topic[config.TOPIC_REJECTS] == R.q_editorial_rejects(spark, SF_SMALL).count() > 0
    assert by_topic[config.TOPIC_TOP_VIDEOS] == 1  # K9: sid key, older versions only
    assert config.TOPIC_USER_TYPES not in by_topic  # only the variant by id publishes profiles
    assert by_topic[config.TOPIC_VOICE] == R.q_voice_scores(spark, SF_SMALL).count()
    assert by_topic[config.TOPIC_HOT_LINES_SPLIT] == R.q_hot_lines_split_types(spark, SF_SMALL).count()


def test_overwrite_keeps_other_topics(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="overwrite-"), "msgs")
    sink = jobs.Sink(fmt="json", path=path, mode="overwrite")
    schema = "topic string, key string, value string"
    for topic, value in (("t1", "a"), ("t2", "b"), ("t1", "c")):
        sink.write(spark.createDataFrame([(topic, None, value)], schema))
    assert sorted((r["topic"], r["value"]) for r in _read(spark, path)) == [("t1", "c"), ("t2", "b")]


def test_variants_have_their_own_topics(spark):
    topics = []

    class Record(jobs.Sink):
        def write(self, messages):
            topics.append(messages.first()["topic"])

    play, cat = fx.search_log(spark, SF_SMALL).where("log_type = 'play'"), fx.catalog(spark, SF_SMALL)
    jobs.run_hot(Record(), play, cat, R.SEARCH_AS_OF, R.SEARCH_DAYS, unique=False, risk_free=False, types=R.SHORT_LONG)
    jobs.run_association(Record(), fx.play_log(spark, SF_SMALL), cat, R.PLAY_AS_OF, R.PLAY_DAYS, key="sid", types=R.ALL)
    jobs.run_editorial(Record(), fx.editorial_lines(spark, SF_SMALL), 1, on_short="drop", kids=True)
    assert topics == [config.TOPIC_HOT_ALL_REGIONS, config.TOPIC_TOP_VIDEOS_ALL_VERSIONS, config.TOPIC_KIDS]


def test_a_window_of_no_days_is_empty_and_a_third_log_counts(spark):
    from searchlens import cli
    out = tempfile.mkdtemp(prefix="cli-days-")
    play, cat, sink = (os.path.join(out, x) for x in ("play", "catalog", "msgs"))
    fx.search_log(spark, SF_SMALL).where("log_type = 'play'").write.parquet(play)
    fx.catalog(spark, SF_SMALL).write.parquet(cat)
    common = ["hot", "--play-log", play, "--catalog", cat, "--as-of", R.SEARCH_AS_OF, "--types", ",".join(R.SHORT_LONG),
              "--sink-format", "json", "--sink-path", sink]
    cli.run([*common, "--days", "0", "--topic", "none"], spark)
    cli.run([*common, "--days", str(R.SEARCH_DAYS), "--extra-log", play, "--extra-log", play, "--topic", "three"], spark)
    docs = {m["topic"]: json.loads(m["value"]) for m in _read(spark, sink)}
    assert docs["none"] == {}
    assert [e["sid"] for e in docs["three"]["total"]] == [r["sid"] for r in R.q_hot_total(spark, SF_SMALL).orderBy("rank").collect()]


def test_catalog_over_jdbc_is_reachable(monkeypatch):
    """The options that reach the JDBC reader; no database is there to read from."""
    from searchlens import cli
    asked = []
    monkeypatch.setattr(cli, "read_catalog_jdbc", lambda *a, **k: asked.append((a, k)))
    args = cli.build_parser().parse_args([
        "voice", "--score-matrix", "m", "--catalog", "program", "--catalog-url", "jdbc:db://host/cms", "--catalog-condition",
        "id > 0", "--catalog-bounds", "1,99", "--catalog-option", "user=u", "--as-of", "20240131"])
    cli._read_catalog(None, args)
    (_, url, table, columns, condition), options = asked[0]
    assert (url, table, condition) == ("jdbc:db://host/cms", "program", "id > 0")
    assert columns == ("id", "sid", "title", "content_type")
    assert options == {"num_partitions": 5, "bounds": (1, 99), "properties": {"user": "u"}}
