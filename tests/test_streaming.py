"""Topic mirror (B4) as a Structured Streaming query with a checkpoint."""

import os
import tempfile


from searchlens.streaming.mirror import MESSAGE_SCHEMA, mirror_messages, start_topic_mirror, topic_pattern


def test_only_listed_topics_pass(spark):
    scratch = tempfile.mkdtemp(prefix="mirror-")
    src, sink, ckpt = (os.path.join(scratch, x) for x in ("src", "sink", "ckpt"))
    rows = [("listed", "k1", "v1"), ("other", "k2", "v2"), ("listed", None, "v3"), ("listed-x", "k4", "v4")]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).write.json(src)
    q = start_topic_mirror(spark, ["listed"], ckpt, source_format="json", source_path=src, sink_format="json",
                           sink_path=sink, trigger={"availableNow": True})
    q.awaitTermination(120)
    got = {(r["key"], r["value"]) for r in spark.read.schema(MESSAGE_SCHEMA).json(sink).collect()}
    assert got == {(None, "v3"), ("k1", "v1")}
    # a restart with the same checkpoint copies only new messages
    spark.createDataFrame([("listed", "k5", "v5")], MESSAGE_SCHEMA).write.mode("append").json(src)
    q = start_topic_mirror(spark, ["listed"], ckpt, source_format="json", source_path=src, sink_format="json",
                           sink_path=sink, trigger={"availableNow": True})
    q.awaitTermination(120)
    assert sorted(r["value"] for r in spark.read.schema(MESSAGE_SCHEMA).json(sink).collect()) == ["v1", "v3", "v5"]


def test_batch_rule_and_regex_whitelist(spark):
    df = spark.createDataFrame([("a.b", "1", "x"), ("a-b", "2", "y"), ("c", "3", "z")], MESSAGE_SCHEMA)
    assert sorted(r["key"] for r in mirror_messages(df, ["a.b", "c"]).collect()) == ["1", "3"]
    assert sorted(r["key"] for r in mirror_messages(df, "a.b|c").collect()) == ["1", "2", "3"]
    assert topic_pattern(["x"]) == "^(x)$"
    headed = spark.createDataFrame([("c", "1", "x", "h")], "topic string, key string, value string, headers string")
    assert mirror_messages(headed, ["c"]).first()["headers"] == "h"


def test_cli_mirror_available_now(spark):
    from searchlens import cli
    scratch = tempfile.mkdtemp(prefix="cli-mirror-")
    src, sink, ckpt = (os.path.join(scratch, x) for x in ("src", "sink", "ckpt"))
    spark.createDataFrame([("a", "1", "x"), ("b", "2", "y"), ("c", "3", "z")], MESSAGE_SCHEMA).write.json(src)
    cli.run(["mirror", "--topics", "a,c", "--checkpoint-location", ckpt, "--source-format", "json", "--source-path", src,
             "--sink-format", "json", "--sink-path", sink, "--available-now"], spark)
    assert sorted(r["key"] for r in spark.read.schema(MESSAGE_SCHEMA).json(sink).collect()) == ["1", "3"]


class _Recorder:
    """Stand-in for a reader or writer: records format, options and calls."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args))
            return self
        return call


def test_kafka_wiring_without_a_broker():
    from types import SimpleNamespace
    from searchlens.sinks.messages import write_messages
    from searchlens.streaming.mirror import read_message_stream
    source = _Recorder()
    spark = SimpleNamespace(readStream=source)
    read_message_stream(spark, "kafka", ["play-log", "browse.log"], options={"kafka.bootstrap.servers": "b:9092"})
    assert ("format", ("kafka",)) in source.calls
    assert ("option", ("subscribePattern", "^(play\\-log|browse\\.log)$")) in source.calls
    assert ("option", ("includeHeaders", "true")) in source.calls
    assert ("option", ("kafka.bootstrap.servers", "b:9092")) in source.calls and ("load", ()) in source.calls
    writer = _Recorder()
    write_messages(SimpleNamespace(write=writer), "kafka", options={"kafka.bootstrap.servers": "b:9092"})
    assert ("format", ("kafka",)) in writer.calls and ("save", ()) in writer.calls
    assert not any(name == "partitionBy" for name, _ in writer.calls)


def _stop_after_first_batch(stream, topics, sink, checkpoint):
    """Run the mirror without end and stop it once a batch is through."""
    import time
    from searchlens.streaming.mirror import mirror_stream
    q = mirror_stream(stream, topics, checkpoint, "parquet", sink, trigger={"processingTime": "3 seconds"})
    for _ in range(600):
        if any(p["batchId"] >= 0 and p["numInputRows"] for p in q.recentProgress):
            break
        time.sleep(0.05)
    q.stop()
    return q


def test_the_mirror_of_a_table_as_a_stream(spark, tmp_path):
    from searchlens import registry as R
    from searchlens.sources import fixtures as fx
    from searchlens.streaming.mirror import mirrored

    from .conftest import SF_SMALL
    want = sorted(map(tuple, R.q_topic_mirror(spark, SF_SMALL).collect()))
    assert want and sorted(map(tuple, R.q_topic_mirror_stream(spark, SF_SMALL).collect())) == want
    # The same table in many files, one a batch, with a stop in between.
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(5).write.parquet(f"{tmp_path}/in/events.parquet")
    stream = fx.topic_message_stream(spark, f"{tmp_path}/in", files_per_batch=1)
    sink, checkpoint = f"{tmp_path}/sink", f"{tmp_path}/checkpoint"
    _stop_after_first_batch(stream, R.MIRROR_TOPICS, sink, checkpoint)
    part = spark.read.parquet(sink).count()
    assert 0 < part < len(want)
    assert sorted(map(tuple, mirrored(stream, R.MIRROR_TOPICS, sink, checkpoint).collect())) == want
    assert len(os.listdir(f"{checkpoint}/commits")) >= 5
    # Nothing new: nothing arrives again.
    assert mirrored(stream, R.MIRROR_TOPICS, sink, checkpoint).count() == len(want)


def test_the_mirror_of_nothing(spark, tmp_path):
    from searchlens.sources import fixtures as fx
    from searchlens.streaming.mirror import mirrored

    from .conftest import SF_SMALL
    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(0).write.parquet(f"{tmp_path}/in/events.parquet")
    stream = fx.topic_message_stream(spark, f"{tmp_path}/in")
    assert mirrored(stream, ["view"], f"{tmp_path}/sink", f"{tmp_path}/checkpoint").count() == 0
