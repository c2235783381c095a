"""Topic mirror (B4) on Structured Streaming.

Copies the messages of listed topics from one message source to another
sink, without end. There is no state and no event time: each micro-batch
is a filter, so the query scales with the source's partitions, and the
checkpoint location records source offsets so a restarted query resumes
where it stopped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

MESSAGE_SCHEMA = StructType([
    StructField("topic", StringType()),
    StructField("key", StringType()),
    StructField("value", StringType()),
])


def topic_pattern(topics: Iterable[str] | str) -> str:
    """Anchored alternation of topic names; a string is taken as a ready regex (``a|b|c``)."""
    if isinstance(topics, str):
        return f"^({topics})$"
    return "^(" + "|".join(re.escape(t) for t in topics) + ")$"


def mirror_messages(messages: DataFrame, topics: Iterable[str] | str) -> DataFrame:
    """The mirror's per-row rule: keep messages of the listed topics, key, value and any headers untouched.

    Key and value keep their source type (bytes from Kafka, strings from
    files), so binary payloads are copied as they are. The same function
    runs on a batch frame and on a stream.
    """
    return messages.where(F.col("topic").rlike(topic_pattern(topics))).select(
        "topic", "key", "value", *[c for c in ("headers",) if c in messages.columns])


def read_message_stream(spark: SparkSession, fmt: str, topics: Iterable[str] | str,
                        path: str | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """A stream of ``(topic, key, value)``.

    For Kafka the topic regex is handed to the source (``subscribePattern``)
    so unlisted topics are never read; file sources are read with the fixed
    message schema and filtered.
    """
    r = spark.readStream.format(fmt)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if fmt == "kafka":
        r = r.option("subscribePattern", topic_pattern(topics)).option("includeHeaders", "true")
        return r.load()
    return r.schema(MESSAGE_SCHEMA).load(path)


def start_topic_mirror(
    spark: SparkSession,
    topics: Iterable[str] | str,
    checkpoint_location: str,
    source_format: str = "kafka",
    source_path: str | None = None,
    source_options: Mapping[str, str] | None = None,
    sink_format: str = "kafka",
    sink_path: str | None = None,
    sink_options: Mapping[str, str] | None = None,
    trigger: Mapping[str, object] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the mirror; ``trigger`` e.g. ``{"processingTime": "10 seconds"}`` or ``{"availableNow": True}``."""
    messages = read_message_stream(spark, source_format, topics, source_path, source_options)
    return mirror_stream(messages, topics, checkpoint_location, sink_format, sink_path, sink_options, trigger, query_name)


def mirror_stream(
    messages: DataFrame,
    topics: Iterable[str] | str,
    checkpoint_location: str,
    sink_format: str = "kafka",
    sink_path: str | None = None,
    sink_options: Mapping[str, str] | None = None,
    trigger: Mapping[str, object] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """The mirror over any stream of messages."""
    out = mirror_messages(messages, topics)
    w = out.writeStream.format(sink_format).option("checkpointLocation", checkpoint_location).outputMode("append")
    for k, v in (sink_options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    if sink_format == "kafka":
        return w.start()
    return w.start(sink_path)


def mirrored(messages: DataFrame, topics: Iterable[str] | str, sink_path: str, checkpoint_location: str) -> DataFrame:
    """Everything that ``messages`` (a stream) holds by now, mirrored into parquet files, and what has arrived there.

    The checkpoint keeps how far the source was read and the sink which
    batches are whole, so a run that is stopped between or within batches
    goes on where it was, and nothing arrives twice.
    """
    query = mirror_stream(messages, topics, checkpoint_location, "parquet", sink_path, trigger={"availableNow": True})
    query.awaitTermination()
    # The sink's own log lists the files of whole batches. An empty sink has a log, but no file to take a schema from.
    return messages.sparkSession.read.schema(mirror_messages(messages, topics).schema).parquet(sink_path)
