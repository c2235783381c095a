"""Stand-in views over the driver's TPC-H-like tables.

The original jobs read play/browse logs, a video catalog, a score matrix and
editorial text files. These builders derive tables of the same shape from
the driver tables (``part``, ``events``, ``lineitem``, ``orders``), so every
operator can be run on data that grows with the scale factor and checked
against DuckDB. The SQL twins live in ``searchlens.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Content types of the stand-in data (lower-cased ``p_type``).
FIXTURE_LONG_TYPES = ("economy", "large", "medium", "promo")
FIXTURE_SHORT_TYPES = ("small", "standard")
FIXTURE_ALL_TYPES = ("economy", "large", "medium", "promo", "small", "standard", "sports")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day_int(ts: Column) -> Column:
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def _props_sid(props: Column) -> Column:
    return F.regexp_extract(props, r"([0-9]+)", 1)


# Characters that stand at the head of two titles in three (the last has no reading).
FIXTURE_CHARACTERS = "行乐长重好"


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video catalog: Chinese, NULL and quoted titles, offline, risk and newer-version rows, and repeated sids.

    Every 50th sid is listed a second time under another title, every 75th
    a second time under the same one; ids do not repeat.
    """
    p = read_table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    first = F.expr(f"substring('{FIXTURE_CHARACTERS}', CAST(p_partkey % 5 + 1 AS INT), 1)")
    second = F.expr(f"substring('{FIXTURE_CHARACTERS}', CAST(p_partkey div 5 % 5 + 1 AS INT), 1)")
    name = F.when(key % 3 == 0, F.col("p_name")).otherwise(F.concat(first, second, F.col("p_name")))
    base = p.select(
        key.alias("id"),
        key.cast("string").alias("sid"),
        F.lower("p_type").alias("content_type"),
        F.when(key % 13 == 0, F.lit(None).cast("string"))
        .when(key % 11 == 0, F.concat(F.lit('"'), name, F.lit('"')))
        .otherwise(name)
        .alias("title"),
        F.lit(1).alias("type"),
        F.when(size % 7 == 0, 0).otherwise(1).alias("status"),
        (size % 3).alias("video_type"),
        F.when(size > 40, 1).otherwise(0).alias("app_version_flag"),
        F.when(size % 10 == 0, 1).otherwise(0).alias("risk_flag"),
    )
    # One scan: the number of 10^9 that each listing's id is moved by. 0 is the first listing, 1 another title, 2 the same.
    listings = F.filter(F.array(F.lit(0), F.when(F.col("id") % 50 == 0, 1), F.when(F.col("id") % 75 == 0, 2)), lambda x: x.isNotNull())
    listed = base.withColumn("_listing", F.explode(listings))
    return listed.select(
        (F.col("id") + F.col("_listing") * F.lit(10**9).cast("bigint")).alias("id"), "sid", "content_type",
        F.when(F.col("_listing") == 1, F.concat("title", F.lit(" II"))).otherwise(F.col("title")).alias("title"),
        "type", "status", "video_type", "app_version_flag", "risk_flag")


def _events_with_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").withColumn("_sid", _props_sid(F.col("props")))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return e.join(p, p["p_partkey"] == F.col("_sid").try_cast("bigint"))


def play_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play log, days 20240101-20240130, with bad users and mismatching log types."""
    j = _events_with_part(spark, sf_dir)
    eid = F.col("event_id")
    user_hash = F.md5(F.col("user_id").cast("string"))
    return j.select(
        eid,
        F.when(eid % 15 == 0, F.lit(None).cast("string"))
        .when(eid % 7 == 0, F.substring(user_hash, 1, 16))
        .otherwise(user_hash)
        .alias("user_id"),
        F.when(eid % 10 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("account_id"),
        F.col("_sid").alias("sid"),
        F.when(eid % 9 == 0, F.lit("sports")).otherwise(F.lower("p_type")).alias("content_type"),
        (F.col("value") * 20).alias("duration"),
        F.when(F.col("event_type") == "view", "userexit")
        .when(F.col("event_type") == "click", "selfend")
        .otherwise(F.col("event_type"))
        .alias("event"),
        F.col("value").alias("score"),
        _day_int(F.col("ts")).alias("key_day"),
        F.hour("ts").cast("int").alias("key_hour"),
    )


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search/browse log from ``lineitem``: NULL users, NULL and empty search text."""
    l = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    j = l.join(o, o["o_orderkey"] == l["l_orderkey"]).join(p, p["p_partkey"] == l["l_partkey"])
    line = F.col("l_linenumber")
    return j.select(
        F.when(F.col("o_custkey") % 25 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("user_id"),
        F.when(line == 6, F.lit(None).cast("string"))
        .when(line == 7, F.lit(""))
        .otherwise(F.upper(F.substring("o_orderpriority", 3, 4)))
        .alias("search_text"),
        F.col("l_partkey").cast("string").alias("sid"),
        F.lower("p_type").alias("content_type"),
        F.when(F.col("l_returnflag") == "R", "detail").otherwise("play").alias("log_type"),
        _day_int(F.col("l_shipdate")).alias("key_day"),
    )


def path_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Navigation paths: NULL, home-type-search codes, bare search codes, misses."""
    p = read_table(spark, sf_dir, "part")
    r = F.col("p_partkey") % 5
    name = F.col("p_name")
    return p.select(
        F.col("p_partkey").cast("string").alias("sid"),
        F.when(r == 0, F.lit(None).cast("string"))
        .when(r == 1, F.concat(F.lit("home-movie-search-"), F.upper(F.substring(name, 1, 3)), F.lit("-x")))
        .when(r == 2, F.concat(F.lit("home-tv-"), F.upper(F.substring(name, 1, 2))))
        .when(r == 3, F.concat(F.lit("home-searc"), F.upper(F.substring(name, 1, 4))))
        .otherwise(F.concat(F.lit("home-sports-"), F.upper(name)))
        .alias("path"),
    )


def editorial_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated editorial text, one ``value`` per line; every 17th line is short."""
    p = read_table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    head = [key.cast("string"), F.lit("\t"), F.lower("p_type")]
    return p.select(
        F.when(key % 17 == 0, F.concat(*head))
        .otherwise(F.concat(*head, F.lit("\t"), F.col("p_name"), F.lit("\t"), F.upper(F.substring("p_name", 1, 4))))
        .alias("value")
    )


def score_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-event preference scores, partitioned by ``partition_tag`` (a yyyyMMdd int)."""
    j = _events_with_part(spark, sf_dir)
    return j.select(
        F.col("_sid").alias("sid_or_subject_code"),
        F.lower("p_type").alias("content_type"),
        F.col("value").alias("score"),
        _day_int(F.col("ts")).alias("partition_tag"),
    )


def access_log_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates spelled as access-log times ``dd/MMM/yyyy:HH:mm:ss``."""
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.date_format("o_orderdate", "dd/MMM/yyyy:HH:mm:ss").alias("en_time"), "o_orderdate")


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ``(topic, key, value)`` messages, the shape a topic mirror copies."""
    return _messages(read_table(spark, sf_dir, "events"))


def topic_message_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream over the table's files."""
    reader = spark.readStream.schema(read_table(spark, sf_dir, "events").schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A pattern, since a stream's plain path must be a folder, and the table may be one file.
    return _messages(reader.parquet(f"{sf_dir}/events.parque[t]"))


def _messages(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("topic"),
        F.col("event_id").cast("string").alias("key"),
        F.col("props").alias("value"),
    )
