"""Physical plans keep the properties the design relies on at scale."""

import pytest

from searchlens import registry as R

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_per_type_top_k_limits_before_the_shuffle(spark):
    text = formatted(R.q_hot_by_type(spark, SF_SMALL))
    assert text.count("WindowGroupLimit") >= 2  # partial (map side) and final


def test_total_top_k_limits_before_single_partition(spark):
    # either a partial WindowGroupLimit or TakeOrderedAndProject (per-partition top-k, then one merge)
    text = formatted(R.q_hot_total(spark, SF_SMALL))
    assert "WindowGroupLimit" in text or "TakeOrderedAndProject" in text


def test_scan_prunes_columns(spark):
    text = formatted(R.q_filter_content_type(spark, SF_SMALL))
    schema = [l for l in text.splitlines() if l.startswith("ReadSchema") and "event_id" in l][0]
    assert "props" in schema and "value" not in schema and "event_type" not in schema and "user_id" not in schema


def test_pushed_filters_reach_parquet(spark):
    from searchlens.operators.filters import filter_valid_play
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumnRenamed("value", "duration") \
        .withColumnRenamed("event_type", "event")
    text = formatted(filter_valid_play(events).select("event_id"))
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,300.0), LessThan(value,7200.0), In(event_type" in text


def test_aggregates_combine_map_side(spark):
    text = formatted(R.q_unique_searchers(spark, SF_SMALL))
    assert "partial_count" in text


def test_preference_profile_shuffles_twice_after_the_join(spark):
    # hourly counts (1) and the (user, account) partitioning (2) that the band sums,
    # the share window and the profile reuse; the scan side may add fixture joins.
    from searchlens.operators.aggregates import preference_shares, profile_documents
    df = spark.createDataFrame([("u", 1, 12, "tv")], "user_id string, account_id bigint, key_hour int, content_type string")
    text = formatted(profile_documents(preference_shares(df)))
    tree = text.split("\n\n")[0]
    assert tree.count("- Exchange") == 2


@pytest.mark.parametrize("k", [20, 5000])
def test_top_k_keeps_its_limit_for_any_k(spark, k):
    from pyspark.sql import functions as F
    from searchlens.operators.ranking import GROUP_LIMIT, top_k
    df = spark.range(0, 100_000, 1, 20).select(F.col("id").alias("n"), (F.col("id") % 3).alias("g"))
    assert "TakeOrderedAndProject" in formatted(top_k(df, k, ["n"]))
    before = spark.conf.get(GROUP_LIMIT)
    tree = formatted(top_k(df, k, ["n"], ["g"])).split("\n\n")[0]
    assert spark.conf.get(GROUP_LIMIT) == before == "1000"
    # By Spark itself up to its threshold, else by a ranking of parts of each group.
    assert tree.count("WindowGroupLimit") == 2 if k < 1000 else tree.count("- Window") == 2 and tree.count("- Exchange") == 2


def test_two_level_ranking_sends_k_rows_a_salt(spark):
    from pyspark.sql import functions as F
    from searchlens.operators.ranking import top_k
    # One group holds all rows but a few, and a third of them are alike.
    df = spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") < 100, "small").otherwise("large").alias("g"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(10**6))).alias("n"))
    want = {g: sorted(r["n"] for r in df.where(F.col("g") == g).collect())[:2000] for g in ("small", "large")}
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = top_k(df, 2000, ["n"], ["g"], salts=16)
        rows = [(r["g"], r["rank"], r["n"]) for r in out.collect()]
        final = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    for g in want:
        assert sorted((k, n) for h, k, n in rows if h == g) == list(enumerate(want[g], 1))
    assert "_place" in final and final.count("Exchange hashpartitioning") == 2


def test_one_row_per_video_meets_the_titles(spark):
    from searchlens.plans import hot
    from searchlens.sources import fixtures as fx
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = spark.createDataFrame([("a", "t", "s", 1)], "search_text string, content_type string, sid string, num bigint")
        tree = formatted(hot.rollup_with_titles(counts, fx.catalog(spark, SF_SMALL), False)).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    side = tree[tree.index("SortMergeJoin"):]
    assert side.index("Aggregate") < side.index("LocalTableScan" if "LocalTableScan" in side else "Scan")


def test_spellings_of_a_long_title(spark):
    from pyspark.sql import functions as F
    from searchlens.functions.titles import spelling_rows
    one = spark.range(1).select(F.expr("transform(sequence(1, 500), i -> if(i % 100 = 0, array('a ', 'b '), array('c ')))").alias("readings"))
    assert spelling_rows(one).count() == 32


def test_day_window_prunes_partitions(spark):
    import os
    import tempfile
    from searchlens.sources.logs import read_log_days
    from searchlens.sources import fixtures as fx
    path = os.path.join(tempfile.mkdtemp(prefix="days-"), "play")
    fx.play_log(spark, SF_SMALL).write.partitionBy("key_day").parquet(path)
    df = read_log_days(spark, path, "20240130", 3)
    text = formatted(df.select("sid"))
    assert "PartitionFilters: [isnotnull(key_day" in text and "(key_day#" in text and "> 20240127)" in text
    assert sorted(r[0] for r in df.select("key_day").distinct().collect()) == [20240128, 20240129, 20240130]


# Static shuffle counts of the jobs' plans, with the small tables broadcast. A change that adds an exchange must
# update this. (The heat job's means are joined by an exchange in the static plan; at run time their size lets Spark
# broadcast them.)
SHUFFLES = {"assoc_top_videos": 2, "assoc_top_videos_by_id": 2, "preference_profile": 3, "pref_payload": 3,
            "heat_score": 4, "hot_by_type": 5, "hot_total": 5, "hot_lines": 5, "hot_payload": 6, "unique_searchers": 2,
            "video_rollup": 3, "voice_scores": 1, "kids_play_rank": 4, "hot_by_type_three_logs": 5, "editorial_sample": 1, "editorial_payload": 2}


def test_shuffle_counts_do_not_grow(spark):
    import re
    pattern = r"(?<!Broadcast)Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)"
    got = {k: len(re.findall(pattern, R.QUERIES[k](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()))
           for k in SHUFFLES}
    assert got == SHUFFLES


def test_score_matrix_day_prunes_partitions(spark):
    import os
    import tempfile
    from searchlens.sources.catalog import scan_score_matrix
    from searchlens.sources import fixtures as fx
    path = os.path.join(tempfile.mkdtemp(prefix="matrix-"), "scores")
    fx.score_matrix(spark, SF_SMALL).write.partitionBy("partition_tag").parquet(path)
    day = scan_score_matrix(path, 20240130, spark=spark)
    text = formatted(day.select("sid_or_subject_code", "score"))
    assert "PartitionFilters: [isnotnull(partition_tag" in text and "= 20240130)" in text
    assert [r[0] for r in day.select("partition_tag").distinct().collect()] == [20240130]
    want = fx.score_matrix(spark, SF_SMALL).where("partition_tag = 20240130").count()
    assert day.count() == want > 0


def test_a_catalog_table_is_read_by_its_partitions(spark):
    df = R.q_table_log_window(spark, SF_SMALL)
    text = formatted(df)
    assert "PartitionFilters: [isnotnull(key_day" in text and "> 20240117)" in text
    days = {r[0] for r in df.select("key_day").distinct().collect()}
    assert days == set(range(20240118, 20240131)) and {f.split("key_day=")[1][:8] for f in df.inputFiles()} == set(map(str, days))


@pytest.mark.parametrize("query", [R.q_weekend_plays, R.q_weekend_scores])
def test_a_table_of_days_prunes_the_log(spark, query):
    df = query(spark, SF_SMALL)
    assert "dynamicpruning" in formatted(df)
    df.collect()
    scan = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "dynamicpruning" in line]
    assert scan


def test_three_logs_are_one_scan_and_one_distinct(spark):
    tree = formatted(R.q_hot_by_type_three_logs(spark, SF_SMALL)).split("\n\n")[0]
    one = formatted(R.q_hot_by_type(spark, SF_SMALL)).split("\n\n")[0]
    assert tree.count("Generate") == one.count("Generate") + 1
    # lineitem, orders and part once for the log; part once more for the paths
    assert tree.count("Scan parquet") == one.count("Scan parquet") + 1


def test_many_days_are_not_broadcast(spark, monkeypatch):
    from searchlens.sources import logs
    log = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "key_day int, sid string")
    days = spark.createDataFrame([(1,), (3,)], "key_day int")
    for most in (36_525, 1):
        monkeypatch.setattr(logs, "MAX_DAYS", most)
        assert sorted(r["sid"] for r in logs.read_log_on(log, days).collect()) == ["a", "c"]
