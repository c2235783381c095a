
import pytest
from pyspark.sql import functions as F

from searchlens import config
from searchlens.functions import dates as D
from searchlens.functions import scalars as S
from searchlens.functions import titles as T
from searchlens.operators import aggregates as A
from searchlens.operators import filters as C
from .conftest import SF_SMALL
from searchlens.operators.features import encode_categories, index_categories, vector_columns
from searchlens.operators.joins import join_catalog_type, join_titles, keep_valid
from searchlens.operators.ranking import seeded_sample, top_k
from searchlens.plans import heat
from searchlens.sources.editorial import parse_editorial


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_unique_searchers_null_user_counts_once(spark):
    df = spark.createDataFrame(
        [("u1", "A", "t", "s"), ("u1", "A", "t", "s"), (None, "A", "t", "s"), (None, "A", "t", "s")],
        "user_id string, search_text string, content_type string, sid string")
    out = A.unique_searchers(df)
    assert rows(out, "search_text", "sid", "num") == [("A", "s", 2)]
    assert rows(A.search_counts(df.drop("user_id")), "num") == [(4,)]


def _views(spark, counts):
    data = [(t, sid, n) for t, per in counts.items() for sid, n in per.items()]
    return spark.createDataFrame(data, "content_type string, sid string, n bigint")


def test_heat_flat_type_scores_100(spark):
    counts = _views(spark, {"movie": {"a": 1, "b": 1, "c": 1}})
    assert rows(heat.heat_scores(counts), "sid", "score") == [("a", 100.0), ("b", 100.0), ("c", 100.0)]


def test_heat_mixed_counts(spark):
    counts = _views(spark, {"movie": {"a": 8, "b": 4, "c": 1}})
    got = dict(rows(heat.heat_scores(counts), "sid", "score"))
    import math
    mean = (8 + 4 + 1) / 3
    assert got["c"] == 0.0
    assert got["a"] == 100.0  # above the mean: clamped
    assert got["b"] == pytest.approx(min(math.log(4) / math.log(mean) * 100, 100.0))


def test_heat_top50_mean_only(spark):
    counts = _views(spark, {"tv": {f"s{i:03d}": (100 if i < 50 else 1) for i in range(60)}})
    means = rows(heat.top_mean_views(counts), "content_type", "mean_views")
    assert means == [("tv", 100.0)]


def test_time_bands_overlap_and_null_hour(spark):
    hours = [10, 11, 14, 15, 16, 18, 21, 22, None]
    df = spark.createDataFrame([("u" * 32, 1, h, "movie") for h in hours],
                               "user_id string, account_id bigint, key_hour int, content_type string")
    shares = A.preference_shares(df)
    n = dict(rows(shares, "band", "n"))
    assert n == {"allTime": 9, "noon": 2, "afternoon": 2, "night": 2}
    assert set(rows(shares, "score")) == {(1.0,)}


def test_preference_share_and_positions(spark):
    df = spark.createDataFrame(
        [("u", 1, 12, "tv"), ("u", 1, 12, "tv"), ("u", 1, 12, "movie"), ("u", 1, 3, "kids"), ("v", None, 12, "tv")],
        "user_id string, account_id bigint, key_hour int, content_type string")
    shares = A.preference_shares(df)
    got = rows(shares.where("band = 'allTime'"), "content_type", "score", "position")
    assert got == [("kids", 0.25, 2), ("movie", 0.25, 3), ("tv", 0.5, 1)]
    noon = rows(shares.where("band = 'noon'"), "content_type", "score")
    assert noon == [("movie", pytest.approx(1 / 3)), ("tv", pytest.approx(2 / 3))]
    docs = A.profile_documents(shares).collect()
    assert len(docs) == 1 and docs[0]["afternoon"] is None and docs[0]["night"] is None
    assert [e["contentType"] for e in docs[0]["allTime"]] == ["tv", "kids", "movie"]


def test_string_hours_compare_as_two_digits(spark):
    df = spark.createDataFrame([("u", 1, "09", "tv"), ("u", 1, "11", "tv")],
                               "user_id string, account_id bigint, key_hour string, content_type string")
    bands = rows(A.preference_shares(df), "band")
    assert bands == [("allTime",), ("noon",)]


def test_top_k_tie_break_smaller_sid_first(spark):
    data = [("movie", f"s{i:02d}", 100 - i) for i in range(19)] + [("movie", "zz", 5), ("movie", "aa", 5)]
    df = spark.createDataFrame(data, "content_type string, sid string, n bigint")
    top = top_k(df, 20, [F.desc("n"), F.asc("sid")], ["content_type"])
    got = {r["sid"]: r["rank"] for r in top.collect()}
    assert len(got) == 20 and got["aa"] == 20 and "zz" not in got


def test_duplicate_catalog_sid_gives_two_groups(spark):
    counts = spark.createDataFrame([("A", "tv", "s1", 3), ("B", "tv", "s1", 5)],
                                   "search_text string, content_type string, sid string, num bigint")
    titles = spark.createDataFrame([("s1", "one", 1), ("s1", "uno", 0)], "sid string, title string, status int")
    out = A.video_rollup(join_titles(counts, titles))
    assert rows(out, "title", "search_code", "num") == [("one", "B", 8), ("uno", "B", 8)]


def test_rollup_text_tie_goes_to_smaller_text(spark):
    counts = spark.createDataFrame([("B", "tv", "s1", 3), ("A", "tv", "s1", 3)],
                                   "search_text string, content_type string, sid string, num bigint")
    titles = spark.createDataFrame([("s1", "one", 1)], "sid string, title string, status int")
    assert rows(A.video_rollup(join_titles(counts, titles)), "search_code", "num") == [("A", 6)]


def test_catalog_type_replaces_log_type(spark):
    plays = spark.createDataFrame([("s1", "sports")], "sid string, content_type string")
    cat = spark.createDataFrame([("s1", "movie")], "sid string, content_type string")
    assert rows(join_catalog_type(plays, cat), "sid", "content_type") == [("s1", "movie")]


def test_keep_valid_is_semi_join(spark):
    left = spark.createDataFrame([("s1", 1), ("s2", 2)], "sid string, n int")
    valid = spark.createDataFrame([("s1",), ("s1",)], "sid string")
    assert rows(keep_valid(left, valid), "sid", "n") == [("s1", 1)]


def test_window_filter_types(spark):
    df = spark.createDataFrame([(20240117,), (20240118,), (20240120,), (20240121,)], "key_day int")
    assert rows(C.filter_window(df, "20240120", 3), "key_day") == [(20240118,), (20240120,), (20240121,)]
    sdf = spark.createDataFrame([("20240117",), ("20240118",)], "key_day string")
    assert rows(C.filter_window(sdf, 20240120, 3), "key_day") == [("20240118",)]


def test_valid_play_bounds_exclusive(spark):
    df = spark.createDataFrame([(300.0, "userexit"), (301.0, "selfend"), (7199.0, "userexit"), (7200.0, "userexit"),
                                (None, "userexit"), (500.0, "error")], "duration double, event string")
    assert rows(C.filter_valid_play(df), "duration") == [(301.0,), (7199.0,)]
    assert len(C.filter_valid_play(df, event_col=None).collect()) == 3


def test_identity_filter(spark):
    df = spark.createDataFrame([("x" * 32, None), ("x" * 31, None), (None, 5), (None, None)],
                               "user_id string, account_id bigint")
    assert len(C.filter_identity(df).collect()) == 2


def test_path_codes(spark):
    df = spark.createDataFrame([("home-movie-search-ABC-x",), ("home-tv-XY",), ("home-searcQQ",), ("home-sports-Z",),
                                ("searchABC",), ("search-ABC",), (None,)], "path string")
    got = [(r[0], r[1]) for r in df.select(S.path_code_home("path"), S.path_code_search("path")).collect()]
    assert got == [("ABC", None), ("XY", None), (None, "QQ"), (None, None), (None, "ABC"), (None, None), (None, None)]


def test_access_log_dates(spark):
    df = spark.createDataFrame([("10/Oct/2019:13:55:36",), ("10/Xxx/2019:13:55:36",), (None,)], "t string")
    out = df.select(D.en_to_cn_datetime("t").alias("dt"), D.en_to_cn_date("t").alias("d"),
                    D.en_to_cn_array("t").alias("a")).collect()
    assert (out[0]["dt"], out[0]["d"], out[0]["a"]) == ("2019-10-10 13:55:36", "2019-10-10", ["2019-10-10", "2019-10-10 13:55:36"])
    assert (out[1]["dt"], out[1]["d"], out[1]["a"]) == (None, None, ["", ""])
    assert (out[2]["dt"], out[2]["d"]) == (None, None)


def test_short_access_log_dates_are_null(spark):
    df = spark.createDataFrame([("10/Oct/20",), ("10/Oct/2019",), ("10/Oct/2019:",)], "t string")
    out = df.select(D.en_to_cn_datetime("t").alias("dt"), D.en_to_cn_date("t").alias("d"), D.en_to_cn_array("t").alias("a")).collect()
    assert [tuple(r) for r in out] == [(None, None, ["", ""]), (None, "2019-10-10", ["", ""]),
                                       ("2019-10-10 ", "2019-10-10", ["2019-10-10", "2019-10-10 "])]


def test_lines_keep_their_fields(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, n int")
    assert df.select(S.joined_line("x", "y", "n")).first()[0] == "a||||3"


def test_short_editorial_lines_are_returned(spark):
    from searchlens.sources.editorial import short_lines
    lines = spark.createDataFrame([("1\tmovie\tTitle\tTT",), ("2\ttv\t\t",), ("",)], "value string")
    assert rows(short_lines(lines), "value", "n_fields") == [("", 0), ("2\ttv\t\t", 2)]


def test_path_preset_reads_text_from_paths(spark):
    from searchlens.sources.logs import log_retrieval, path_search_preset
    log = spark.createDataFrame([("home-tv-XY", "tv", "s1", 20240120), (None, "tv", "s2", 20240120), ("home-tv-Z", "mv", "s3", 20240120)],
                                "path string, content_type string, sid string, key_day int")
    out = log_retrieval(log, "20240120", 3, *reversed_preset(path_search_preset(["tv"], ["tv"])))
    assert sorted((r["search_text"] or "", r["sid"], r["num"]) for r in out.collect()) == [("", "s2", 1), ("XY", "s1", 1)]


def test_calendar_functions(spark):
    df = spark.createDataFrame([("20240303",), ("20240304",), ("20240302",)], "d string")
    day = D.parse_day("d")
    out = df.select(D.add_days("d", -3).alias("m3"), D.add_days("d", 1, "yyyy-MM-dd").alias("p1"),
                    D.is_sunday(day).alias("sun"), D.is_monday(day).alias("mon"), D.is_weekend(day).alias("we"),
                    D.week_range(day).alias("wk"), D.days_gap("d", F.lit("20240101")).alias("gap")).collect()
    assert (out[0]["m3"], out[0]["p1"], out[0]["sun"], out[0]["we"]) == ("20240229", "2024-03-04", True, True)
    assert (out[1]["mon"], out[1]["we"], out[1]["gap"]) == (True, False, 63)
    assert (out[2]["sun"], out[2]["we"], out[0]["wk"]) == (False, True, "2024-02-26~2024-03-03")
    assert C.day_add("20240301", -1) == "20240229" and C.window_start(20240120, 3) == "20240117"


READINGS = [("行", ["hang", "xing"]), ("乐", ["le", "yue"])]


def _titled(spark, rows):
    readings = spark.createDataFrame(READINGS, "ch string, readings array<string>")
    return T.title_readings(spark.createDataFrame(rows, "k int, title string"), readings)


def test_title_readings_spellings_and_code(spark):
    df = _titled(spark, [(1, "行乐 abc12"), (2, "***"), (3, None), (4, "爱")])
    got = {r["k"]: r for r in df.select("k", T.search_code("readings").alias("code"), T.has_chinese("title").alias("zh"),
                                        T.title_tokens("title").alias("tok")).collect()}
    assert got[1]["code"] == "hla1" and got[1]["tok"] == ["行", "乐", "abc", "12"] and got[1]["zh"]
    assert got[2]["code"] is None and not got[2]["zh"]
    assert got[3]["code"] is None and not got[3]["zh"]
    assert got[4]["code"] == "爱"
    spelt = sorted((r["k"], r["position"], r["spelling"]) for r in T.spelling_rows(df).collect())
    assert spelt == [(1, 0, "hang le abc 12 "), (1, 1, "hang yue abc 12 "), (1, 2, "xing le abc 12 "),
                     (1, 3, "xing yue abc 12 "), (4, 0, "爱 ")]


def test_rows_that_share_an_id_or_a_title_stay_apart(spark):
    df = _titled(spark, [(1, "AB"), (1, "CD"), (2, "AB"), (2, "AB")])
    assert rows(df.select("k", "title", T.search_code("readings").alias("c")), "k", "title", "c") == [
        (1, "AB", "a"), (1, "CD", "c"), (2, "AB", "a"), (2, "AB", "a")]


def test_spellings_come_in_blocks_and_overflow_loudly(spark, monkeypatch):
    monkeypatch.setattr(T, "SPELLING_BLOCK", 3)
    df = _titled(spark, [(1, "行乐行乐")])
    got = sorted((r["position"], r["spelling"]) for r in T.spelling_rows(df).collect())
    import itertools
    want = [" ".join(p) + " " for p in itertools.product(["hang", "xing"], ["le", "yue"], ["hang", "xing"], ["le", "yue"])]
    assert got == list(enumerate(want))
    with pytest.raises(Exception, match="2\\^63"):
        T.spelling_rows(_titled(spark, [(1, "行" * 70)])).collect()


def test_clean_title(spark):
    df = spark.createDataFrame([('  "Hello", 世界! 42\t',), ("***",)], "t string")
    got = [r[0] for r in df.select(T.clean_title("t")).collect()]
    assert got == ["Hello 世界 42", ""]
    assert df.select(T.strip_quotes(F.lit('a"b"'))).first()[0] == "ab"


def test_parse_editorial_short_rows(spark):
    lines = spark.createDataFrame([("1\tmovie\tTitle\tTT",), ("2\ttv",), ("3\ttv\tX\tY\textra",)], "value string")
    out = parse_editorial(lines, on_short="drop")
    assert rows(out, "sid", "search_text") == [("1", "TT"), ("3", "Y")]
    with pytest.raises(Exception):
        parse_editorial(lines, on_short="fail").collect()


def test_seeded_sample_repeatable_without_replacement(spark):
    df = spark.createDataFrame([(f"s{i}", "t" if i % 2 else "u") for i in range(100)], "sid string, content_type string")
    a = rows(seeded_sample(df, 5, 42, "sid", ["content_type"]), "content_type", "rank", "sid")
    b = rows(seeded_sample(df, 5, 42, "sid", ["content_type"]), "content_type", "rank", "sid")
    c = rows(seeded_sample(df, 5, 7, "sid", ["content_type"]), "content_type", "rank", "sid")
    assert a == b and a != c and len({x[2] for x in a}) == 10


def test_one_hot_fixture(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "a"), (4, "a"), (5, "c")], "id int, category string")
    idx = {r["category"]: r["category_index"] for r in index_categories(df, "category").collect()}
    assert idx == {"a": 0.0, "c": 1.0, "b": 2.0}
    enc = vector_columns(encode_categories(df, "category"), "category_vec")
    got = {r["category"]: (r["vec_size"], r["vec_active"]) for r in enc.collect()}
    assert got == {"a": (2, 0), "c": (2, 1), "b": (2, None)}


def test_table_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(A.table_profile(df), "column_name", "data_type", "n_rows", "n_nulls") == [("a", "int", 2, 0), ("b", "string", 2, 1)]


def test_bands_config_defaults():
    assert dict(config.BANDS)["afternoon"] == (16, 17, 18) and 18 in dict(config.BANDS)["night"]


def test_sql_functions_agree_with_column_builders(spark):
    from searchlens.functions.sql import register_sql_functions
    register_sql_functions(spark, prefix="t_")
    df = spark.createDataFrame([("10/Oct/2019:13:55:36", "home-tv-AB", 8.0, 4.0), ("10/Xxx/2019:13:55:36", "searcXY", 1.0, 1.0),
                                (None, None, 2.0, 1.5)], "en string, path string, v double, m double")
    got = df.selectExpr("t_en_to_cn_datetime(en) a", "t_en_to_cn_date(en) b", "t_path_code_home(path) c",
                        "t_path_code_search(path) d", "t_heat_score(v, m) e").collect()
    want = df.select(D.en_to_cn_datetime("en").alias("a"), D.en_to_cn_date("en").alias("b"),
                     S.path_code_home("path").alias("c"), S.path_code_search("path").alias("d"),
                     S.heat_score("v", "m").alias("e")).collect()
    assert got == want


def test_log_retrieval_presets(spark):
    from searchlens.sources.logs import assoc_preset, log_retrieval, search_preset, view_preset
    log = spark.createDataFrame([("u" * 32, 7, "s1", "tv", "2024-01-20 13:05:00", 20240120, "q", 400.0, "userexit"),
                                 (None, None, "s2", "tv", "2024-01-20 13:05:00", 20240120, "q", 100.0, "userexit")],
                                "user_id string, account_id int, sid string, content_type string, datetime string, "
                                "key_day int, search_text string, duration double, event string")
    out = log_retrieval(log, "20240120", 3, *reversed_preset(assoc_preset(["tv"])))
    assert [tuple(r) for r in out.collect()] == [("u" * 32, "s1", "13", 7)]
    assert out.schema["account_id"].dataType.simpleString() == "bigint"
    assert log_retrieval(log, "20240120", 3, *reversed_preset(search_preset(["tv"]))).count() == 2
    assert log_retrieval(log, "20240120", 3, *reversed_preset(view_preset(["tv"]))).count() == 1


def reversed_preset(preset):
    fields, cond, results = preset
    return cond, fields, results


def test_cluster_conf_scales_partitions():
    from searchlens.session import cluster_conf
    big = cluster_conf(100 * 10**12)
    assert int(big["spark.sql.shuffle.partitions"]) == 18627  # 10 TB shuffled / 512 MiB
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(10**9)["spark.sql.shuffle.partitions"]) == 200
    small = cluster_conf(100 * 10**12, executor_memory_bytes=2 << 30, executor_cores=2)  # 2 GiB, 2 cores
    assert int(small["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]) == int((2 << 30) * 0.6 / 2 / 2)
    assert int(small["spark.sql.shuffle.partitions"]) > int(big["spark.sql.shuffle.partitions"])


def test_scan_log_and_read_catalog(spark):
    from searchlens.sources.catalog import read_catalog
    from searchlens.sources.logs import scan_log
    log = spark.createDataFrame([("u1", "s1", 20240120, 5), ("u2", "s2", 20240110, 6), ("u3", "s3", 20240121, 7)],
                                "userid string, videosid string, key_day int, key_hour int")
    out = scan_log(log, {"user_id": "userid", "sid": "videosid", "time": F.lpad(F.col("key_hour").cast("string"), 2, "0")},
                   where=F.col("videosid") != "s3", as_of="20240121", days=3)
    assert [tuple(r) for r in out.collect()] == [("u1", "s1", "05")]
    assert out.columns == ["user_id", "sid", "time"]
    cat = spark.createDataFrame([(1, "a", "tv"), (2, "b", "movie")], "id int, sid string, content_type string")
    got = read_catalog(cat, {"sid_mysql": "sid", "type": "content_type"}, F.col("content_type") == "tv")
    assert [tuple(r) for r in got.collect()] == [("a", "tv")] and got.columns == ["sid_mysql", "type"]


class _FakeJdbcReader:
    """Records what read_catalog_jdbc asks of a JDBC reader (no database involved)."""

    def __init__(self, log):
        self.log, self.opts = log, {}

    def option(self, k, v):
        self.opts[k] = v
        return self

    def load(self):
        self.log.append(dict(self.opts))
        log = self.log

        class _Frame:
            def first(self):
                return (3, 41)

            def select(self, *cols):
                log.append(("select", cols))
                return self
        return _Frame()


def test_read_catalog_jdbc_options():
    from types import SimpleNamespace
    from searchlens.sources.catalog import read_catalog_jdbc
    log = []
    spark = SimpleNamespace(read=SimpleNamespace(format=lambda fmt: _FakeJdbcReader(log) if fmt == "jdbc" else None))
    read_catalog_jdbc(spark, "jdbc:db://host/cms", "basecontent", ["sid", "content_type"],
                      condition="type = 1 AND status = 1", properties={"user": "u"}, equal_rows=False)
    bounds_q, main_q, select = log
    assert bounds_q["dbtable"] == "(SELECT min(id) lo, max(id) hi FROM basecontent WHERE type = 1 AND status = 1) b"
    assert main_q["dbtable"] == "(SELECT sid, content_type, id FROM basecontent WHERE type = 1 AND status = 1) catalog_rows"
    assert (main_q["partitionColumn"], main_q["lowerBound"], main_q["upperBound"], main_q["numPartitions"]) == ("id", "3", "42", "5")
    assert main_q["user"] == "u" and main_q["url"] == "jdbc:db://host/cms"
    assert select == ("select", ("sid", "content_type"))


def test_read_catalog_jdbc_in_ranges_of_equal_rows(spark, monkeypatch):
    from types import SimpleNamespace
    from searchlens.sources import catalog
    log, asked = [], []
    # The ids come from the stand-in reader; their ranges are found by Spark on a table with a wide gap.
    ids = spark.range(100).select((F.col("id") + F.when(F.col("id") >= 95, 10**9).otherwise(0)).alias("id"))

    class _Reader(_FakeJdbcReader):
        def load(self):
            return ids if self.opts.get("dbtable", "").startswith("(SELECT id FROM") else super().load()

    class _Rows:
        def select(self, *cols):
            return cols

    fake = SimpleNamespace(read=SimpleNamespace(
        format=lambda fmt: _Reader(log), jdbc=lambda *a, **k: asked.append((a, k)) or _Rows()))
    out = catalog.read_catalog_jdbc(fake, "jdbc:db://host/cms", "basecontent", ["sid", "content_type"], condition="type = 1",
                                    num_partitions=4, properties={"user": "u"})
    ((url, query), options), = asked
    assert url == "jdbc:db://host/cms" and query == "(SELECT sid, content_type, id FROM basecontent WHERE type = 1) catalog_rows"
    assert options == {"properties": {"user": "u"}, "predicates": [
        "id <= 24 OR id IS NULL", "id > 24 AND id <= 49", "id > 49 AND id <= 74", "id > 74"]}
    assert out == ("sid", "content_type")


def test_id_ranges_hold_equally_many_rows(spark):
    from searchlens.sources.catalog import id_ranges, range_predicates
    from searchlens.sources import fixtures as fx
    catalog = fx.catalog(spark, SF_SMALL)
    total = catalog.count()
    ranges = id_ranges(catalog, "id", 5).orderBy("part").collect()
    assert len(ranges) == 5 and sum(r["n"] for r in ranges) == total
    assert max(r["n"] for r in ranges) - min(r["n"] for r in ranges) <= 1
    # Equal widths would put nearly all rows in the first of them.
    width = (max(r["high"] for r in ranges) + 1) // 5
    assert catalog.where(F.col("id") < width).count() > 0.9 * total
    # Every row meets one predicate.
    predicates = range_predicates("id", [r["high"] for r in ranges[:-1]])
    rows = catalog.select("id").unionByName(spark.createDataFrame([(None,)], "id bigint"))
    hits = [rows.where(p).count() for p in predicates]
    assert hits == [ranges[0]["n"] + 1] + [r["n"] for r in ranges[1:]]
    # Many rows with one id, and fewer ids than ranges.
    few = spark.createDataFrame([(7,)] * 90 + [(8,)] * 5 + [(None,)], "id bigint")
    assert [tuple(r) for r in id_ranges(few, "id", 5).orderBy("part").collect()] == [(0, 7, 7, 90), (4, 8, 8, 5)]
    assert id_ranges(few.limit(0), "id", 5).count() == 0 and range_predicates("id", []) == ["1 = 1"]
