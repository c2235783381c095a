"""Every registered query equals its DuckDB oracle (rows, columns, values), and entry() runs."""

import duckdb
import pytest

import __spark_entry__ as se
from searchlens.oracle import ORACLE_SQL as ORACLE
from searchlens.registry import QUERIES

from .conftest import SF_SMALL
from .oracle_check import SPARK_TO_DUCK, TABLES, value_hash


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(se.queries()) and set(ORACLE) <= set(se.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert value_hash(df.columns, rows) == value_hash(ocols, orows)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["content_type", "rank", "sid", "search_code", "title", "num"]
    assert df.count() > 0


def test_chinese_titles_and_their_readings_are_really_there(spark):
    flags = QUERIES["title_language_flags"](spark, SF_SMALL)
    assert 0 < flags.where("has_chinese").count() < flags.count()
    spellings = QUERIES["title_spellings"](spark, SF_SMALL)
    assert spellings.where("position > 0").count() > 0
    codes = QUERIES["title_search_code"](spark, SF_SMALL)
    assert codes.where("search_code rlike '好'").count() > 0  # a character without a reading stands for itself
    assert codes.groupBy("sid").count().where("count > 1").count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_column_types_match_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
