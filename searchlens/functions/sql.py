"""SQL access to the scalar helpers.

The original jobs register functions so SQL text can call them. Here they are
Spark SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN expr``): the body
is inlined into the calling plan, so it stays JVM-side and inside whole-stage
codegen, unlike a Python UDF. The bodies are the Column expressions of
``scalars``, ``dates`` and ``titles`` themselves, written out as SQL.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .. import config
from . import dates, scalars, titles


def helpers(home_types: Iterable[str] = config.HOME_PATH_TYPES) -> dict[str, tuple[str, str, Column]]:
    """Name -> (parameters, result type, expression over columns named like the parameters)."""
    return {
        "path_code_home": ("path STRING", "STRING", scalars.path_code_home("path", home_types)),
        "path_code_search": ("path STRING", "STRING", scalars.path_code_search("path")),
        "en_to_cn_date": ("en STRING", "STRING", dates.en_to_cn_date("en")),
        "en_to_cn_datetime": ("en STRING", "STRING", dates.en_to_cn_datetime("en")),
        "day_add": ("day STRING, n INT", "STRING", F.date_format(F.date_add(dates.parse_day("day"), F.col("n")), "yyyyMMdd")),
        "hour_of": ("datetime STRING", "STRING", dates.hour_of("datetime")),
        "has_chinese": ("t STRING", "BOOLEAN", titles.has_chinese("t")),
        "clean_title": ("t STRING", "STRING", titles.clean_title("t")),
        "heat_score": ("v DOUBLE, mean DOUBLE", "DOUBLE", scalars.heat_score("v", "mean")),
    }


def _sql_text(spark: SparkSession, parameters: str, expression: Column) -> str:
    """The SQL of an expression over columns named like the parameters."""
    plan = spark.createDataFrame([], parameters).select(expression.alias("out"))._jdf.queryExecution().analyzed()
    return plan.expressions().head().child().sql()


def register_sql_functions(spark: SparkSession, prefix: str = "",
                           home_types: Iterable[str] = config.HOME_PATH_TYPES) -> list[str]:
    """Create (or replace) the session's temporary SQL functions; returns their names."""
    names = []
    for name, (parameters, result, expression) in helpers(home_types).items():
        body = _sql_text(spark, parameters, expression)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {result} RETURN {body}")
        names.append(prefix + name)
    return names
