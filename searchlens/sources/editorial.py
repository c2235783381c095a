"""Tab-separated editorial lists (A5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDITORIAL_COLUMNS = ("sid", "content_type", "title", "search_text")


def _fields(value_col: str) -> Column:
    """The tab-separated fields of a line; trailing empty ones count as missing, like Java's ``split``."""
    return F.split(F.regexp_replace(F.col(value_col), "\t+$", ""), "\t")


def short_lines(lines: DataFrame, columns: Sequence[str] = EDITORIAL_COLUMNS, value_col: str = "value") -> DataFrame:
    """The lines that ``parse_editorial(on_short="drop")`` leaves out: ``value, n_fields``."""
    n = F.when(F.length(value_col) > 0, F.size(_fields(value_col))).otherwise(0)
    return lines.select(F.col(value_col).alias("value"), n.alias("n_fields")).where(F.col("n_fields") < len(columns))


def parse_editorial(
    lines: DataFrame,
    columns: Sequence[str] = EDITORIAL_COLUMNS,
    on_short: str = "fail",
    value_col: str = "value",
) -> DataFrame:
    """A5: split each line on tabs and keep the first ``len(columns)`` fields.

    A line with fewer fields fails the job (``on_short="fail"``, as the
    original does) or is dropped (``"drop"``; ``short_lines`` returns those).
    """
    if on_short not in ("fail", "drop"):
        raise ValueError("on_short must be 'fail' or 'drop'")
    n = len(columns)
    df = lines.select(_fields(value_col).alias("_f"))
    enough = F.size("_f") >= n
    if on_short == "drop":
        df = df.where(enough)
    else:
        df = df.withColumn(
            "_f", F.when(enough, F.col("_f")).otherwise(F.raise_error(F.lit(f"editorial line has fewer than {n} fields")))
        )
    return df.select(*[F.get(F.col("_f"), i).alias(c) for i, c in enumerate(columns)])
