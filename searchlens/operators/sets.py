"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_logs(*frames: DataFrame) -> DataFrame:
    """Stack logs by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_with_type(programs: DataFrame, subjects: DataFrame, subject_type: str, type_col: str = "content_type") -> DataFrame:
    """Programs plus subjects, the latter with a constant content type."""
    return programs.unionByName(subjects.withColumn(type_col, F.lit(subject_type)).select(*programs.columns))
