"""Catalog reads (A3, A6) and the score matrix (A4).

The catalog lives in a relational database in production. ``read_catalog_jdbc``
reads it in id ranges that hold equally many rows, one JDBC partition per
range, with the row filter in the pushed-down query. Any other table (parquet, catalog table) works the
same through ``read_catalog``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import numbered


def read_catalog_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    condition: str | None = None,
    id_col: str = "id",
    num_partitions: int = 5,
    bounds: tuple[int, int] | None = None,
    properties: Mapping[str, str] | None = None,
    equal_rows: bool = True,
) -> DataFrame:
    """Catalog rows over JDBC, split into ``num_partitions`` id ranges.

    The ranges hold equally many rows, whatever gaps the ids have: the ids
    alone are read first, in ranges of equal width, their quantiles are found
    (``id_ranges``), and each range is handed over as a predicate. With
    ``equal_rows=False`` the rows themselves are read in ranges of equal
    width. ``bounds`` default to the table's min and max id, read by one
    small query.
    """
    where = f" WHERE {condition}" if condition else ""
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if bounds is None:
        b = reader.option("dbtable", f"(SELECT min({id_col}) lo, max({id_col}) hi FROM {table}{where}) b").load().first()
        bounds = (int(b[0] or 0), int(b[1] or 0))

    def in_equal_widths(names: Sequence[str]) -> DataFrame:
        return (
            reader.option("dbtable", f"(SELECT {', '.join(names)} FROM {table}{where}) catalog_rows")
            .option("partitionColumn", id_col)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1] + 1))
            .option("numPartitions", str(num_partitions))
            .load()
        )

    names = list(dict.fromkeys([*columns, id_col]))
    if not equal_rows or num_partitions < 2:
        return in_equal_widths(names).select(*columns)
    edges = [r["high"] for r in id_ranges(in_equal_widths([id_col]), id_col, num_partitions).orderBy("high").collect()]
    query = f"(SELECT {', '.join(names)} FROM {table}{where}) catalog_rows"
    # The URL and the properties go with the call, as predicates are no option of a reader.
    return spark.read.jdbc(url, query, predicates=range_predicates(id_col, edges[:-1]),
                           properties=dict(properties or {})).select(*columns)


def id_ranges(ids: DataFrame, id_col: str, parts: int) -> DataFrame:
    """(part, low, high, n) of at most ``parts`` ranges of an id column that hold equally many rows, NULL left out.

    The ids are numbered in their order without meeting in one task, and the
    k-th range ends where the k-th share of the numbers ends; rows with the
    same id are in one range, the one of the first of them.
    """
    counts = ids.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    placed = numbered(counts, [F.col(id_col).asc()], "place", weight="n")
    total = placed.agg(F.sum("n")).first()[0] or 0
    part = F.expr(f"CAST(place * {parts} div {max(total, 1)} AS INT)")
    return placed.groupBy(part.alias("part")).agg(F.min(id_col).alias("low"), F.max(id_col).alias("high"), F.sum("n").alias("n"))


def range_predicates(id_col: str, edges: Sequence[int]) -> list[str]:
    """SQL conditions of the ranges that end at the given ids, and of the last one beyond; NULL is in the first."""
    if not edges:
        return ["1 = 1"]
    out = [f"{id_col} <= {edges[0]} OR {id_col} IS NULL"]
    out += [f"{id_col} > {a} AND {id_col} <= {b}" for a, b in zip(edges, edges[1:], strict=False)]
    return [*out, f"{id_col} > {edges[-1]}"]


def read_catalog(
    catalog: DataFrame,
    columns: Sequence[str] | Mapping[str, str | Column],
    where: Column | str | None = None,
) -> DataFrame:
    """A3 over any table: filter (pushed to the source), then project."""
    df = catalog if where is None else catalog.where(where)
    if isinstance(columns, Mapping):
        return df.select(*[(c if isinstance(c, Column) else df[c]).alias(n) for n, c in columns.items()])
    return df.select(*columns)


def scan_score_matrix(
    matrix: DataFrame | str,
    day: str | int,
    spark: SparkSession | None = None,
    partition_col: str = "partition_tag",
) -> DataFrame:
    """A4: one day of a day-partitioned score matrix.

    ``matrix`` is a DataFrame or the base path of a parquet directory
    partitioned by ``partition_col``; the equality filter prunes the other
    day directories at planning time.
    """
    if isinstance(matrix, str):
        matrix = spark.read.parquet(matrix)
    dtype = matrix.schema[partition_col].dataType.simpleString()
    value = int(day) if dtype in ("int", "bigint") else str(day)
    return matrix.where(F.col(partition_col) == F.lit(value))
