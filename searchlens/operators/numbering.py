"""Numbers of rows in a global order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import written

_IN_PART = 33   # bits of a row's place in its partition, in Spark's increasing ids


def numbered(df: DataFrame, order: Sequence[Column], name: str = "number", weight: str | None = None) -> DataFrame:
    """``df`` with each row's place in ``order``, from 0. The order must be full: no two rows equal in it.

    With ``weight``, a column of whole numbers, a row counts as that many, and its place is that of the first of them.

    The rows are range-partitioned by the order and sorted within, and each gets its partition's number and its place
    there. That is written, so that both stay what they are. One row per partition then gives the rows before it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                     .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", _IN_PART)
    size = F.sum(weight) if weight else F.count(F.lit(1))
    sizes = placed.groupBy(part.alias("_part")).agg(size.alias("_size"))
    # At most one row per shuffle partition: a single task adds them up, and every task gets the sums.
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    within = F.col("_at").bitwiseAND((1 << _IN_PART) - 1)
    if weight:
        # A partition is one range of the order, and is summed up by itself.
        within = F.sum(weight).over(Window.partitionBy("_part").orderBy("_at")) - F.col(weight)
    return (placed.withColumn("_part", part).join(F.broadcast(before), "_part")
            .withColumn(name, F.col("_before") + within)
            .drop("_at", "_part", "_before"))
