"""Message payloads and writers.

A payload is a DataFrame of ``(topic, key, value)`` string rows, the shape
Spark's Kafka sink takes. Documents that gather ranked lists (one list per
content type) are built by two bounded aggregations: ``top_n`` entries per
type, then one row over at most (types + 1) lists. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def message_frame(df: DataFrame, topic: str, value: Column, key: Column | None = None) -> DataFrame:
    """One message per row."""
    k = key.cast("string") if key is not None else F.lit(None).cast("string")
    return df.select(F.lit(topic).alias("topic"), k.alias("key"), value.cast("string").alias("value"))


def ranked_document(
    top_by_group: DataFrame,
    group_col: str,
    rank_col: str,
    entry: Column,
    total_order: Sequence[Column | str] = (),
    total_n: int = 0,
    total_key: str = "total",
) -> DataFrame:
    """One JSON object ``{group: [entry, ...], ..., total: [...]}`` as column ``value``.

    Groups are in ascending order, then ``total_key``: the first ``total_n``
    of all rows by ``total_order``. When each group's rows are its best by
    that same order, those are the best of the whole input too, so the total
    needs no pass of its own over the input.
    """
    top = top_by_group
    if total_order:
        place = F.row_number().over(Window.orderBy(*[F.col(o) if isinstance(o, str) else o for o in total_order]))
        top = top.withColumn("_place", place)
        in_total = F.when(F.col("_place") <= total_n, F.struct(F.col("_place"), entry.alias("_entry")))
    else:
        in_total = F.when(F.lit(False), F.struct(F.lit(0).alias("_place"), entry.alias("_entry")))
    item = F.struct(F.col(rank_col).alias("_rank"), entry.alias("_entry"))
    lists = top.groupBy(F.col(group_col).alias("_group")).agg(
        F.array_sort(F.collect_list(item)).alias("_items"), F.collect_list(in_total).alias("_total"))
    doc = lists.agg(F.array_sort(F.collect_list(F.struct("_group", "_items"))).alias("_l"),
                    F.array_sort(F.flatten(F.collect_list("_total"))).alias("_t"))
    groups = F.transform("_l", lambda e: F.struct(e["_group"].alias("k"), F.transform(e["_items"], lambda x: x["_entry"]).alias("v")))
    total = F.transform(F.array(F.col("_t")), lambda t: F.struct(F.lit(total_key).alias("k"), F.transform(t, lambda x: x["_entry"]).alias("v")))
    total = F.filter(total, lambda e: F.size(e["v"]) > 0)
    return doc.select(F.to_json(F.map_from_entries(F.concat(groups, total))).alias("value"))


def document_message(doc: DataFrame, topic: str, key: str | None = None) -> DataFrame:
    """B1: a one-document payload as a message (written once, not repeated)."""
    return doc.select(F.lit(topic).alias("topic"), F.lit(key).cast("string").alias("key"), F.col("value"))


def write_messages(
    messages: DataFrame,
    fmt: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    mode: str = "append",
) -> None:
    """Write ``(topic, key, value)`` rows from the executors.

    ``fmt="kafka"`` needs the Kafka connector on the class path and a
    ``kafka.bootstrap.servers`` option; any file format (``json``,
    ``parquet``) writes to ``path`` partitioned by topic. ``mode="overwrite"``
    replaces the files of the topics that are written, and of no other.
    """
    w = messages.write.format(fmt).mode(mode)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if fmt == "kafka":
        w.save()
    else:
        w.option("partitionOverwriteMode", "dynamic").partitionBy("topic").save(path)
