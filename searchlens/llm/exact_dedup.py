"""Exact dedup as a skew-safe combining tree.

Equal texts meet in three steps, each of which groups by the full content and not by its digest alone:

1. every map task combines the copies it reads itself (the partial aggregate before the first shuffle);
2. the local winners merge by (digest, salt), the salt being the map task's number modulo ``salts``, so that a group
   with a third of all rows meets in ``salts`` places and never in one;
3. the salt winners, at most ``salts`` a text, combine globally by digest and text.

Everything is DataFrame operations. Defined results: a null text counts as empty; equal means identical, code point
for code point; of equal texts the row with the largest id stays (a null id is smaller than any other), and of
repeated rows with that id exactly one; an empty table gives no rows; other columns are ignored or, in
``drop_copies``, kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, saved, text_of

Digest = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    """The 32 bytes of the SHA-256 of the text in UTF-8."""
    return F.unhex(F.sha2(text, 256))


def _combine(rows: DataFrame, best: Callable[[], Column]) -> DataFrame:
    """(digest, text, best, n) of every different text, by the three steps above."""
    merged = rows.groupBy("digest", "salt", "text").agg(best().alias("best"), F.count("*").alias("n"))
    return merged.groupBy("digest", "text").agg(best().alias("best"), F.sum("n").alias("n"))


def exact_dedup(docs: DataFrame, ident: str = "doc_id", text: str = "text", salts: int = 32,
                digest: Digest = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The tree above finds the winner and the size of every group. Its answers go back to the documents by digest, a
    key of 32 bytes in place of the text; groups that hold 1/1000 of all rows are answered by broadcast. Should
    two different texts ever share a digest, the tree shows it and their documents are answered by text.
    """
    rows = docs.select(F.col(ident).alias("best"), text_of(text).alias("text")).select(
        "best", "text", digest(F.col("text")).alias("digest"), (F.spark_partition_id() % salts).alias("salt"))
    groups = _combine(rows, lambda: F.max("best"))
    classes = saved(groups.groupBy("digest").agg(F.count("*").alias("texts"), F.max("best").alias("keep_id"),
                                                 F.sum("n").alias("group_size")), "classes")
    facts = saved(docs.select(F.col(ident).alias("doc_id"), text_of(text).alias("text")).select(
        "doc_id", digest(F.col("text")).alias("digest"), F.lower(F.sha2("text", 256)).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row")), "facts")
    # Which of the repeated rows with the winning id stays: the same map-side combining, on 8 bytes a row.
    top = facts.groupBy("digest").agg(F.max(F.struct("doc_id", "row"))["row"].alias("keep_row"))
    answers = saved(classes.where("texts = 1").drop("texts").join(top, "digest"), "answers")
    out = lookup(facts, answers, "digest", "group_size", facts.count())
    clashing = classes.where("texts > 1").select("digest")
    if not clashing.isEmpty():
        out = out.unionByName(_by_text(rows, clashing))
    return out.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                      "text_sha256")


def _by_text(rows: DataFrame, clashing: DataFrame) -> DataFrame:
    """The answers for texts whose digest another text has too, with the text itself as the key."""
    facts = saved(rows.join(clashing, "digest", "left_semi").select(
        F.col("best").alias("doc_id"), "digest", "text", "salt", F.monotonically_increasing_id().alias("row")), "clash")
    answers = saved(_combine(facts.withColumn("best", F.struct("doc_id", "row")), lambda: F.max("best")).select(
        "text", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        F.col("best.row").alias("keep_row")), "clash_answers")
    out = lookup(facts, answers, "text", "group_size", facts.count())
    return out.select("digest", "doc_id", F.lower(F.sha2("text", 256)).alias("text_sha256"), "row", "keep_id",
                      "group_size", "keep_row")


def drop_copies(docs: DataFrame, ident: str = "doc_id", text: str = "text", salts: int = 32,
                digest: Digest = sha256) -> DataFrame:
    """The documents without their copies, in the columns and order of ``docs``.

    The winners carry their other columns through the tree, so no join back to the documents is needed.
    """
    others = [c for c in docs.columns if c != text]
    rows = docs.select(
        F.struct(F.col(ident).alias("id"), F.col(text).isNull().alias("no_text"),
                 F.struct(*others).alias("rest")).alias("best"),
        text_of(text).alias("text")).select(
        "best", "text", digest(F.col("text")).alias("digest"), (F.spark_partition_id() % salts).alias("salt"))
    kept = _combine(rows, lambda: F.max_by("best", F.struct("best.id")))
    columns = [F.when(~F.col("best.no_text"), F.col("text")).alias(text) if c == text
               else F.col("best.rest").getField(c).alias(c) for c in docs.columns]
    return kept.select(*columns)
