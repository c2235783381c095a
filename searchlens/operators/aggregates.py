"""Aggregations.

Every aggregate is a ``groupBy().agg()`` with built-in functions, so Spark
combines map-side before the shuffle: a hot key (one video or one user with
a third of all rows) reaches the reducer as one partial row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import config
from .filters import filter_account


def search_counts(df: DataFrame, text_col: str = "search_text", type_col: str = "content_type",
                  sid_col: str = "sid") -> DataFrame:
    """Searches per (text, type, sid), as ``num``."""
    return df.groupBy(text_col, type_col, sid_col).agg(F.count(F.lit(1)).alias("num"))


def unique_searchers(df: DataFrame, user_col: str = "user_id", text_col: str = "search_text",
                     type_col: str = "content_type", sid_col: str = "sid") -> DataFrame:
    """Distinct searchers per (text, type, sid); all NULL users together count once.

    ``distinct`` then count, not ``count(DISTINCT user)`` (which skips NULL).
    The distinct step shuffles on all four columns, so a hot video's users
    spread over many tasks; the count then combines map-side.
    """
    return search_counts(df.select(user_col, text_col, type_col, sid_col).distinct(), text_col, type_col, sid_col)


def play_counts(df: DataFrame, keys: Sequence[str] = ("content_type", "sid"), out: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def video_rollup(df: DataFrame, keys: Sequence[str] = ("sid", "content_type", "title", "status"),
                 text_col: str = "search_text", num_col: str = "num") -> DataFrame:
    """E5: per video, the search text with the largest count and the total count.

    Ties between texts go to the smaller text. ``min(struct(-num, text))`` is
    an ordinary aggregate, so it is combined map-side like the sum.
    """
    best = F.min(F.struct((-F.col(num_col)).alias("neg"), F.col(text_col).alias("text")))
    return df.groupBy(*keys).agg(best["text"].alias("search_code"), F.sum(num_col).alias(num_col))


def score_sums(df: DataFrame, key_col: str = "sid_or_subject_code", score_col: str = "score") -> DataFrame:
    """Summed score per key."""
    return df.groupBy(key_col).agg(F.sum(score_col).alias(score_col))


def type_means(top: DataFrame, type_col: str = "content_type", value_col: str = "n",
               out: str = "mean_views") -> DataFrame:
    """Mean of ``value_col`` per type over the (already top-k) rows."""
    return top.groupBy(type_col).agg(F.avg(F.col(value_col).cast("double")).alias(out))


# --- preference shares (E6-E8) ---

def band_names(hour_col: str, bands: Iterable[tuple[str, Sequence[int]]] = config.BANDS,
               all_time: str | None = config.ALL_TIME, hour_is_string: bool = False) -> Column:
    """Array of the bands an hour falls in (overlaps allowed), ``all_time`` first.

    String hours are compared as two-digit strings, as the original SQL does.
    """
    h = F.col(hour_col)
    items = [F.lit(all_time)] if all_time is not None else []
    for name, hours in bands:
        values = [f"{x:02d}" for x in hours] if hour_is_string else list(hours)
        items.append(F.when(h.isin(values), F.lit(name)))
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def preference_shares(
    plays: DataFrame,
    user_col: str = "user_id",
    account_col: str = "account_id",
    hour_col: str = "key_hour",
    type_col: str = "content_type",
    bands: Iterable[tuple[str, Sequence[int]]] = config.BANDS,
    all_time: str | None = config.ALL_TIME,
    count_col: str | None = None,
) -> DataFrame:
    """Share of each content type in a user's plays, per band.

    Columns: user, account, band, type, ``n``, ``score`` (n / plays of the
    user in that band), ``position`` (1 = largest share; ties by type). A
    band without plays has no rows. Plays without an account are skipped.
    ``count_col``: the rows are counts of plays already, in that column.

    Plan: plays are counted per (user, account, hour, type) with map-side
    combine (shuffle 1); the small hourly rows are then hash-partitioned by
    (user, account) once (shuffle 2), and the band sums, the share window and
    any later per-user grouping reuse that partitioning. Per user there are
    at most 24 hours x types rows, so no group grows with the log.
    """
    bands = tuple(bands)
    hourly = (filter_account(plays, account_col)
              .groupBy(user_col, account_col, hour_col, type_col)
              .agg((F.sum(count_col) if count_col else F.count(F.lit(1))).alias("n")))
    is_str = isinstance(plays.schema[hour_col].dataType, StringType)
    by_band = (hourly.repartition(user_col, account_col)
               .withColumn("band", F.explode(band_names(hour_col, bands, all_time, is_str)))
               .groupBy(user_col, account_col, "band", type_col)
               .agg(F.sum("n").alias("n")))
    # One ordering for both expressions (the sum over the whole frame), so a
    # single Window operator over a single sort computes share and position.
    w = Window.partitionBy(user_col, account_col, "band").orderBy(F.desc("n"), F.asc(type_col))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (by_band
            .withColumn("score", F.col("n") / F.sum("n").over(whole))
            .withColumn("position", F.row_number().over(w)))


def profile_documents(
    shares: DataFrame,
    user_col: str = "user_id",
    account_col: str = "account_id",
    type_col: str = "content_type",
    band_order: Sequence[str] = (config.ALL_TIME,) + tuple(b for b, _ in config.BANDS),
) -> DataFrame:
    """One row per (user, account) with one ranked ``[{contentType, score}]`` list per band.

    Each list holds at most as many entries as there are content types; an
    empty band becomes NULL, so ``to_json`` leaves it out.
    """
    entry = F.struct(F.col("band"), F.col("position"), F.col(type_col).alias("contentType"), F.col("score"))
    gathered = shares.groupBy(user_col, account_col).agg(F.array_sort(F.collect_list(entry)).alias("_l"))

    def ranked(band: str) -> Column:
        own = F.filter("_l", lambda e: e["band"] == F.lit(band))
        return F.when(F.size(own) > 0, F.transform(
            own, lambda e: F.struct(e["contentType"].alias("contentType"), e["score"].alias("score")))).alias(band)

    return gathered.select(user_col, account_col, *[ranked(b) for b in band_order])


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, rows, NULLs. One pass over the data."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"),
                 F.col("_rows").alias("n_rows"), F.col(f"_n{i}").alias("n_nulls"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return one.select(F.inline(F.array(*entries)))
