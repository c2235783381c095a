"""Title text (H20-H25): cleaning, tokens, readings, spellings, search codes.

Readings of Chinese characters come from a ``(ch, readings)`` table the
user supplies (any pronunciation dictionary). Tokens are exploded, joined
to that table and gathered back per title, all as DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config

CJK = f"[{config.CJK_CLASS}]"
# Characters kept by the cleaner, and the token pattern
# (one Chinese character, a run of digits, or a run of ASCII letters).
KEEP_PATTERN = f"[^0-9a-zA-Z\\s{config.CJK_CLASS}]"
TOKEN_PATTERN = f"([0-9]+|[a-zA-Z]+|{CJK})"
def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def has_chinese(text: Column | str) -> Column:
    """The text holds a character of the CJK block; NULL text is false."""
    return F.coalesce(_c(text).rlike(CJK), F.lit(False))


def clean_title(text: Column | str) -> Column:
    """Keep Chinese, digits, ASCII letters and white space, then trim white space."""
    kept = F.regexp_replace(_c(text), KEEP_PATTERN, "")
    return F.regexp_replace(kept, r"^\s+|\s+$", "")


def strip_quotes(text: Column | str) -> Column:
    """C14: remove double quotes."""
    return F.replace(_c(text), F.lit('"'), F.lit(""))


def title_tokens(text: Column | str) -> Column:
    """Tokens of the cleaned title, in order; empty for NULL or nothing left."""
    return F.coalesce(F.regexp_extract_all(clean_title(text), F.lit(TOKEN_PATTERN), 1), F.array().cast("array<string>"))


def readings_table(readings: DataFrame, ch_col: str = "ch", readings_col: str = "readings") -> DataFrame:
    """Normalise a pronunciation table: one row per single CJK character, readings in lower case.

    After the filter the table has at most one row per character of the CJK
    block (20,902) whatever its source, which is what makes broadcasting it safe. A character listed
    twice keeps its smallest reading list, so the choice repeats run to run.
    """
    return (readings.where((F.length(ch_col) == 1) & F.col(ch_col).rlike(CJK))
            .select(F.col(ch_col).alias("_tok"),
                    F.transform(readings_col, lambda r: F.lower(r)).alias("_readings"))
            .groupBy("_tok").agg(F.min("_readings").alias("_readings")))


def _reading_options(tok: Column, readings: Column) -> Column:
    return F.transform(F.coalesce(readings, F.array(F.lower(tok))), lambda r: F.concat(r, F.lit(" ")))


def title_readings(titles: DataFrame, readings: DataFrame, title_col: str = "title") -> DataFrame:
    """Per title, the list of reading lists, one per token in title order.

    A token without readings (a digit or letter run, or an unknown
    character) stands for itself in lower case; every reading is followed
    by one space. Adds column ``readings`` (``array<array<string>>``).

    Equal rows are counted before their tokens are exploded, joined to the
    broadcast readings and gathered back under the whole row as the key, so
    the input is computed once, a repeated row is worked on once, and rows
    that share an id but not a title stay apart. The count is kept per input
    partition, so that no single row stands for more rows than one partition
    held when it is repeated at the end.
    """
    rows = titles.columns
    counted = (titles.withColumn("_part", F.spark_partition_id())
               .groupBy(*rows, "_part").agg(F.count(F.lit(1)).alias("_copies")))
    toks = counted.select("*", F.posexplode_outer(title_tokens(title_col)).alias("_pos", "_tok"))
    joined = toks.join(F.broadcast(readings_table(readings)), "_tok", "left")
    entry = F.when(F.col("_pos").isNotNull(), F.struct("_pos", _reading_options(F.col("_tok"), F.col("_readings")).alias("_r")))
    gathered = joined.groupBy(*rows, "_part", "_copies").agg(F.array_sort(F.collect_list(entry)).alias("_l"))
    return gathered.select(*rows, F.transform("_l", lambda e: e["_r"]).alias("readings"),
                           F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")).alias("_copy")).drop("_copy")


# Spellings of one title that are numbered at a time.
SPELLING_BLOCK = 100_000


def spelling_count(readings: Column | str) -> Column:
    """How many spellings a title has: the product of its reading counts, 0 for an empty title.

    A product beyond 64 bits is an error, never a wrong number.
    """
    r = _c(readings)
    product = F.aggregate(r, F.lit(1).cast("bigint"), lambda n, opts: F.try_multiply(n, F.size(opts).cast("bigint")))
    checked = F.coalesce(product, F.raise_error(F.lit("a title has more than 2^63 spellings")).cast("bigint"))
    return F.when(F.size(r) > 0, checked).otherwise(F.lit(0).cast("bigint"))


def spelling_at(readings: Column | str, number: Column | str) -> Column:
    """Spelling ``number`` (from 0) of a title, the first token varying slowest.

    The number is read as digits, one per token, in the mixed radix of the
    reading counts: the last token's reading is the remainder.
    """
    start = F.struct(_c(number).cast("bigint").alias("left"), F.lit("").alias("text"))
    last_first = F.reverse(_c(readings))

    def take(state: Column, opts: Column) -> Column:
        n = F.size(opts).cast("bigint")
        digit = (state["left"] % n).cast("int")
        return F.struct(F.call_function("div", state["left"], n).alias("left"),
                        F.concat(F.get(opts, digit), state["text"]).alias("text"))

    return F.aggregate(last_first, start, take, lambda state: state["text"])


def spelling_rows(df: DataFrame, readings_col: str = "readings", out: str = "spelling",
                  position: str = "position") -> DataFrame:
    """One row per combination of one reading per token, numbered from 0, the first token varying slowest.

    The whole product comes out. The numbers of a title's spellings are
    exploded in blocks and each spelling is built from its number, so the
    plan is the same for titles of any length, and no row ever holds the
    product. Titles without tokens give no rows.
    """
    total = df.withColumn("_total", spelling_count(readings_col)).where(F.col("_total") > 0)
    zero = F.lit(0).cast("bigint")
    blocks = total.withColumn("_block", F.explode(F.sequence(zero, F.expr(f"(_total - 1) div {SPELLING_BLOCK}"))))
    first = F.col("_block") * SPELLING_BLOCK
    numbers = blocks.withColumn(position, F.explode(F.sequence(first, F.least(first + SPELLING_BLOCK, F.col("_total")) - 1)))
    return numbers.withColumn(out, spelling_at(readings_col, position)).drop("_total", "_block")


def search_code(readings: Column | str, length: int = config.SEARCH_CODE_LENGTH) -> Column:
    """Initials of the first spelling, at most ``length``; NULL for an empty title.

    Uses only the first reading of each token, so it never builds the product.
    """
    r = _c(readings)
    initials = F.array_join(F.transform(r, lambda opts: F.substring(F.get(opts, 0), 1, 1)), "")
    return F.when(F.size(r) > 0, F.substring(initials, 1, length))
