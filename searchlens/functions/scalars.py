"""Scalar column expressions (H1-H3, H17-H19). All built-in, codegen-friendly."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def heat_score(value: Column | str, mean: Column | str, cap: float = 100.0) -> Column:
    """H1: ``ln(value) / ln(mean) * 100``, at most ``cap``.

    A type whose top-k mean is 1 has every count equal to 1; the original
    computes 0/0 = NaN there and maps it to the cap, which is what the guard
    returns (Spark's ANSI mode would raise on the division).
    """
    v, m = _c(value).cast("double"), _c(mean).cast("double")
    raw = F.try_divide(F.ln(v), F.ln(m)) * F.lit(100.0)
    return F.when(m == 1.0, F.lit(cap)).when(raw.isNull() | F.isnan(raw), F.lit(cap)).otherwise(F.least(raw, F.lit(cap)))


def home_path_pattern(types: Iterable[str] = config.HOME_PATH_TYPES) -> str:
    return "home-(" + "|".join(f"{t}-" for t in types) + ")(search-)?([A-Z]+)"


# Fixed value: search code pattern of the other product's paths (the star binds to the final h).
SEARCH_PATH_PATTERN = "search*([A-Z]+)"


def path_code_home(path: Column | str, types: Iterable[str] = config.HOME_PATH_TYPES) -> Column:
    """H2: upper-case search code after ``home-<type>-[search-]``; NULL when absent."""
    return F.nullif(F.regexp_extract(_c(path), home_path_pattern(types), 3), F.lit(""))


def path_code_search(path: Column | str) -> Column:
    """H3: upper-case run after ``searc``/``search``; NULL when absent."""
    return F.nullif(F.regexp_extract(_c(path), SEARCH_PATH_PATTERN, 1), F.lit(""))


def to_int_id(code: Column | str) -> Column:
    """String id to a number (bigint); NULL when it is not an integer."""
    return _c(code).try_cast("bigint")


def joined_line(*fields: Column | str, sep: str = "||") -> Column:
    """Fields joined by ``||``; a NULL field is empty, so that every line has as many fields."""
    return F.concat_ws(sep, *[F.coalesce(_c(f).cast("string"), F.lit("")) for f in fields])


def json_of(**fields: Column | str) -> Column:
    """A JSON object of named fields; NULL fields are left out."""
    return F.to_json(F.struct(*[_c(v).alias(k) for k, v in fields.items()]))
