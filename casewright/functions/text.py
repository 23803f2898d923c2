"""Text helpers. Sheets hold '' for blank; these are the only places blank and null meet."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

Col = "Column | str"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """'' and all-space text become null, so that blank keys never meet in a join."""
    c = _col(c)
    return F.when(F.length(F.trim(c)) > 0, c)


def null_to_blank(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def has(c: Column | str, word: str, null_is_true: bool = False) -> Column:
    """Case-sensitive substring test; a missing text never matches unless asked to."""
    return F.coalesce(F.contains(_col(c), F.lit(word)), F.lit(null_is_true))


def has_any(c: Column | str, words, null_is_true: bool = False) -> Column:
    """Whether the text holds at least one of the words."""
    return F.coalesce(_col(c).rlike("|".join(words)), F.lit(null_is_true))


def strip_punctuation(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"[^\w\s]+", "")


def digits(c: Column | str) -> Column:
    """Number made of the digits in a text; no digits gives 0."""
    only = F.regexp_replace(_col(c).cast("string"), "[^0-9]", "")
    return F.coalesce(only.try_cast("double"), F.lit(0.0))


def number(c: Column | str, default: float | None = None) -> Column:
    """Lenient cast for sheet cells: blank or unreadable gives the default."""
    value = blank_to_null(_col(c).cast("string")).try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def truthy(c: Column | str, dtype: str, null_is_true: bool = False) -> Column:
    """Boolean view of a column: text is true when not blank, numbers when not zero."""
    c = _col(c)
    if dtype == "string":
        flag = F.length(c) > 0
    elif dtype == "boolean":
        flag = c
    elif dtype in ("date", "timestamp", "timestamp_ntz"):
        flag = c.isNotNull()
    else:
        flag = c != 0
    return F.coalesce(flag, F.lit(null_is_true))


def sorted_list(c: Column | str, sep: str = ", ") -> Column:
    """Aggregate: texts of the group joined in sorted order."""
    return F.array_join(F.sort_array(F.collect_list(_col(c))), sep)
