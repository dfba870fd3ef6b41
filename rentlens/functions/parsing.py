"""Raw text to typed columns. Unreadable input becomes NULL instead of failing the job under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """``$1,234.50`` to 1234.5."""
    return F.regexp_replace(as_column(c), r"[$,]", "").try_cast("double")


def flag(c: Column | str) -> Column:
    """``t``/``f`` to a boolean; anything else is unknown."""
    c = as_column(c)
    return F.when(c == "t", True).when(c == "f", False)


def number(c: Column | str, dtype: str = "double") -> Column:
    return as_column(c).try_cast(dtype)


def iso_date(c: Column | str) -> Column:
    return as_column(c).try_cast("date")


def json_array_size(c: Column | str) -> Column:
    """Number of elements of a JSON array text; NULL for NULL or malformed text."""
    return F.size(F.from_json(as_column(c), "array<string>"))


def date_parts(c: Column | str) -> dict[str, Column]:
    """Year, month and day of week (Sunday is 1)."""
    c = as_column(c)
    return {"year": F.year(c), "month": F.month(c), "dow": F.dayofweek(c)}
