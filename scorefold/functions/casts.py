"""Names and casts that never fail on dirty values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def string_sql(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(name: str) -> Column:
    """A column by its exact name."""
    return F.col(quoted(name))


def as_column(value: Column | str) -> Column:
    return named(value) if isinstance(value, str) else value


def safe_double(value: Column | str, on_invalid: float | None = 0.0) -> Column:
    """Double, with null, NaN and unparsable input replaced by on_invalid (None: null)."""
    number = F.nanvl(as_column(value).try_cast("double"), F.lit(None).cast("double"))
    return number if on_invalid is None else F.coalesce(number, F.lit(on_invalid))


def safe_int(value: Column | str, on_invalid: int | None = 0) -> Column:
    """Whole number; the text '12.5' is not one, ' 7 ' is, and the number 12.5 is cut to 12."""
    number = as_column(value).try_cast("bigint")
    return number if on_invalid is None else F.coalesce(number, F.lit(on_invalid).cast("bigint"))


def truncated_int(value: Column | str) -> Column:
    """Whole part of any numeric text, 0 when there is none ('3.9' -> 3)."""
    return F.coalesce(as_column(value).cast("string").try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))
