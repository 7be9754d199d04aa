"""Number and bar formatting for report texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorefold.functions.casts import as_column


def fixed(value: Column | str, digits: int) -> Column:
    """Fixed-point text, ties by the exact binary value and half-even.

    format_string rounds half-up on the shortest decimal form, which prints
    0.125 as 0.13; the pattern form of format_number does not.
    """
    pattern = "0" if digits == 0 else "0." + "0" * digits
    return F.call_function("format_number", as_column(value).cast("double"), F.lit(pattern))


def pad_left(text: Column, width: int) -> Column:
    """Right-align to width; longer text is kept whole."""
    return F.when(F.length(text) < width, F.lpad(text, width, " ")).otherwise(text)


def pad_right(text: Column, width: int) -> Column:
    return F.when(F.length(text) < width, F.rpad(text, width, " ")).otherwise(text)


def bar(percent: Column | str, per_block: float = 2.0, block: str = "█") -> Column:
    """One block per `per_block` percent, rounded down."""
    return F.repeat(F.lit(block), F.floor(as_column(percent) / per_block).cast("int"))
