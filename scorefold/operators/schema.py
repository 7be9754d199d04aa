"""Column names, required columns and safe numeric columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.functions.casts import named, safe_double


def normalize_columns(df: DataFrame) -> DataFrame:
    """Remove spaces from every column name, in one projection."""
    names = [c.replace(" ", "") for c in df.columns]
    clashes = sorted(n for n, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"columns collide once spaces are removed: {clashes}")
    return df.toDF(*names)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required columns the table lacks, in the order asked for."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def ensure_columns(df: DataFrame, columns: Iterable[str], default: float = 0.0) -> DataFrame:
    """Add the absent columns with a constant (names compare case-sensitively)."""
    absent = missing_columns(df, columns)
    return df.withColumns({c: F.lit(default) for c in absent}) if absent else df


def to_double(df: DataFrame, columns: Iterable[str], on_invalid: float | None = 0.0) -> DataFrame:
    """Cast the present columns to double; on_invalid=None keeps null for bad input."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: safe_double(c, on_invalid) for c in present}) if present else df


def clean_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every feature present, double and never null, as vector assembly needs it."""
    return to_double(ensure_columns(df, columns), columns)


def columns_except(df: DataFrame, excluded: Iterable[str]) -> list[str]:
    """Score columns of a wide table: all but the known others."""
    excluded = set(excluded)
    return [c for c in df.columns if c not in excluded]


def columns_between(df: DataFrame, prefix: str = "_", suffix: str = "_4") -> list[str]:
    """Columns by prefix and suffix."""
    return [c for c in df.columns if c.startswith(prefix) and c.endswith(suffix)]


def project(df: DataFrame, columns: Iterable[str], rounded: Iterable[str] = (), digits: int = 2) -> DataFrame:
    """The wanted columns that exist, some of them rounded."""
    rounded = set(rounded)
    return df.select(
        *[
            F.round(named(c), digits).alias(c) if c in rounded else named(c)
            for c in columns
            if c in df.columns
        ]
    )
