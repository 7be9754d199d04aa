"""Filters and searches.

Searches return every match; `limit` is the optional size of a shown page and
always follows an order, so the page is the same on each run.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold.functions.casts import as_column, named

TABLE_PAGE, SAMPLE_PAGE, SUBJECT_PAGE = 2000, 1000, 1000


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def bounded_sample(df: DataFrame, n: int = TABLE_PAGE, order_by=None) -> DataFrame:
    """The first n rows in the given order (default: all columns from the left)."""
    return df.orderBy(*(order_by or [named(c) for c in df.columns])).limit(n)


def _page(df: DataFrame, limit: int | None, order_by) -> DataFrame:
    return df if limit is None else bounded_sample(df, limit, order_by)


def filter_codes(df: DataFrame, codes: list[str] | DataFrame, column: str = "MaMH") -> DataFrame:
    """Rows whose code is in a list, or in the first column of a table of codes."""
    types = dict(df.dtypes)
    if isinstance(codes, DataFrame):
        code, code_type = codes.dtypes[0]
        # equal types join as they are; text is the common ground for all others
        left = named(column) if types[column] == code_type else named(column).cast("string")
        right = named(code) if types[column] == code_type else named(code).cast("string")
        wanted = codes.select(right.alias("__code"))
        return df.join(wanted, left == F.col("__code"), "left_semi")
    wanted = [str(c) for c in codes]
    if types[column] in ("tinyint", "smallint", "int", "bigint"):
        # compare as numbers, so that the list reaches the scan; other texts match no number
        numbers = [int(c) for c in wanted if re.fullmatch("0|-?[1-9][0-9]*", c)]
        return df.filter(named(column).isin(numbers))
    return df.filter(named(column).cast("string").isin(wanted))


def student_search(df: DataFrame, keyword: str = "", columns=("ma_sv", "ho_ten")) -> DataFrame:
    """Case-insensitive substring over whichever of the columns exist."""
    present = [c for c in columns if c in df.columns]
    if not keyword or not present:
        return df
    needle = keyword.lower()
    return df.filter(_any([F.lower(named(c).cast("string")).contains(needle) for c in present]))


def matches(value: Column | str, keyword: str, mode: str = "regex") -> Column:
    """Case-insensitive match; mode "literal" takes the keyword's characters as they are."""
    if mode not in ("regex", "literal"):
        raise ValueError(f"unknown search mode: {mode}")
    text = as_column(value).cast("string")
    if mode == "literal":
        return F.lower(text).contains(keyword.lower())
    return text.rlike("(?iu)" + keyword)


def check_pattern(spark: SparkSession, keyword: str) -> None:
    """Raise ValueError for a pattern that Spark cannot read, before a job starts."""
    try:
        spark.range(1).select(F.lit("").rlike("(?iu)" + keyword)).collect()
    except PySparkException as error:
        raise ValueError(f"not a pattern: {keyword}") from error


def search_any(
    df: DataFrame,
    keyword: str,
    columns: list[str] | None = None,
    mode: str = "regex",
    limit: int | None = None,
    order_by=None,
) -> DataFrame:
    """Rows where any column matches; an empty keyword keeps all rows."""
    keyword = keyword.strip()
    if keyword:
        if mode == "regex":
            check_pattern(df.sparkSession, keyword)
        df = df.filter(_any([matches(c, keyword, mode) for c in columns or df.columns]))
    return _page(df, limit, order_by)


def subject_title(code="MaMH", name="TenMH", separator: str = " - ") -> Column:
    """`code - name`, or the code alone when there is no name."""
    code, name = as_column(code).cast("string"), F.coalesce(as_column(name), F.lit(""))
    return F.when(name == "", code).otherwise(F.concat(code, F.lit(separator), name))


def search_subjects(
    stats: DataFrame, keyword: str, mode: str = "regex", limit: int | None = None
) -> DataFrame:
    """Distinct (MaMH, TenMH) whose code or name matches, with the title to show."""
    keyword = keyword.strip()
    if keyword and mode == "regex":
        check_pattern(stats.sparkSession, keyword)
    found = stats.select("MaMH", "TenMH")
    found = found.filter(matches("TenMH", keyword, mode) | matches("MaMH", keyword, mode)) if keyword else found.limit(0)
    return _page(found.distinct(), limit, ["MaMH", "TenMH"]).withColumn("title", subject_title())


def parse_title(df: DataFrame, column: str = "title", separator: str = " - ") -> DataFrame:
    """Split a shown title back into MaMH and TenMH, at the first separator."""
    parts = F.split(named(column), re.escape(separator), 2)
    return df.withColumns(
        {
            "MaMH": F.trim(F.get(parts, F.lit(0))),
            "TenMH": F.coalesce(F.trim(F.get(parts, F.lit(1))), F.lit("")),
        }
    )


def add_selection(selected: DataFrame, picked: DataFrame, key: str = "MaMH") -> DataFrame:
    """The selection plus the picked rows it does not hold yet, one per key."""
    fresh = picked.dropDuplicates([key]).join(selected.select(key), key, "left_anti")
    return selected.unionByName(fresh.select(*selected.columns))
