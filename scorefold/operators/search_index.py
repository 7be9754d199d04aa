"""Searches by a stored trigram index.

`save_index` writes a table in blocks of rows, and for every three characters in a row the
blocks they occur in.  A keyword's own trigrams name the few blocks that may match; only
those are read, and the plain predicates of `search` decide on each of their rows, so the
result is that of a scan.  A pattern without three plain characters in a row, or one whose
trigrams occur in too many blocks, is a scan.

Both tables are sorted by what they are looked up by, so Parquet's statistics skip the
rest of a file: trigrams by themselves, rows by their block.
"""

from __future__ import annotations

from functools import cache, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold.functions.casts import named
from scorefold.operators.search import check_pattern, matches
from scorefold.sources.versions import current, replace

#: Rows of a block; blocks that a search reads by the index at most, beyond which it scans.
BLOCK_ROWS = 256
MOST_BLOCKS = 400
_BLOCK = "__block"
#: Characters that mean something in a pattern.
_SIGNS = set(".^$*+?{}[]()|\\")


@cache
def _case_pairs() -> dict[str, str]:
    """Small letters that share a capital with another one, such as long s and dotless i, and that other one."""

    def one(text: str, otherwise: str) -> str:
        return text if len(text) == 1 else otherwise

    small = {one(chr(i).lower(), "") for i in range(0x110000)} - {""}
    return {c: t for c in sorted(small) if (t := one(one(c.upper(), c).lower(), c)) != c}


def folded(text: Column) -> Column:
    """What texts have in common that differ in case only; the dot above an I, which comes and goes with case, is left out."""
    pairs = _case_pairs()
    return F.translate(F.lower(text), "".join(pairs) + "\u0307", "".join(pairs.values()))


def _grams(text: Column) -> Column:
    """The distinct trigrams of a text; none for a null or shorter one."""
    # a match of no length at every place, each with the next three characters
    return F.coalesce(F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(?=(.{3}))"), F.lit(1))), F.array().cast("array<string>"))


def literals(keyword: str, mode: str) -> list[str]:
    """Texts that every match contains, case aside; none if that is not plain to see from the pattern."""
    if mode == "literal":
        return [keyword]
    if set("|()[]{}\\") & set(keyword):
        return []
    found, run = [], ""
    for i, c in enumerate(keyword):
        following = keyword[i + 1 : i + 2]
        if c in _SIGNS or following in ("*", "?"):
            found.append(run)
            run = ""
        else:
            run += c
            if following == "+":  # it repeats, so what comes behind need not follow this one alone
                found.append(run)
                run = ""
    return [r for r in [*found, run] if r]


def save_index(df: DataFrame, path: str, columns: list[str] | None = None, block_rows: int = BLOCK_ROWS) -> None:
    """Store df, with an index of the columns (default: all), as the path's new version."""
    columns = columns or df.columns

    def write(place: str) -> None:
        # numbers rise along each task's rows, so blocks are runs of a file
        numbered = df.withColumn(_BLOCK, F.expr(f"monotonically_increasing_id() div {int(block_rows)}"))
        numbered.write.parquet(f"{place}/rows")
        rows = df.sparkSession.read.schema(numbered.schema).parquet(f"{place}/rows")
        texts = F.array(*[folded(named(c).cast("string")) for c in columns])
        grams = rows.select(_BLOCK, F.explode(F.array_distinct(F.flatten(F.transform(texts, _grams)))).alias("gram"))
        postings = grams.groupBy("gram", _BLOCK).agg(F.count("*").alias("rows")).repartitionByRange("gram", _BLOCK).sortWithinPartitions("gram", _BLOCK)
        postings.write.parquet(f"{place}/grams")

    replace(df.sparkSession, path, write)


class SearchIndex:
    """A stored table that can be searched; it goes on reading the version it was opened on."""

    def __init__(self, spark: SparkSession, path: str):
        place = current(spark, path)
        self.spark, self.rows, self.grams = spark, spark.read.parquet(f"{place}/rows"), spark.read.parquet(f"{place}/grams")
        self.columns = [c for c in self.rows.columns if c != _BLOCK]

    def _wanted(self, keyword: str, mode: str) -> list[str]:
        """The trigrams of every match."""
        found = literals(keyword, mode)
        if not found:
            return []
        row = self.spark.range(1).select(F.flatten(F.array(*[_grams(folded(F.lit(x))) for x in found])).alias("g")).first()
        return sorted(set(row["g"]))

    def blocks(self, keyword: str, mode: str = "regex", most: int = MOST_BLOCKS) -> list[int] | None:
        """The blocks that may hold a match; None if the index cannot tell, or they are more than `most`."""
        grams = self._wanted(keyword, mode)
        if not grams:
            return None
        postings = self.grams.where(reduce(or_, [F.col("gram") == g for g in grams]))
        both = postings.groupBy(_BLOCK).agg(F.count("*").alias("n")).where(F.col("n") == len(grams)).select(_BLOCK)
        found = [r[0] for r in both.limit(most + 1).collect()]
        return sorted(found) if len(found) <= most else None

    def candidates(self, keyword: str, mode: str = "regex", most: int = MOST_BLOCKS) -> DataFrame:
        """The rows of the blocks that may hold a match, all rows if the index cannot tell."""
        found = self.blocks(keyword, mode, most)
        if found is None:
            return self.rows.select(*map(named, self.columns))
        # runs of blocks as ranges, which the scan compares with a file's statistics
        runs: list[list[int]] = []
        for b in found:
            if runs and runs[-1][1] == b - 1:
                runs[-1][1] = b
            else:
                runs.append([b, b])
        inside = reduce(or_, [F.col(_BLOCK).between(a, b) for a, b in runs]) if runs else F.lit(False)
        return self.rows.where(inside).select(*map(named, self.columns))

    def search_any(self, keyword: str, columns: list[str] | None = None, mode: str = "regex") -> DataFrame:
        """Rows where any of the indexed columns matches, as search.search_any finds them; an empty keyword keeps all rows."""
        keyword = keyword.strip()
        if not keyword:
            return self.rows.select(*map(named, self.columns))
        if mode == "regex":
            check_pattern(self.spark, keyword)
        return self.candidates(keyword, mode).filter(reduce(or_, [matches(c, keyword, mode) for c in columns or self.columns]))

    def student_search(self, keyword: str = "", columns=("ma_sv", "ho_ten")) -> DataFrame:
        """As search.student_search; the keyword's characters stand for themselves."""
        present = [c for c in columns if c in self.columns]
        if not keyword or not present:
            return self.rows.select(*map(named, self.columns))
        return self.candidates(keyword, "literal").filter(reduce(or_, [F.lower(named(c).cast("string")).contains(keyword.lower()) for c in present]))
