"""Order statistics and ranks that no single task holds: medians from counts, numbered labels."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorefold.functions.casts import named
from scorefold.session import durable

#: Ranges of values per doubling; and a bound of the logarithm of any double.
RANGES = 4096
MOST_LOG = 1075


def range_of(x: Column) -> Column:
    """The number of the value's range: ranges order as values do and are 1/6000 of their value wide.

    The same for every table, without a pass that looks for bounds first: Java's logarithm
    is never smaller for a larger number.
    """
    number = F.floor(F.log2(F.abs(x)) * RANGES) + (MOST_LOG * RANGES + 1)
    return F.when(x == 0, F.lit(0).cast("bigint")).when(x < 0, -number).otherwise(number)


def medians(counts: DataFrame, keys: list[str], value: str, weight: str, output: str = "median") -> DataFrame:
    """keys and the exact median of value, each value counted weight times; null and NaN values do not count.

    counts holds a row per key and value, or several.  The values' ranges are counted first:
    running counts over a key's ranges tell which range holds the middle (or two of them,
    for an even number), so all but those ranges' rows are left behind, wherever they are.
    Running counts over what is left give the middle values.  Rows of one key are spread
    over all tasks until then, and nothing is gathered in a buffer; windows spill.
    """
    own = [named(k) for k in keys]
    x = F.col("__x")
    rows = counts.where(named(value).isNotNull() & ~F.isnan(named(value)) & (named(weight) > 0))
    rows = rows.select(*own, named(value).cast("double").alias("__x"), named(weight).cast("bigint").alias("__n"))
    key = Window.partitionBy(*own)
    to = F.sum("__n").over(key.orderBy("__range").rowsBetween(Window.unboundedPreceding, 0))
    ranges = rows.groupBy(*own, range_of(x).alias("__range")).agg(F.sum("__n").alias("__n"), F.min("__x").alias("__least"), F.max("__x").alias("__most"))
    ranges = ranges.withColumns({"__to": to, "__all": F.sum("__n").over(key)})

    def holds() -> Column:
        """Whether a run of places (from 0) that ends before __to holds one of the middle places."""
        start = F.col("__to") - F.col("__n")
        low, high = F.floor((F.col("__all") - 1) / 2), F.floor(F.col("__all") / 2)
        return ((start <= low) & (low < F.col("__to"))) | ((start <= high) & (high < F.col("__to")))

    middle = ranges.where(holds())
    # a range of one value, as on a marking scale, needs no second look
    sure = middle.where(F.col("__least") == F.col("__most")).select(*own, F.col("__least").alias("__x"))
    open_ = middle.where(F.col("__least") < F.col("__most")).select(*own, "__range", (F.col("__to") - F.col("__n")).alias("__before"), "__all")
    open_ = open_.withColumnsRenamed({k: f"__open_{i}" for i, k in enumerate([*keys, "__range"])})
    same = [named(k).eqNullSafe(F.col(f"__open_{i}")) for i, k in enumerate([*keys, "__range"])]  # null is a key too
    near = rows.withColumn("__range", range_of(x)).join(open_, reduce(and_, same))
    near = near.groupBy(*own, "__range", "__x").agg(F.sum("__n").alias("__n"), F.first("__before").alias("__before"), F.first("__all").alias("__all"))
    in_range = Window.partitionBy(*own, "__range").orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("__to", F.col("__before") + F.sum("__n").over(in_range)).where(holds()).select(*own, "__x")
    return sure.union(near).groupBy(*own).agg((F.min("__x") * 0.5 + F.max("__x") * 0.5).alias(output))


def label_index(df: DataFrame, label: str, output: str = "ml_label") -> DataFrame:
    """Number the labels from 0 as doubles, most frequent first, ties alphabetical; a null label has no number.

    The labels are sorted over all tasks; a task's first number is the sum of the counts of
    the tasks before it, one row each.
    """
    sizes = df.where(named(label).isNotNull()).groupBy(named(label).alias("__label")).agg(F.count("*").alias("__n"))
    ordered = sizes.repartitionByRange(F.desc("__n"), "__label").withColumn("__part", F.spark_partition_id())
    ordered = durable(ordered)  # a second run of the sort might cut the parts elsewhere
    parts = ordered.groupBy("__part").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))  # a row per task
    place = F.row_number().over(Window.partitionBy("__part").orderBy(F.desc("__n"), "__label")) - 1
    numbers = ordered.withColumn("__place", place).join(starts, "__part").select("__label", (F.col("__start") + F.col("__place")).cast("double").alias(output))
    return df.join(numbers, named(label) == F.col("__label"), "left").select(*[named(c) for c in df.columns if c != output], named(output))
