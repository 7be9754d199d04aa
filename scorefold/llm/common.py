"""What the operators of this subpackage share: word rules, written results, Arrow helpers."""

from __future__ import annotations

import math
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold.session import scratch_path

#: A word is a run of characters other than blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import this package too, wherever the driver was started
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read back with df's schema (also when it has no rows)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROW = "__row"


def free(name: str, *tables: DataFrame) -> str:
    """name, behind so many underscores that no column of the tables has it (case ignored)."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, name: str, row: str = ROW) -> DataFrame:
    """df with a column `row` that names each row, the same in every read of it.

    Rows of Parquet files are named by the hash of their file's path and their place
    in it, which needs no copy; any other table is written once with numbers.
    """
    if df._jdf.queryExecution().analyzed().nodeName().startswith("LogicalRelation"):
        try:
            place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
            return df.select("*", place.alias(row))
        except AnalysisException:
            pass  # files of another format have no row_index
    place = F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("place"))
    return written(df.withColumn(row, place), name)


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's text modulo divisor; a null id counts as empty text, which gives 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor


def small(df: DataFrame, rows: int, most: int) -> DataFrame:
    """df with a broadcast hint if its counted rows stay within most; else Spark joins by shuffle."""
    return F.broadcast(df) if rows <= most else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bits_for(rows: int, per_group: int, least: int = 0) -> int:
    """So many bits that rows spread over 2^bits groups of about per_group rows."""
    return max(least, math.ceil(math.log2(max(1, rows / per_group))))


def texts(column: pa.Array) -> list[str]:
    """The column's texts, a null as an empty one."""
    return ["" if x is None else x for x in column.to_pylist()]


def word_bytes(text: str) -> list[bytes]:
    """Words in UTF-8, A-Z lowered; bytes.split() and bytes.lower() know ASCII only, as WORD does."""
    return text.encode().lower().split()


def batches(columns: dict[str, list | np.ndarray], schema: pa.Schema, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """The columns as record batches of bounded length."""
    n = len(next(iter(columns.values())))
    for at in range(0, n, rows):
        yield pa.record_batch([pa.array(columns[f.name][at : at + rows], type=f.type) for f in schema], schema=schema)
