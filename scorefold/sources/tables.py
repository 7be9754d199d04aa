"""Delimited text tables."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from scorefold import labels
from scorefold.functions.casts import named, quoted, safe_double, safe_int
from scorefold.operators.schema import normalize_columns
from scorefold.session import durable
from scorefold.sources.versions import current, first_line, replace

# quotes are doubled inside quoted fields, and outer spaces belong to the value
CSV_OPTIONS = {
    "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}

EMPTY_MARK = "\x01"
#: Files whose first lines are asked for side by side.
HEADERS_AT_ONCE = 16


def _header_separator(line) -> Column:
    """`;` if the line holds more of them than commas, else `,`."""

    def count(sign: str) -> Column:
        return F.length(line) - F.length(F.replace(line, F.lit(sign), F.lit("")))

    return F.when(count(";") > count(","), ";").otherwise(",")


def detect_delimiter(spark: SparkSession, path: str) -> str:
    """The separator of a file, or of a folder whose files agree; `,` for an empty one."""
    first_line = spark.read.text(current(spark, path)).limit(1).select(_header_separator(F.col("value")).alias("s")).first()
    return first_line["s"] if first_line else ","


def read_table(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    sep: str | None = None,
    normalize: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """A CSV table with header; the separator is detected and header spaces are removed.

    Columns are taken by their header names, in whatever order the file has them: the
    result has the schema's columns, null where the file has none.  All files of a
    folder must have one header; a file with another raises.  Without a schema types
    are inferred, which reads the whole table first.  `multiline` allows line breaks
    inside quoted fields, and makes each file one task.
    """
    path = current(spark, path) if isinstance(path, str) else path
    options = CSV_OPTIONS | {"sep": sep or detect_delimiter(spark, path), "multiLine": multiline}
    if schema is None:
        df = spark.read.options(**options, inferSchema=True).csv(path)
        return normalize_columns(df) if normalize else df
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = spark.read.options(**options).csv(path).columns  # reads one line
    plain = [name.replace(" ", "") for name in header] if normalize else header
    types = {field.name: field.dataType for field in wanted}
    in_file = StructType([StructField(name, types.get(p, StringType())) for name, p in zip(header, plain)])
    # a quoted empty field is an empty text, an unquoted one is null; Spark tells them apart by this mark only
    df = spark.read.options(**options, enforceSchema=False, emptyValue=EMPTY_MARK).schema(in_file).csv(path)
    texts = [c for c, t in df.dtypes if t == "string"]
    df = df.withColumns({c: F.when(named(c) == EMPTY_MARK, "").otherwise(named(c)) for c in texts}) if texts else df
    df = normalize_columns(df) if normalize else df
    return df.select(
        *[named(f.name) if f.name in plain else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted]
    )


def read_folder(spark: SparkSession, path: str, schema: StructType | str | None = None, normalize: bool = True, multiline: bool = False) -> DataFrame:
    """The CSV files of a folder as one table, each by its own separator and header.

    Files of one header and separator are read together, by Spark's reader, which cuts large
    files (not with `multiline`); the parts are united by column name, null where a file
    lacks a column.  Without a schema the columns are all that occur, as texts, in the order
    of the files' names.  An empty folder gives no rows.  Only first lines are read
    beforehand, of HEADERS_AT_ONCE files at a time; a header has no line breaks.
    """
    place = current(spark, path)
    files = sorted(r["path"] for r in spark.read.format("binaryFile").load(place).where("length > 0").select("path").collect())
    with ThreadPool(HEADERS_AT_ONCE) as pool:
        lines = pool.map(lambda f: first_line(spark, f), files)
    shapes: dict[tuple[str, str], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        shapes.setdefault((";" if line.count(";") > line.count(",") else ",", line), []).append(file)
    if schema is None:
        names: dict[str, None] = {}
        for sep, _ in shapes:
            some = shapes[sep, _][0]
            names.update(dict.fromkeys(n.replace(" ", "") if normalize else n for n in spark.read.options(**CSV_OPTIONS, sep=sep).csv(some).columns))
        schema = StructType([StructField(n, StringType()) for n in names])
    parts = [read_table(spark, own, schema, sep, normalize, multiline) for (sep, _), own in shapes.items()]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _header_schema(spark: SparkSession, path: str, sep: str, normalize: bool, text: set[str], whole: set[str]) -> StructType:
    """Every column of the header: text, whole numbers, and doubles for the rest."""
    names = spark.read.options(**CSV_OPTIONS, sep=sep).csv(current(spark, path)).columns
    names = [n.replace(" ", "") for n in names] if normalize else names
    return StructType.fromDDL(
        ", ".join(f"{quoted(n)} {'string' if n in text else 'int' if n in whole else 'double'}" for n in names)
    )


def read_scores(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Wide student scores, separated by `;`: texts, a whole TOEIC, and a double per subject."""
    schema = schema or _header_schema(spark, path, ";", False, {"ma_sv", "ho_ten"}, {"TOEIC"})
    return read_table(spark, path, schema, sep=";", normalize=False)


def read_subject_stats(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Subject statistics, separated by `,`: numeric columns as doubles, all others, the code too, as text."""
    if schema is None:
        names = spark.read.options(**CSV_OPTIONS, sep=",").csv(current(spark, path)).columns
        others = {n.replace(" ", "") for n in names} - set(labels.SUBJECT_NUMERIC) - set(labels.SUBJECT_FEATURES)
        schema = _header_schema(spark, path, ",", True, others, set())
    return read_table(spark, path, schema, sep=",")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", sep: str = ",") -> None:
    """Write a result as the path's new version; parquet unless CSV is asked for.

    The path may be the one that df reads.  Read it back with this module, or with
    `versions.current`.
    """

    def write(place: str) -> None:
        writer = df.write.options(**CSV_OPTIONS, sep=sep) if fmt == "csv" else df.write
        writer.format(fmt).save(place)

    replace(df.sparkSession, path, write)


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """The table, written once to the shared folder, and its row count, taken while it was written."""
    seen = Observation()
    table = durable(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return table, int(seen.get.get("n", 0))


def load_typed(raw: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Text columns as numbers ("double" or "bigint"), and what was found on the way.

    The first result is raw with the named columns cast (null where a text is no number),
    written once to the shared folder.  The second has, per column of raw: column, rows,
    nulls, unparsable (texts that are no number, NaN among them; null for a column that is
    not cast).  Both come from one pass over raw.
    """
    cast = {c: safe_double(c, None) if t == "double" else safe_int(c, None) for c, t in types.items()}
    facts = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(raw.columns):
        facts.append(F.count_if(named(c).isNull()).alias(f"nulls{i}"))
        if c in cast:
            facts.append(F.count_if(named(c).isNotNull() & cast[c].isNull()).alias(f"bad{i}"))
    seen = Observation()
    table = durable(raw.observe(seen, *facts).withColumns(cast))
    found = seen.get
    report = [(c, found.get("rows", 0), found.get(f"nulls{i}", 0), found.get(f"bad{i}", 0) if c in cast else None) for i, c in enumerate(raw.columns)]
    return table, raw.sparkSession.createDataFrame(report, "column string, rows long, nulls long, unparsable long")
