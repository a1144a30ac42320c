"""CSV landing files, generic tables and file listings."""

from __future__ import annotations

import csv
import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcatalog import vocab
from clipcatalog.functions.columns import as_col

CORRUPT = "_corrupt_record"


def _text_fields(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _bare(path_column):
    return F.element_at(F.split(path_column, "/"), -1)


def read_positional_csv(
    spark: SparkSession, path, columns: list[str], glob: str = "*.csv", null_tokens: list[str] | None = None,
    quarantine: bool = False, source_column: str = "SOURCE_FILE", multi_line: bool = True,
) -> DataFrame:
    """Many CSV files of different widths into one wide all-text shape.

    Columns bind by position: a short row is padded with NULL, blanks around
    fields go away and the null tokens become NULL.  A row with more fields
    than the layout, or a broken quote, is bad: it is skipped, or returned
    alone with ``quarantine=True``.  Fields may hold line ends, so a file is one task; where a
    delivery is known to have none, ``multi_line=False`` lets several tasks share a file.
    """
    tokens = vocab.CSV_NULL_TOKENS if null_tokens is None else null_tokens
    layout = _text_fields([f"c{i}" for i in range(len(columns))] + [CORRUPT])
    raw = (
        spark.read.schema(layout)
        .option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)  # else a row's width is not seen when only some columns are asked for
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .csv(path)
        .select("*", _bare(F.col("_metadata.file_path")).alias(source_column))
    )
    # A short row also fills the corrupt column: it is bad only when too wide.
    too_wide = F.col(CORRUPT).isNotNull() & F.col(f"c{len(columns) - 1}").isNotNull()
    if quarantine:
        return raw.filter(too_wide).select(F.col(CORRUPT).alias("bad_row"), source_column)
    values = []
    for i, name in enumerate(columns):
        text = F.trim(F.col(f"c{i}"))
        values.append(F.when(~text.isin(tokens), text).alias(name))
    return raw.filter(~too_wide).select(*values, source_column)


def required_columns(df: DataFrame, names) -> DataFrame:
    """The frame itself, or an error that lists the missing columns."""
    have = {c.lower() for c in df.columns}
    missing = sorted(n for n in names if n.lower() not in have)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def _csv_headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Header fields to the files that carry them, from the first line of each file.

    One distributed pass over the lines; only distinct headers and file names,
    which the file listing holds anyway, reach the driver.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True).text(paths)
        .filter("_metadata.file_block_start = 0")
        .select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"))
    )
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("header"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.groupBy("header").agg(F.sort_array(F.collect_set("path")).alias("files")).collect():
        names = tuple(n.strip() for n in next(csv.reader([row["header"].lstrip("\ufeff")]), []))
        found.setdefault(names, []).extend(re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(f)) for f in row["files"])
    return found


def read_named_csv(spark: SparkSession, paths: list[str], required: list[str], columns: list[str],
                   url: str | None = None, multi_line: bool = True) -> DataFrame:
    """CSV files by header name, one read per layout, one shape out.

    Files of one folder may name their columns in different orders.  Names
    match in any case; absent columns become ``''``; rows without a ``url``
    value are dropped; files without a line are skipped.  A header is one line.
    ``multi_line=False``, for files without line ends in fields, lets several tasks share a file.
    """
    if not paths:
        raise ValueError("no input paths")
    out = None
    for names, files in sorted(_csv_headers(spark, paths).items()):
        at: dict[str, int] = {}
        for i, name in enumerate(names):
            at.setdefault(name.lower(), i)
        missing = sorted(n for n in required if n.lower() not in at)
        if missing:
            raise ValueError(f"missing required columns: {missing}")
        df = (
            spark.read.schema(_text_fields([f"c{i}" for i in range(len(names))]))
            .option("header", True).option("multiLine", multi_line).option("escape", '"').csv(sorted(files))
        )
        picked = df.select(*[
            (F.coalesce(F.col(f"c{at[n.lower()]}"), F.lit("")) if n.lower() in at else F.lit("")).alias(n)
            for n in columns
        ])
        out = picked if out is None else out.unionByName(picked)
    if out is None:
        out = spark.createDataFrame([], _text_fields(columns))
    return out if url is None else out.filter(F.col(url) != "")


def list_inputs(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below a path that match a glob, sorted; an error when there are none.

    Only metadata is read: the content column is pruned away.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
        .select("path", _bare(F.col("path")).alias("name"), F.col("length").cast("bigint").alias("length"))
        .orderBy("path")
    )
    if files.isEmpty():
        raise FileNotFoundError(f"no file matches {glob} below {path}")
    return files


def read_table(spark: SparkSession, name: str, fmt: str = "parquet", **options) -> DataFrame:
    """Whole table through a connector; Parquet by default."""
    return spark.read.format(fmt).options(**options).load(name)


def write_overwrite(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet", **options) -> None:
    df.write.format(fmt).mode(mode).options(**options).save(name)


def write_csv_fixed_order(df: DataFrame, path: str, columns: list[str]) -> None:
    """CSV with a header and exactly these columns, in this order."""
    (
        df.select(*columns).write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_optional(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The table, or an empty frame of the expected schema when it is absent.

    Only "does not exist" counts as absent; any other failure is raised.
    """
    try:
        return spark.read.format(fmt).load(name)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], schema)
        raise


def conform_schema(df: DataFrame, target: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """All target columns, typed and in order; missing ones get their default."""
    defaults = defaults or {}
    have = {c.lower(): c for c in df.columns}
    out = []
    for field in target.fields:
        if field.name.lower() in have:
            value = F.col(have[field.name.lower()])
        else:
            value = F.lit(defaults.get(field.name))
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)


def publish_views(spark: SparkSession, views: dict) -> dict[str, DataFrame]:
    """Build a chain of named views in dependency order.

    Each value is a function of the frames built so far; each result becomes a
    temporary view of that name.
    """
    built: dict[str, DataFrame] = {}
    for name, build in views.items():
        built[name] = build(built)
        built[name].createOrReplaceTempView(name)
    return built


def distinct_urls(df: DataFrame, url: str, contains: str | None = None) -> DataFrame:
    """Distinct set URLs, optionally only those that contain a text."""
    out = df.select(F.col(url).alias("url")).filter(F.coalesce(as_col("url"), F.lit("")) != "")
    if contains:
        out = out.filter(F.contains(F.col("url"), F.lit(contains)))
    return out.distinct()
