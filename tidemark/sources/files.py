"""File sources: inventory of a folder, newest file per logical name, and landed sheets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.names import clean_headers
from tidemark.functions.text import strip_strings
from tidemark.functions.times import coerce, timestamps_to_text, to_text
from tidemark.sources.workbooks import read_workbooks


def inventory(spark: SparkSession, folder: str, pattern: str = "*.xlsx") -> DataFrame:
    """(path, modified, length) of matching files; their content is not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    )
    return files.select("path", F.col("modificationTime").cast("timestamp_ntz").alias("modified"), "length")


def logical_name(path: Column, prefixes) -> Column:
    """A path without its source or archive folder."""
    return reduce(lambda c, p: F.replace(c, F.lit(p), F.lit("")), prefixes, path)


def newest(files: DataFrame, prefixes) -> DataFrame:
    """Latest file per logical name: (name, path, modified). Combined map-side; equal times go to the last path."""
    best = files.groupBy(logical_name(F.col("path"), prefixes).alias("name")).agg(
        F.max(F.struct("modified", "path")).alias("best"))
    return best.select("name", "best.path", "best.modified")


def newer_than_archive(source: DataFrame, archive: DataFrame) -> DataFrame:
    """Source files that the archive lacks or holds in an older state (both from :func:`newest`)."""
    a = archive.select("name", F.col("modified").alias("_archived"))
    return source.join(a, "name", "left").where(F.col("_archived").isNull() | (F.col("modified") > F.col("_archived"))).drop("_archived")


def matches(path: Column, table: str) -> Column:
    """Equal to the table name, or holding it after a slash or underscore; case does not matter."""
    low, name = F.lower(path), table.lower()
    return (low == name) | low.contains("/" + name) | low.contains("_" + name)


def file_of(files: DataFrame, table: str) -> DataFrame:
    """First matching path in listing order, and how many match, as one row (null and 0 when none)."""
    return files.where(matches(F.col("path"), table)).agg(F.min("path").alias("path"), F.count("path").alias("matching"))


def read_sheet(spark: SparkSession, path: str, text_columns=(), coerced=(), multi_line: bool = False) -> DataFrame:
    """A sheet landed as CSV or Parquet, or the first sheet of a workbook: headers cleaned, times as text, strings stripped.

    ``text_columns`` become strings; ``coerced`` hold times whose unreadable values become null. A CSV file is split over tasks
    unless ``multi_line`` says that its cells hold line breaks.
    """
    plain = path.rstrip("/").lower()
    if plain.endswith(".parquet"):
        raw = spark.read.parquet(path)
    elif plain.endswith((".xlsx", ".xlsm")):
        raw = read_workbooks(spark, path)
    elif plain.endswith(".xls"):
        raise ValueError(f"{path} has the old binary format; only .xlsx and .xlsm workbooks are read")
    else:
        raw = spark.read.option("header", True).option("multiLine", multi_line).csv(path)
    return clean_sheet(raw, text_columns, coerced)


def clean_sheet(raw: DataFrame, text_columns=(), coerced=()) -> DataFrame:
    df = strip_strings(timestamps_to_text(clean_headers(raw)), text_columns)
    return df.withColumns({c: to_text(coerce(F.col(f"`{c}`"))) for c in coerced}) if coerced else df
