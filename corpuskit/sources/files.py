"""JSON corpora as one row an item: (source_file, ordinal, item VARIANT).

Files are ordered by path and items by their place, which keeps first-wins rules stable. A file that
isn't JSON gives no rows; in a file of lines only the bad line is lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _items(value: Column) -> Column:
    """The elements of a parsed array, or the one document that it is."""
    return F.when(F.schema_of_variant(value).startswith("ARRAY"), value.cast("array<variant>")).otherwise(F.array(value))


def _documents(spark: SparkSession, path: str, pattern: str, recursive: bool) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", pattern).text(path, wholetext=True)
    parsed = files.select(F.col("_metadata.file_path").alias("source_file"), F.try_parse_json("value").alias("v")).where("v is not null")
    return parsed.select("source_file", F.posexplode(_items(F.col("v"))).alias("ordinal", "item"))


def read_formatted(spark: SparkSession, path: str) -> DataFrame:
    """All *.json files below a folder, or one file."""
    return _documents(spark, path, "*.json", True)


def read_lines(spark: SparkSession, path: str, pattern: str = "*.{jsonl,ndjson}") -> DataFrame:
    """One item a line; ordinal counts a file's good lines in order of their bytes' task."""
    lines = spark.read.option("pathGlobFilter", pattern).text(path).select(F.col("_metadata.file_path").alias("source_file"), F.monotonically_increasing_id().alias("at"), F.try_parse_json("value").alias("item"))
    return lines.where("item is not null").select("source_file", F.col("at").alias("ordinal"), "item")


def read_generic(spark: SparkSession, path: str) -> DataFrame:
    """The .json, .jsonl and .ndjson files of a folder, case of the extension aside, without its subfolders."""
    whole = _documents(spark, path, "*.[jJ][sS][oO][nN]", False)
    lines = read_lines(spark, path, "*.{[jJ][sS][oO][nN][lL],[nN][dD][jJ][sS][oO][nN]}")
    return whole.select("source_file", F.col("ordinal").cast("long").alias("ordinal"), "item").unionByName(lines)
