"""Scans: CSV, JSON lookups, parquet, catalogue tables, inline rows and date slices."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsift.lookups import VIDEO_RENAMES
from reelsift.sources.splitcsv import read_split_csv

ALL_DATES = "all_dates"
CSV_DIALECT = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


def inline_table(spark: SparkSession, rows: list[tuple], columns: list[str] | T.StructType) -> DataFrame:
    """Rows written in the program as a table whose size the planner knows."""
    if isinstance(columns, T.StructType):
        return spark.createDataFrame(rows, columns)
    data = {name: [row[i] for row in rows] for i, name in enumerate(columns)}
    return spark.createDataFrame(pa.table(data))


def read_media_csv(spark: SparkSession, path: str, schema: T.StructType | str, split: bool = False, block_bytes: int | None = None) -> DataFrame:
    """CSV with quoted, multi-line records and a declared schema, under the clean column names.

    With ``split`` a large file is read in several tasks (:mod:`reelsift.sources.splitcsv`), else each file in one.
    """
    if split:
        return read_split_csv(spark, path, schema, block_bytes=block_bytes).drop("_file").withColumnsRenamed(VIDEO_RENAMES)
    return spark.read.schema(schema).options(**CSV_DIALECT).csv(path).withColumnsRenamed(VIDEO_RENAMES)


def load_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose column types are inferred, which costs one more pass over the data."""
    return spark.read.options(**CSV_DIALECT, sep=",", inferSchema=True, encoding="utf-8").csv(path)


def read_tag_translations(spark: SparkSession, path: str) -> DataFrame:
    lookup = spark.read.csv(path, header=True, inferSchema=True)
    return lookup.select(
        F.col("normalized_tag").alias("original_tag"), F.col("english_translation").alias("translated_tag")
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Table stored under a path in any format the session knows."""
    return spark.read.format(fmt).load(path)


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")


def file_country(path: str | Column = "_metadata.file_path") -> Column:
    """Country code of the scanned file: the first two letters of its name, or of the folder ``XX_...`` around it."""
    path = F.col(path) if isinstance(path, str) else path
    folder = F.regexp_extract(path, r"/([A-Z]{2})_[^/]*/[^/]+$", 1)
    return F.when(folder != "", folder).otherwise(F.substring(F.regexp_extract(path, r"([^/]*)$", 1), 1, 2))


def read_country_files(spark: SparkSession, path: str, schema: T.StructType | str, split: bool = False, block_bytes: int | None = None) -> DataFrame:
    """Every country's file in one scan, without the description, tagged with ``country_dataset``; ``split`` as in :func:`read_media_csv`."""
    if split:
        lines = read_split_csv(spark, path, schema, block_bytes=block_bytes)
        return lines.withColumn("country_dataset", file_country("_file")).drop("description", "_file").withColumnsRenamed(VIDEO_RENAMES)
    scan = spark.read.schema(schema).options(**CSV_DIALECT).csv(path)
    return (
        scan.withColumn("country_dataset", file_country()).drop("description").withColumnsRenamed(VIDEO_RENAMES)
    )


def read_category_lookup(
    spark: SparkSession, path: str, multi_line: bool = True, country: str | None = None
) -> DataFrame:
    """(category_id, category_name) from category files ``{"items": [{"id", "snippet": {"title"}}]}``.

    With ``country`` each country has names of its own: the column of that name holds the country of the file.
    """
    schema = "items array<struct<id: string, snippet: struct<title: string>>>"
    files = spark.read.schema(schema).json(path, multiLine=multi_line)
    scopes = [file_country().alias(country)] if country else []
    items = files.select(*scopes, F.explode("items").alias("item"))
    return (
        items.groupBy(*([country] if country else []), F.col("item.id").alias("category_id"))
        .agg(F.min("item.snippet.title").alias("category_name"))
    )


def add_category_name(
    df: DataFrame, lookup: DataFrame, column: str = "category_id", country: str | None = None
) -> DataFrame:
    """Add ``category_name`` by id, and by ``country`` where given; ids without a name give null."""
    scopes = [F.col(country).alias("__country")] if country else []
    keyed = lookup.select(*scopes, F.col("category_id").alias("__id"), "category_name")
    on = F.col(column).cast("string") == F.col("__id")
    if country:
        on &= F.col(country) == F.col("__country")
    return df.drop("category_name").join(keyed, on, "left").drop("__id", "__country")


def read_or_build(read: Callable[[], DataFrame], build: Callable[[], DataFrame]) -> DataFrame:
    """The saved table when it exists, else the one built from its sources."""
    try:
        return read()
    except AnalysisException as missing:
        if missing.getCondition() not in {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}:
            raise
        return build()


def slice_by_date(df: DataFrame, value: str = ALL_DATES, column: str = "last_updated_date") -> DataFrame:
    """Rows of one update date, or all of them; prunes folders when the table is partitioned by that date."""
    return df if value == ALL_DATES else df.where(F.col(column) == F.lit(value).cast("date"))
