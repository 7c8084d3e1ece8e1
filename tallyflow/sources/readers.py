"""Readers with explicit schemas, and the incremental date window."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.operators.cleaning import first_per_key


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_json_devices(
    spark: SparkSession, path: str, schema: T.StructType, key: str, order: Sequence[str | Column]
) -> DataFrame:
    """JSON lines below a folder, one row per key: the first under ``order``."""
    return first_per_key(spark.read.schema(schema).json(path), [key], order)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, header: bool = True) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=header)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = "\t",
    header: bool = False,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Delimited text, plain or gzip."""
    options: dict[str, Any] = {"timestampFormat": timestamp_format} if timestamp_format else {}
    return spark.read.options(**options).csv(path, schema=schema, sep=sep, header=header)


def read_csv_with(
    spark: SparkSession, path: str, schema: T.StructType | str, converters: Mapping[str, Any]
) -> DataFrame:
    """Every CSV file of a folder, with a column expression applied per named column."""
    df = spark.read.csv(path, schema=schema, header=True)
    return df.withColumns({c: f(F.col(c)) for c, f in converters.items() if c in df.columns})


def latest_partition(df: DataFrame, column: str = "date") -> DataFrame:
    """One row: the newest value of a partition column."""
    return df.agg(F.max(column).alias("latest"))


def incremental_window(latest: Column, as_of: Column, start: Column | None = None, end: Column | None = None) -> tuple[Column, Column]:
    """(from, to): the day after the newest partition up to yesterday; equal bounds push ``to`` on."""
    first = F.coalesce(start, F.date_add(latest, 1)) if start is not None else F.date_add(latest, 1)
    last = F.coalesce(end, F.date_sub(as_of, 1)) if end is not None else F.date_sub(as_of, 1)
    return first, F.when(last == first, F.date_add(last, 1)).otherwise(last)


def strip_margin(text: str, bar: str = "|") -> str:
    return re.sub(r"(?m)^[ \t]*" + re.escape(bar), "", text)


def sql_job(spark: SparkSession, text: str, args: Mapping[str, Any], views: Mapping[str, DataFrame]) -> DataFrame:
    """Run a margin-barred SQL text with named parameters over the given frames.

    The frames are passed as ``{name}`` fields, values as ``:name`` parameters; neither
    is pasted into the text as a string.
    """
    return spark.sql(strip_margin(text), args=dict(args), **views)
