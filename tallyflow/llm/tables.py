"""Helpers shared by the operators: input tables, staged tables, column names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Where the session has no such setting (tests), the context's checkpoint folder or else the
    warehouse serves, which executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = found.get() if found.isDefined() else spark.conf.get("spark.sql.warehouse.dir") + "/.scratch"
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """The rows written once to the shared scratch folder and read back, which cuts the lineage."""
    spark = df.sparkSession
    path = scratch_folder(spark)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; plain ASCII takes the faster built-in."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, so that helper columns beside it clash with none of them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
