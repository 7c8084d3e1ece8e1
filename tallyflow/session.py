"""Session helpers shared by tests, the bench and iterative operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str | int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyflow")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` or the one that the caller has set, else one in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.scratch").rstrip("/")


def spread(df: DataFrame, rows: int) -> DataFrame:
    """The rows by ``cut_lineage``, in partitions of about ``rows`` at most.

    A few large input files are few tasks in every pass of an iterative fit. Where no partition holds more, rows stay as they lie.
    """
    df = cut_lineage(df)
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    if (sizes["most"] or 0) <= rows:
        return df
    return cut_lineage(df.repartition(max(-(-sizes["all"] // rows), df.rdd.getNumPartitions())))


def staged(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, written once and read back.

    For rows that several branches read: unlike a checkpoint it is compressed, a branch reads only its columns,
    and its size is known, so that a small one is broadcast without a shuffle of the other side.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder that the cluster, the caller or ``shared_folder`` names."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
