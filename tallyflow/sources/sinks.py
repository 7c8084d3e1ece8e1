"""Writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, column: str = "date", mode: str = "append", files_per_value: int = 1) -> None:
    """Parquet by partition column.

    A rerun in ``overwrite`` mode replaces only the partitions it writes. Rows of one
    value are spread over ``files_per_value`` tasks, so that a large day is no single task.
    """
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_value))
    (
        df.repartition(F.col(column), spread)
        .write.partitionBy(column)
        .option("partitionOverwriteMode", "dynamic")
        .mode(mode)
        .parquet(path)
    )


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv_gzip(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, compression="gzip")


def write_csv_by(df: DataFrame, path: str, column: str) -> None:
    """One folder of gzip CSV files for each value of a column, all in one job."""
    df.write.mode("overwrite").partitionBy(column).csv(path, header=True, compression="gzip")


def publish_rate_model(nodes: DataFrame, path: str, metadata: Mapping[str, object]) -> None:
    """Node table plus a one-row table describing the run."""
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    row = nodes.sparkSession.createDataFrame([tuple(str(v) for v in metadata.values())], list(metadata))
    row.write.mode("overwrite").parquet(f"{path}/metadata")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
