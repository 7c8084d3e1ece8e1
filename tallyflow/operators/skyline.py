"""Pareto frontier of two measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.operators.ordering import running_max


def frontier(df: DataFrame, x: str, y: str) -> DataFrame:
    """(x, y, copies) of the points that no point with a greater x beats in y; equal y stays.

    Only the best y of each x can be on the frontier, so one row per x is compared.
    """
    best = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(
        F.count(F.lit(1)).alias("copies")
    ).groupBy("x").agg(F.max_by(F.struct("y", "copies"), "y").alias("b")).select("x", "b.*")
    return running_max(best, [-F.col("x")], "y").where(F.col("y_before").isNull() | (F.col("y") >= F.col("y_before"))).drop("y_before")
