"""Latent weights that reconcile a cell table with two marginal tables."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.session import cut_lineage


def marginal_totals(cells: DataFrame, dims: tuple[str, str], measure: str) -> DataFrame:
    """(dim, value, total) of both dimensions from one pass."""
    d0, d1 = dims
    sets = cells.groupingSets([[F.col(d0)], [F.col(d1)]], d0, d1).agg(
        F.grouping(d0).alias("_g"), F.sum(measure).alias("total")
    )
    return sets.select(
        F.when(F.col("_g") == 0, d0).otherwise(d1).alias("dim"),
        F.when(F.col("_g") == 0, F.col(d0).cast("string")).otherwise(F.col(d1).cast("string")).alias("value"),
        "total",
    )


def _rescale(cells: DataFrame, dim: str, other: str, measure: str, weights: DataFrame, target: DataFrame) -> DataFrame:
    """Weights of ``dim`` that meet its targets, given the weights of the other dimension."""
    w = weights.select(F.col("value").alias(other), F.col("weight").alias("_w"))
    reached = cells.join(w, other).groupBy(dim).agg(F.sum(F.col(measure) * F.col("_w")).alias("_r"))
    goal = target.select(F.col("value").alias(dim), F.col("total").alias("_t"))
    return reached.join(goal, dim).select(
        F.col(dim).alias("value"), F.coalesce(F.try_divide("_t", "_r"), F.lit(0.0)).alias("weight")
    )


def fit_weights(
    cells: DataFrame, dims: tuple[str, str], measure: str, targets: DataFrame, tolerance: float = 1e-6, sweeps: int | None = None
) -> DataFrame:
    """(dim, value, weight): non-negative w with sum(w_i w_j cell_ij) equal to both targets.

    Iterative proportional fitting: each half-step is one join and one aggregation. Sweeps end when no
    weight moves by more than ``tolerance`` of itself, or when the moves no longer fall (targets that
    no weights can meet), or after ``sweeps`` if given. ``targets`` holds (dim, value, total), values as text.
    """
    d0, d1 = dims
    table = cut_lineage(
        cells.groupBy(F.col(d0).cast("string").alias(d0), F.col(d1).cast("string").alias(d1)).agg(F.sum(measure).alias(measure))
    )
    goal = {d: targets.where(F.col("dim") == d) for d in dims}
    w1 = table.select(F.col(d1).alias("value")).distinct().withColumn("weight", F.lit(1.0))
    w0 = None
    least, stale = float("inf"), 0
    for sweep in count(1):
        w0 = _rescale(table, d0, d1, measure, w1, goal[d0])
        new = cut_lineage(_rescale(table, d1, d0, measure, w0, goal[d1]))
        change = F.abs(F.try_divide(F.col("weight") - F.col("_was"), F.col("_was")))
        moved = new.join(w1.select("value", F.col("weight").alias("_was")), "value").agg(F.max(change)).first()[0] or 0.0
        w1 = new
        stale = 0 if moved < least * 0.99 else stale + 1
        least = min(least, moved)
        if moved <= tolerance or stale == 3 or sweep == sweeps:
            break
    return w0.select(F.lit(d0).alias("dim"), "*").unionByName(w1.select(F.lit(d1).alias("dim"), "*"))


def fitted_totals(cells: DataFrame, dims: tuple[str, str], measure: str, weights: DataFrame) -> DataFrame:
    """(dim, value, total) of the weighted cells."""
    out = cells
    for d in dims:
        w = weights.where(F.col("dim") == d).select(F.col("value").alias("_v"), F.col("weight").alias("_w_" + d))
        out = out.join(w, F.col(d).cast("string") == F.col("_v")).drop("_v")
    weighted = out.withColumn("_m", F.col(measure) * F.col("_w_" + dims[0]) * F.col("_w_" + dims[1]))
    return marginal_totals(weighted, dims, "_m")


def mismatches(fitted: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows whose rounded fitted total differs from the rounded target, or that have no target or no fit."""
    joined = fitted.withColumnRenamed("total", "got").join(targets.withColumnRenamed("total", "expected"), ["dim", "value"], "full")
    return joined.where(~F.round("got").eqNullSafe(F.round("expected")))


def reconciliation(fitted: DataFrame, targets: DataFrame) -> DataFrame:
    """Per dimension: values compared, rounded mismatches and the largest relative error."""
    joined = fitted.withColumnRenamed("total", "got").join(targets.withColumnRenamed("total", "expected"), ["dim", "value"], "full")
    wrong = ~F.round("got").eqNullSafe(F.round("expected"))
    return joined.groupBy("dim").agg(
        F.count(F.lit(1)).alias("values"),
        F.count_if(wrong).alias("mismatches"),
        F.max(F.abs(F.try_divide(F.col("got") - F.col("expected"), F.col("expected")))).alias("max_error"),
    )
