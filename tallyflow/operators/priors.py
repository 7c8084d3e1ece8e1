"""Beta-binomial priors of sibling groups by the digamma fixed point."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The fit travels to the tasks by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Start, stopping rule and iteration limit of the fixed point.
START = 0.5
TOLERANCE = 1e-3
MAX_ITERATIONS = 900

def _same(parent: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col("_k_" + p)) for p in parent])


def eligible_children(nodes: DataFrame, parent: Sequence[str], child: str, min_trials: float, min_children: int = 5) -> DataFrame:
    """Children with more than ``min_trials`` trials whose parent has more than ``min_children`` distinct ones."""
    busy = nodes.where(F.col("trial") > min_trials)
    distinct = busy.select(*parent, child).distinct()
    sizes = distinct.groupBy(*[F.col(p).alias("_k_" + p) for p in parent]).agg(F.count(F.lit(1)).alias("num_types"))
    if parent:
        wide = busy.join(sizes, _same(parent)).drop(*["_k_" + p for p in parent])
    else:
        wide = busy.withColumn("num_types", sizes.scalar())
    return wide.where(F.col("num_types") > min_children)


def _psi(x: np.ndarray) -> np.ndarray:
    shift = sum(1.0 / (x + i) for i in range(6))
    y = x + 6.0
    inv2 = 1.0 / (y * y)
    tail = inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 * (1 / 240 - inv2 / 132))))
    return np.log(y) - 0.5 / y - tail - shift


def fit_beta(trial: np.ndarray, success: np.ndarray) -> tuple[float, float, int]:
    """(alpha, beta, iterations); a parameter that reaches 0 stays 0."""
    return _fit([np.unique(x, return_counts=True) for x in (trial, success, trial - success)])


def _fit(counted: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[float, float, int]:
    """The fixed point from how often each number of trials, successes and failures occurs."""
    (n, n_times), (s, s_times), (f, f_times) = counted
    gain = lambda values, times, at: np.sum(times * (_psi(values + at) - _psi(np.array(at))))
    a = b = START
    for step in range(1, MAX_ITERATIONS + 2):
        bottom = gain(n, n_times, a + b)
        if not bottom > 0:
            break
        new_a = a * gain(s, s_times, a) / bottom if a > 0 else a
        new_b = b * gain(f, f_times, b) / bottom if b > 0 else b
        done = abs(a - new_a) < TOLERANCE and abs(b - new_b) < TOLERANCE
        a, b = float(new_a), float(new_b)
        if done or a + b <= 0:
            break
    return a, b, step


def beta_priors(children: DataFrame, parent: Sequence[str]) -> DataFrame:
    """(parent..., alpha, beta, n_iter) fitted to the (trial, success) pairs of each parent's children.

    The fit needs only how many children have each number of trials, of successes and of
    failures. These are counted before the fit, so a parent's task holds its different numbers and not
    its children: with whole numbers that is at most the root of twice its trials, three times.
    """
    schema = ",".join([f"`{f.name}` {f.dataType.simpleString()}" for f in children.select(*parent).schema] + ["alpha double", "beta double", "n_iter int"])
    number = F.explode(F.array(*[
        F.struct(F.lit(k).alias("_kind"), v.cast("double").alias("_value"))
        for k, v in enumerate((F.col("trial"), F.col("success"), F.col("trial") - F.col("success")))
    ])).alias("_x")
    counted = children.select(*parent, number).select(*parent, "_x.*").groupBy(*parent, "_kind", "_value").agg(F.count(F.lit(1)).alias("_n"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_value")
        kinds = [pdf[pdf["_kind"] == k] for k in range(3)]
        a, b, steps = _fit([(k["_value"].to_numpy(float), k["_n"].to_numpy(float)) for k in kinds])
        return pdf[list(parent)].iloc[:1].assign(alpha=a, beta=b, n_iter=steps)

    return counted.groupBy(*parent).applyInPandas(fit, schema)


def fixed_prior(children: DataFrame, parent: Sequence[str], alpha: float, beta: float) -> DataFrame:
    return children.select(*parent).distinct().withColumns({"alpha": F.lit(alpha), "beta": F.lit(beta), "n_iter": F.lit(0)})
