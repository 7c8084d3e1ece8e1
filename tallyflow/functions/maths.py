"""Numeric expressions."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

TIGHT_EPS = 1e-14
LOOSE_EPS = 1e-10


def log_loss(p: Column, y: Column, eps: float = TIGHT_EPS) -> Column:
    """Logarithmic loss of probability ``p`` given label ``y``, with ``p`` kept off 0 and 1."""
    bounded = F.greatest(F.least(p, F.lit(1.0 - eps)), F.lit(eps))
    return F.when(y == 1, -F.log(bounded)).otherwise(-F.log(1 - bounded))


def z_value(alpha: float) -> float:
    return NormalDist().inv_cdf(1 - alpha / 2)


def margin_of_error(rate: Column, n: Column, alpha: float = 0.05) -> Column:
    return F.try_divide(F.sqrt(rate * (1 - rate)) * F.lit(z_value(alpha)), F.sqrt(n))


def log_factorial(n: Column) -> Column:
    """ln n!: exact product up to 20, Stirling's series beyond (error below 1e-13)."""
    x = F.greatest(n, F.lit(21)).cast("double")
    series = (
        x * F.log(x) - x + 0.5 * F.log(x * (2 * math.pi))
        + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3))) + 1 / (1260 * F.pow(x, F.lit(5)))
    )
    small = F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))
    return F.when(n <= 20, small).otherwise(series)


def binomial_likelihood(theta: Column, n: Column, x: Column) -> Column:
    """Probability of ``x`` successes in ``n`` draws; computed on the log scale."""
    choose = log_factorial(n) - log_factorial(x) - log_factorial(n - x)
    power = lambda base, e: F.when(e == 0, F.lit(0.0)).otherwise(e * F.log(base))
    impossible = ((theta <= 0) & (x > 0)) | ((theta >= 1) & (x < n))
    return F.when(impossible, F.lit(0.0)).otherwise(F.exp(choose + power(theta, x) + power(1 - theta, n - x)))


def smoothing_weight(gamma: float, day: Column, last_day: Column) -> Column:
    """Exponential weight of a day: gamma * (1 - gamma) ** lag."""
    return gamma * F.pow(F.lit(1.0 - gamma), F.datediff(last_day, day))


def posterior_mean(trial: Column, success: Column, alpha: Column, beta: Column) -> Column:
    return F.try_divide(success + alpha, trial + alpha + beta)


def beta_mean(alpha: Column, beta: Column) -> Column:
    return F.try_divide(alpha, alpha + beta)


def beta_variance(alpha: Column, beta: Column) -> Column:
    total = alpha + beta
    return F.try_divide(alpha * beta, total * total * (total + 1))


def squared_error(p: Column, y: Column) -> Column:
    return F.pow(y - p, F.lit(2))


def digamma(x: Column) -> Column:
    """Digamma for x > 0: six recurrence steps, then the asymptotic series."""
    shifted = x + 6
    recurrence = sum((1 / (x + i) for i in range(1, 6)), 1 / x)
    inv2 = 1 / (shifted * shifted)
    tail = inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 * (1 / 240 - inv2 * (1 / 132)))))
    return F.log(shifted) - 0.5 / shifted - tail - recurrence
