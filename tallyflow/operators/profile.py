"""Counts, rates, distributions and summaries of table columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.functions.maths import margin_of_error, z_value
from tallyflow.functions.text import tokens
from tallyflow.operators.cleaning import with_group_count
from tallyflow.operators.ordering import exact_quantiles, in_blocks


def value_counts(df: DataFrame, dim: str) -> DataFrame:
    return df.groupBy(dim).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), dim)


def rates_by(df: DataFrame, dim: str, label: str, min_share: float | None = None) -> DataFrame:
    """Rows, positives and rate per value; optionally only values with at least ``min_share`` of all rows."""
    out = df.groupBy(dim).agg(F.count(F.lit(1)).alias("cnt"), F.sum(label).alias("pos"))
    out = out.withColumn("rate", F.try_divide(F.col("pos"), F.col("cnt")))
    if min_share is None:
        return out
    return out.where(F.col("cnt") / df.agg(F.count(F.lit(1))).scalar() >= min_share)


def long_values(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """(column, value) rows of several columns, values as text."""
    pairs = F.array(*[F.struct(F.lit(d).alias("column"), F.col(d).cast("string").alias("value")) for d in dims])
    keep = [c for c in df.columns if c not in dims]
    return df.select(*keep, F.inline(pairs))


def distinct_counts(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """(column, cardinality) of several columns in one pass; null is no value."""
    pairs = long_values(df.select(*dims), dims).where(F.col("value").isNotNull()).distinct()
    return pairs.groupBy("column").agg(F.count(F.lit(1)).alias("cardinality"))


def approximate_distinct_counts(df: DataFrame, dims: Sequence[str], error: float = 0.02) -> DataFrame:
    return df.agg(*[F.approx_count_distinct(d, error).alias(d) for d in dims])


def distinct_values(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    return long_values(df.select(*dims), dims).distinct()


def column_stats(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.sum(column).alias("sum"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("stddev")
    )


def min_observations(df: DataFrame, column: str, alpha: float) -> DataFrame:
    """Whole observations needed for significance level ``alpha``: z^2 s (1 - s) / alpha^2."""
    s = F.stddev_samp(column)
    z = z_value(alpha)
    return df.agg((z * z * s * (1 - s) / (alpha * alpha)).cast("long").alias("min_observations"))


def shares(df: DataFrame, dim: str, within: Sequence[str] = ()) -> DataFrame:
    """Count and share of each value, overall or inside the groups of ``within``."""
    counts = df.where(F.col(dim).isNotNull()).groupBy(*within, dim).agg(F.count(F.lit(1)).alias("cnt"))
    if within:
        total = F.sum("cnt").over(Window.partitionBy(*within))
    else:
        total = counts.agg(F.sum("cnt")).scalar()
    return counts.withColumn("share", F.col("cnt") / total)


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min, quartiles and max per column, quantiles exact."""
    values = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    )
    basic = values.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("stddev"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(values, "value", [0.25, 0.5, 0.75], ["column"])
    wide = quartiles.groupBy("column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))]
    )
    return basic.join(wide, "column", "left")


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls, share) of every column from one aggregate row."""
    total = F.count(F.lit(1))
    one = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.count_if(F.col(c).isNull()).alias("nulls"),
                    F.try_divide(F.count_if(F.col(c).isNull()), total).alias("share"),
                )
                for c in df.columns
            ]
        ).alias("r")
    )
    return one.select(F.inline("r"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form (a, b, r), one pass."""
    one = df.agg(
        F.array(
            *[
                F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"))
                for a, b in combinations(columns, 2)
            ]
        ).alias("r")
    )
    return one.select(F.inline("r"))


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over the column's range, last bin closed; density per group."""
    values = df.where(F.col(column).isNotNull())
    span = values.agg(F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))).scalar()
    binned = values.withColumn("_s", span).withColumn(
        "bin",
        F.when(F.col("_s.hi") > F.col("_s.lo"), F.least(
            F.floor((F.col(column) - F.col("_s.lo")) * bins / (F.col("_s.hi") - F.col("_s.lo"))), F.lit(bins - 1)
        )).otherwise(0).cast("int"),
    )
    counts = binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"), F.max("_s").alias("_s"))
    total = F.sum("n").over(Window.partitionBy(*by))
    width = (F.col("_s.hi") - F.col("_s.lo")) / bins
    return counts.select(*by, "bin", "n", F.try_divide(F.col("n"), total * width).alias("density"))


def weighted_rate(df: DataFrame, label: str, weight: str) -> DataFrame:
    return df.agg(F.try_divide(F.sum(F.col(label) * F.col(weight)), F.sum(weight)).alias("rate"))


def mean_by(df: DataFrame, dim: str, value: str) -> DataFrame:
    return df.groupBy(dim).agg(F.avg(value).alias("mean")).orderBy("mean", dim)


def monthly_mean_of_daily_means(df: DataFrame, ts: str, value: str, every_month: bool = False) -> DataFrame:
    """Mean per day, then mean of the days of each month; empty months on request."""
    daily = df.groupBy(F.to_date(ts).alias("day")).agg(F.avg(value).alias("mean"))
    monthly = daily.groupBy(F.trunc("day", "month").alias("month")).agg(F.avg("mean").alias("mean"))
    if not every_month:
        return monthly
    spine = monthly.agg(F.min("month").alias("a"), F.max("month").alias("b")).select(
        F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("month")
    )
    return spine.join(monthly, "month", "left")


def first_time(df: DataFrame, dims: Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*dims).agg(F.min(ts).alias("first_time"))


def flag_sums(df: DataFrame, dim: str, flags: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(dim).agg(*[F.sum(c).alias(n + "_sum") for n, c in flags.items()])


def token_counts(df: DataFrame, text: str, k: int) -> DataFrame:
    """The ``k`` most frequent tokens over whole texts."""
    return top_k(
        df.select(F.explode(tokens(F.col(text))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("cnt")),
        [F.desc("cnt"), "token"],
        k,
    )


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def gram_counts(
    df: DataFrame, term: str, order: Sequence[str | Column], n: int, group: Sequence[str] = ()
) -> DataFrame:
    """Count of every run of ``n`` consecutive terms of the ordered sequence (per group).

    Runs are read in blocks of positions that overlap by ``n - 1`` rows, so neither the
    whole sequence nor a hot group is one task.
    """
    blocks = in_blocks(df, order, group, reach=n - 1)
    ahead = Window.partitionBy(*group, "_block").orderBy("idx")
    terms = [F.col(term), *[F.lead(term, i).over(ahead) for i in range(1, n)]]
    runs = blocks.select("_own", *[t.alias(f"t{i}") for i, t in enumerate(terms)]).where(
        F.col("_own") & F.col(f"t{n - 1}").isNotNull()
    )
    return runs.groupBy(F.concat_ws(" > ", *[f"t{i}" for i in range(n)]).alias("gram")).agg(F.count(F.lit(1)).alias("cnt"))


def top_by_property(
    installs: DataFrame, properties: DataFrame, key: str, prop: str, name: str, min_devices: int, cutoff: float
) -> DataFrame:
    """(property value, name, share): apps on more than ``cutoff`` of a value's devices.

    Only values with more than ``min_devices`` devices count; both limits are strict.
    """
    sizes = properties.where(F.col(prop).isNotNull()).groupBy(prop).agg(F.count(F.lit(1)).alias("_n"))
    hits = (
        installs.select(key, name).distinct().join(properties.select(key, prop), key)
        .groupBy(prop, name).agg(F.count(F.lit(1)).alias("_k"))
    )
    joined = hits.join(sizes.where(F.col("_n") > min_devices), prop)
    return joined.select(prop, name, (F.col("_k") / F.col("_n")).alias("share")).where(F.col("share") > cutoff)


def rate_variance(df: DataFrame, dims: Sequence[str], label: str) -> DataFrame:
    """Population variance of the rate over each column's values: a screen for features."""
    rates = long_values(df.select(label, *dims), dims).groupBy("column", "value").agg(F.avg(label).alias("rate"))
    return rates.groupBy("column").agg(F.var_pop("rate").alias("rate_variance"), F.count(F.lit(1)).alias("values"))


def categorical_profile(df: DataFrame, dims: Sequence[str], label: str, alpha: float = 0.05) -> DataFrame:
    """Per column and value: count, share, positives, rate and its margin of error."""
    counts = (
        long_values(df.select(label, *dims), dims)
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("cnt"), F.sum(label).alias("pos"))
    )
    total = df.agg(F.count(F.lit(1))).scalar()
    rate = F.try_divide(F.col("pos"), F.col("cnt"))
    return counts.select(
        "column", "value", "cnt", "pos",
        (F.col("cnt") / total).alias("share"),
        rate.alias("rate"),
        margin_of_error(rate, F.col("cnt"), alpha).alias("margin"),
    )


def share_of_value(df: DataFrame, dim: str) -> DataFrame:
    """Rows with their value's share of all rows, the ratio merged onto each row."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return with_group_count(df, [dim], "_n").withColumn(dim + "_ratio", F.col("_n") / total).drop("_n")


def row_totals(long: DataFrame, key: str, value: str) -> DataFrame:
    return long.groupBy(key).agg(F.sum(value).alias("total"))
