"""Stable samples and splits by hash order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.operators.ordering import hash_key, numbered, numbered_by_hash


def hash_share(*key: str) -> Column:
    """Uniform number in [0, 1) that depends on the key only."""
    return F.conv(F.substring(hash_key(*key), 1, 8), 16, 10).cast("double") / float(2**32)


def random_split(df: DataFrame, key: Sequence[str], shares: Sequence[float]) -> list[DataFrame]:
    """Parts by shares of the hash range; the same row is always in the same part."""
    parts, low = [], 0.0
    for share in shares:
        high = low + share
        parts.append(df.where((hash_share(*key) >= low) & (hash_share(*key) < high)))
        low = high
    return parts


def with_part(df: DataFrame, key: Sequence[str], names: Sequence[str], shares: Sequence[float], out: str = "part") -> DataFrame:
    edge, chain = 0.0, None
    for name, share in zip(names, shares):
        edge += share
        hit = hash_share(*key) < edge
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return df.withColumn(out, chain.otherwise(names[-1]))


def stratified(df: DataFrame, key: Sequence[str], label: str, test_share: float, out: str = "part") -> DataFrame:
    """Exactly the rounded-down test share of every label, by hash order inside the label."""
    sizes = df.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
    placed = numbered_by_hash(df, key, [label]).join(sizes, F.col(label).eqNullSafe(F.col("_l")))
    test = F.col("idx") < F.floor(F.col("_n") * test_share)
    return placed.withColumn(out, F.when(test, "test").otherwise("train")).drop("idx", "_n", "_l")


def chronological(df: DataFrame, order: Sequence[str | Column], train_share: float = 0.8, out: str = "part") -> DataFrame:
    """The first share of the rows in time order trains, the rest tests."""
    total = df.agg(F.count(F.lit(1))).scalar()
    cut = F.floor(total * train_share)
    return numbered(df, order).withColumn(out, F.when(F.col("idx") < cut, "train").otherwise("test")).drop("idx")


def sample_rows(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """Exactly ``n`` rows (or all), uniform by hash order; each task offers its ``n`` smallest hashes."""
    return df.orderBy(hash_key(*key), *key).limit(n)


def balanced(df: DataFrame, key: Sequence[str], label: str, n: int) -> DataFrame:
    """``n`` positive and ``n`` negative rows by hash order; each task offers ``n`` of each."""
    place = F.row_number().over(Window.partitionBy(label).orderBy(hash_key(*key), *key))
    return df.where(F.col(label).isin(0, 1)).withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def labelled_union(negatives: DataFrame, positives: DataFrame, label: str = "label", shuffle_key: Sequence[str] | None = None) -> DataFrame:
    both = negatives.withColumn(label, F.lit(0)).unionByName(positives.withColumn(label, F.lit(1)))
    return both.orderBy(hash_key(*shuffle_key)) if shuffle_key else both
