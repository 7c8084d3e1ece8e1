"""Feature encodings, column screens and installed-app feature rules."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.operators.ordering import numbered


def frequency_dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, idx, n): values numbered by falling frequency, then by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return numbered(counts, [-F.col("n"), "value"])


def sorted_dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, idx): distinct values numbered in their own order."""
    return numbered(df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct(), ["value"])


def with_index(df: DataFrame, column: str, dictionary: DataFrame, out: str, unknown: bool = True) -> DataFrame:
    """Rows with the dictionary number of a value; unknown values get the next free number, or null."""
    known = dictionary.select(F.col("value").alias("_v"), F.col("idx").alias("_i"))
    number = F.coalesce("_i", dictionary.agg(F.count(F.lit(1))).scalar()) if unknown else F.col("_i")
    return df.join(known, df[column] == F.col("_v"), "left").withColumn(out, number).drop("_v", "_i")


def embedding_widths(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, cardinality, width): 3 up to 10 values, 5 up to 100, else 10."""
    from tallyflow.operators.profile import distinct_counts

    n = F.col("cardinality")
    return distinct_counts(df, columns).withColumn("width", F.when(n <= 10, 3).when(n <= 100, 5).otherwise(10))


def one_hot_long(df: DataFrame, key: str, index: str) -> DataFrame:
    """Sparse one-hot in long form: (key, index, 1)."""
    return df.select(key, F.col(index).alias("index"), F.lit(1).alias("value"))


def dummies(df: DataFrame, column: str, values: Sequence[str], prefix: str | None = None) -> DataFrame:
    """A 0/1 column per declared value; the same list serves training and test rows."""
    stem = "" if prefix == "" else (prefix or column) + "_"
    return df.withColumns({f"{stem}{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in values}).drop(column)


def interactions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The product of every unordered column pair."""
    return df.withColumns({f"{a}_{b}_interaction": F.col(a) * F.col(b) for a, b in combinations(columns, 2)})


def composites(df: DataFrame, spec: Mapping[str, Sequence[str]], missing: str = "unknown") -> DataFrame:
    """Joined categoricals, e.g. ``account_campaign`` from account and campaign."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(missing))
    return df.withColumns({name: F.concat_ws("_", *[part(c) for c in parts]) for name, parts in spec.items()})


def binary_codes(df: DataFrame, column: str, out: str, source: DataFrame | None = None) -> DataFrame:
    """0 for the smaller of two values, 1 for the larger; the values come from ``source`` or the rows."""
    ends = (source or df).agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    return df.withColumn("_e", ends).withColumn(
        out, F.when(F.col(column) == F.col("_e.lo"), 0).when(F.col(column) == F.col("_e.hi"), 1)
    ).drop("_e")


def cyclical(df: DataFrame, column: str, source: DataFrame | None = None) -> DataFrame:
    """Sine and cosine with the number of distinct values (of ``source`` or the rows) as period."""
    period = (source or df).agg(F.countDistinct(column)).scalar()
    angle = F.col(column) * (2 * math.pi / period)
    return df.withColumns({column + "_sin": F.sin(angle), column + "_cos": F.cos(angle)})


def hash_index(value: Column, modulo: int) -> Column:
    """A slot from the first digits of the text's digest, as any engine can repeat it."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 8), 16, 10).cast("long") % modulo


def hash_bits(value: Column, modulo: int, bits: int = 8) -> Column:
    return F.lpad(F.bin(hash_index(value, modulo)), bits, "0")


def varying_columns(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """(column, variance) of the columns whose population variance exceeds the threshold."""
    one = df.agg(
        F.array(*[F.struct(F.lit(c).alias("column"), F.var_pop(c).alias("variance")) for c in columns]).alias("r")
    )
    return one.select(F.inline("r")).where(F.col("variance") > threshold)


def varying_names(long: DataFrame, devices: DataFrame, key: str, name: str, threshold: float) -> DataFrame:
    """The same screen for a 0/1 matrix in long form: variance p (1 - p) over all devices."""
    total = devices.agg(F.count(F.lit(1))).scalar()
    p = F.count_distinct(key) / total
    return long.groupBy(name).agg((p * (1 - p)).alias("variance")).where(F.col("variance") > threshold)


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns scaled to [0, 1]; a constant column becomes 0."""
    ends = df.agg(
        F.struct(*[x for c in columns for x in (F.min(c).alias("lo_" + c), F.max(c).alias("hi_" + c))])
    ).scalar()
    scaled = {
        c: F.coalesce(F.try_divide(F.col(c) - F.col(f"_e.lo_{c}"), F.col(f"_e.hi_{c}") - F.col(f"_e.lo_{c}")), F.when(F.col(c).isNotNull(), 0.0))
        for c in columns
    }
    return df.withColumn("_e", ends).withColumns(scaled).drop("_e")


def without_preinstalled(installs: DataFrame, properties: DataFrame, key: str, prop: str, name: str, top: DataFrame) -> DataFrame:
    """Installs without the apps that come with the device's property value (``top`` of the training rows)."""
    placed = installs.join(properties.select(key, prop), key, "left")
    listed = top.select(F.col(prop).alias("_p"), F.col(name).alias("_a"))
    return placed.join(listed, (F.col(prop) == F.col("_p")) & (F.col(name) == F.col("_a")), "left_anti").drop(prop)


def without_name_tokens(installs: DataFrame, name: str, tokens: DataFrame, token: str, parts: Sequence[str] = ()) -> DataFrame:
    """Installs whose package name has no dotted part among the tokens, and none of the substrings."""
    names = installs.select(name).distinct()
    parted = names.select(name, F.explode(F.split(name, r"\.")).alias("_t"))
    banned = parted.join(tokens.select(F.col(token).alias("_t")).distinct(), "_t", "left_semi").select(name).distinct()
    kept = installs.join(banned, name, "left_anti")
    return kept.where(reduce(lambda a, b: a & b, [~F.col(name).contains(p) for p in parts])) if parts else kept


def usable_rows(labels: DataFrame, installs: DataFrame, key: str, label: str, name: str, value: str) -> DataFrame:
    """Labelled devices with app data: (key, label, name, value), all-zero apps and devices left out."""
    return (
        installs.where(F.col(value) > 0)
        .join(labels.where(F.col(label).isNotNull()).select(key, label), key)
        .select(key, label, name, value)
    )
