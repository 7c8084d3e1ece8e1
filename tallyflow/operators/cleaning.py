"""Row filters, deduplication, null handling and minority bucketing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(items: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def of_kind(df: DataFrame, kinds: str | Sequence[str], column: str = "event") -> DataFrame:
    return df.where(F.col(column) == kinds) if isinstance(kinds, str) else df.where(F.col(column).isin(*kinds))


def between(df: DataFrame, column: str, start, end, closed: bool = True) -> DataFrame:
    upper = F.col(column) <= end if closed else F.col(column) < end
    return df.where((F.col(column) >= start) & upper)


def without_tests(df: DataFrame, flag: Column) -> DataFrame:
    """Keep rows whose test flag is exactly false; a missing flag drops the row."""
    return df.where(flag == F.lit(False))


def having(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [c.isNotNull() for c in _cols(columns)]))


def mentions_any(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first under a declared order.

    An aggregate, not a window: each task keeps one row per key before the shuffle,
    so a key with very many copies costs nothing extra.
    """
    rest = [c for c in df.columns if c not in keys]
    key_order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_cols(order))])
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), key_order).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def exclude(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Drop listed values; null stays, as it does in a frame comparison."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(*values))


def within_sigmas(df: DataFrame, columns: Sequence[str], limit: float = 3) -> DataFrame:
    """Rows whose population z-score is below ``limit`` in every column."""
    stats = df.agg(
        F.struct(*[x for c in columns for x in (F.avg(c).alias("m_" + c), F.stddev_pop(c).alias("s_" + c))]).alias("s")
    ).scalar()
    scored = df.withColumn("_s", stats)
    tests = [
        F.abs(F.try_divide(F.col(c) - F.col(f"_s.m_{c}"), F.col(f"_s.s_{c}"))) < limit for c in columns
    ]
    return scored.where(reduce(lambda a, b: a & b, tests)).drop("_s")


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def fill_strings(df: DataFrame, value: str = "unset") -> DataFrame:
    return df.na.fill(value)


def reshape(
    df: DataFrame,
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
    zeros: Sequence[str] = (),
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Rename, drop, add zero-filled columns and reorder."""
    out = df.withColumnsRenamed(dict(rename or {})).drop(*drop)
    out = out.withColumns({c: F.lit(0) for c in zeros}) if zeros else out
    return out.select(*order) if order else out


def with_group_count(df: DataFrame, keys: Sequence[str], out: str = "count", source: DataFrame | None = None) -> DataFrame:
    """Rows with the size of their group (in ``source`` or the rows), by aggregate and join.

    A window would gather a hot group in one task; the join lets the engine split it.
    """
    sizes = (source or df).groupBy(*[F.col(k).alias("_g_" + k) for k in keys]).agg(F.count(F.lit(1)).alias(out))
    on = reduce(lambda a, b: a & b, [df[k].eqNullSafe(sizes["_g_" + k]) for k in keys])
    return df.join(sizes, on).drop(*["_g_" + k for k in keys])


def minority_by_count(df: DataFrame, column: str, threshold: int, label: str = "MinorityCategory") -> DataFrame:
    """Replace values seen fewer than ``threshold`` times; a null category drops, as in an inner join."""
    counted = with_group_count(df.where(F.col(column).isNotNull()), [column], "_n")
    return counted.withColumn(column, F.when(F.col("_n") < threshold, label).otherwise(F.col(column))).drop("_n")


def minority_by_share(df: DataFrame, columns: Sequence[str], share: float = 0.005, label: str = "minority") -> DataFrame:
    """Replace values with at most ``share`` of all rows; null stays.

    One aggregation counts the values of all columns. Fewer than 1 / ``share`` values of a column can
    have more, so these go to the rows as one short list per column, without a join.
    """
    if share <= 0:
        return df.withColumns({c: F.col(c).cast("string") for c in columns})
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("string").alias("v")) for k, c in enumerate(columns)]))
    counts = df.select(cells.alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    frequent = counts.where((F.col("n") / total > share) & F.col("x.v").isNotNull())
    lists = frequent.agg(F.array(*[F.collect_list(F.when(F.col("x.k") == k, F.col("x.v"))) for k in range(len(columns))])).scalar()
    rows = df.withColumn("_lists", lists)
    kept = {
        c: F.when(F.col(c).isNotNull() & ~F.array_contains(F.col("_lists")[k], F.col(c).cast("string")), label).otherwise(F.col(c).cast("string"))
        for k, c in enumerate(columns)
    }
    return rows.withColumns(kept).drop("_lists")


def above_threshold(df: DataFrame, column: str, threshold: int) -> DataFrame:
    """Rows whose value of ``column`` occurs more than ``threshold`` times; only these values meet the rows."""
    sizes = df.groupBy(F.col(column).alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    return df.join(greater_than(sizes, "_n", threshold), df[column].eqNullSafe(sizes["_g"]), "left_semi")


def greater_than(df: DataFrame, column: str, minimum: float) -> DataFrame:
    return df.where(F.col(column) > minimum)
