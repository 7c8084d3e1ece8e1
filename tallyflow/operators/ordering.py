"""Exact ranks, running totals and quantiles without a one-task sort.

Every function works in two levels: rows are cut into ordered pieces, the small table
of piece totals is accumulated, and each row then needs only its own piece. A group
that holds a third of all rows is therefore spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of a piece that one task orders, sampled keys for each cut, and most cuts of one split.
PIECE_ROWS = 100_000
SAMPLES = 8
MOST_DEPTH = 13


def _cols(items: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right["_o_" + k]) for k in keys])


def piece_depth(df: DataFrame) -> int:
    """Halvings that bring the rows, which are counted, down to PIECE_ROWS a piece."""
    pieces = -(-df.count() // PIECE_ROWS)
    return min(MOST_DEPTH, max(0, pieces - 1).bit_length())


def with_pieces(df: DataFrame, order: Sequence[str | Column], measures: Sequence[str] = ()) -> DataFrame:
    """Add ``_piece``, an ordered split into as many parts as the number of rows asks for.

    The cut points are every SAMPLES-th of the order keys with the smallest hashes, so the split
    is the same on every run, does not depend on partitioning and may be computed twice. A row
    finds its piece by halving. A small input is one piece. ``measures`` are read along with the
    keys, so that the sample shares the shuffle that aggregated them instead of reading the input again.
    """
    depth = piece_depth(df)
    if not depth:
        return df.withColumn("_piece", F.lit(0))
    cols = _cols(order)
    key = cols[0] if len(cols) == 1 else F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)])
    sampled = (
        df.where(reduce(lambda a, b: a & b, [F.col(m) >= float("-inf") for m in measures], F.lit(True)))
        .select(key.alias("k"))
        .orderBy(F.xxhash64("k"), "k")
        .limit(SAMPLES * 2**depth - 1)
        .agg(F.sort_array(F.collect_list("k")).alias("p"))
    )
    every = F.sequence(F.lit(SAMPLES), F.lit(SAMPLES * (2**depth - 1)), F.lit(SAMPLES))
    points = sampled.select(F.transform(every, lambda i: F.get("p", i - 1)).alias("p")).scalar()
    parts = df.withColumns({"_key": key, "_piece": F.lit(0)})
    for level in reversed(range(depth)):
        half = 2**level
        below = F.get(points, F.col("_piece") + (half - 1)) < F.col("_key")
        parts = parts.withColumn("_piece", F.col("_piece") + F.when(below, half).otherwise(0))
    return parts.drop("_key")


def _with_offsets(parts: DataFrame, totals: dict[str, Column], group: Sequence[str]) -> DataFrame:
    keys = [*group, "_piece"]
    per_piece = parts.groupBy(*keys).agg(*[c.alias("_t_" + n) for n, c in totals.items()])
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_piece.select(
        *[F.col(k).alias("_o_" + k) for k in keys],
        *[F.coalesce(F.sum("_t_" + n).over(before), F.lit(0)).alias("_off_" + n) for n in totals],
    )
    return parts.join(offsets, _same(parts, offsets, keys)).drop(*["_o_" + k for k in keys])


def numbered(
    df: DataFrame,
    order: Sequence[str | Column],
    group: Sequence[str] = (),
    out: str = "idx",
) -> DataFrame:
    """0-based position of each row in its group under a total order."""
    parts = with_pieces(df, order)
    joined = _with_offsets(parts, {"n": F.count(F.lit(1))}, group)
    inside = Window.partitionBy(*group, "_piece").orderBy(*_cols(order))
    return joined.withColumn(
        out, (F.row_number().over(inside) - 1 + F.col("_off_n")).cast("long")
    ).drop("_piece", "_off_n")


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    sums: Sequence[str],
    group: Sequence[str] = (),
) -> DataFrame:
    """Add ``<c>_before``, the sum of ``c`` over all earlier rows, for each column in ``sums``.

    ``df`` holds one row per order key and group, i.e. it is already aggregated.
    """
    parts = with_pieces(df, order, sums)
    joined = _with_offsets(parts, {c: F.sum(c) for c in sums}, group)
    inside = (
        Window.partitionBy(*group, "_piece")
        .orderBy(*_cols(order))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return joined.withColumns(
        {
            c + "_before": F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col("_off_" + c)
            for c in sums
        }
    ).drop("_piece", *["_off_" + c for c in sums])


def running_max(
    df: DataFrame, order: Sequence[str | Column], column: str, group: Sequence[str] = ()
) -> DataFrame:
    """Add ``<column>_before``, the greatest value over all earlier rows; null for the first."""
    keys = [*group, "_piece"]
    parts = with_pieces(df, order)
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy(*keys).agg(F.max(column).alias("_t")).select(
        *[F.col(k).alias("_o_" + k) for k in keys], F.max("_t").over(before).alias("_off")
    )
    inside = Window.partitionBy(*keys).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.join(offsets, _same(parts, offsets, keys))
        .withColumn(column + "_before", F.greatest(F.max(column).over(inside), F.col("_off")))
        .drop("_piece", "_off", *["_o_" + k for k in keys])
    )


def hash_key(*cols: str) -> Column:
    """Hex digest of key columns; a stable pseudo-random order that any engine can repeat.

    One column is digested as its text. Several are told apart by their lengths, and a null from any text.
    """
    texts = [F.col(c).cast("string") for c in cols]
    if len(texts) == 1:
        return F.md5(F.coalesce(texts[0], F.lit("\0")))
    return F.md5(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def numbered_by_hash(df: DataFrame, key: Sequence[str], group: Sequence[str] = (), out: str = "idx") -> DataFrame:
    """0-based position under the hash order; as many hex digits as the number of rows asks for cut the pieces."""
    digits = -(-piece_depth(df) // 4)
    parts = df.withColumn("_h", hash_key(*key)).withColumn("_piece", F.substring("_h", 1, digits))
    joined = _with_offsets(parts, {"n": F.count(F.lit(1))}, group)
    inside = Window.partitionBy(*group, "_piece").orderBy("_h", *key)
    return joined.withColumn(
        out, (F.row_number().over(inside) - 1 + F.col("_off_n")).cast("long")
    ).drop("_piece", "_off_n", "_h")


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], group: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolation quantiles per group: rows ``(group..., p, q)``."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    cumulated = running_totals(counts, [value], ["n"], group)
    totals = counts.groupBy(*[F.col(g).alias("_o_" + g) for g in group]).agg(F.sum("n").alias("_all"))
    if group:
        joined = cumulated.join(totals, _same(cumulated, totals, group))
    else:
        joined = cumulated.withColumn("_all", totals.select("_all").scalar())
    position = lambda p: p * (F.col("_all") - 1)
    inside = lambda i: (i >= F.col("n_before")) & (i < F.col("n_before") + F.col("n"))
    wanted = F.filter(
        F.array(*[F.lit(float(p)) for p in probs]),
        lambda p: inside(F.floor(position(p))) | inside(F.ceil(position(p))),
    )
    hits = joined.withColumn("p", F.explode(wanted)).withColumn("_pos", position(F.col("p")))
    return (
        hits.groupBy(*group, "p")
        .agg(
            F.max(F.when(inside(F.floor("_pos")), F.col(value))).alias("_lo"),
            F.max(F.when(inside(F.ceil("_pos")), F.col(value))).alias("_hi"),
            F.max(F.col("_pos") - F.floor("_pos")).alias("_f"),
        )
        .select(*group, "p", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")).alias("q"))
    )


def in_blocks(
    df: DataFrame, order: Sequence[str | Column], group: Sequence[str], reach: int, size: int = 4096
) -> DataFrame:
    """Rows in blocks of ``size`` positions plus ``reach`` rows of the next block.

    Adds ``idx``, ``_block`` and ``_own``; a window over ``(group, _block)`` then sees
    every neighbour up to ``reach`` rows ahead, and only ``_own`` rows are kept after it.
    """
    positioned = numbered(df, order, group)
    block = F.floor(F.col("idx") / size)
    borrowed = (F.col("idx") % size < reach) & (block > 0)
    return (
        positioned.withColumn("_home", block)
        .withColumn("_block", F.explode(F.when(borrowed, F.array(block, block - 1)).otherwise(F.array(block))))
        .withColumn("_own", F.col("_block") == F.col("_home"))
        .drop("_home")
    )
