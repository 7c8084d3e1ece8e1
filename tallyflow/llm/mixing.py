"""Sources mixed to target weights by systematic sampling. DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.tables import staged, text_or_empty, whole_row

PIECE_ROWS = 20_000


def word_count(text: str = "text") -> Column:
    """Words of a text. Each shrinks to its first character, and these are counted: no word becomes a row of its own in memory."""
    firsts = F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]*+([^\x20\x09-\x0D])[^\x20\x09-\x0D]*+|[\x20\x09-\x0D]++$", "$1")
    return F.char_length(firsts).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2
) -> DataFrame:
    """(source, source_size, target): shares of ``share`` times all sizes, by weight.

    Sources in code point order, null last, take ``weights`` in turn. No target exceeds ``most``
    times its source's size; the excess goes to the others by weight until none is above. That
    fixed point is found in one pass: in order of limit per weight, a source is full if its limit
    is at most its part of what the sources before it leave. One row per source enters the windows.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    order = F.row_number().over(by_name) - 1
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (order % len(weights) + 1).cast("int"))
    rows = totals.withColumn("_w", turn).withColumn("_limit", F.col("source_size") * most)
    by_limit = Window.orderBy(F.col("_limit") / F.col("_w"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(0))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.sum("source_size").over(all_rows) * F.lit(float(share))
    rows = rows.withColumn("_budget", budget).withColumn(
        "_full",
        F.col("_limit") * F.sum("_w").over(after)
        <= (F.col("_budget") - F.coalesce(F.sum("_limit").over(before), F.lit(0))) * F.col("_w"),
    )
    left = F.col("_budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_limit"))).over(all_rows), F.lit(0))
    open_weight = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(all_rows)
    return rows.withColumn(
        "target", F.when(F.col("_full"), F.col("_limit").cast("double")).otherwise(left * F.col("_w") / open_weight)
    ).select("source", "source_size", "target")


def with_copies(
    docs: DataFrame,
    id: str = "doc_id",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: int = 17,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Every row with ``source_size``, ``target`` and ``copies``: how often the mix takes it.

    Needs ``source`` and ``size`` (long, 0 or more). Each document of a source expects
    target / source_size copies. Their prefix sums, in order of size class and then digest of the
    id, start at a random offset per source; a document is taken once for each integer that its
    step crosses, so never more than ``most`` times and each size class in proportion. The
    offset and the order depend on ``seed`` only: reruns agree.

    The prefix sum has two levels. Pieces of a source (a size class, or parts of a large one, as
    many as its count asks for) are counted and summed up; inside a piece rows are numbered. No
    task holds a whole source. The input, which should be narrow, is written once for these steps. Null ids and null sources are values like others, repeated rows
    are documents of their own, a source without words takes no words. Columns ``source_size``,
    ``target`` and ``copies`` of the input are replaced; names that begin with ``_`` are for helpers.
    """
    docs = staged(docs.drop("source_size", "target", "copies"))
    bits = F.length(F.bin("size"))
    drop = F.greatest(bits - 4, F.lit(0))
    shifted = F.call_function("shiftright", F.col("size"), drop)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))))
    rows = docs.withColumns({"_class": bits * 16 + shifted, "_key": key})
    totals = source_targets(docs.select("source", "size"), weights, share, most).withColumnRenamed("source", "_s")
    classes = rows.groupBy(F.col("source").alias("_cs"), F.col("_class").alias("_cc")).agg(
        F.ceil(F.count(F.lit(1)) / piece_rows).alias("_parts")
    )
    rows = rows.join(
        classes, F.col("source").eqNullSafe(F.col("_cs")) & (F.col("_class") == F.col("_cc")), "left"
    ).drop("_cs", "_cc")
    part = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") % F.col("_parts")
    rows = rows.withColumn("_part", part).drop("_parts")
    pieces = rows.groupBy(
        F.col("source").alias("_ps"), F.col("_class").alias("_pc"), F.col("_part").alias("_pp")
    ).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_ps").orderBy("_pc", "_pp").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    rows = rows.join(
        pieces,
        F.col("source").eqNullSafe(F.col("_ps")) & (F.col("_class") == F.col("_pc")) & (F.col("_part") == F.col("_pp")),
        "left",
    ).drop("_ps", "_pc", "_pp")
    inside = Window.partitionBy("source", "_class", "_part").orderBy("_key", F.col(id), "size")
    rows = rows.withColumn("_rank", F.col("_before") + F.row_number().over(inside))
    rows = rows.join(totals, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    digest = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))))
    offset = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(offset + step * F.col("_rank")) - F.floor(offset + step * (F.col("_rank") - 1))
    copies = F.least(crossed, F.lit(most).cast("long")).cast("long")
    return rows.withColumn("copies", copies).drop("_class", "_key", "_part", "_before", "_rank")


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mix itself: every document as many times as it is taken, columns as before.

    Copies are decided on narrow rows and meet the documents again by a digest of the whole row,
    so the texts move once. Rows that agree in every column are numbered to share their copies.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(whole_row(docs), F.xxhash64(*columns).alias("_a"), F.hash(*columns).alias("_b"))
    narrow = docs.select(
        F.col(id).alias("_id"), F.col("source"), word_count(text).alias("size"), F.xxhash64(*columns).alias("_a"),
        F.hash(*columns).alias("_b"),
    )
    copies = (
        with_copies(narrow, "_id", **options)
        .groupBy("_a", "_b")
        .agg(F.array_sort(F.collect_list("copies")).alias("_copies"))
        .where(F.array_max("_copies") > 0)
    )
    number = F.row_number().over(Window.partitionBy("_a", "_b").orderBy("_a"))
    taken = rows.join(copies, ["_a", "_b"]).withColumn("_n", F.element_at("_copies", number))
    again = F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int"))).alias("_again")
    return taken.where(F.col("_n") > 0).select("_row", again).select("_row.*")
