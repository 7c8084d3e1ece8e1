"""Do two user groups, split by a document pair, engage differently with other documents?"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.functions.mapping import positive_or_zero
from tallyflow.operators.ordering import exact_quantiles
from tallyflow.session import cut_lineage, staged
from tallyflow.sources.readers import sql_job

# Percentiles of the engagement metrics.
LEVELS = {"median": 0.5, "first_third": 0.33, "last_third": 0.67}

RESULT = T.StructType(
    [
        T.StructField("message_type", T.StringType(), True),
        T.StructField("sum", T.LongType(), True),
        T.StructField("count", T.LongType(), False),
        T.StructField("engagement_ratio", T.DoubleType(), True),
    ]
)

RAW_DATA_QUERY = """
    |select device_id, message_type, received, view,
    |       case when time_on_page > 0 then time_on_page else 0 end as time_on_page,
    |       case when scroll_depth > 0 then scroll_depth else 0 end as scroll_depth
    |from {flat}
    |where received = 1 and view > 0 and date >= :from_date"""


def raw_rows(spark: SparkSession, flat: DataFrame, from_date: str) -> DataFrame:
    """Viewed messages since a date, with the metrics clamped at zero."""
    return sql_job(spark, RAW_DATA_QUERY, {"from_date": from_date}, {"flat": flat})


def clamped(df: DataFrame, *metrics: str) -> DataFrame:
    return df.withColumns({m: positive_or_zero(F.col(m)) for m in metrics})


def with_percentiles(rows: DataFrame, metrics: list[str], doc: str = "message_type", exact: bool = True) -> DataFrame:
    """Every row with its document's percentiles of each metric.

    Percentiles are aggregated per document and joined back; a window would hold all rows
    of a popular document in one task. Exact ones read the rows several times a metric, so
    rows and percentiles are staged; a few percentiles then meet the rows without a shuffle.
    """
    out = rows = staged(rows) if exact else rows
    for metric in metrics:
        names = {level: f"{level}_{metric}" for level in LEVELS}
        if exact:
            long = exact_quantiles(rows, metric, list(LEVELS.values()), [doc])
            stats = staged(long.groupBy(doc).agg(
                *[F.max(F.when(F.col("p") == p, F.col("q"))).alias(names[level]) for level, p in LEVELS.items()]
            ))
        else:
            stats = rows.groupBy(doc).agg(
                *[F.percentile_approx(metric, p).alias(names[level]) for level, p in LEVELS.items()]
            )
        out = out.join(stats.withColumnRenamed(doc, "_doc"), F.col(doc).eqNullSafe(F.col("_doc")), "left").drop("_doc")
    return out


def per_user_and_document(rows: DataFrame, metric: str, user: str = "device_id", doc: str = "message_type") -> DataFrame:
    """(user, doc, n, engaged): rows seen, and rows strictly above the document's median."""
    return engagements(rows, [metric], user, doc).withColumnRenamed("engaged_" + metric, "engaged")


def engagements(rows: DataFrame, metrics: Sequence[str], user: str = "device_id", doc: str = "message_type") -> DataFrame:
    """(user, doc, n, engaged_<metric>...): the same counts of several metrics, in one aggregation."""
    above = lambda m: F.when(F.col(m) > F.col("median_" + m), 1).otherwise(0)
    return rows.groupBy(F.col(user).alias("user"), F.col(doc).alias("doc")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(above(m)).alias("engaged_" + m) for m in metrics]
    )


def user_groups(seen: DataFrame, d1: str, d2: str) -> DataFrame:
    """(user, group_no): 1 likes d1 and not d2, 2 the reverse. Never having seen one is not liking it."""
    likes = lambda d: F.max(F.when((F.col("doc") == d) & (F.col("engaged") > 0), 1).otherwise(0))
    return (
        seen.where(F.col("doc").isin(d1, d2))
        .groupBy("user")
        .agg(likes(d1).alias("a"), likes(d2).alias("b"))
        .where(F.col("a") != F.col("b"))
        .select("user", F.when(F.col("a") == 1, 1).otherwise(2).alias("group_no"))
    )


def engaged_ratio(groups: DataFrame, seen: DataFrame, *, excluded: tuple[str, ...] = (), only: str | None = None) -> DataFrame:
    """Rows seen, rows engaged and their ratio per group and document."""
    docs = seen.where(F.col("doc") == only) if only else seen.where(~F.col("doc").isin(*excluded))
    return _ratios(docs.join(groups, "user").groupBy("group_no", F.col("doc").alias("message_type")).agg(
        F.sum("engaged").alias("sum"), F.sum("n").alias("count")
    ))


def _ratios(df: DataFrame) -> DataFrame:
    return df.withColumn("engagement_ratio", F.try_divide(F.col("sum"), F.col("count")))


def document_pairs(seen: DataFrame, max_documents: int = 5_000) -> DataFrame:
    """All unordered document pairs. The document list is one row, its length is checked."""
    return _with_documents(seen.select(F.col("doc").alias("d1")).distinct(), seen, "d2", max_documents).where(
        F.col("d1") < F.col("d2")
    )


def _with_documents(df: DataFrame, seen: DataFrame, name: str, max_documents: int) -> DataFrame:
    listed = seen.select("doc").distinct().agg(F.sort_array(F.collect_list("doc"))).scalar()
    checked = F.when(F.size("_docs") <= max_documents, F.col("_docs")).otherwise(
        F.raise_error(F.lit(f"more than {max_documents} documents: choose the pairs to test"))
    )
    return df.withColumn("_docs", listed).withColumn(name, F.explode(checked)).drop("_docs")


def separation_test(rows: DataFrame, metric: str, user: str = "device_id", doc: str = "message_type", max_documents: int = 5_000) -> DataFrame:
    """Engaged ratio of both groups of every pair on every other document, in one plan.

    Group 1 of (d1, d2) is "likes d1" minus "likes d1 and d2", and sums are additive, so

        count(d1, d2, group 1, d3) = single(d1, d3) - both(d1, d2, d3)

    where ``single`` and ``both`` are sums over the documents one user has seen. Users are
    first merged by what they saw and liked, so equal users are counted once. The rows
    are aggregated to (user, document) once and checkpointed.
    """
    return separation_tests(rows, [metric], user, doc, max_documents)


def separation_tests(rows: DataFrame, metrics: Sequence[str], user: str = "device_id", doc: str = "message_type", max_documents: int = 5_000) -> DataFrame:
    """The separation tests of several metrics; the rows are read and aggregated once for all of them."""
    counts = cut_lineage(engagements(rows, metrics, user, doc))
    tests = [
        _separation(counts.select("user", "doc", "n", F.col("engaged_" + m).alias("engaged")), m, max_documents) for m in metrics
    ]
    return reduce(DataFrame.unionByName, tests)


def _separation(seen: DataFrame, metric: str, max_documents: int) -> DataFrame:
    # documents per user are bounded by the document list
    one = F.struct("doc", "n", "engaged")
    profiles = (
        seen.groupBy("user")
        .agg(F.array_sort(F.collect_list(one)).alias("docs"))
        .groupBy("docs")
        .agg(F.count(F.lit(1)).alias("users"))
        .withColumn("liked", F.transform(F.filter("docs", lambda d: d["engaged"] > 0), lambda d: d["doc"]))
    )
    totals = [F.sum(F.col("s.n") * F.col("users")).alias("n"), F.sum(F.col("s.engaged") * F.col("users")).alias("e")]
    likes = profiles.withColumn("a", F.explode("liked"))
    single = (
        likes.withColumn("s", F.explode("docs")).where(F.col("s.doc") != F.col("a"))
        .groupBy("a", F.col("s.doc").alias("d3")).agg(*totals)
    )
    both = (
        likes.withColumn("b", F.explode(F.filter("liked", lambda x: x > F.col("a"))))
        .withColumn("s", F.explode("docs"))
        .where((F.col("s.doc") != F.col("a")) & (F.col("s.doc") != F.col("b")))
        .groupBy(F.col("a").alias("d1"), F.col("b").alias("d2"), F.col("s.doc").alias("d3"))
        .agg(*totals)
    )
    wide = _with_documents(single, seen, "other", max_documents).where(
        (F.col("other") != F.col("a")) & (F.col("other") != F.col("d3"))
    )
    placed = wide.select(
        F.least("a", "other").alias("d1"),
        F.greatest("a", "other").alias("d2"),
        F.when(F.col("a") < F.col("other"), 1).otherwise(2).alias("group_no"),
        "d3", "n", "e",
    )
    shared = both.select("d1", "d2", "d3", F.col("n").alias("n2"), F.col("e").alias("e2"))
    out = placed.join(shared, ["d1", "d2", "d3"], "left").select(
        "d1", "d2", "group_no",
        F.lit(metric).alias("metric"),
        F.col("d3").alias("message_type"),
        (F.col("e") - F.coalesce("e2", F.lit(0))).alias("sum"),
        (F.col("n") - F.coalesce("n2", F.lit(0))).alias("count"),
    )
    return _ratios(out.where(F.col("count") > 0))
