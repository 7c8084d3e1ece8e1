"""Alert grouping: enrichment, frequent runs, host and type buckets, k-means groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.dates import calendar_parts
from tallyflow.functions.text import has_any_com, keyword_flags, without_digits
from tallyflow.operators.clustering import cluster_numbers, k_means, k_means_sweep, string_exemplars
from tallyflow.operators.profile import first_time, gram_counts, top_k
from tallyflow.session import cut_lineage

# Alert keywords and the tried group numbers.
KEYWORDS = ("ping", "load", "sql", "memcach", "storage", "cpu")
TRIED_GROUPS = (5, 10, 15, 20, 30, 40, 50, 60, 80, 90, 100)


def enriched(alerts: DataFrame) -> DataFrame:
    """Alerts (time, host, type) with calendar parts, keyword flags and combined names."""
    parts = calendar_parts(F.col("time"))
    host = without_digits(F.col("host"))
    return alerts.withColumns(
        {
            "date": F.to_date("time"),
            "hour": parts["hour"],
            "day_of_week": parts["day_name"],
            "hour_minute": parts["hour_minute"],
            "timestamp": parts["epoch_micros"],
            "is_ending_with_com": has_any_com(F.col("host")),
            "host_no_numbers": host,
            **keyword_flags(F.col("type"), KEYWORDS),
            "host_type_combined": F.concat_ws("_", host, F.col("type")),
        }
    )


def frequent_runs(alerts: DataFrame, n: int = 6, k: int = 10) -> DataFrame:
    """The most frequent runs of ``n`` first alerts per hour, in time order."""
    first = first_time(enriched(alerts), ["date", "hour", "host_no_numbers", "type", "host_type_combined"], "time")
    runs = gram_counts(first, "host_type_combined", ["date", "hour", "first_time", "host_type_combined"], n)
    return top_k(runs, [F.desc("cnt"), "gram"], k)


def with_buckets(rows: DataFrame, column: str, out: str, distance: int = 2) -> DataFrame:
    """Rows with the number of their string bucket: names of one exemplar."""
    clusters = cluster_numbers(string_exemplars(rows.select(column), column, distance))
    return rows.join(clusters.select(F.col("vertex").alias(column), F.col("cluster_id").alias(out)), column)


def bucketed(alerts: DataFrame, distance: int = 2) -> DataFrame:
    """Enriched alerts with their host, type and combined buckets."""
    rows = with_buckets(enriched(alerts), "host_no_numbers", "host_cluster_id", distance)
    rows = with_buckets(rows, "type", "alert_cluster_id", distance)
    return cut_lineage(with_buckets(rows, "host_type_combined", "combined_cluster_id", distance))


GROUPED_BY = ["host_cluster_id", "alert_cluster_id", "timestamp"]


def grouped(alerts: DataFrame, k: int = 60, seed: int = 1, distance: int = 2) -> DataFrame:
    """Alerts with host, type and combined bucket, and with their group of ``k``."""
    return k_means(bucketed(alerts, distance), GROUPED_BY, k, seed)


def group_sweep(alerts: DataFrame, ks=TRIED_GROUPS, seed: int = 1, distance: int = 2) -> DataFrame:
    """(tried, k, calinski_harabasz) of each tried number of groups."""
    return k_means_sweep(bucketed(alerts, distance), GROUPED_BY, ks, seed)
