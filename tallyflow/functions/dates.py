"""Date and time expressions. Day 0 of a week is Monday."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def weekday_and_hour(text: Column) -> tuple[Column, Column]:
    """(weekday, hour) of a timestamp text; null for empty or unreadable text."""
    ts = F.try_to_timestamp(blank_to_null(text))
    return F.weekday(ts), F.hour(ts)


def epoch_millis(text: Column) -> Column:
    """Epoch milliseconds at whole seconds; null for bad text."""
    return F.unix_seconds(F.try_to_timestamp(text)) * 1000


def date_text(text: Column) -> Column:
    """``yyyy-MM-dd`` of a timestamp text; empty text stays empty."""
    return F.when(text == "", "").otherwise(
        F.date_format(F.try_to_timestamp(blank_to_null(text)), "yyyy-MM-dd")
    )


def hour_spine(spark: SparkSession, first: int = 0, stop: int = 24) -> DataFrame:
    """Calendar dimension of hours with their two-digit labels."""
    return spark.range(first, stop).select(
        F.col("id").cast("int").alias("hour"), hour_label(F.col("id")).alias("hour_label")
    )


def hour_label(hour: Column) -> Column:
    return F.lpad(hour.cast("string"), 2, "0")


def weekday_spine(spark: SparkSession) -> DataFrame:
    return spark.range(7).select(F.col("id").cast("int").alias("weekday"))


def days_back(as_of: Column, days: int) -> Column:
    return F.date_sub(as_of, days)


def training_window(end: Column | None, days: int, as_of: Column, lag: int = 4) -> tuple[Column, Column]:
    """(start, end) of a window of ``days``; a missing end lies ``lag`` days before ``as_of``."""
    last = F.coalesce(end, F.date_sub(as_of, lag)) if end is not None else F.date_sub(as_of, lag)
    return F.date_sub(last, days), last


def zone_time(utc: Column, zone: str) -> Column:
    """Wall clock of a UTC instant in a zone."""
    return F.from_utc_timestamp(utc, zone)


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "hour": F.hour(ts),
        "month": F.month(ts),
        "day_name": F.date_format(ts, "EEEE"),
        "hour_minute": F.hour(ts) * 100 + F.minute(ts),
        "epoch_micros": F.unix_micros(ts.cast("timestamp")),
        "weekday": F.weekday(ts),
    }


def season(month: Column) -> Column:
    return (
        F.when(month.between(3, 5), "Spring")
        .when(month.between(6, 8), "Summer")
        .when(month.between(9, 11), "Autumn")
        .otherwise("Winter")
    )


def churned(start: Column, end: Column, horizon_days: int = 365) -> Column:
    return F.when(F.datediff(end, start) < horizon_days, 1).otherwise(0)


def horizon_label(days: Column, month: int) -> Column:
    """1 when the service ended within ``month`` months of 30.4 days."""
    return F.when(F.bround(days / F.lit(30.4), 0) + 1 <= month, 1).otherwise(0)
