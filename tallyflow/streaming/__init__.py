"""Late data. Every job is a bounded batch; the one rule for late rows is a wider batch window."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTCOME_DELAY_DAYS = 2


def with_late_outcomes(outcomes: DataFrame, time: str, start: date, end: date, delay_days: int = OUTCOME_DELAY_DAYS) -> DataFrame:
    """Outcomes in ``[start, end + delay]``: they may arrive after the trial window closed."""
    return outcomes.where((F.col(time) >= F.lit(start)) & (F.col(time) <= F.lit(end + timedelta(days=delay_days))))
