"""Churn horizon models: one label per month of service."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.dates import churned, horizon_label
from tallyflow.operators import models as md
from tallyflow.operators.splits import random_split
from tallyflow.session import cut_lineage


def labelled(df: DataFrame, start: str, end: str, months: Sequence[int] = range(1, 13), horizon_days: int = 365) -> DataFrame:
    """Distinct rows with days of service, churn flag and one label per month."""
    days = F.datediff(end, start)
    labels = {f"month_{m}": horizon_label(days, m) for m in months}
    return df.distinct().withColumns({"days_of_service": days, "churned": churned(F.col(start), F.col(end), horizon_days), **labels})


def horizon_models(rows: DataFrame, key: str, dims: Sequence[str], labels: Sequence[str], make=None) -> DataFrame:
    """(label_name, metrics...) of one model per label on held-out rows."""
    estimator = make or (lambda: md.LogisticRegression(regParam=0.01, maxIter=20))
    parts = random_split(rows, [key], [0.7, 0.3])
    train, test = md.prepare(parts[0], [parts[1]], dims, [])
    keep = ["features", *labels]
    return md.per_label(cut_lineage(train.select(*keep)), cut_lineage(test.select(*keep)), labels, estimator)


