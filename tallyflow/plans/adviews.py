"""Ad-view and routing prediction: cleaned categoricals, filtered numbers, classifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.operators import models as md
from tallyflow.operators.cleaning import drop_nulls, fill, minority_by_share, within_sigmas
from tallyflow.operators.splits import random_split

# Fills of the routing table.
ROUTING_FILLS = {
    "nluanger": 0.0, "nludisgust": 0.0, "nlufear": 0.0, "nlujoy": 0.0, "nlusadness": 0.0, "nlusentiment": 0.0,
    "customer_program_name": "free",
}


def cleaned(
    df: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    required: Sequence[str] = (),
    fills: Mapping[str, object] | None = None,
    sigmas: float | None = None,
    share: float = 0.005,
) -> DataFrame:
    """Required columns present, nulls filled, rare categories merged, outliers dropped."""
    out = drop_nulls(df, required) if required else df
    out = fill(out, fills) if fills else out
    out = minority_by_share(out, categorical, share)
    return within_sigmas(out, numeric, sigmas) if sigmas else out


def split_features(df: DataFrame, key: str, label: str, categorical: Sequence[str], numeric: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    rows = df.withColumn("label", F.col(label).cast("double"))
    parts = random_split(rows, [key], [0.7, 0.3])
    train, test = md.prepare(parts[0], [parts[1]], categorical, numeric)
    return train.select(key, "label", "features"), test.select(key, "label", "features")


def compare(train: DataFrame, test: DataFrame, models: Mapping[str, object]) -> DataFrame:
    """(model, metrics...) of fitted models on the test rows."""
    found = []
    for name, estimator in models.items():
        fitted = estimator.fit(train)
        found.append({"model": name, **md.classification_metrics(md.score_rows(fitted, test)).first().asDict()})
    return md.metric_rows(train.sparkSession, found, "model")
