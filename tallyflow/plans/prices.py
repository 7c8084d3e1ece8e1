"""Price time-series regression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.dates import season
from tallyflow.operators import models as md
from tallyflow.operators.cleaning import exclude
from tallyflow.operators.splits import chronological

# Totals and super-regions that are not single regions.
NON_REGIONS = (
    "TotalUS", "West", "California", "GreatLakes", "Northeast", "Midsouth", "SouthCentral", "Southeast", "Plains",
)


def dated(df: DataFrame, day: str) -> DataFrame:
    return df.withColumns(
        {
            "month": F.month(day).cast("string"),
            "day_of_week": F.date_format(day, "EEEE"),
            "year": F.year(day).cast("string"),
            "season": season(F.month(day)),
        }
    )


def split_features(
    df: DataFrame, day: str, key: str, label: str, categorical: Sequence[str], numeric: Sequence[str], region: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Feature rows of the first 80 % of the series and of the rest."""
    rows = exclude(df, region, NON_REGIONS) if region else df
    placed = chronological(dated(rows, day).withColumn("label", F.col(label).cast("double")), [day, key])
    train, test = md.prepare(placed.where("part = 'train'"), [placed.where("part = 'test'")], categorical, numeric)
    return train.select(key, "label", "features"), test.select(key, "label", "features")
