"""Click-log feature preparation from a column specification."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.operators.features import composites
from tallyflow.operators.ordering import numbered
from tallyflow.operators.splits import with_part
from tallyflow.session import cut_lineage

# Columns of the full click log, by role.
CATEGORICAL = (
    "geo_state", "geo_country", "geo_city", "zip_code", "category_1", "domain", "app_bundle", "publisher_id",
    "device_type", "device_os", "device_os_version", "device_browser", "device_browser_version", "carrier",
    "language", "exchange_id", "banner_type",
)
COMPOSITE = {
    "account_campaign": ("account_id", "campaign_id"),
    "account_banner": ("account_id", "banner_id"),
    "account_advertiser": ("account_id", "advertiser_id"),
    "account_offer": ("account_id", "offer_id"),
}
BINARY = ("is_interstitial", "is_mobile_web_optimized", "is_app")
CYCLICAL = ("user_day_of_week", "user_hour")
# Embedding width up to so many categories, and beyond; parts of the rows.
WIDTHS = ((10, 3), (100, 5))
WIDEST = 10
PARTS = {"train": 0.6, "validation": 0.2, "test": 0.2}


@dataclass
class ClickSpec:
    categorical: Sequence[str] = CATEGORICAL
    composite: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(COMPOSITE))
    binary: Sequence[str] = BINARY
    cyclical: Sequence[str] = CYCLICAL
    label: str = "clicks"
    weight: str = "impressions"


# Dictionary entries that go to every task; a longer dictionary is joined by shuffle.
BROADCAST_ENTRIES = 500_000


def value_numbers(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, idx): the distinct texts of all columns, numbered in order, from one pass over the rows."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    long = rows.select(F.explode(cells).alias("x")).select("x.*").where(F.col("value").isNotNull()).distinct()
    return cut_lineage(numbered(long, ["value"], ["column"]))


def with_composites(rows: DataFrame, spec: ClickSpec) -> DataFrame:
    """Categories as text, nulls as ``unknown``, and the composite ones."""
    filled = rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in spec.categorical})
    return composites(filled, spec.composite)


def category_widths(rows: DataFrame, spec: ClickSpec) -> DataFrame:
    """(column, categories, width): distinct values of each category and its embedding's width."""
    found = value_numbers(with_composites(rows, spec), [*spec.categorical, *spec.composite])
    counts = found.groupBy("column").agg(F.count(F.lit(1)).alias("categories"))
    width = F.lit(WIDEST)
    for most, size in reversed(WIDTHS):
        width = F.when(F.col("categories") <= most, size).otherwise(width)
    return counts.withColumn("width", width)


def parted(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows with their ``part``: train, validation or test, by the digest of ``key``."""
    return with_part(rows, key, list(PARTS), list(PARTS.values()))


def part_rates(rows: DataFrame, spec: ClickSpec, key: Sequence[str]) -> DataFrame:
    """(part, n, rate): rows and the weighted click rate of each part."""
    w = F.col(spec.weight)
    return parted(rows, key).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.try_divide(F.sum(F.col(spec.label) * w), F.sum(w)).alias("rate")
    )


def prepare(rows: DataFrame, spec: ClickSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Dense category ids, 0/1 codes, sine and cosine columns, label and weight.

    All dictionaries and periods come from one pass over the rows and the ends of the two-valued
    columns from another, however many columns there are.
    """
    base = with_composites(rows, spec)
    ids = [*spec.categorical, *spec.composite]
    numbers = value_numbers(base, [*ids, *spec.cyclical])
    sizes = {r["column"]: r["count"] for r in numbers.groupBy("column").count().collect()}
    out = base
    if spec.binary:
        ends = base.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in spec.binary]).first()
        codes = {c: F.when(F.col(c) == F.lit(ends[c]["lo"]), 0).when(F.col(c) == F.lit(ends[c]["hi"]), 1) for c in spec.binary}
        out = out.withColumns(codes)
    for c in spec.cyclical:
        angle = F.col(c) * (2 * math.pi / max(1, sizes.get(c, 0)))
        out = out.withColumns({c + "_sin": F.sin(angle), c + "_cos": F.cos(angle)})
    for c in ids:
        known = numbers.where(F.col("column") == c).select(F.col("value").alias("_v"), F.col("idx").alias("_i"))
        known = F.broadcast(known) if sizes.get(c, 0) <= BROADCAST_ENTRIES else known
        out = out.join(known, F.col(c) == F.col("_v"), "left").withColumn(c, F.col("_i")).drop("_v", "_i")
    waves = [f"{c}_{w}" for c in spec.cyclical for w in ("sin", "cos")]
    return out.select(*keep, *ids, *spec.binary, *waves, spec.label, spec.weight)
