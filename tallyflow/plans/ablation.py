"""Segment model ablation: the same L1 path, searched over all points and folds, on nine feature sets."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.operators import evaluation as ev
from tallyflow.operators import features as fe
from tallyflow.operators import l1_path as lp
from tallyflow.operators.ordering import numbered
from tallyflow.operators.profile import top_by_property
from tallyflow.operators.splits import stratified
from tallyflow.session import cut_lineage

# Screens of the ablation.
MIN_APP_VARIANCE = 0.09
MIN_MODEL_VARIANCE = 0.0099
MIN_DEVICES, CUTOFF = 100, 0.9
SYSTEM_PARTS = ("google.android",)
SYSTEM_TOKENS = ("sec",)
PROPERTIES = ("carrier_name", "device_model", "device_vendor")


@dataclass(frozen=True)
class Variant:
    name: str
    common_apps: bool = False
    by_name: bool = False
    preinstalled: bool = False
    clean_rows: bool = False
    models: bool = True


VARIANTS = (
    Variant("all apps"),
    Variant("common apps", common_apps=True),
    Variant("common apps, clean rows", common_apps=True, clean_rows=True),
    Variant("common apps, by name", common_apps=True, by_name=True),
    Variant("common apps, by name, clean rows", common_apps=True, by_name=True, clean_rows=True),
    Variant("without preinstalled", preinstalled=True),
    Variant("common apps, without preinstalled", common_apps=True, preinstalled=True),
    Variant("common apps only", common_apps=True, models=False),
    Variant("common apps only, without preinstalled", common_apps=True, preinstalled=True, models=False),
)


def feature_rows(
    v: Variant, installs: DataFrame, people: DataFrame, train_people: DataFrame, key: str, prop: Sequence[str],
    tops: Mapping[str, DataFrame], min_app_variance: float, min_model_variance: float,
) -> DataFrame:
    """(key, feature) of one variant; every screen is learned on the training devices."""
    apps = installs
    if v.by_name:
        tokens = train_people.select(F.explode(F.array(*[F.col(c) for c in (prop[0], prop[-1])])).alias("token"))
        system = tokens.sparkSession.createDataFrame([(x,) for x in SYSTEM_TOKENS], "token string")
        apps = fe.without_name_tokens(apps, "app", tokens.union(system), "token", SYSTEM_PARTS)
    if v.preinstalled:
        for p in prop:
            apps = fe.without_preinstalled(apps, people, key, p, "app", tops[p])
    if v.common_apps:
        kept = fe.varying_names(apps.join(train_people.select(key), key), train_people, key, "app", min_app_variance)
        apps = apps.join(kept.select("app"), "app", "left_semi")
    rows = apps.select(key, F.concat(F.lit("app:"), "app").alias("feature"))
    if v.models:
        model_rows = people.select(key, F.concat(F.lit("model:"), F.col(prop[1])).alias("feature"))
        kept = fe.varying_names(model_rows.join(train_people.select(key), key), train_people, key, "feature", min_model_variance)
        rows = rows.unionByName(model_rows.join(kept.select("feature"), "feature", "left_semi").select(key, "feature"))
    return rows


def sparse_vectors(rows: DataFrame, people: DataFrame, key: str, label: str, clean_rows: bool, folds: int) -> tuple[DataFrame, DataFrame]:
    """Sparse 0/1 rows (label, part, fold, idx, val) and the dictionary (feature, j) of the training devices' features.

    Devices without feature stay unless cleaned. Features are numbered by name in a table that is joined, so no map of
    them is sent about; a feature that only test devices have has no number.
    """
    placed = people.select(key, F.col(label).cast("double").alias("label"), "part")
    rows = cut_lineage(rows.distinct())
    names = rows.join(placed.where("part = 'train'").select(key), key, "left_semi").select("feature").distinct()
    dictionary = cut_lineage(numbered(names, ["feature"], out="j"))
    lists = rows.join(dictionary, "feature").groupBy(key).agg(F.array_sort(F.collect_list(F.col("j").cast("int"))).alias("idx"))
    joined = placed.join(lists, key, "left")
    if clean_rows:
        joined = joined.where(F.col("idx").isNotNull() | (F.col("part") == "test"))
    idx = F.coalesce("idx", F.array().cast("array<int>"))
    ready = joined.select("label", "part", lp.fold_of([key], folds).alias("fold"), idx.alias("idx"), F.transform(idx, lambda _: F.lit(1.0)).alias("val"))
    return cut_lineage(ready), dictionary


def ablation(
    installs: DataFrame,
    people: DataFrame,
    key: str,
    label: str,
    prop: Sequence[str] = PROPERTIES,
    variants: Sequence[Variant] = VARIANTS,
    fit: Callable[[DataFrame, int], lp.L1Path] | None = None,
    folds: int = 4,
    min_devices: int = MIN_DEVICES,
    cutoff: float = CUTOFF,
    min_app_variance: float = MIN_APP_VARIANCE,
    min_model_variance: float = MIN_MODEL_VARIANCE,
    test_share: float = 0.3,
) -> DataFrame:
    """One row per variant: average precision on the stratified test devices and on the training devices, the mean over the
    left-out folds at the chosen point, that point, its kept features, and how many passes over the rows all points and
    folds took together. ``installs`` holds (key, app); devices without label are left out (``usable_people``).
    A variant whose screens no feature passes is the model of the intercept alone, with no features.
    """
    fit = fit or (lambda rows, size: lp.searched_path(rows, size, folds=folds))
    placed = cut_lineage(stratified(people.where(F.col(label).isNotNull()), [key], label, test_share))
    train_people = placed.where("part = 'train'").drop("part")
    installs = cut_lineage(installs.distinct())
    tops = {
        p: cut_lineage(top_by_property(installs.join(train_people.select(key), key), train_people, key, p, "app", min_devices, cutoff))
        for p in prop
    }
    results = []
    for v in variants:
        rows = feature_rows(v, installs, placed, train_people, key, prop, tops, min_app_variance, min_model_variance)
        data, dictionary = sparse_vectors(rows, placed, key, label, v.clean_rows, folds)
        size = dictionary.count()
        train = data.where("part = 'train'").drop("part")
        path = fit(train, size)
        found = [ev.average_precision(path.score(d)).first()["average_precision"] for d in (data.where("part = 'test'"), train)]
        kept = int((path.weights[path.best] != 0).sum())
        cv = path.precision[path.best] if path.precision else None
        results.append((v.name, *found, cv, path.best, size, kept, path.passes))
    schema = "variant string, average_precision double, train_precision double, fold_precision double, point int, features int, kept int, passes int"
    return people.sparkSession.createDataFrame(results, schema)


def usable_people(people: DataFrame, installs: DataFrame, key: str, label: str) -> DataFrame:
    """Devices that have a label and app data."""
    known = fe.usable_rows(people, installs.withColumn("_v", F.lit(1)), key, label, "app", "_v").select(key).distinct()
    return people.join(known, key, "left_semi")
