"""Short-text marketing classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.text import short_text_features
from tallyflow.operators import models as md
from tallyflow.operators.features import interactions, min_max
from tallyflow.operators.splits import random_split
from tallyflow.session import cut_lineage

FEATURES = (
    "tweet_length", "got_link", "num_of_hashtags", "num_of_user_tags", "exclamation_mark_count",
    "question_mark_count", "num_of_emojis", "got_money_sign",
)


def featured(df: DataFrame, text: str) -> DataFrame:
    """Numeric text features, scaled to [0, 1], and all their pairwise products."""
    made = {n: c.cast("double") for n, c in short_text_features(F.col(text)).items()}
    return interactions(min_max(df.withColumns(made), FEATURES), FEATURES)


def feature_columns() -> list[str]:
    from itertools import combinations

    return [*FEATURES, *[f"{a}_{b}_interaction" for a, b in combinations(FEATURES, 2)]]


def classify(df: DataFrame, key: str, text: str, label: str, estimator=None):
    """(metrics of the hold-out rows, predictions of the unlabelled rows)."""
    ready = md.assembler(feature_columns()).transform(featured(df, text)).select(key, label, "features")
    ready = cut_lineage(ready.withColumnRenamed(label, "label"))
    train, test = random_split(ready.where("label is not null"), [key], [0.7, 0.3])
    model = (estimator or md.RandomForestClassifier(numTrees=20, maxDepth=6, seed=30)).fit(train)
    unlabelled = md.probability(model.transform(ready.where("label is null"))).select(key, "score", "prediction")
    return md.classification_metrics(md.score_rows(model, test)), unlabelled
