"""Interest-segment dataset: interaction scores, questionnaire answers and enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.scoring import event_score, interest_score
from tallyflow.operators.cleaning import first_per_key, mentions_any

# The log rows that count, and the carriers asked.
CONTENT_KINDS = (
    "contentitem_received",
    "contentitem_view",
    "contentitem_click",
    "contentitem_timeonpage",
    "contentitem_pagescroll",
)
ANSWER_KIND = "timeline_onboardingmessage_click"
CARRIERS = ("sprint", "verizon")
FEATURE_WORDS = ("camera", "video")
ATTRIBUTES = {
    "carrier_name": "carriername",
    "device_model": "devicemodel",
    "device_model_name": "devicemodelname",
    "device_os_type": "deviceostype",
    "device_vendor": "devicevendor",
}
PAYLOAD = (
    "properties struct<istest:string,deviceid:string,messagetype:string,actionid:string,"
    "atlasuniqueuserid:string,devicefeatures_attribute:string,scrolldepth:string,timeonpage:double,"
    "feedbackvalue:boolean,selecteditems:array<string>>"
)


def parsed(events: DataFrame, kinds: Sequence[str], carriers: Sequence[str] = CARRIERS) -> DataFrame:
    """Rows of the wanted kinds and carriers, payload parsed once, test traffic dropped."""
    p = F.from_json("properties", PAYLOAD).getField("properties")
    return (
        events.where(F.col("event").isin(*kinds) & F.col("carriername").isin(*carriers))
        .withColumn("p", p)
        .where((F.col("p.istest") == "false") & F.col("p.deviceid").isNotNull())
    )


def content_scores(
    events: DataFrame, words: DataFrame, since, carriers: Sequence[str] = CARRIERS, feature_words: Sequence[str] = FEATURE_WORDS
) -> DataFrame:
    """Best score per device, event kind, topic and action.

    ``words`` holds (message_type, word_count). Repeats keep their maximum, because scroll
    events send intermediate states.
    """
    rows = parsed(events.where(F.col("time") > F.lit(since)), CONTENT_KINDS, carriers).where(
        F.col("p.messagetype").isNotNull()
        & F.col("p.devicefeatures_attribute").isNotNull()
        & mentions_any(F.col("p.devicefeatures_attribute"), feature_words)
    )
    counted = rows.join(
        words.select(F.lower("message_type").alias("_topic"), "word_count"),
        F.lower("p.messagetype") == F.col("_topic"),
        "left",
    )
    score = event_score(
        F.col("event"), F.col("p.scrolldepth"), F.col("p.timeonpage"), F.col("word_count"),
        F.col("p.actionid"), F.col("p.feedbackvalue"), F.col("p.selecteditems"),
    )
    return counted.groupBy(
        F.col("p.deviceid").alias("device_id"),
        "event",
        F.col("p.messagetype").alias("topic"),
        F.col("p.actionid").alias("action"),
    ).agg(
        F.max("p.atlasuniqueuserid").alias("user_id"),
        *[F.max(raw).alias(name) for name, raw in ATTRIBUTES.items()],
        F.max(score).alias("score"),
    )


def receive_counts(scores: DataFrame) -> DataFrame:
    """Received notifications per device, at least as many as were viewed."""
    return (
        scores.groupBy("device_id")
        .pivot("event", ["contentitem_received", "contentitem_view"])
        .sum("score")
        .na.fill(0.0)
        .select("device_id", F.greatest("contentitem_received", "contentitem_view").alias("receive"))
    )


def device_scores(scores: DataFrame) -> DataFrame:
    """Rounded score per received notification, from one aggregation per device."""
    acted = F.col("event") != "contentitem_received"
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("event") == kind, F.col("score"))), F.lit(0.0))
    return (
        scores.groupBy("device_id")
        .agg(
            *[F.max(F.when(acted, F.col(c))).alias(c) for c in ("user_id", *ATTRIBUTES)],
            F.sum(F.when(acted, F.col("score"))).alias("_total"),
            F.greatest(of("contentitem_received"), of("contentitem_view")).alias("_receive"),
            F.max(acted).alias("_any"),
        )
        .where("_any")
        .select(
            "device_id", "user_id", *ATTRIBUTES,
            F.round(F.try_divide("_total", "_receive")).alias("score"),
            F.lit(None).cast("double").alias("interest"),
        )
    )


def interest_answers(events: DataFrame, topic: str = "photography", carriers: Sequence[str] = CARRIERS) -> DataFrame:
    """Finished questionnaires: score and 1/0 interest, the first answer per device."""
    rows = parsed(events, [ANSWER_KIND], carriers).where(F.col("p.actionid") == "done")
    picked = F.coalesce("p.selecteditems", F.array().cast("array<string>"))
    answers = rows.select(
        F.col("p.deviceid").alias("device_id"),
        F.col("p.atlasuniqueuserid").alias("user_id"),
        *[F.col(raw).alias(name) for name, raw in ATTRIBUTES.items()],
        interest_score(picked, topic).alias("score"),
        "time",
        F.xxhash64("properties").alias("_tie"),
    )
    one = first_per_key(answers, ["device_id"], ["time", "_tie"]).drop("time", "_tie")
    return one.withColumn("interest", F.when(F.col("score") > 0, 1.0).otherwise(0.0))


def consolidate(*populations: DataFrame) -> DataFrame:
    """Union of scored populations, one row per device."""
    rows = populations[0]
    for other in populations[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("device_id").agg(
        *[F.max(c).alias(c) for c in ("user_id", *ATTRIBUTES)],
        F.sum("score").alias("score"),
        F.max("interest").alias("interest"),
    )


def enrich(users: DataFrame, ids: DataFrame, demographics: DataFrame, apps: DataFrame | None = None) -> DataFrame:
    """Left joins: id map, demographics, then installed apps. The engine sizes each side."""
    out = users.join(ids.select("mobileuid", "subid"), F.col("user_id") == F.col("mobileuid"), "left")
    out = out.join(demographics, F.col("subid") == F.col("source_dfx_id"), "left")
    return out.join(apps, F.col("device_id") == F.col("deviceId"), "left") if apps is not None else out


def segment_dataset(
    events: DataFrame, words: DataFrame, ids: DataFrame, demographics: DataFrame, since, apps: DataFrame | None = None
) -> DataFrame:
    scored = device_scores(content_scores(events, words, since))
    return enrich(consolidate(scored, interest_answers(events)), ids, demographics, apps)


