"""Flatten a JSON event log into one row per sent message.

The log is scanned and its payload parsed once: all facets of a message, its clicks
included, come out of a single aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.dates import date_text, epoch_millis
from tallyflow.functions.text import to_float, to_int
from tallyflow.session import staged
from tallyflow.sources.readers import latest_partition
from tallyflow.sources.schemas import conform, payload_field
from tallyflow.sources.sinks import write_partitioned

# Fixed values: (column, payload key, type, default) of a sent record.
SENT_FIELDS = (
    ("device_os_version", "deviceosversion", "string", None),
    ("days_from_eula_approval", "daysfromeulaapproval", "double", None),
    ("program_name", "programname", "string", None),
    ("carrier_name", "carriername", "string", None),
    ("content_item_category", "Category", "string", None),
    ("chosen_conversation_rank", "chosenconversationrank", "bigint", None),
    ("device_model", "devicemodel", "string", None),
    ("device_os_type", "deviceostype", "string", None),
    ("device_vendor", "devicevendor", "string", None),
    ("expanded_notification_exists", "expandednotification_exists", "boolean", None),
    ("expanded_notification_is_enabled", "expandednotification_isenabled", "boolean", False),
    ("form_factor", "formfactor", "string", None),
    ("home_tier", "hometier", "string", None),
    ("installation_source", "installationsource", "string", None),
    ("is_pos_customer", "isposcustomer", "boolean", False),
    ("item_subject", "itemsubject", "list", ""),
    ("is_user_in_new_content_exploration_group", "isuserinnewcontentexplorationgroup", "boolean", False),
    ("sent_local_day_of_week", "localdayofweek", "string", None),
    ("sent_localtime", "localtime", "millis", None),
    ("message_type", "messagetype", "string", None),
    ("min_days_between_notifications", "mindaysbetweennotifications", "bigint", None),
    ("model_fallback_level", "modelfallbacklevel", "bigint", None),
    ("model_id", "modelid", "string", None),
    ("model_id_version", "modelidversion", "string", None),
    ("model_recommendation_probability", "modelrecommendationprobability", "double", None),
    ("model_original_model", "modeloriginalmodel", "string", None),
    ("notification_copy_original_variant_count", "notificationcopyoriginalvariantcount", "bigint", None),
    ("notification_copy_attributes", "notificationcopyattributes", "list", None),
    ("notification_copy_variant_label", "notificationcopyvariantlabel", "string", None),
    ("notification_frequency_model_id", "notificationfrequencymodelid", "string", None),
    ("notification_loading_method", "notificationloadingmethod", "string", "fullappinitialization"),
    ("notification_preview_headline", "notificationpreviewheadline", "string", None),
    ("notification_preview_message", "notificationpreviewmessage", "string", None),
    ("notification_render_type", "notificationrendertype", "string", None),
    ("possible_conversations_count", "possibleconversationscount", "bigint", None),
    ("priority_method", "prioritymethod", "string", None),
    ("sales_source", "salessource", "string", None),
    ("segments_attribute", "segments_attribute", "list", ""),
    ("sent_as_high_priority", "sentashighpriority", "boolean", False),
    ("show_footer", "showfooter", "boolean", None),
    ("source_sender", "source_sender", "string", None),
    ("timeline_enabled", "timeline_enabled", "boolean", False),
    ("word_count", "wordcount", "bigint", None),
    ("card_background_attribute", "cardbackground_attribute", "string", None),
    ("complexity_attribute", "complexity_attribute", "bigint", None),
    ("content_channels_card", "content_channels_card", "boolean", False),
    ("content_channels_notification", "content_channels_notification", "boolean", False),
    ("content_channels_search_results", "content_channels_searchresults", "boolean", False),
    ("contenttype_attribute", "contenttype_attribute", "list", []),
    ("device_type_mobile", "deviceType_mobile", "boolean", False),
    ("device_type_tablet", "deviceType_Tablet", "boolean", False),
    ("device_features_attribute", "devicefeatures_attribute", "list", []),
    ("format_attribute", "format_attribute", "string", None),
    ("notificationcopy_attribute", "notificationcopy_attribute", "list", []),
    ("subject_attribute", "subject_attribute", "list", []),
    ("app_badge_count", "appbadgecount", "bigint", 0),
    ("app_badge_count_method", "appbadgecountmethod", "string", None),
    ("app_version", "appversion", "string", None),
    ("background_image_attribute", "backgroundimageattribute", "string", None),
    ("background_image_original_variant_count", "backgroundimageoriginalvariantcount", "bigint", None),
    ("registration_region", "registrationregion", "string", None),
    ("registration_city", "registrationcity", "string", None),
    ("registration_country", "registrationcountry", "string", None),
)

SENT = "contentitem_sent"
RECEIVED = "contentitem_received"
DISMISS = "contentitem_dismiss"
VIEW = "contentitem_view"
TIME_ON_PAGE = "contentitem_timeonpage"
PAGE_SCROLL = "contentitem_pagescroll"
FEEDBACK_MODULE = "contentitem_feedbackmodule"
CLICK = "contentitem_click"
KINDS = (SENT, RECEIVED, DISMISS, VIEW, TIME_ON_PAGE, PAGE_SCROLL, FEEDBACK_MODULE, CLICK)

FACET_KEYS = (
    "messageid", "deviceid", "timestamp", "istest", "daysfromeulaapproval", "agentlocale", "devicelocale",
    "timeonpage", "scrolldepth", "actionid", "feedbackvalue", "messagetype",
)


def payload_schema() -> str:
    """All payload keys as text; typed only after the rows are filtered."""
    keys = list(dict.fromkeys([*FACET_KEYS, *[key for _, key, _, _ in SENT_FIELDS]]))
    return "properties struct<" + ",".join(f"`{k}`:string" for k in keys) + ">"


def parse_log(events: DataFrame, start, end, kinds: Sequence[str] = KINDS) -> DataFrame:
    """Log rows of the wanted kinds and time range with the payload as a struct ``p``.

    Test traffic and rows without a message id leave here, by one rule for all kinds.
    """
    return (
        events.where(F.col("event").isin(*kinds) & (F.col("time") >= F.lit(start)) & (F.col("time") <= F.lit(end)))
        .select("event", "time", F.from_json("properties", payload_schema()).getField("properties").alias("p"))
        .where((F.col("p.istest") == "false") & F.col("p.messageid").isNotNull())
        .withColumn("rank_key", F.struct("time", F.xxhash64("p")))
    )


def _typed(key: str, kind: str, default) -> Column:
    raw = F.col("p").getField(key)
    if kind == "list":
        parsed = F.when(raw.startswith("["), F.from_json(raw, "array<string>")).otherwise(F.split(raw, ","))
        if default is None:
            return parsed
        return F.coalesce(parsed, F.array(*[F.lit(v) for v in ([default] if default == "" else default)]).cast("array<string>"))
    if kind == "millis":
        return epoch_millis(raw)
    value = raw if kind == "string" else to_int(raw) if kind == "bigint" else raw.try_cast(kind)
    return value if default is None else F.coalesce(value, F.lit(default))


def sent_columns() -> list[Column]:
    typed = [_typed(key, kind, default).alias(name) for name, key, kind, default in SENT_FIELDS]
    return [
        F.col("p.deviceid").alias("device_id"),
        *typed,
        date_text(F.coalesce(F.col("p.timestamp"), F.lit(""))).alias("date"),
        epoch_millis(F.col("p.timestamp")).alias("sent_timestamp"),
    ]


def is_sent() -> Column:
    return (F.col("event") == SENT) & F.col("p.daysfromeulaapproval").isNotNull() & F.col("p.deviceid").isNotNull()


# One loader per row kind; each is a branch of the parsed log.
def sent_events(log: DataFrame) -> DataFrame:
    return log.where(is_sent()).select(F.col("p.messageid").alias("message_id"), "rank_key", *sent_columns())


def received_events(log: DataFrame) -> DataFrame:
    return log.where(F.col("event") == RECEIVED).select(
        F.col("p.messageid").alias("received_message_id"),
        "rank_key",
        F.coalesce("p.agentlocale", F.lit("")).alias("agent_locale"),
        F.coalesce("p.devicelocale", F.lit("")).alias("device_locale"),
        epoch_millis(F.col("p.timestamp")).alias("received_timestamp"),
    )


def _stamped(log: DataFrame, condition: Column, name: str) -> DataFrame:
    return log.where(condition).select(
        F.col("p.messageid").alias(name + "_message_id"),
        "rank_key",
        epoch_millis(F.col("p.timestamp")).alias(name + "_timestamp"),
    )


def dismiss_events(log: DataFrame) -> DataFrame:
    return _stamped(log, F.col("event") == DISMISS, "dismiss")


def is_view() -> Column:
    return (F.col("event") == VIEW) & F.col("p.daysfromeulaapproval").isNotNull()


def view_events(log: DataFrame) -> DataFrame:
    return _stamped(log, is_view(), "view")


def seconds_on_page() -> Column:
    return F.bround(to_float(F.coalesce("p.timeonpage", F.lit("0.0"))), 2)


def time_on_page_events(log: DataFrame) -> DataFrame:
    return log.where(F.col("event") == TIME_ON_PAGE).select(
        F.col("p.messageid").alias("time_on_page_message_id"), "rank_key", seconds_on_page().alias("time_on_page")
    )


def whole_depth() -> Column:
    return to_float(F.coalesce("p.scrolldepth", F.lit("0.0"))).try_cast("long")


def page_scroll_events(log: DataFrame) -> DataFrame:
    return (
        log.where(F.col("event") == PAGE_SCROLL)
        .groupBy(F.col("p.messageid").alias("page_scroll_message_id"))
        .agg(F.max(whole_depth()).alias("scroll_depth"))
    )


def feedback_impressions(log: DataFrame) -> DataFrame:
    return _stamped(log, F.col("event") == FEEDBACK_MODULE, "feedback_module_impression")


def is_feedback_click() -> Column:
    return (F.col("event") == CLICK) & (F.col("p.actionid") == "feedbackmodule")


def feedback_clicks(log: DataFrame) -> DataFrame:
    return log.where(is_feedback_click()).select(
        F.col("p.messageid").alias("feedback_module_click_message_id"),
        "rank_key",
        F.col("p.feedbackvalue").try_cast("boolean").alias("feedback_value"),
    )


def click_rows(log: DataFrame) -> DataFrame:
    """(message, action, timestamp) with the number of equal clicks."""
    return (
        log.where((F.col("event") == CLICK) & F.col("p.actionid").isNotNull())
        .groupBy(
            F.col("p.messageid").alias("click_message_id"),
            F.col("p.actionid").alias("action"),
            epoch_millis(F.col("p.timestamp")).alias("timestamp"),
        )
        .agg(F.count(F.lit(1)).alias("repeats"))
    )


def _click() -> Column:
    return F.struct(epoch_millis(F.col("p.timestamp")).alias("timestamp"), F.col("p.actionid").alias("action"))


def _in_order(clicks: Column) -> Column:
    ordered = F.transform(
        F.array_sort(clicks), lambda c: F.struct(c["action"].alias("action"), c["timestamp"].alias("timestamp"))
    )
    return F.when(F.size(clicks) > 0, ordered)


def click_events(log: DataFrame) -> DataFrame:
    """All clicks of a message, with repeats, as one time-ordered list ``actions``.

    ``click_rows`` has the same clicks as a long table, for messages with very many.
    """
    return (
        log.where((F.col("event") == CLICK) & F.col("p.actionid").isNotNull())
        .groupBy(F.col("p.messageid").alias("click_message_id"))
        .agg(_in_order(F.collect_list(_click())).alias("actions"))
    )


def topic_click_counts(log: DataFrame, actions: Sequence[str]) -> DataFrame:
    """Clicks per message type and action, one column per declared action, 0-filled."""
    return (
        log.where((F.col("event") == CLICK) & F.col("p.messagetype").isNotNull())
        .withColumn("action", F.coalesce("p.actionid", F.lit("")))
        .groupBy(F.lower("p.messagetype").alias("message_type"))
        .pivot("action", list(actions))
        .count()
        .na.fill(0)
    )


# Joins of one facet each, for use on any pair of frames.
def join_facet(
    anchors: DataFrame,
    facet: DataFrame,
    key: str,
    facet_key: str,
    flag: str | None = None,
) -> DataFrame:
    """Left join that keeps the facet's columns, with an optional 0/1 match flag."""
    joined = anchors.join(facet, anchors[key] == facet[facet_key], "left")
    if flag:
        joined = joined.withColumn(flag, F.when(F.col(facet_key).isNotNull(), 1).otherwise(0))
    return joined.drop(facet_key)


def facets(log: DataFrame) -> DataFrame:
    """Every facet per message id, the clicks included, in one aggregation."""
    stamp = epoch_millis(F.col("p.timestamp"))
    first = lambda value, cond: F.min_by(F.when(cond, value), F.when(cond, F.col("rank_key")))
    kind = lambda k: F.col("event") == k
    seen = lambda cond: F.max(F.when(cond, 1).otherwise(0))
    return log.groupBy(F.col("p.messageid").alias("message_id")).agg(
        first(F.struct(*sent_columns()), is_sent()).alias("_sent"),
        first(F.coalesce("p.agentlocale", F.lit("")), kind(RECEIVED)).alias("agent_locale"),
        first(F.coalesce("p.devicelocale", F.lit("")), kind(RECEIVED)).alias("device_locale"),
        first(stamp, kind(RECEIVED)).alias("received_timestamp"),
        seen(kind(RECEIVED)).alias("received"),
        seen(kind(DISMISS)).alias("dismiss"),
        first(stamp, kind(DISMISS)).alias("dismiss_timestamp"),
        seen(is_view()).alias("view"),
        first(stamp, is_view()).alias("view_timestamp"),
        first(seconds_on_page(), kind(TIME_ON_PAGE)).alias("time_on_page"),
        F.max(F.when(kind(PAGE_SCROLL), whole_depth())).alias("scroll_depth"),
        seen(kind(FEEDBACK_MODULE)).alias("feedback_module_impression"),
        first(stamp, kind(FEEDBACK_MODULE)).alias("feedback_module_impression_timestamp"),
        first(F.col("p.feedbackvalue").try_cast("boolean"), is_feedback_click()).alias("feedback_value"),
        _in_order(F.collect_list(F.when(kind(CLICK) & F.col("p.actionid").isNotNull(), _click()))).alias("actions"),
    )


def flatten_events(events: DataFrame, start, end) -> DataFrame:
    """One row per sent message with all its facets. The log is read and parsed once."""
    log = parse_log(events, start, end)
    return facets(log).where(F.col("_sent").isNotNull()).select("message_id", "_sent.*", *FACET_COLUMNS)


def flatten_increment(events: DataFrame, path: str, as_of, start=None) -> tuple | None:
    """Flattens the days after the newest one in ``path`` up to the day before ``as_of`` and adds them.

    The rows are conformed to the job's own columns and written by date; days that a broken run has
    left are replaced. ``start`` is the first day where nothing is written yet. Returns the
    window, or None if there is nothing to do.
    """
    spark = events.sparkSession
    target = flatten_events(events.limit(0), as_of, as_of).schema
    try:
        newest = latest_partition(spark.read.schema(target).parquet(path)).first()["latest"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    if newest is None and start is None:
        raise ValueError("the first run needs a start day")
    first = date.fromisoformat(newest) + timedelta(days=1) if newest is not None else start
    last = as_of - timedelta(days=1)
    if first > last:
        return None
    # a day ends before the next begins
    flat = conform(flatten_events(events.where(F.col("time") < F.lit(last + timedelta(days=1))), first, as_of), target)
    write_partitioned(flat, path, "date", mode="overwrite")
    return first, last


def facet_states(log: DataFrame) -> DataFrame:
    """Mergeable facets per message: the earliest row of each kind with its rank, the greatest depth, all clicks.

    States of parts of a log merge to the state of the whole (``merged_states``): earliest rows by their rank, clicks
    as one list. A message needs no sent row to have a state.
    """
    stamp = epoch_millis(F.col("p.timestamp"))
    kind = lambda k: F.col("event") == k
    first = lambda cond, *values: F.min(F.when(cond, F.struct("rank_key", F.struct(*values).alias("v"))))
    locale = lambda key: F.coalesce(F.col("p").getField(key), F.lit(""))
    return log.groupBy(F.col("p.messageid").alias("message_id")).agg(
        first(is_sent(), *sent_columns()).alias("s_sent"),
        first(
            kind(RECEIVED), locale("agentlocale").alias("agent_locale"), locale("devicelocale").alias("device_locale"), stamp.alias("at")
        ).alias("s_received"),
        first(kind(DISMISS), stamp.alias("at")).alias("s_dismiss"),
        first(is_view(), stamp.alias("at")).alias("s_view"),
        first(kind(TIME_ON_PAGE), seconds_on_page().alias("seconds")).alias("s_page"),
        first(kind(FEEDBACK_MODULE), stamp.alias("at")).alias("s_module"),
        first(is_feedback_click(), F.col("p.feedbackvalue").try_cast("boolean").alias("value")).alias("s_feedback"),
        F.max(F.when(kind(PAGE_SCROLL), whole_depth())).alias("scroll_depth"),
        F.collect_list(F.when(kind(CLICK) & F.col("p.actionid").isNotNull(), _click())).alias("clicks"),
    )


def merged_states(states: DataFrame) -> DataFrame:
    """One state per message from any number of them."""
    earliest = [c for c in states.columns if c.startswith("s_")]
    return states.groupBy("message_id").agg(
        *[F.min(c).alias(c) for c in earliest], F.max("scroll_depth").alias("scroll_depth"), F.flatten(F.collect_list("clicks")).alias("clicks")
    )


def flat_rows(states: DataFrame) -> DataFrame:
    """The rows of ``flatten_events`` from states, and ``sent_day``, the log day of the sent row."""
    seen = lambda c: F.col(c).isNotNull().cast("int")
    values = {
        "agent_locale": F.col("s_received.v.agent_locale"), "device_locale": F.col("s_received.v.device_locale"),
        "received_timestamp": F.col("s_received.v.at"), "received": seen("s_received"),
        "dismiss": seen("s_dismiss"), "dismiss_timestamp": F.col("s_dismiss.v.at"),
        "view": seen("s_view"), "view_timestamp": F.col("s_view.v.at"),
        "time_on_page": F.col("s_page.v.seconds"), "scroll_depth": F.col("scroll_depth"),
        "feedback_module_impression": seen("s_module"), "feedback_module_impression_timestamp": F.col("s_module.v.at"),
        "feedback_value": F.col("s_feedback.v.value"), "actions": _in_order(F.col("clicks")),
    }
    day = F.to_date("s_sent.rank_key.time").alias("sent_day")
    return states.where(F.col("s_sent").isNotNull()).select("message_id", "s_sent.v.*", *[values[c].alias(c) for c in FACET_COLUMNS], day)


def update_days(events: DataFrame, path: str, first, last, delay_days: int) -> DataFrame:
    """Adds the log days ``first`` to ``last`` to the table in ``path`` and merges late facets into the days that they concern.

    The states of the new days are written to ``path/states``, by run, also those of messages without a sent row.
    Then the days from ``delay_days`` before ``first`` on are built anew from the states of the runs that can hold their
    facets, up to ``delay_days`` before or after the sent row, and replaced in ``path/flat`` (by sent_day). Older
    days stay as they are. The log is read for the new days only. A run that broke off may be repeated: it
    replaces its states and days. Returns the whole table.
    """
    spark = events.sparkSession
    log = parse_log(events.where(F.col("time") < F.lit(last + timedelta(days=1))), first, last + timedelta(days=1))
    states = facet_states(log)
    states.write.mode("overwrite").parquet(f"{path}/states/last={last.isoformat()}/first={first.isoformat()}")
    since = first - timedelta(days=delay_days)
    kept = spark.read.schema(states.schema).option("basePath", f"{path}/states").parquet(f"{path}/states")
    kept = kept.where(F.col("last") >= F.lit((since - timedelta(days=delay_days)).isoformat())).drop("last", "first")
    rows = flat_rows(merged_states(kept)).where((F.col("sent_day") >= F.lit(since)) & (F.col("sent_day") <= F.lit(last)))
    write_partitioned(rows, f"{path}/flat", "sent_day", mode="overwrite")
    return spark.read.schema(rows.schema).parquet(f"{path}/flat")


FACET_COLUMNS = (
    "agent_locale", "device_locale", "received_timestamp", "received", "dismiss", "dismiss_timestamp",
    "view", "view_timestamp", "time_on_page", "scroll_depth", "feedback_module_impression",
    "feedback_module_impression_timestamp", "feedback_value", "actions",
)


def flatten_by_joins(events: DataFrame, start, end) -> DataFrame:
    """The same rows by eight left joins; kept as the plain form the aggregate is tested against.

    The log is parsed once; each of the nine loaders reads its columns of the parsed table.
    """
    from tallyflow.operators.cleaning import first_per_key

    log = staged(parse_log(events, start, end))
    one = lambda df, key: first_per_key(df, [key], ["rank_key"]).drop("rank_key")
    out = one(sent_events(log), "message_id")
    steps = (
        (one(received_events(log), "received_message_id"), "received_message_id", "received"),
        (one(dismiss_events(log), "dismiss_message_id"), "dismiss_message_id", "dismiss"),
        (one(view_events(log), "view_message_id"), "view_message_id", "view"),
        (one(time_on_page_events(log), "time_on_page_message_id"), "time_on_page_message_id", None),
        (page_scroll_events(log), "page_scroll_message_id", None),
        (one(feedback_impressions(log), "feedback_module_impression_message_id"),
         "feedback_module_impression_message_id", "feedback_module_impression"),
        (one(feedback_clicks(log), "feedback_module_click_message_id"), "feedback_module_click_message_id", None),
        (click_events(log), "click_message_id", None),
    )
    for facet, key, flag in steps:
        out = join_facet(out, facet, "message_id", key, flag)
    return out


def newest_event_time(events: DataFrame, since) -> DataFrame:
    """Newest time per event kind."""
    return events.where(F.col("time") >= F.lit(since)).groupBy("event").agg(F.max("time").alias("max_time"))
