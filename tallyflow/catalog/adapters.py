"""The roles of the engagement jobs, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.catalog import Tables


def event_log(t: Tables) -> DataFrame:
    """Raw log with a JSON payload; one row of ``events`` yields one or two log rows."""
    e = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    pick = lambda i, *names: F.element_at(F.array(*[F.lit(n) for n in names]), (i % len(names) + 1).cast("int"))
    kind = F.col("event_type")
    kinds = F.concat(
        F.array(
            F.when(kind == "signup", "contentitem_sent")
            .when(kind == "view", "contentitem_received")
            .when(kind == "click", "contentitem_click")
            .when(kind == "purchase", "contentitem_timeonpage")
            .otherwise("contentitem_dismiss")
        ),
        F.when((kind == "view") & (F.col("event_id") % 2 == 0), F.array(F.lit("contentitem_view")))
        .when((kind == "view") & (F.col("event_id") % 5 == 0), F.array(F.lit("contentitem_feedbackmodule")))
        .when(kind == "purchase", F.array(F.lit("contentitem_pagescroll")))
        .when((kind == "error") & (F.col("k") % 4 == 0), F.array(F.lit("timeline_onboardingmessage_click")))
        .otherwise(F.array().cast("array<string>")),
    )
    rows = e.withColumn("event", F.explode(kinds))
    ev = F.col("event")
    action = (
        F.when(ev == "contentitem_click", pick(F.col("k"), "backbutton", "feedbackmodule", "readmore", "share"))
        .when(ev == "timeline_onboardingmessage_click", F.lit("done"))
    )
    rows = rows.select(
        "event",
        F.col("ts").alias("time"),
        F.year("ts").alias("year"),
        F.concat_ws("_", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("messageid"),
        F.concat(F.lit("topic_"), (F.col("k") % 6).cast("string")).alias("messagetype"),
        pick(F.col("user_id"), "sprint", "verizon", "att").alias("carriername"),
        F.when(F.col("k") % 11 != 0, pick(F.col("k"), "gold", "basic")).alias("programname"),
        F.when(F.col("k") % 13 != 0, (F.col("user_id") * 7 % 400).cast("double")).alias("daysfromeulaapproval"),
        pick(F.col("user_id"), "samsung", "lge", "apple", "moto").alias("devicevendor"),
        pick(F.col("user_id"), "m1", "m2", "m3", "m4", "m5").alias("devicemodel"),
        pick(F.col("user_id"), "one", "two").alias("devicemodelname"),
        F.when(F.col("user_id") % 4 == 2, "ios").otherwise("android").alias("deviceostype"),
        F.col("event_id"),
        F.when(F.col("event_id") % 97 == 3, F.lit(None)).otherwise(F.col("event_id") % 50 == 7).alias("istest"),
        F.col("user_id").cast("string").alias("deviceid"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("atlasuniqueuserid"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.when(ev == "contentitem_received", "en_us").alias("agentlocale"),
        F.when(ev == "contentitem_received", pick(F.col("k"), "en_us", "fr_fr")).alias("devicelocale"),
        F.when(ev == "contentitem_timeonpage", F.col("value") / 3).alias("timeonpage"),
        F.when(ev == "contentitem_pagescroll", 25 * (1 + F.col("k") % 4)).alias("scrolldepth"),
        action.alias("actionid"),
        F.when((action == "feedbackmodule") & (F.col("k") % 3 != 0), F.col("k") % 2 == 1).alias("feedbackvalue"),
        F.when(ev == "timeline_onboardingmessage_click",
               F.when(F.col("k") % 8 == 0, F.array(F.lit("photography"), F.lit("music"))).otherwise(F.array(F.lit("sport")))
               ).alias("selecteditems"),
        F.when(F.col("k") % 3 != 2, pick(F.col("k"), "camera,calls", "wifi", "video")).alias("devicefeatures_attribute"),
        F.lit("8.1").alias("deviceosversion"),
        F.when(F.col("k") % 2 == 0, "a,b").alias("itemsubject"),
        F.col("k").alias("wordcount"),
        pick(F.col("k"), "waterfalltoprank", "random").alias("modelid"),
        (F.col("k") / 100.0).alias("modelrecommendationprobability"),
        pick(F.col("user_id"), "web", "store").alias("installationsource"),
        F.lit("r").alias("registrationregion"),
        F.lit("c").alias("registrationcity"),
        F.lit("us").alias("registrationcountry"),
    )
    promoted = ("event", "time", "year", "messageid", "messagetype", "carriername", "programname",
                "daysfromeulaapproval", "devicevendor", "devicemodel", "devicemodelname", "deviceostype")
    payload = [c for c in rows.columns if c not in ("event", "time", "year", "event_id")]
    ready = rows.select(
        *promoted, F.to_json(F.struct(F.struct(*payload).alias("properties"))).alias("properties")
    )
    # a generator keeps the derived JSON text from being pasted into every later filter
    return ready.select(F.inline(F.array(F.struct(*ready.columns))))


# The same log in SQL, with the payload as plain columns.
LOG_SQL = """
base as (
  select *, cast(json_extract_string(props, '$.k') as integer) as k from events
), kinds as (
  select *, case event_type when 'signup' then 'contentitem_sent' when 'view' then 'contentitem_received'
    when 'click' then 'contentitem_click' when 'purchase' then 'contentitem_timeonpage' else 'contentitem_dismiss' end as event
  from base
  union all select *, 'contentitem_view' from base where event_type = 'view' and event_id % 2 = 0
  union all select *, 'contentitem_feedbackmodule' from base where event_type = 'view' and event_id % 2 <> 0 and event_id % 5 = 0
  union all select *, 'contentitem_pagescroll' from base where event_type = 'purchase'
  union all select *, 'timeline_onboardingmessage_click' from base where event_type = 'error' and k % 4 = 0
), acted as (
  select *, case when event = 'contentitem_click' then ['backbutton','feedbackmodule','readmore','share'][k % 4 + 1]
    when event = 'timeline_onboardingmessage_click' then 'done' end as actionid
  from kinds
), log as (
  select event, event_id, ts as time, user_id, k,
    user_id || '_' || strftime(ts, '%Y-%m-%d') as message_id,
    'topic_' || (k % 6) as message_type,
    ['sprint','verizon','att'][user_id % 3 + 1] as carrier_name,
    case when k % 11 <> 0 then ['gold','basic'][k % 2 + 1] end as program_name,
    case when k % 13 <> 0 then cast(user_id * 7 % 400 as double) end as days,
    ['samsung','lge','apple','moto'][user_id % 4 + 1] as device_vendor,
    ['m1','m2','m3','m4','m5'][user_id % 5 + 1] as device_model,
    ['one','two'][user_id % 2 + 1] as device_model_name,
    case when user_id % 4 = 2 then 'ios' else 'android' end as device_os_type,
    case when event_id % 97 = 3 then null else event_id % 50 = 7 end as istest,
    cast(user_id as varchar) as device_id,
    'u' || user_id as unique_user,
    cast(epoch(date_trunc('second', ts)) as bigint) * 1000 as ms,
    case when event = 'contentitem_received' then 'en_us' end as agent_locale,
    case when event = 'contentitem_received' then ['en_us','fr_fr'][k % 2 + 1] end as device_locale,
    case when event = 'contentitem_timeonpage' then value / 3 end as time_on_page,
    case when event = 'contentitem_pagescroll' then 25 * (1 + k % 4) end as scroll_depth,
    actionid,
    case when actionid = 'feedbackmodule' and k % 3 <> 0 then k % 2 = 1 end as feedback_value,
    event = 'timeline_onboardingmessage_click' and k % 8 = 0 as likes_photo,
    case when k % 3 <> 2 then ['camera,calls','wifi','video'][k % 3 + 1] end as features,
    ['waterfalltoprank','random'][k % 2 + 1] as model_id,
    k / 100.0 as model_p,
    ['web','store'][user_id % 2 + 1] as installation_source
  from acted
), good as (
  select * from log where istest = false
)
"""


def lines(t: Tables) -> DataFrame:
    """Line items with order, customer, nation and part attributes."""
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )


LINES_SQL = """
lines as (
  select * from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
    join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
)
"""
