"""Event loaders, joins, rates, separation, segments and installs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyflow.catalog import Tables, case
from tallyflow.catalog.adapters import LINES_SQL, LOG_SQL, event_log, lines
from tallyflow.catalog.basics import scratch
from tallyflow.operators import cleaning as cl
from tallyflow.operators.priors import beta_priors, eligible_children, fixed_prior
from tallyflow.plans import flatten as fl
from tallyflow.plans import installs as ins
from tallyflow.plans import rates as rt
from tallyflow.plans import segments as sg
from tallyflow.plans import separation as sp

START, END = date(2024, 1, 1), date(2024, 2, 1)


def log_of(t: Tables):
    return fl.parse_log(event_log(t), START, END)


def first_sql(kind: str, columns: str, more: str = "", prefix: str = "") -> str:
    """Oracle of a deduplicated loader: the earliest row per message."""
    return f"""with {LOG_SQL}
    select {columns} from good where event = '{kind}' {more}
    qualify row_number() over (partition by message_id order by time, event_id) = 1"""


def once(df, key):
    return cl.first_per_key(df, [key], ["rank_key"]).drop("rank_key")


SENT_SQL = "and days is not null"


@case("LD1_sent_events", first_sql("contentitem_sent", """message_id, device_id, days as days_from_eula_approval,
  program_name, carrier_name, message_type, ms as sent_timestamp, strftime(time, '%Y-%m-%d') as date, k as word_count,
  case when k % 2 = 0 then 'a|b' else '' end as item_subject, false as is_pos_customer,
  'fullappinitialization' as notification_loading_method, '' as segments_attribute""", SENT_SQL))
def _(t):
    out = once(fl.sent_events(log_of(t)), "message_id")
    return out.select(
        "message_id", "device_id", "days_from_eula_approval", "program_name", "carrier_name", "message_type",
        "sent_timestamp", "date", F.col("word_count").cast("int").alias("word_count"),
        F.concat_ws("|", "item_subject").alias("item_subject"), "is_pos_customer", "notification_loading_method",
        F.concat_ws("|", "segments_attribute").alias("segments_attribute"),
    )


@case("LD2_received_events", first_sql("contentitem_received", "message_id as received_message_id, agent_locale, device_locale, ms as received_timestamp"))
def _(t):
    return once(fl.received_events(log_of(t)), "received_message_id")


@case("LD3_dismiss_events", first_sql("contentitem_dismiss", "message_id as dismiss_message_id, ms as dismiss_timestamp"))
def _(t):
    return once(fl.dismiss_events(log_of(t)), "dismiss_message_id")


@case("LD4_view_events", first_sql("contentitem_view", "message_id as view_message_id, ms as view_timestamp", "and days is not null"))
def _(t):
    return once(fl.view_events(log_of(t)), "view_message_id")


@case("LD5_time_on_page_events", first_sql("contentitem_timeonpage", "message_id as time_on_page_message_id, round_even(time_on_page, 2) as time_on_page"))
def _(t):
    return once(fl.time_on_page_events(log_of(t)), "time_on_page_message_id")


@case("LD6_page_scroll_events", f"with {LOG_SQL} select message_id as page_scroll_message_id, cast(max(scroll_depth) as bigint) as scroll_depth from good where event = 'contentitem_pagescroll' group by 1")
def _(t):
    return fl.page_scroll_events(log_of(t))


@case("LD7_feedback_impressions", first_sql("contentitem_feedbackmodule", "message_id as feedback_module_impression_message_id, ms as feedback_module_impression_timestamp"))
def _(t):
    return once(fl.feedback_impressions(log_of(t)), "feedback_module_impression_message_id")


@case("LD8_feedback_clicks", first_sql("contentitem_click", "message_id as feedback_module_click_message_id, feedback_value", "and actionid = 'feedbackmodule'"))
def _(t):
    return once(fl.feedback_clicks(log_of(t)), "feedback_module_click_message_id")


ACTIONS_SQL = """string_agg(actionid || '@' || ms, ';' order by ms, actionid)"""


def action_text():
    return F.array_join(F.transform("actions", lambda a: F.concat(a["action"], F.lit("@"), a["timestamp"].cast("string"))), ";")


@case("LD9_click_events", f"with {LOG_SQL} select message_id as click_message_id, {ACTIONS_SQL} as actions from good where event = 'contentitem_click' group by 1")
def _(t):
    return fl.click_events(log_of(t)).select("click_message_id", action_text().alias("actions"))


@case("AG6_collect_actions", f"with {LOG_SQL} select message_id as click_message_id, cast(count(*) as integer) as n, min(ms) as first_ms from good where event = 'contentitem_click' group by 1")
def _(t):
    one = fl.click_events(log_of(t))
    return one.groupBy("click_message_id").agg(
        F.sum(F.size("actions")).cast("int").alias("n"), F.min(F.col("actions")[0]["timestamp"]).alias("first_ms")
    )


@case("AG3_max_per_key", f"with {LOG_SQL} select message_id, round(max(time_on_page), 3) as time_on_page from good where event = 'contentitem_timeonpage' group by 1")
def _(t):
    return rt.time_on_page(event_log(t), START, END).select("message_id", F.round(F.col("time_on_page").cast("double"), 3).alias("time_on_page"))


@case("AG7_topic_click_counts", f"""with {LOG_SQL} select message_type,
  count(*) filter (actionid = 'backbutton') as backbutton, count(*) filter (actionid = 'feedbackmodule') as feedbackmodule,
  count(*) filter (actionid = 'readmore') as readmore, count(*) filter (actionid = 'share') as share
  from good where event = 'contentitem_click' group by 1""")
def _(t):
    return fl.topic_click_counts(log_of(t), ["backbutton", "feedbackmodule", "readmore", "share"])


@case("AG27_newest_event_time", f"with {LOG_SQL} select event, strftime(max(time), '%Y-%m-%d %H:%M:%S') as max_time from log where time >= '2024-01-10' group by 1")
def _(t):
    return fl.newest_event_time(event_log(t), date(2024, 1, 10)).withColumn("max_time", F.date_format("max_time", "yyyy-MM-dd HH:mm:ss"))


FACET = """select message_id, first({value} order by time, event_id) as v, true as hit from good where event = '{kind}' {more} group by 1"""
ANCHOR_SQL = f"""with {LOG_SQL}, anchors as (
  select * from good where event = 'contentitem_sent' and days is not null
  qualify row_number() over (partition by message_id order by time, event_id) = 1
)"""


def facet_sql(name: str, kind: str, value: str, more: str = "") -> str:
    return f", {name} as ({FACET.format(value=value, kind=kind, more=more)})"


def anchors_of(t):
    return once(fl.sent_events(log_of(t)), "message_id").select("message_id", "device_id", "sent_timestamp")


@case("JN1_flag_join", ANCHOR_SQL + facet_sql("f", "contentitem_dismiss", "ms") + """
  select a.message_id, a.device_id, a.ms as sent_timestamp, f.v as dismiss_timestamp, cast(coalesce(f.hit, false) as integer) as dismiss
  from anchors a left join f using (message_id)""")
def _(t):
    facet = once(fl.dismiss_events(log_of(t)), "dismiss_message_id")
    return fl.join_facet(anchors_of(t), facet, "message_id", "dismiss_message_id", "dismiss")


@case("JN2_received_join", ANCHOR_SQL + facet_sql("f", "contentitem_received", "{'d': device_locale, 'm': ms}") + """
  select a.message_id, a.device_id, a.ms as sent_timestamp, case when f.hit then 'en_us' end as agent_locale, f.v.d as device_locale,
    f.v.m as received_timestamp, cast(coalesce(f.hit, false) as integer) as received from anchors a left join f using (message_id)""")
def _(t):
    facet = once(fl.received_events(log_of(t)), "received_message_id")
    return fl.join_facet(anchors_of(t), facet, "message_id", "received_message_id", "received")


@case("JN3_numeric_join", ANCHOR_SQL + facet_sql("f", "contentitem_timeonpage", "round_even(time_on_page, 2)") + """
  select a.message_id, a.device_id, a.ms as sent_timestamp, f.v as time_on_page from anchors a left join f using (message_id)""")
def _(t):
    facet = once(fl.time_on_page_events(log_of(t)), "time_on_page_message_id")
    return fl.join_facet(anchors_of(t), facet, "message_id", "time_on_page_message_id")


# first(v order by ...) skips null values in some engines, so the value travels in a struct
@case("JN4_value_join", ANCHOR_SQL + facet_sql("f", "contentitem_click", "{'v': feedback_value}", "and actionid = 'feedbackmodule'") + """
  select a.message_id, a.device_id, a.ms as sent_timestamp, f.v.v as feedback_value from anchors a left join f using (message_id)""")
def _(t):
    facet = once(fl.feedback_clicks(log_of(t)), "feedback_module_click_message_id")
    return fl.join_facet(anchors_of(t), facet, "message_id", "feedback_module_click_message_id")


FLAT_SQL = (
    ANCHOR_SQL
    + facet_sql("r", "contentitem_received", "{'d': device_locale, 'm': ms}")
    + facet_sql("d", "contentitem_dismiss", "ms")
    + facet_sql("v", "contentitem_view", "ms", "and days is not null")
    + facet_sql("top", "contentitem_timeonpage", "round_even(time_on_page, 2)")
    + ", s as (select message_id, max(scroll_depth) as v from good where event = 'contentitem_pagescroll' group by 1)"
    + facet_sql("fi", "contentitem_feedbackmodule", "ms")
    + facet_sql("fc", "contentitem_click", "{'v': feedback_value}", "and actionid = 'feedbackmodule'")
    + f", c as (select message_id, {ACTIONS_SQL} as v from good where event = 'contentitem_click' group by 1)"
    + """
  select a.message_id, a.device_id, a.carrier_name, a.message_type, a.days as days_from_eula_approval, a.ms as sent_timestamp,
    strftime(a.time, '%Y-%m-%d') as date, r.v.d as device_locale, r.v.m as received_timestamp,
    cast(coalesce(r.hit, false) as integer) as received, d.v as dismiss_timestamp, cast(coalesce(d.hit, false) as integer) as dismiss,
    v.v as view_timestamp, cast(coalesce(v.hit, false) as integer) as "view", top.v as time_on_page, cast(s.v as bigint) as scroll_depth,
    fi.v as feedback_module_impression_timestamp, cast(coalesce(fi.hit, false) as integer) as feedback_module_impression,
    fc.v.v as feedback_value, c.v as actions
  from anchors a left join r using (message_id) left join d using (message_id) left join v using (message_id)
    left join top using (message_id) left join s using (message_id) left join fi using (message_id)
    left join fc using (message_id) left join c using (message_id)"""
)
FLAT_COLUMNS = (
    "message_id", "device_id", "carrier_name", "message_type", "days_from_eula_approval", "sent_timestamp", "date",
    "device_locale", "received_timestamp", "received", "dismiss_timestamp", "dismiss", "view_timestamp", "view",
    "time_on_page", "scroll_depth", "feedback_module_impression_timestamp", "feedback_module_impression", "feedback_value",
)


@case("JN5_funnel_by_joins", FLAT_SQL)
def _(t):
    return fl.flatten_by_joins(event_log(t), START, END).select(*FLAT_COLUMNS, action_text().alias("actions"))


@case("JOB1_flatten_events", FLAT_SQL)
def _(t):
    return fl.flatten_events(event_log(t), START, END).select(*FLAT_COLUMNS, action_text().alias("actions"))


@case("JOB1_incremental_flatten", f"select * from ({FLAT_SQL}) where date < '2024-01-21'")
def _(t):
    path = scratch(t) + "/flat"
    events = event_log(t)
    # two runs: the second one finds the newest day of the first and goes on from there
    for as_of in (date(2024, 1, 10), date(2024, 1, 21)):
        fl.flatten_increment(events, path, as_of, START)
    flat = t.spark.read.schema(fl.flatten_events(events.limit(0), START, END).schema).parquet(path)
    return flat.select(*FLAT_COLUMNS, action_text().alias("actions"))


@case("LATE1_merged_days", FLAT_SQL)
def _(t):
    # three runs; facets of a message come up to the whole month apart
    events, path = event_log(t), scratch(t) + "/late"
    for first, last in ((START, date(2024, 1, 9)), (date(2024, 1, 10), date(2024, 1, 19)), (date(2024, 1, 20), END)):
        flat = fl.update_days(events, path, first, last, delay_days=40)
    return flat.select(*FLAT_COLUMNS, action_text().alias("actions"))


# installed apps: a customer is a device, its ordered parts are its packages
def devices(t):
    one = F.struct(
        F.lower(F.concat(F.lit("com."), F.regexp_replace("p_brand", "#", "."), F.when(F.col("p_size") == 1, ".vpl").otherwise(""))).alias("package"),
        F.when(F.col("p_size") != 2, F.concat("p_type", F.lit("_y_"), F.replace("p_name", F.lit(" "), F.lit("&amp;")))).alias("category"),
    )
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy(F.col("o_custkey").cast("string").alias("deviceId")).agg(F.collect_list(one).alias("packages"))


DEVICES_SQL = """
names as (
  select cast(o_custkey as varchar) as "deviceId",
    lower('com.' || replace(p_brand, '#', '.')) || case when p_size = 1 then '.vpl' else '' end as package,
    case when p_size <> 2 then replace(replace(replace(replace(lower(p_type || '_y_' || replace(p_name, ' ', '&amp;')), '&amp;', 'and'), ' ', '_'), '_y_', '_and_'), '_e_', '_and_') end as category
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
)"""


@case("ARR1_explode_names", f"""with {DEVICES_SQL} select "deviceId", package as name, count(*) as n from names where package not like '%.vpl' group by 1, 2""")
def _(t):
    return ins.device_names(devices(t), "apps").groupBy("deviceId", "name").agg(F.count(F.lit(1)).alias("n"))


@case("ARR2_frequent_names", f"""with {DEVICES_SQL}, kept as (select * from names where category is not null qualify count(*) over (partition by category) > 160)
  select "deviceId", category as name, count(*) as n from kept group by 1, 2""")
def _(t):
    rows = ins.frequent_names(ins.device_names(devices(t), "categories"), 160)
    return rows.groupBy("deviceId", "name").agg(F.count(F.lit(1)).alias("n"))


@case("STR4_normal_names", f"with {DEVICES_SQL} select category as name, count(*) as n from names where category is not null group by 1")
def _(t):
    return ins.device_names(devices(t), "categories").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@case("FLT7_without_preloads", f"with {DEVICES_SQL} select package as name, count(*) as n from names where package not like '%.vpl' group by 1")
def _(t):
    return ins.device_names(devices(t), "apps").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


BRANDS = [f"com.brand.{i}" for i in range(1, 6)]


@case("AG8_pivot_sum", f"""with {DEVICES_SQL} select "deviceId", {', '.join(f"count(*) filter (package = '{b}') as " + chr(34) + b.replace('.', '_') + chr(34) for b in BRANDS)} from names where package not like '%.vpl' group by 1""")
def _(t):
    rows = ins.device_names(devices(t), "apps")
    return ins.pivot_names(rows, BRANDS).toDF("deviceId", *[b.replace(".", "_") for b in BRANDS])


@case("AG9_pivot_presence", f"""with {DEVICES_SQL} select "deviceId", {', '.join(f"max(cast(package = '{b}' as integer)) as " + chr(34) + b.replace('.', '_') + chr(34) for b in BRANDS)} from names where package not like '%.vpl' group by 1""")
def _(t):
    rows = ins.device_names(devices(t), "apps")
    return ins.pivot_names(rows, BRANDS, binary=True).toDF("deviceId", *[b.replace(".", "_") for b in BRANDS])


@case("LD10_android_received", f"""with {LOG_SQL} select carrier_name as "CarrierName", device_id as "DeviceId", days as "DaysFromEulaApproval",
  coalesce(program_name, 'unset') as "ProgramName", message_id as "MessageId", message_type as "MessageType", device_vendor as "DeviceVendor"
  from good where event = 'contentitem_received' and device_os_type = 'android' and days is not null""")
def _(t):
    return ins.received_on_android(event_log(t), START).drop("rank_key")


@case("LD10_android_sent", f"""with {LOG_SQL} select device_id as "deviceId", days as "daysFromEulaApproval", coalesce(program_name, 'unset') as "programName",
  strftime(time, '%Y-%m-%d') as date, installation_source as "installationSource", '8.1' as "deviceOsVersion"
  from good where event = 'contentitem_sent' and device_os_type = 'android' and days is not null""")
def _(t):
    return ins.sent_on_android(event_log(t), START, END).select("deviceId", "daysFromEulaApproval", "programName", "date", "installationSource", "deviceOsVersion")


PREVIEW_SQL = f"""with {LOG_SQL}, rec as (
  select * from good where event = 'contentitem_received' and device_os_type = 'android' and days is not null
  qualify row_number() over (partition by message_id order by time, event_id) = 1
), vw as (select distinct message_id from good where event = 'contentitem_view' and days is not null)
"""


@case("JN6_preview_clicks", PREVIEW_SQL + """select rec.message_id as "MessageId", rec.device_id as "DeviceId",
  cast(vw.message_id is not null as integer) as "PreviewClicked" from rec left join vw using (message_id)""")
def _(t):
    log = event_log(t)
    received = cl.first_per_key(ins.received_on_android(log, START), ["MessageId"], ["rank_key"])
    return ins.with_preview_clicks(received, ins.viewed(log, START)).select("MessageId", "DeviceId", "PreviewClicked")


@case("JN7_events_with_devices", PREVIEW_SQL + f""", {DEVICES_SQL}, totals as (select "deviceId", count(*) as n from names where package not like '%.vpl' group by 1)
  select rec.message_id as "MessageId", rec.device_id as "DeviceId", totals.n from rec join totals on rec.device_id = totals."deviceId" """)
def _(t):
    received = cl.first_per_key(ins.received_on_android(event_log(t), START), ["MessageId"], ["rank_key"])
    totals = ins.device_names(devices(t), "apps").groupBy("deviceId").agg(F.count(F.lit(1)).alias("n"))
    return ins.with_device_features(received, totals).select("MessageId", "DeviceId", "n")


@case("JOB7_views_with_apps", PREVIEW_SQL + f""", {DEVICES_SQL}, kept as (
    select * from names where category is not null qualify count(*) over (partition by category) > 200
  ), totals as (select "deviceId", count(*) as n from kept group by 1)
  select rec.message_id as "MessageId", cast(vw.message_id is not null as integer) as "PreviewClicked", totals.n as apps
  from rec left join vw using (message_id) join totals on rec.device_id = totals."deviceId" """)
def _(t):
    out = ins.views_with_apps(devices(t), event_log(t), START, threshold=200)
    fixed = {"CarrierName", "DeviceId", "DaysFromEulaApproval", "ProgramName", "MessageId", "MessageType", "DeviceVendor", "PreviewClicked"}
    counts = F.array(*[F.col(f"`{c}`") for c in out.columns if c not in fixed])
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("MessageId", "PreviewClicked", total.alias("apps"))


@case("AG14_latest_per_device", f"""with {LOG_SQL} select device_id as "deviceId", days as "daysFromEulaApproval", strftime(time, '%Y-%m-%d') as date
  from good where event = 'contentitem_sent' and device_os_type = 'android' and days is not null
  qualify row_number() over (partition by device_id order by days desc, strftime(time, '%Y-%m-%d') desc) = 1""")
def _(t):
    rows = ins.sent_on_android(event_log(t), START, END)
    return ins.latest_per_device(rows, "deviceId", ["daysFromEulaApproval", "date"]).select("deviceId", "daysFromEulaApproval", "date")


@case("WN2_adjacent_later_date", """select event_id, cast(user_id as bigint) as user_id, strftime(max(cast(ts as date)) over (
  partition by user_id order by cast(ts as date) desc, event_id desc rows between 1 preceding and current row), '%Y-%m-%d') as adjacent_later_date from events""")
def _(t):
    rows = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"))
    out = ins.with_adjacent_later_date(rows, "user_id", "day", ["event_id"])
    return out.select("event_id", "user_id", F.date_format("adjacent_later_date", "yyyy-MM-dd").alias("adjacent_later_date"))


def telemetry(t):
    app = F.struct(
        F.col("l_orderkey").alias("FirstInstallTime"), (F.col("l_returnflag") == "R").alias("IsSystemApp"),
        F.col("l_partkey").alias("LastUpdateTime"), F.col("p_name").alias("Name"), F.col("p_brand").alias("PackageName"),
        F.col("l_linenumber").cast("long").alias("VersionCode"), F.lit("1.0").alias("VersionName"),
    )
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    body = F.struct(
        (F.col("o_orderkey") % 10 == 0).alias("IsTest"), F.lit("sprint").alias("CarrierName"),
        F.col("o_custkey").cast("string").alias("DeviceId"), F.array(app).alias("InstalledApps"),
    )
    return rows.select(
        F.when(F.col("o_orderstatus") == "F", "systemapps").when(F.col("o_orderstatus") == "O", "apps").otherwise("battery").alias("event_name"),
        F.lit("android").alias("os"), F.col("o_orderkey").cast("string").alias("uuid"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("event_date"), F.to_json(body).alias("json_data"), F.lit("4").alias("agentversion"),
    )


@case("JOB8_telemetry_history", """select cast(o_custkey as varchar) as "deviceId", cast(o_orderkey as varchar) as uuid,
  case o_orderstatus when 'F' then 'systemapps' else 'apps' end as "telemetryType", strftime(o_orderdate, '%Y-%m-%d') as date,
  p_brand as package, cast(l_linenumber as bigint) as version
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
  where o_orderstatus in ('F','O') and o_orderkey % 10 <> 0 and o_orderdate >= '1996-01-01' and o_orderdate <= '1998-12-31'""")
def _(t):
    out = ins.telemetry_history(telemetry(t), "1996-01-01", "1998-12-31")
    one = out.withColumn("a", F.explode("installedApps"))
    return one.select("deviceId", "uuid", "telemetryType", "date", F.col("a.PackageName").alias("package"), F.col("a.VersionCode").alias("version"))


# hierarchical rates on line items: brand, then nation
HIERARCHY = ["p_brand", "n_name"]


def daily(t):
    rows = lines(t).select(
        *HIERARCHY, F.to_date("l_shipdate").alias("receive_date"), F.lit(1).alias("trial"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("success"),
    )
    return rt.sum_by(rows, [*HIERARCHY, "receive_date"])


DAILY_SQL = f"""with {LINES_SQL}, daily as (
  select p_brand, n_name, cast(l_shipdate as date) as receive_date, count(*) as trial, count(*) filter (l_returnflag = 'R') as success
  from lines group by all
), smooth as (
  select *, 0.001 * power(1 - 0.001, date_diff('day', receive_date, (select max(receive_date) from daily))) as w from daily
), leaves as (
  select p_brand, n_name, sum(trial) as trial, sum(success) as success, sum(w * trial) as ts, sum(w * success) as ss from smooth group by all
), nodes as (
  select 2 as level, p_brand, n_name, trial, success, ts, ss from leaves
  union all select 1, p_brand, null, sum(trial), sum(success), sum(ts), sum(ss) from leaves group by p_brand
  union all select 0, null, null, sum(trial), sum(success), sum(ts), sum(ss) from leaves
)"""
GAMMA, MIN_TRIALS = 0.001, 80


@case("AG4_sum_by_keys_and_day", DAILY_SQL + " select p_brand, n_name, strftime(receive_date, '%Y-%m-%d') as receive_date, trial, success from daily")
def _(t):
    return daily(t).withColumn("receive_date", F.date_format("receive_date", "yyyy-MM-dd")).withColumn("success", F.col("success").cast("long"))


@case("MTH5_exponential_smoothing", DAILY_SQL + " select p_brand, n_name, round(sum(w * trial), 6) as trial_smooth, round(sum(w * success), 6) as success_smooth from smooth group by all")
def _(t):
    out = rt.smoothed(daily(t), GAMMA).groupBy(*HIERARCHY)
    return out.agg(F.round(F.sum("trial_smooth"), 6).alias("trial_smooth"), F.round(F.sum("success_smooth"), 6).alias("success_smooth"))


@case("AG5_level_rollup", DAILY_SQL + """ select level, p_brand, n_name, cast(trial as bigint) as trial, cast(success as bigint) as success,
  round(ts, 6) as trial_smooth, round(ss, 6) as success_smooth from nodes""")
def _(t):
    out = rt.node_table(rt.smoothed(daily(t), GAMMA), HIERARCHY)
    return out.select("level", *HIERARCHY, "trial", "success", F.round("trial_smooth", 6).alias("trial_smooth"), F.round("success_smooth", 6).alias("success_smooth"))


PRIOR_SQL = """, busy as (
  select *, count(*) over (partition by level, case when level > 1 then p_brand end) as types from nodes where level > 0 and trial > 80
), pri as (
  select distinct level, case when level > 1 then p_brand end as pb from busy where types > 5
), model as (
  select n.level, n.p_brand, n.n_name, n.trial, n.success, n.ts, n.ss, 2.0 as alpha, 3.0 as beta, (ss + 2.0) / (ts + 5.0) as probability
  from nodes n join pri on pri.level = n.level and pri.pb is not distinct from case when n.level > 1 then n.p_brand end where n.level > 0
  union all select level, p_brand, n_name, trial, success, ts, ss, 0, 0, ss / ts from nodes where level = 0
)"""


@case("PRI1_eligible_children", DAILY_SQL + """ select p_brand, n_name, cast(trial as bigint) as trial, cast(success as bigint) as success,
  types as num_types from (select *, count(*) over (partition by p_brand) as types from leaves where trial > 80) where types > 5""")
def _(t):
    leaves = rt.sum_by(daily(t), HIERARCHY)
    out = eligible_children(leaves, ["p_brand"], "n_name", MIN_TRIALS)
    return out.select("p_brand", "n_name", "trial", "success", "num_types")


@case("WN3_distinct_children", DAILY_SQL + " select p_brand, n_name, count(*) over (partition by p_brand) as num_types from leaves where trial > 60")
def _(t):
    busy = rt.sum_by(daily(t), HIERARCHY).where(F.col("trial") > 60)
    return eligible_children(busy, ["p_brand"], "n_name", 0, 0).select("p_brand", "n_name", "num_types")


@case("PRI2_beta_priors")
def _(t):
    children = rt.sum_by(daily(t), HIERARCHY)
    return beta_priors(children, ["p_brand"]).select("p_brand", F.round("alpha", 3).alias("alpha"), F.round("beta", 3).alias("beta"), "n_iter")


def fixed(children, parent):
    return fixed_prior(children, parent, 2.0, 3.0)


def model_of(t, fit=fixed):
    return rt.rate_model(rt.smoothed(daily(t), GAMMA), HIERARCHY, MIN_TRIALS, fit=fit)


@case("JN10_child_with_parent_prior", DAILY_SQL + PRIOR_SQL + " select level, p_brand, n_name, cast(trial as bigint) as trial, cast(alpha as double) as alpha, cast(beta as double) as beta from model")
def _(t):
    return model_of(t).select("level", *HIERARCHY, "trial", "alpha", "beta")


@case("JOB2_rate_model_fixed_prior", DAILY_SQL + PRIOR_SQL + " select level, p_brand, n_name, round(probability, 6) as probability from model")
def _(t):
    return rt.published_rows(model_of(t), HIERARCHY).withColumn("probability", F.round("probability", 6))


@case("HR1_published_rows", DAILY_SQL + PRIOR_SQL + " select level, p_brand, n_name, round(probability, 6) as probability from model")
def _(t):
    return rt.published_rows(model_of(t), HIERARCHY).withColumn("probability", F.round("probability", 6))


@case("JOB2_rate_model")
def _(t):
    return model_of(t, beta_priors).select("level", *HIERARCHY, "trial", F.round("probability", 6).alias("probability"))


@case("MTH6_posterior_mean", DAILY_SQL + " select p_brand, n_name, round((success + 2) / (trial + 5), 6) as p from leaves")
def _(t):
    leaves = rt.sum_by(daily(t), HIERARCHY)
    return leaves.select(*HIERARCHY, F.round(rt.posterior_mean(F.col("trial"), F.col("success"), F.lit(2.0), F.lit(3.0)), 6).alias("p"))


LOOKUP_SQL = """, probe as (
  select c_custkey, case when c_custkey % 7 = 0 then 'Brand#99' else 'Brand#' || (c_custkey % 25 + 1) end as p_brand,
    case when c_custkey % 5 = 0 then null when c_custkey % 11 = 0 then 'NOWHERE' else n_name end as n_name,
    cast(c_mktsegment = 'BUILDING' as integer) as success
  from customer join nation on c_nationkey = n_nationkey
), looked as (
  select probe.*, coalesce(m2.probability, m1.probability, m0.probability) as p from probe
    left join model m2 on m2.level = 2 and m2.p_brand = probe.p_brand and m2.n_name = probe.n_name
    left join model m1 on m1.level = 1 and m1.p_brand = probe.p_brand
    cross join (select probability from model where level = 0) m0
)"""


def probe(t):
    c = F.col("c_custkey")
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        F.when(c % 7 == 0, "Brand#99").otherwise(F.concat(F.lit("Brand#"), (c % 25 + 1).cast("string"))).alias("p_brand"),
        F.when(c % 5 == 0, F.lit(None)).when(c % 11 == 0, "NOWHERE").otherwise(F.col("n_name")).alias("n_name"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("success"),
    )


@case("JN14_fallback_lookup", DAILY_SQL + PRIOR_SQL + LOOKUP_SQL + " select c_custkey, round(p, 6) as p from looked")
def _(t):
    out = rt.with_probability(probe(t), model_of(t), HIERARCHY, "p")
    return out.select("c_custkey", F.round("p", 6).alias("p"))


@case("EV13_model_metrics", DAILY_SQL + PRIOR_SQL + LOOKUP_SQL + """ select round(avg(case when success = 1 then -ln(greatest(least(p, 1 - 1e-10), 1e-10))
  else -ln(1 - greatest(least(p, 1 - 1e-10), 1e-10)) end), 6) as model_log_loss, round(avg(power(success - p, 2)), 6) as model_mse from looked""")
def _(t):
    out = rt.model_metrics(probe(t), model_of(t), HIERARCHY)
    return out.select(F.round("model_log_loss", 6).alias("model_log_loss"), F.round("model_mse", 6).alias("model_mse"))


TRIAL_SQL = f"""with {LOG_SQL}, trials as (
  select * from good where event = 'contentitem_received' and time >= '2024-01-05' and time <= '2024-01-20'
  qualify row_number() over (partition by message_id order by time, event_id) = 1
), outcome as (
  select message_id, max(time_on_page) as time_on_page from good
  where event = 'contentitem_timeonpage' and time >= '2024-01-05' and time <= '2024-01-22' group by 1
)"""
FROM, TO = date(2024, 1, 5), date(2024, 1, 20)


@case("LD11_trial_notifications", TRIAL_SQL + " select message_id, carrier_name, days as days_from_eula, message_type, device_vendor, strftime(time, '%Y-%m-%d %H:%M:%S') as time from trials")
def _(t):
    out = rt.trial_notifications(event_log(t), FROM, TO)
    return out.withColumns({"time": F.date_format("time", "yyyy-MM-dd HH:mm:ss"), "days_from_eula": F.col("days_from_eula").cast("double")})


@case("LD12_outcomes", TRIAL_SQL + " select message_id, round(time_on_page, 3) as time_on_page from outcome")
def _(t):
    return rt.time_on_page(event_log(t), FROM, TO).withColumn("time_on_page", F.round(F.col("time_on_page").cast("double"), 3))


@case("LATE1_late_outcomes", TRIAL_SQL + """ select strftime(time, '%Y-%m-%d') as day, count(*) as n from good where event = 'contentitem_timeonpage'
  and time >= '2024-01-05' and time <= '2024-01-22' group by 1""")
def _(t):
    from tallyflow.streaming import with_late_outcomes

    rows = log_of(t).where(F.col("event") == "contentitem_timeonpage")
    return with_late_outcomes(rows, "time", FROM, TO).groupBy(F.date_format("time", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


BASE_SQL = TRIAL_SQL + """, base_rows as (
  select * from good where event = 'contentitem_received' and model_id = 'waterfalltoprank' and time >= '2024-01-05' and time <= '2024-01-20'
  qualify row_number() over (partition by message_id order by time, event_id) = 1
), joined as (
  select base_rows.*, cast(coalesce(outcome.time_on_page, 0) >= 3 as integer) as success from base_rows
    left join outcome on base_rows.message_id = outcome.message_id
)"""


@case("LD13_baseline_notifications", BASE_SQL + " select message_id, coalesce(program_name, 'unset') as program_name, installation_source, round(model_p, 4) as waterfall_p from base_rows")
def _(t):
    out = rt.baseline_notifications(event_log(t), FROM, TO)
    return out.select("message_id", "program_name", "installation_source", F.round(F.col("waterfall_p").cast("double"), 4).alias("waterfall_p"))


BINS_SQL = """case when days < 6 then 'a' when days < 12 then 'b' when days < 21 then 'c' when days < 30 then 'd' when days < 45 then 'e'
  when days < 60 then 'f' when days < 80 then 'g' when days < 110 then 'h' when days < 140 then 'i' when days < 180 then 'j'
  when days < 250 then 'k' when days < 350 then 'l' else 'm' end"""


@case("JN9_trials_with_outcomes", TRIAL_SQL + f""" select t.message_id, {BINS_SQL} as days_from_eula_bin, strftime(t.time, '%Y-%m-%d') as receive_date,
  cast(coalesce(o.time_on_page, 0) >= 3 as integer) as success, 1 as trial from trials t left join outcome o using (message_id) where t.days is not null""")
def _(t):
    out = rt.training_rows(event_log(t), FROM, TO)
    return out.select("message_id", "days_from_eula_bin", F.date_format("receive_date", "yyyy-MM-dd").alias("receive_date"), "success", "trial")


@case("MAP5_day_bins", TRIAL_SQL + f" select {BINS_SQL} as bin, count(*) as n from trials where days is not null group by 1")
def _(t):
    items = rt.with_day_bins(rt.trial_notifications(event_log(t), FROM, TO))
    return items.groupBy(F.col("days_from_eula_bin").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@case("MAP6_success_flag", TRIAL_SQL + " select cast(time_on_page >= 3 as integer) as success, count(*) as n from outcome group by 1")
def _(t):
    out = rt.time_on_page(event_log(t), FROM, TO).select(rt.success_flag(F.col("time_on_page")).alias("success"))
    return out.groupBy("success").agg(F.count(F.lit(1)).alias("n"))


@case("EV12_baseline_metrics", BASE_SQL + """, p as (select success, cast(model_p as double) as p from joined where days is not null)
  select round(avg(case when success = 1 then -ln(greatest(least(p, 1 - 1e-10), 1e-10)) else -ln(1 - greatest(least(p, 1 - 1e-10), 1e-10)) end), 5) as baseline_log_loss,
  round(avg(power(success - p, 2)), 5) as baseline_mse from p""")
def _(t):
    log = event_log(t)
    items = rt.with_day_bins(rt.baseline_notifications(log, FROM, TO)).withColumn("waterfall_p", F.col("waterfall_p").cast("double"))
    out = rt.baseline_metrics(rt.with_outcomes(items, rt.time_on_page(log, FROM, TO)))
    return out.select(F.round("baseline_log_loss", 5).alias("baseline_log_loss"), F.round("baseline_mse", 5).alias("baseline_mse"))


@case("JOB3_backtest")
def _(t):
    out = rt.backtest(event_log(t), date(2024, 1, 20), 15, 0.05, ["carrier_name", "days_from_eula_bin"], min_trials=5, min_children=2)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


# separation tests: part type is the document, customer the device
def seen_rows(t, exact=True, metrics=("time_on_page",)):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select(F.col("o_custkey").alias("device_id"), F.col("p_type").alias("message_type"), F.col("l_quantity").alias("time_on_page"), F.col("l_extendedprice").alias("scroll_depth"))
    return sp.with_percentiles(rows, list(metrics), exact=exact)


SEEN_SQL = """rows_ as (
  select o_custkey as device_id, p_type as message_type, l_quantity as time_on_page, l_extendedprice as scroll_depth
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
), med as (
  select message_type, quantile_cont(time_on_page, 0.5) as median_time_on_page, quantile_cont(time_on_page, 0.33) as first_third_time_on_page,
    quantile_cont(time_on_page, 0.67) as last_third_time_on_page from rows_ group by 1
), seen as (
  select device_id as u, message_type as d, count(*) as n, count(*) filter (time_on_page > median_time_on_page) as e
  from rows_ join med using (message_type) group by 1, 2
)"""


@case("WN1_percentiles_per_document", f"with {SEEN_SQL} select message_type, count(*) as n, round(max(median_time_on_page), 6) as median, round(max(first_third_time_on_page), 6) as first_third, round(max(last_third_time_on_page), 6) as last_third from rows_ join med using (message_type) group by 1")
def _(t):
    r = lambda c, n: F.round(F.max(c + "_time_on_page"), 6).alias(n)
    return seen_rows(t).groupBy("message_type").agg(F.count(F.lit(1)).alias("n"), r("median", "median"), r("first_third", "first_third"), r("last_third", "last_third"))


@case("WN1_approximate_percentiles")
def _(t):
    return seen_rows(t, exact=False).groupBy("message_type").agg(F.count(F.lit(1)).alias("n"), F.max("median_time_on_page").alias("median"))


def seen_of(t):
    return sp.per_user_and_document(seen_rows(t), "time_on_page")


GROUP_SQL = """, grp as (
  select a.u, case when la = 1 then 1 else 2 end as group_no from (
    select u, max(cast(d = 'ECONOMY' and e > 0 as integer)) as la, max(cast(d = 'PROMO' and e > 0 as integer)) as lb from seen where d in ('ECONOMY', 'PROMO') group by 1
  ) a where la <> lb
)"""


@case("SEP1_user_groups", f"with {SEEN_SQL} {GROUP_SQL} select u as \"user\", group_no from grp")
def _(t):
    return sp.user_groups(seen_of(t), "ECONOMY", "PROMO")


@case("SEP2_engaged_ratio", f"with {SEEN_SQL} {GROUP_SQL} select group_no, d as message_type, cast(sum(e) as bigint) as sum, cast(sum(n) as bigint) as count, round(sum(e) / sum(n), 6) as engagement_ratio from seen join grp using (u) where d = 'SMALL' group by 1, 2")
def _(t):
    seen = seen_of(t)
    out = sp.engaged_ratio(sp.user_groups(seen, "ECONOMY", "PROMO"), seen, only="SMALL")
    return out.withColumn("engagement_ratio", F.round("engagement_ratio", 6))


@case("JN13_group_users_with_documents", f"with {SEEN_SQL} {GROUP_SQL} select group_no, cast(sum(n) as bigint) as rows_, count(*) as users from seen join grp using (u) group by 1")
def _(t):
    seen = seen_of(t)
    return seen.join(sp.user_groups(seen, "ECONOMY", "PROMO"), "user").groupBy("group_no").agg(F.sum("n").alias("rows_"), F.count(F.lit(1)).alias("users"))


@case("SEP3_out_of_sample", f"with {SEEN_SQL} {GROUP_SQL} select group_no, d as message_type, cast(sum(e) as bigint) as sum, cast(sum(n) as bigint) as count, round(sum(e) / sum(n), 6) as engagement_ratio from seen join grp using (u) where d not in ('ECONOMY','PROMO') group by 1, 2")
def _(t):
    seen = seen_of(t)
    out = sp.engaged_ratio(sp.user_groups(seen, "ECONOMY", "PROMO"), seen, excluded=("ECONOMY", "PROMO"))
    return out.withColumn("engagement_ratio", F.round("engagement_ratio", 6))


PAIRS_SQL = """, docs as (select distinct d from seen), pairs as (select a.d as d1, b.d as d2 from docs a join docs b on a.d < b.d), liked as (
  select d1, d2, u, max(cast(d = d1 and e > 0 as integer)) as la, max(cast(d = d2 and e > 0 as integer)) as lb
  from pairs join seen on d in (d1, d2) group by 1, 2, 3
), sep as (
  select d1, d2, case when la = 1 then 1 else 2 end as group_no, s.d as message_type, cast(sum(e) as bigint) as sum, cast(sum(n) as bigint) as count
  from liked join seen s on s.u = liked.u and s.d <> d1 and s.d <> d2 where la <> lb group by 1, 2, 3, 4
)"""


@case("SEP5_document_pairs", f"with {SEEN_SQL} {PAIRS_SQL} select d1, d2 from pairs")
def _(t):
    return sp.document_pairs(seen_of(t))


@case("JN12_pairs_with_other_documents", f"with {SEEN_SQL} {PAIRS_SQL} select d1, d2, count(distinct message_type) as others from sep group by 1, 2")
def _(t):
    out = sp.separation_test(seen_rows(t), "time_on_page")
    return out.groupBy("d1", "d2").agg(F.countDistinct("message_type").alias("others"))


SEPARATION_SQL = f"with {SEEN_SQL} {PAIRS_SQL} select d1, d2, group_no, 'time_on_page' as metric, message_type, sum, count, round(sum / count, 6) as engagement_ratio from sep"


@case("JOB4_separation_test", SEPARATION_SQL)
def _(t):
    return sp.separation_test(seen_rows(t), "time_on_page").withColumn("engagement_ratio", F.round("engagement_ratio", 6))


@case("SEP4_all_metrics", SEPARATION_SQL + f" union all select * from (with {SEEN_SQL.replace('time_on_page', 'scroll_depth').replace('l_quantity as scroll_depth, l_extendedprice as scroll_depth', 'l_extendedprice as scroll_depth')} {PAIRS_SQL} select d1, d2, group_no, 'scroll_depth' as metric, message_type, sum, count, round(sum / count, 6) as engagement_ratio from sep)")
def _(t):
    metrics = ("time_on_page", "scroll_depth")
    out = sp.separation_tests(seen_rows(t, metrics=metrics), metrics)
    return out.withColumn("engagement_ratio", F.round("engagement_ratio", 6))


@case("SET4_one_plan_union", f"with {SEEN_SQL} {PAIRS_SQL} select group_no, count(*) as rows_, cast(sum(count) as bigint) as total from sep group by 1")
def _(t):
    out = sp.separation_test(seen_rows(t), "time_on_page")
    return out.groupBy("group_no").agg(F.count(F.lit(1)).alias("rows_"), F.sum("count").alias("total"))


RAW_SQL = """raw as (
  select cast(user_id as bigint) as device_id, event_type as message_type,
    case when value > 20 then round(value - 20, 4) else 0 end as time_on_page, case when value > 50 then round(value - 50, 4) else 0 end as scroll_depth
  from events where event_type <> 'error' and event_id % 3 <> 0 and ts >= '2024-01-10')"""
LEVEL_SQL = ", ".join(
    f"round(quantile_cont({c}, {p}), 6) as {n}_{c}" for c in ("time_on_page", "scroll_depth") for n, p in sp.LEVELS.items()
)


@case("JOB5_engagement_raw_data", f"with {RAW_SQL} select device_id, message_type, time_on_page, scroll_depth, l.* exclude (d) from raw join (select message_type as d, {LEVEL_SQL} from raw group by 1) l on d = message_type")
def _(t):
    flat = t.events.select(
        F.col("user_id").alias("device_id"), F.col("event_type").alias("message_type"),
        (F.col("event_type") != "error").cast("int").alias("received"), (F.col("event_id") % 3).cast("int").alias("view"),
        F.round(F.col("value") - 20, 4).alias("time_on_page"), F.round(F.col("value") - 50, 4).alias("scroll_depth"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
    )
    metrics = ["time_on_page", "scroll_depth"]
    rows = sp.raw_rows(t.spark, flat, "2024-01-10").withColumns({m: F.col(m).cast("double") for m in metrics})
    out = sp.with_percentiles(rows.select("device_id", "message_type", *metrics), metrics)
    levels = [f"{n}_{m}" for m in metrics for n in sp.LEVELS]
    return out.withColumns({c: F.round(c, 6) for c in levels})


# segments
def word_counts(t):
    return t.part.groupBy(F.concat(F.lit("topic_"), (F.col("p_size") % 6).cast("string")).alias("message_type")).agg(F.max("p_size").cast("double").alias("word_count"))


SEGMENT_SQL = f"""with {LOG_SQL}, words as (
  select 'topic_' || (p_size % 6) as message_type, cast(max(p_size) as double) as word_count from part group by 1
), scored as (
  select good.*, case event when 'contentitem_received' then 1 when 'contentitem_view' then 1
    when 'contentitem_pagescroll' then scroll_depth / 10.0
    when 'contentitem_timeonpage' then case when time_on_page > 0 and word_count > 0 and time_on_page * 5 / word_count >= 0.1
      then least(ceil(time_on_page * 5 / word_count * 10), 10) else 0 end
    when 'contentitem_click' then case when actionid = 'feedbackmodule' and feedback_value is not null then case when feedback_value then 10 else -15 end
      when actionid in ('feedbackmodule', 'backbutton') then 0 else 1 end
    when 'timeline_onboardingmessage_click' then case when likes_photo then 50 else -75 end else 0 end as score
  from good left join words using (message_type)
), content as (
  select device_id, event, message_type as topic, actionid as action, max(unique_user) as user_id, max(carrier_name) as carrier_name,
    max(device_model) as device_model, cast(max(score) as double) as score from scored
  where event in ('contentitem_received','contentitem_view','contentitem_click','contentitem_timeonpage','contentitem_pagescroll')
    and carrier_name in ('sprint','verizon') and (features like '%camera%' or features like '%video%') and time > '2024-01-02'
  group by 1, 2, 3, 4
), dev as (
  select device_id, max(user_id) filter (event <> 'contentitem_received') as user_id, max(carrier_name) as carrier_name,
    sum(score) filter (event <> 'contentitem_received') as total,
    greatest(coalesce(sum(score) filter (event = 'contentitem_received'), 0), coalesce(sum(score) filter (event = 'contentitem_view'), 0)) as receive
  from content group by 1 having count(*) filter (event <> 'contentitem_received') > 0
), answers as (
  select device_id, unique_user as user_id, carrier_name, cast(score as double) as score, case when score > 0 then 1.0 else 0.0 end as interest from scored
  where event = 'timeline_onboardingmessage_click' and carrier_name in ('sprint','verizon')
  qualify row_number() over (partition by device_id order by time, event_id) = 1
), unioned as (
  select device_id, user_id, carrier_name, case when receive > 0 then round(total / receive) end as score, cast(null as double) as interest from dev
  union all select device_id, user_id, carrier_name, score, cast(interest as double) from answers
), users as (
  select device_id, max(user_id) as user_id, max(carrier_name) as carrier_name, sum(score) as score, max(interest) as interest from unioned group by 1
)"""
SINCE = date(2024, 1, 2)


def content(t):
    return sg.content_scores(event_log(t), word_counts(t), SINCE)


@case("SCO4_event_scores", SEGMENT_SQL + " select device_id, event, topic, action, score from content")
def _(t):
    return content(t).select("device_id", "event", "topic", "action", "score")


@case("AG11_consolidated_attributes", SEGMENT_SQL + " select device_id, event, topic, action, user_id, carrier_name, device_model from content")
def _(t):
    return content(t).select("device_id", "event", "topic", "action", "user_id", "carrier_name", "device_model")


@case("AG10_receive_counts", SEGMENT_SQL + """ select device_id, greatest(coalesce(sum(score) filter (event = 'contentitem_received'), 0),
  coalesce(sum(score) filter (event = 'contentitem_view'), 0)) as receive from content group by 1""")
def _(t):
    return sg.receive_counts(content(t))


@case("LD14_interest_answers", SEGMENT_SQL + " select device_id, user_id, carrier_name, score, cast(interest as double) as interest from answers")
def _(t):
    return sg.interest_answers(event_log(t)).select("device_id", "user_id", "carrier_name", "score", "interest")


@case("SET1_scored_populations", SEGMENT_SQL + " select device_id, user_id, carrier_name, score, interest from users")
def _(t):
    out = sg.consolidate(sg.device_scores(content(t)), sg.interest_answers(event_log(t)))
    return out.select("device_id", "user_id", "carrier_name", "score", "interest")


def id_map(t):
    return t.customer.where("c_acctbal > 0").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("mobileuid"), F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("subid"))


def demographics(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("source_dfx_id"), F.col("n_name").alias("state"), F.col("c_mktsegment").alias("dwelling_type"))


ENRICH_SQL = SEGMENT_SQL + """, app as (select cast(o_custkey as varchar) as dev, count(*) as orders from orders group by 1), ids as (select 'u' || c_custkey as mobileuid, 's' || c_custkey as subid from customer where c_acctbal > 0),
  dgx as (select 's' || c_custkey as source_dfx_id, n_name as state, c_mktsegment as dwelling_type from customer join nation on c_nationkey = n_nationkey)
  select device_id, user_id, score, interest, subid, state, dwelling_type, app.orders as app_orders from users left join ids on user_id = mobileuid
  left join dgx on subid = source_dfx_id left join app on device_id = dev"""


def app_matrix(t):
    return t.orders.groupBy(F.col("o_custkey").cast("string").alias("deviceId")).agg(F.count(F.lit(1)).alias("app_orders"))


@case("JN11_enrichment", ENRICH_SQL)
def _(t):
    users = sg.consolidate(sg.device_scores(content(t)), sg.interest_answers(event_log(t)))
    return sg.enrich(users, id_map(t), demographics(t), app_matrix(t)).select("device_id", "user_id", "score", "interest", "subid", "state", "dwelling_type", "app_orders")


@case("JOB6_segment_dataset", ENRICH_SQL)
def _(t):
    out = sg.segment_dataset(event_log(t), word_counts(t), id_map(t), demographics(t), SINCE, app_matrix(t))
    return out.select("device_id", "user_id", "score", "interest", "subid", "state", "dwelling_type", "app_orders")
