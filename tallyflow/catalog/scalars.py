"""Scalar functions on table columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyflow.catalog import case
from tallyflow.functions import dates as d
from tallyflow.functions import mapping as mp
from tallyflow.functions import maths as m
from tallyflow.functions import scoring as sc
from tallyflow.functions import text as tx

def some_text():
    """Timestamp text with empty and unreadable values among it."""
    good = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return F.when(F.col("event_id") % 9 == 0, "").when(F.col("event_id") % 9 == 1, "no date").otherwise(good)


SOME_SQL = "case when event_id % 9 = 0 then '' when event_id % 9 = 1 then 'no date' else strftime(ts, '%Y-%m-%d %H:%M:%S') end"


@case("DT1_weekday_hour", "select event_id, case when event_id % 9 > 1 then isodow(ts) - 1 end as weekday, case when event_id % 9 > 1 then hour(ts) end as hour from events")
def _(t):
    weekday, hour = d.weekday_and_hour(some_text())
    return t.events.select("event_id", weekday.alias("weekday"), hour.alias("hour"))


@case("DT2_epoch_millis", "select event_id, case when event_id % 9 > 1 then cast(epoch(date_trunc('second', ts)) as bigint) * 1000 end as ms from events")
def _(t):
    return t.events.select("event_id", d.epoch_millis(some_text()).alias("ms"))


@case("DT3_date_text", "select event_id, case when event_id % 9 = 0 then '' when event_id % 9 > 1 then strftime(ts, '%Y-%m-%d') end as day from events")
def _(t):
    return t.events.select("event_id", d.date_text(some_text()).alias("day"))


@case("DT4_calendar_spines", """select h.hour, lpad(cast(h.hour as varchar), 2, '0') as hour_label, w.weekday, count(event_id) as n
  from (select cast(range as integer) as hour from range(24)) h, (select cast(range as integer) as weekday from range(7)) w
  left join events on hour(ts) = h.hour and isodow(ts) - 1 = w.weekday group by 1, 2, 3""")
def _(t):
    counts = t.events.groupBy(F.hour("ts").alias("hour"), F.weekday("ts").alias("weekday")).agg(F.count(F.lit(1)).alias("n"))
    days = F.explode(F.sequence(F.lit(0), F.lit(6))).alias("weekday")
    spine = d.hour_spine(t.spark).select("*", days)
    return spine.join(counts, ["hour", "weekday"], "left").na.fill(0)


@case("DT5_days_back", "select event_id, strftime(cast(ts as date) - 14, '%Y-%m-%d') as back, strftime(cast(ts as date) - 34, '%Y-%m-%d') as first, strftime(cast(ts as date) - 4, '%Y-%m-%d') as last from events")
def _(t):
    day = F.to_date("ts")
    first, last = d.training_window(None, 30, day)
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    return t.events.select("event_id", text(d.days_back(day, 14)).alias("back"), text(first).alias("first"), text(last).alias("last"))


@case("DT6_zone_time", "select event_id, strftime(ts + interval 2 hour, '%Y-%m-%d %H:%M:%S') as local from events")
def _(t):
    return t.events.select("event_id", F.date_format(d.zone_time(F.col("ts").cast("timestamp"), "+02:00"), "yyyy-MM-dd HH:mm:ss").alias("local"))


@case("DT7_calendar_parts", "select event_id, hour(ts) as hour, month(ts) as month, dayname(ts) as day_name, hour(ts) * 100 + minute(ts) as hour_minute, epoch_us(ts) as epoch_micros, isodow(ts) - 1 as weekday from events")
def _(t):
    parts = d.calendar_parts(F.col("ts"))
    return t.events.select("event_id", *[c.alias(n) for n, c in parts.items()])


@case("DT8_season", "select case when month(o_orderdate) between 3 and 5 then 'Spring' when month(o_orderdate) between 6 and 8 then 'Summer' when month(o_orderdate) between 9 and 11 then 'Autumn' else 'Winter' end as season, count(*) as n from orders group by 1")
def _(t):
    return t.orders.groupBy(d.season(F.month("o_orderdate")).alias("season")).agg(F.count(F.lit(1)).alias("n"))


SERVICE_SQL = "with s as (select o_custkey, cast(min(o_orderdate) as date) as a, cast(max(o_orderdate) as date) as b from orders group by 1)"


def service(t):
    return t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))


@case("DT9_churned", SERVICE_SQL + " select o_custkey, date_diff('day', a, b) as days, cast(date_diff('day', a, b) < 1500 as integer) as churned from s")
def _(t):
    return service(t).select("o_custkey", F.datediff("b", "a").alias("days"), d.churned(F.col("a"), F.col("b"), 1500).alias("churned"))


@case("DT10_horizon_labels", SERVICE_SQL + ", q as (select o_custkey, round_even(date_diff('day', a, b) / 30.4, 0) + 1 as m from s) select o_custkey, " + ", ".join(f"cast(m <= {k * 6} as integer) as month_{k * 6}" for k in range(1, 13)) + " from q")
def _(t):
    days = F.datediff("b", "a")
    return service(t).select("o_custkey", *[d.horizon_label(days, 6 * k).alias(f"month_{6 * k}") for k in range(1, 13)])


def number_text():
    return F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("event_id").cast("string"))


@case("STR1_to_list", "select doc_id, len(string_split(text, ',')) as n from documents")
def _(t):
    return t.documents.select("doc_id", F.size(tx.to_list(F.col("text"))).alias("n"))


@case("STR2_safe_numbers", "select event_id, case when event_id % 5 <> 0 then event_id end as whole, case when event_id % 7 <> 0 then value end as real_ from events")
def _(t):
    real = F.when(F.col("event_id") % 7 == 0, "x").otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", tx.to_int(number_text()).alias("whole"), tx.to_float(real).alias("real_"))


@case("STR3_to_bool", "select event_id, case event_id % 3 when 0 then true when 1 then false end as flag from events")
def _(t):
    text = F.when(F.col("event_id") % 3 == 0, "True").when(F.col("event_id") % 3 == 1, "FALSE").otherwise("maybe")
    return t.events.select("event_id", tx.to_bool(text, strict=False).alias("flag"))


@case("STR5_keyword_flags", "select event_id, cast(contains(lower(event_type), 'click') as integer) as click_related, cast(contains(lower(event_type), 'view') as integer) as view_related, cast(contains(lower(event_type), 'err') as integer) as err_related from events")
def _(t):
    return t.events.select("event_id", *[c.alias(n) for n, c in tx.keyword_flags(F.upper("event_type"), ["click", "view", "err"]).items()])


@case("STR6_host_texts", "select page_id, regexp_replace(url, '[0-9]', '', 'g') as host, cast(regexp_matches(url, '(?i).com') as integer) as com, regexp_replace(url, '[0-9]', '', 'g') || '_' || page_id as combined from pages")
def _(t):
    host = tx.without_digits(F.col("url"))
    return t.pages.select("page_id", host.alias("host"), tx.has_any_com(F.col("url")).alias("com"), F.concat_ws("_", host, F.col("page_id").cast("string")).alias("combined"))


@case("STR7_email_domain", "select c_custkey, split_part(lower(c_name) || '@mail' || c_nationkey || '.org', '@', 2) as domain from customer")
def _(t):
    return t.customer.select("c_custkey", tx.email_domain(F.concat(F.lower("c_name"), F.lit("@mail"), F.col("c_nationkey").cast("string"), F.lit(".org"))).alias("domain"))


@case("MTH1_log_loss", "select l_returnflag, round(avg(case when l_linestatus = 'F' then -ln(greatest(least(l_discount, 1 - 1e-14), 1e-14)) else -ln(1 - greatest(least(l_discount, 1 - 1e-14), 1e-14)) end), 6) as loss from lineitem group by 1")
def _(t):
    y = (F.col("l_linestatus") == "F").cast("int")
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.avg(m.log_loss(F.col("l_discount"), y)), 6).alias("loss"))


@case("MTH2_margin_of_error", "select p_brand, round(sqrt(q * (1 - q)) * 1.959963984540054 / sqrt(n), 8) as margin from (select p_brand, avg(cast(p_type = 'PROMO' as integer)) as q, count(*) as n from part group by 1)")
def _(t):
    q = t.part.groupBy("p_brand").agg(F.avg((F.col("p_type") == "PROMO").cast("int")).alias("q"), F.count(F.lit(1)).alias("n"))
    return q.select("p_brand", F.round(m.margin_of_error(F.col("q"), F.col("n")), 8).alias("margin"))


@case("MTH3_binomial_likelihood", "select l_orderkey, l_linenumber, l_partkey, round(exp(lgamma(l_quantity + 1) - lgamma(l_linenumber + 1) - lgamma(l_quantity - l_linenumber + 1) + l_linenumber * ln(0.3) + (l_quantity - l_linenumber) * ln(0.7)), 7) as likelihood from lineitem where l_quantity >= l_linenumber")
def _(t):
    rows = t.lineitem.where("l_quantity >= l_linenumber")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.round(m.binomial_likelihood(F.lit(0.3), F.col("l_quantity"), F.col("l_linenumber")), 7).alias("likelihood"))


@case("MTH7_beta_moments", "select p_brand, round(a / (a + b), 8) as mean, round(a * b / ((a + b) * (a + b) * (a + b + 1)), 8) as variance from (select p_brand, count(*) filter (p_size > 25) + 1.0 as a, count(*) filter (p_size <= 25) + 1.0 as b from part group by 1)")
def _(t):
    ab = t.part.groupBy("p_brand").agg((F.count_if(F.col("p_size") > 25) + 1.0).alias("a"), (F.count_if(F.col("p_size") <= 25) + 1.0).alias("b"))
    a, b = F.col("a"), F.col("b")
    return ab.select("p_brand", F.round(m.beta_mean(a, b), 8).alias("mean"), F.round(m.beta_variance(a, b), 8).alias("variance"))


@case("MTH8_squared_error", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(power(l_discount - l_tax, 2), 8) as se from lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(m.squared_error(F.col("l_tax"), F.col("l_discount")), 8).alias("se"))


@case("MAP1_two_values", "select c_custkey, case c_mktsegment when 'BUILDING' then 1.0::double when 'MACHINERY' then 0.0::double end as flag from customer")
def _(t):
    return t.customer.select("c_custkey", mp.two_values(F.col("c_mktsegment"), "BUILDING", "MACHINERY").alias("flag"))


def label_table(table):
    return "map {" + ", ".join(f"'{k}': {v}::double" for k, v in table.items()) + "}"


def label_names(table):
    return [*table, "Z: unknown"]


def range_sql():
    parts = []
    for name, table in mp.RANGE_LABELS.items():
        names = label_names(table)
        listed = "[" + ", ".join(f"'{n}'" for n in names) + f"][c_custkey % {len(names)} + 1]"
        parts.append(f"{label_table(table)}[{listed}] as {name}")
    return "select c_custkey, " + ", ".join(parts) + " from customer"


@case("MAP2_range_midpoints", range_sql())
def _(t):
    made = []
    for name, table in mp.RANGE_LABELS.items():
        names = label_names(table)
        label = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("c_custkey") % len(names) + 1).cast("int"))
        made.append(mp.midpoint(label, table).alias(name))
    return t.customer.select("c_custkey", *made)


@case("SCO1_scroll_score", "select event_id, [2.5, 5.0, 7.5, 10.0, 0.0][event_id % 5 + 1]::double as score from events")
def _(t):
    texts = F.array(*[F.lit(x) for x in ("25", "50.0", "75", "100", "110")])
    depth = F.element_at(texts, (F.col("event_id") % 5 + 1).cast("int"))
    return t.events.select("event_id", sc.scroll_score(depth).alias("score"))


@case("SCO2_reading_score", "select event_id, cast(case when value * 5 / w >= 0.1 and value > 0 then least(ceil(value * 5 / w * 10), 10) else 0 end as double) as score from (select *, event_id % 400 + 40 as w from events)")
def _(t):
    return t.events.select("event_id", sc.reading_score(F.col("value"), F.col("event_id") % 400 + 40).alias("score"))


@case("SCO3_feedback_and_interest", "select event_id, case when event_id % 2 = 0 then 10.0::double else -15.0::double end as feedback, case when event_id % 3 = 0 then 50.0::double else -75.0::double end as interest from events")
def _(t):
    picked = F.when(F.col("event_id") % 3 == 0, F.array(F.lit("music"), F.lit("photography"))).otherwise(F.array(F.lit("music")))
    return t.events.select("event_id", sc.feedback_score(F.col("event_id") % 2 == 0).alias("feedback"), sc.interest_score(picked).alias("interest"))
