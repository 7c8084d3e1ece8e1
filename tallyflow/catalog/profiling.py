"""Aggregations, distributions, order statistics and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyflow.catalog import case
from tallyflow.functions.text import TOKEN, keyword_flags
from tallyflow.operators import marginals as mg
from tallyflow.operators import profile as pf
from tallyflow.operators.ordering import exact_quantiles
from tallyflow.operators.skyline import frontier


def rounded(df, *names, places=6):
    return df.withColumns({n: F.round(n, places) for n in names})


def returned(t):
    return t.lineitem.withColumn("y", (F.col("l_returnflag") == "R").cast("int"))


Y = "cast(l_returnflag = 'R' as integer)"


@case("AG1_value_counts", "select p_type, count(*) as cnt from part group by 1")
def _(t):
    return pf.value_counts(t.part, "p_type")


@case("AG2_rates", f"select l_linenumber, count(*) as cnt, cast(sum({Y}) as bigint) as pos, round(avg({Y}), 6) as rate from lineitem group by 1 having count(*) / (select count(*) from lineitem) >= 0.14")
def _(t):
    return rounded(pf.rates_by(returned(t), "l_linenumber", "y", 0.14), "rate")


@case("AG12_distinct_counts", "select 'p_brand' as \"column\", count(distinct p_brand) as cardinality from part union all select 'p_type', count(distinct p_type) from part union all select 'p_size', count(distinct p_size) from part union all select 'p_name', count(distinct p_name) from part")
def _(t):
    return pf.distinct_counts(t.part, ["p_brand", "p_type", "p_size", "p_name"])


@case("AG12_approximate_distinct_counts")
def _(t):
    return pf.approximate_distinct_counts(t.lineitem, ["l_orderkey", "l_partkey", "l_suppkey"])


@case("AG13_column_stats", "select round(sum(l_extendedprice), 2) as sum, round(avg(l_extendedprice), 6) as mean, round(stddev_samp(l_extendedprice), 6) as stddev from lineitem")
def _(t):
    return rounded(rounded(pf.column_stats(t.lineitem, "l_extendedprice"), "mean", "stddev"), "sum", places=2)


@case("MTH4_min_observations", "select cast(trunc(1.959963984540054 * 1.959963984540054 * s * (1 - s) / 0.0025) as bigint) as min_observations from (select stddev_samp(l_discount) as s from lineitem)")
def _(t):
    return pf.min_observations(t.lineitem, "l_discount", 0.05)


@case("AG15_first_time", "select strftime(ts, '%Y-%m-%d') as day, hour(ts) as hour, user_id, event_type, epoch_us(min(ts)) as first_time from events group by 1, 2, 3, 4")
def _(t):
    rows = t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.hour("ts").alias("hour"), "user_id", "event_type", "ts")
    return pf.first_time(rows, ["day", "hour", "user_id", "event_type"], "ts").withColumn("first_time", F.unix_micros(F.col("first_time").cast("timestamp")))


@case("AG16_monthly_mean", "select strftime(date_trunc('month', day), '%Y-%m-%d') as month, round(avg(m), 4) as mean from (select cast(o_orderdate as date) as day, avg(o_totalprice) as m from orders group by 1) group by 1")
def _(t):
    out = pf.monthly_mean_of_daily_means(t.orders, "o_orderdate", "o_totalprice", every_month=True)
    return rounded(out.withColumn("month", F.date_format("month", "yyyy-MM-dd")), "mean", places=4)


@case("AG17_mean_by_dimension", "select c_mktsegment, round(avg(c_acctbal), 6) as mean from customer group by 1")
def _(t):
    return rounded(pf.mean_by(t.customer, "c_mktsegment", "c_acctbal"), "mean")


@case("AG18_shares", "select lang, count(*) as cnt, round(count(*) / (select count(*) from documents), 8) as share from documents where lang is not null group by 1")
def _(t):
    return rounded(pf.shares(t.documents, "lang"), "share", places=8)


@case("AG18_shares_within", "select source, lang, count(*) as cnt, round(count(*) / sum(count(*)) over (partition by source), 8) as share from documents where lang is not null group by 1, 2")
def _(t):
    return rounded(pf.shares(t.documents, "lang", ["source"]), "share", places=8)


@case("AG19_row_totals", "select l_orderkey, round(sum(l_quantity), 4) as total from lineitem group by 1")
def _(t):
    return rounded(pf.row_totals(t.lineitem, "l_orderkey", "l_quantity"), "total", places=4)


def summary_sql(c):
    return (
        f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as stddev, min({c}) as min, max({c}) as max, "
        f"round(quantile_cont({c}, 0.25), 6) as q25, round(quantile_cont({c}, 0.5), 6) as q50, round(quantile_cont({c}, 0.75), 6) as q75 from lineitem"
    )


@case("AG20_summary", " union all ".join(summary_sql(c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def _(t):
    return rounded(pf.summary(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]), "mean", "stddev", "q25", "q50", "q75")


@case("AG21_null_counts", "with h as (select event_id, case when event_id % 4 > 0 then value end as v from events) select 'event_id' as \"column\", count(*) - count(event_id) as nulls, round((count(*) - count(event_id)) / count(*), 8) as share from h union all select 'v', count(*) - count(v), round((count(*) - count(v)) / count(*), 8) from h")
def _(t):
    rows = t.events.select("event_id", F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("v"))
    return rounded(pf.null_counts(rows), "share", places=8)


@case("AG22_distinct_values", "select distinct 'p_brand' as \"column\", p_brand as value from part union select distinct 'p_type', p_type from part")
def _(t):
    return pf.distinct_values(t.part, ["p_brand", "p_type"])


NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@case("AG23_correlations", " union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 8) as r from lineitem" for i, a in enumerate(NUM) for b in NUM[i + 1 :]))
def _(t):
    return rounded(pf.correlations(t.lineitem, NUM), "r", places=8)


@case("AG24_histogram", f"""with s as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem), b as (
  select {Y} as y, cast(least(floor((l_extendedprice - lo) * 20 / (hi - lo)), 19) as integer) as bin, (hi - lo) / 20 as w from lineitem, s)
  select y, bin, count(*) as n, round(count(*) / (sum(count(*)) over (partition by y) * max(w)), 10) as density from b group by 1, 2""")
def _(t):
    return rounded(pf.histogram(returned(t), "l_extendedprice", 20, ["y"]), "density", places=10)


@case("AG25_weighted_rate", f"select round(sum({Y} * l_quantity) / sum(l_quantity), 8) as rate from lineitem")
def _(t):
    return rounded(pf.weighted_rate(returned(t), "y", "l_quantity"), "rate", places=8)


@case("AG28_token_counts", f"""select token, count(*) as cnt from (select unnest(regexp_extract_all(text, '{TOKEN.replace("'", "''")}')) as token from documents)
  group by 1 order by cnt desc, token limit 20""")
def _(t):
    return pf.token_counts(t.documents, "text", 20)


@case("AG29_gram_counts", """with s as (select event_id, ts, event_type, lead(event_type, 1) over w as b, lead(event_type, 2) over w as c, lead(event_type, 3) over w as d,
  lead(event_type, 4) over w as e, lead(event_type, 5) over w as f from events window w as (order by ts, event_id))
  select event_type || ' > ' || b || ' > ' || c || ' > ' || d || ' > ' || e || ' > ' || f as gram, count(*) as cnt from s where f is not null group by 1""")
def _(t):
    return pf.gram_counts(t.events, "event_type", ["ts", "event_id"], 6)


@case("AG29_gram_counts_per_user", """with s as (select event_type, lead(event_type, 1) over w as b, lead(event_type, 2) over w as c from events window w as (partition by user_id order by ts, event_id))
  select event_type || ' > ' || b || ' > ' || c as gram, count(*) as cnt from s where c is not null group by 1""")
def _(t):
    return pf.gram_counts(t.events, "event_type", ["ts", "event_id"], 3, ["user_id"])


@case("AG30_flag_sums", "select hour(ts) as hour, cast(sum(cast(contains(event_type, 'click') as integer)) as bigint) as click_related_sum, cast(sum(cast(contains(event_type, 'error') as integer)) as bigint) as error_related_sum from events group by 1")
def _(t):
    rows = t.events.select(F.hour("ts").alias("hour"), "event_type")
    return pf.flag_sums(rows, "hour", keyword_flags(F.col("event_type"), ["click", "error"]))


def cells(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select("p_brand", F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("nation"), "l_quantity", "l_extendedprice")


CELLS_SQL = "with c as (select p_brand, 'N' || s_nationkey as nation, l_quantity, l_extendedprice from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey)"
DIMS = ("p_brand", "nation")


@case("AG31_marginal_totals", CELLS_SQL + " select 'p_brand' as dim, p_brand as value, round(sum(l_quantity), 4) as total from c group by 2 union all select 'nation', nation, round(sum(l_quantity), 4) from c group by 2")
def _(t):
    return rounded(mg.marginal_totals(cells(t), DIMS, "l_quantity"), "total", places=4)


@case("LAT1_latent_weights")
def _(t):
    targets = mg.marginal_totals(cells(t), DIMS, "l_extendedprice")
    return rounded(mg.fit_weights(cells(t), DIMS, "l_quantity", targets), "weight", places=4)


@case("LAT2_reconciliation", CELLS_SQL + " select 'p_brand' as dim, count(distinct p_brand) as \"values\", cast(0 as bigint) as mismatches from c union all select 'nation', count(distinct nation), 0 from c")
def _(t):
    grouped = cells(t).groupBy(*DIMS).agg(F.sum("l_quantity").alias("l_quantity"), F.sum("l_extendedprice").alias("l_extendedprice"))
    targets = mg.marginal_totals(grouped, DIMS, "l_extendedprice")
    weights = mg.fit_weights(grouped, DIMS, "l_quantity", targets)
    out = mg.reconciliation(mg.fitted_totals(grouped, DIMS, "l_quantity", weights), targets)
    return out.select("dim", "values", "mismatches")


@case("WN4_frontier", """with b as (select p_size as x, p_retailprice as y, count(*) as copies from part group by 1, 2)
  select x, y, copies from b where not exists (select 1 from b o where (o.x > b.x and o.y > b.y) or (o.x = b.x and o.y > b.y))""")
def _(t):
    return frontier(t.part, "p_size", "p_retailprice")


@case("ORD1_global_sort", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders")
def _(t):
    return t.orders.orderBy("o_orderdate", "o_orderkey").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@case("ORD2_top_k", "select l_partkey, count(*) as n from lineitem group by 1 order by n desc, l_partkey limit 20")
def _(t):
    return pf.top_k(t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), "l_partkey"], 20)


@case("JN15_ratio_merge", "select p_partkey, round(count(*) over (partition by p_type) / (select count(*) from part), 8) as p_type_ratio from part")
def _(t):
    return rounded(pf.share_of_value(t.part, "p_type").select("p_partkey", "p_type_ratio"), "p_type_ratio", places=8)


@case("EV14_rate_variance", f"""with r as (select 'l_linenumber' as "column", cast(l_linenumber as varchar) as v, avg({Y}) as rate from lineitem group by 2
  union all select 'l_linestatus', l_linestatus, avg({Y}) from lineitem group by 2)
  select "column", round(var_pop(rate), 10) as rate_variance, count(*) as "values" from r group by 1""")
def _(t):
    return rounded(pf.rate_variance(returned(t), ["l_linenumber", "l_linestatus"], "y"), "rate_variance", places=10)


@case("JOB14_categorical_profile", f"""with r as (select 'l_linenumber' as "column", cast(l_linenumber as varchar) as value, {Y} as y from lineitem
  union all select 'l_linestatus', l_linestatus, {Y} from lineitem), g as (
  select "column", value, count(*) as cnt, cast(sum(y) as bigint) as pos, avg(y) as rate from r group by 1, 2)
  select "column", value, cnt, pos, round(cnt / (select count(*) from lineitem), 8) as share, round(rate, 8) as rate,
    round(sqrt(rate * (1 - rate)) * 1.959963984540054 / sqrt(cnt), 8) as margin from g""")
def _(t):
    return rounded(pf.categorical_profile(returned(t), ["l_linenumber", "l_linestatus"], "y"), "share", "rate", "margin", places=8)


@case("AG26_top_by_property", """with d as (select distinct o_custkey as dev, p_brand as app from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey),
  n as (select c_nationkey, count(*) as n from customer group by 1 having count(*) > 55),
  k as (select c_nationkey, app, count(*) as k from d join customer on c_custkey = dev group by 1, 2)
  select c_nationkey, app, round(k / n, 8) as share from k join n using (c_nationkey) where k / n > 0.75""")
def _(t):
    return rounded(pf.top_by_property(installs(t), t.customer.withColumnRenamed("c_custkey", "dev"), "dev", "c_nationkey", "app", 55, 0.75), "share", places=8)


def installs(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(F.col("o_custkey").alias("dev"), F.col("p_brand").alias("app")).distinct()


@case("AG20_exact_quantiles", "select l_returnflag, p, round(case p when 0.05 then quantile_cont(l_extendedprice, 0.05) when 0.5 then quantile_cont(l_extendedprice, 0.5) else quantile_cont(l_extendedprice, 0.95) end, 6) as q from lineitem, (select unnest([0.05, 0.5, 0.95])::double as p) group by 1, 2")
def _(t):
    return rounded(exact_quantiles(t.lineitem, "l_extendedprice", [0.05, 0.5, 0.95], ["l_returnflag"]), "q")
