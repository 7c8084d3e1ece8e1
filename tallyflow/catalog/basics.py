"""Sources, sinks, schemas, filters and projections."""

from __future__ import annotations

import os
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.catalog import Tables, case
from tallyflow.catalog.adapters import LOG_SQL, event_log
from tallyflow.functions import mapping as mp
from tallyflow.session import shared_folder
from tallyflow.operators import cleaning as cl
from tallyflow.sources import readers as rd
from tallyflow.sources import schemas as sm
from tallyflow.sources import sinks as sk


def scratch(t: Tables) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(t.spark)}/tallyflow-{os.urandom(6).hex()}"


@case("SRC1_table_scan", "select n_nationkey, n_name, n_regionkey from nation")
def _(t):
    t.nation.createOrReplaceTempView("tallyflow_nation")
    return rd.read_table(t.spark, "tallyflow_nation")


@case("SRC2_parquet_scan", "select o_orderkey, o_totalprice from orders")
def _(t):
    return rd.read_parquet(t.spark, t.path("orders")).select("o_orderkey", "o_totalprice")


@case("SRC3_json_devices", "select user_id, min(event_id) as event_id, arg_min(event_type, event_id) as event_type from events group by 1")
def _(t):
    path = scratch(t) + "/json"
    sk.write_json(t.events.select("user_id", "event_id", "event_type"), path)
    return rd.read_json_devices(t.spark, path, "user_id bigint, event_id bigint, event_type string", "user_id", ["event_id"])


@case("SRC4_csv_typed", "select device, max(metric) as best, count(*) filter (metric > 9.5) as above from (select l_suppkey as device, l_quantity as metric from lineitem) group by 1")
def _(t):
    path = scratch(t) + "/csv"
    sk.write_csv_gzip(t.lineitem.select(F.col("l_suppkey").alias("device"), F.col("l_quantity").alias("metric")), path)
    rows = rd.read_csv(t.spark, path, "device bigint, metric double")
    return rows.groupBy("device").agg(F.max("metric").alias("best"), F.count_if(F.col("metric") > 9.5).alias("above"))


@case("SRC5_delimited", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as at, value from events")
def _(t):
    path = scratch(t) + "/tsv"
    rows = t.events.select("event_id", F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("at"), "value")
    rows.write.csv(path, sep="\t", compression="gzip")
    out = rd.read_delimited(t.spark, path, "id bigint, at timestamp, value double", timestamp_format="dd/MM/yyyy HH:mm:ss")
    return out.toDF("event_id", "at", "value").withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))


@case("SRC6_csv_folder_with_converters", "select c_custkey, case c_mktsegment when 'BUILDING' then 1.0::double when 'MACHINERY' then 0.0::double end as segment, case when c_custkey % 2 = 0 then 21.0::double end as age_range from customer")
def _(t):
    path = scratch(t) + "/csv"
    rows = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.when(F.col("c_custkey") % 2 == 0, "A: 18-24 years old").otherwise("?").alias("age_range"))
    rows.repartition(3).write.csv(path, header=True)
    converters = {"segment": lambda c: mp.two_values(c, "BUILDING", "MACHINERY"), "age_range": lambda c: mp.midpoint(c, mp.AGE)}
    return rd.read_csv_with(t.spark, path, "c_custkey bigint, segment string, age_range string", converters)


@case("SRC7_incremental_window", "select strftime(max(cast(ts as date)) + 1, '%Y-%m-%d') as first, strftime(date '2024-02-10' - 1, '%Y-%m-%d') as last from events")
def _(t):
    newest = rd.latest_partition(t.events.select(F.to_date("ts").alias("date")))
    first, last = rd.incremental_window(F.col("latest"), F.lit(date(2024, 2, 10)))
    return newest.select(F.date_format(first, "yyyy-MM-dd").alias("first"), F.date_format(last, "yyyy-MM-dd").alias("last"))


JOB_TEXT = """
    |select event_type, count(*) as n, round(sum(value), 4) as total
    |from {events}
    |where ts >= :from_date
    |group by event_type"""


@case("SRC8_sql_job", "select event_type, count(*) as n, round(sum(value), 4) as total from events where ts >= '2024-01-15' group by 1")
def _(t):
    return rd.sql_job(t.spark, JOB_TEXT, {"from_date": date(2024, 1, 15)}, {"events": t.events})


@case("SEP6_query_text", "select event_type, count(*) as n, round(sum(value), 4) as total from events where ts >= '2024-01-25' group by 1")
def _(t):
    assert "|" not in rd.strip_margin(JOB_TEXT)
    return rd.sql_job(t.spark, JOB_TEXT, {"from_date": date(2024, 1, 25)}, {"events": t.events})


BY_DAY_SQL = "select strftime(ts, '%Y-%m-%d') as date, count(*) as n, round(sum(value), 4) as total from events group by 1"


def by_day(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


def dated(t):
    return t.events.select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("date"))


@case("SNK1_partitioned_parquet", BY_DAY_SQL)
def _(t):
    path = scratch(t) + "/days"
    sk.write_partitioned(dated(t), path)
    # a rerun of some days replaces only these days
    sk.write_partitioned(dated(t).where("date >= '2024-01-20'"), path, mode="overwrite")
    return by_day(t.spark.read.schema("event_id bigint, value double, date string").parquet(path))


@case("SNK2_plain_parquet", BY_DAY_SQL)
def _(t):
    path = scratch(t) + "/plain"
    sk.write_parquet(dated(t), path)
    return by_day(t.spark.read.parquet(path))


@case("SNK3_json_lines", BY_DAY_SQL)
def _(t):
    path = scratch(t) + "/json"
    sk.write_json(dated(t), path)
    return by_day(t.spark.read.schema("event_id bigint, value double, date string").json(path))


@case("SNK4_gzip_csv", "select event_type, count(*) as n, min(event_id) as first from events group by 1")
def _(t):
    path = scratch(t) + "/csv"
    sk.write_csv_by(t.events.select("event_id", "event_type"), path, "event_type")
    kinds = [r["event_type"] for r in t.events.select("event_type").distinct().collect()]
    rows = [rd.read_csv(t.spark, f"{path}/event_type={k}", "event_id bigint").withColumn("event_type", F.lit(k)) for k in kinds]
    both = reduce(DataFrame.unionByName, rows)
    return both.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))


@case("SNK5_publish_rate_model")
def _(t):
    from tallyflow.catalog.engagement import model_of

    path = scratch(t) + "/model"
    sk.publish_rate_model(model_of(t), path, {"days_back": 30, "smoothing_factor": 0.001, "hierarchy": "p_brand,n_name"})
    meta = t.spark.read.parquet(path + "/metadata")
    nodes = t.spark.read.parquet(path + "/nodes").groupBy("level").agg(F.count(F.lit(1)).alias("nodes"))
    return nodes.withColumn("hierarchy", meta.select("hierarchy").scalar())


EXAMPLE = {"event_id": 1, "value": 1.0, "event_type": "a", "missing": "x", "nested": {"b": [1], "a": True}}


@case("SCH1_schema_from_example", "select cast(null as varchar) as a_b_kind, event_id from events")
def _(t):
    schema = sm.schema_from_example(EXAMPLE)
    out = sm.conform(t.events, schema)
    return out.select(F.col("nested.a").cast("string").alias("a_b_kind"), "event_id")


@case("SCH2_conform", "select event_id, value, event_type, cast(null as varchar) as missing from events")
def _(t):
    example = {k: v for k, v in EXAMPLE.items() if k != "nested"}
    return sm.conform(t.events, sm.schema_from_example(example))


@case("SCH3_empty_frame", "select event_type, value from events")
def _(t):
    empty = sm.empty_frame(t.spark, sm.schema_from_example({"event_type": "a", "value": 1.0}))
    return empty.unionByName(t.events.select("event_type", "value"))


@case("SCH4_nested_json", "select event_id, cast(json_extract_string(props, '$.k') as integer) as k, false as flag from events")
def _(t):
    parsed = sm.parse_json(F.col("props"), "k int, flag boolean", strict=True)
    return t.events.select("event_id", parsed.alias("p")).select("event_id", "p.k", F.coalesce("p.flag", F.lit(False)).alias("flag"))


@case("SCH5_json_paths", f"with {LOG_SQL} select device_id, round(sum(time_on_page), 4) as total from log where event = 'contentitem_timeonpage' group by 1")
def _(t):
    rows = event_log(t).where(F.col("event") == "contentitem_timeonpage")
    field = lambda k: sm.payload_field(F.col("properties"), k)
    return rows.groupBy(field("deviceid").alias("device_id")).agg(F.round(F.sum(field("timeonpage").cast("double")), 4).alias("total"))


@case("FLT1_event_kinds", "select event_id, event_type from events where event_type in ('click', 'view')")
def _(t):
    return cl.of_kind(t.events, ["click", "view"], "event_type").select("event_id", "event_type")


@case("FLT2_time_range", "select event_id from events where ts >= '2024-01-05' and ts < '2024-01-10'")
def _(t):
    return cl.between(t.events, "ts", date(2024, 1, 5), date(2024, 1, 10), closed=False).select("event_id")


@case("FLT3_partition_predicate", "select o_orderstatus, count(*) as n from orders where o_orderstatus in ('F', 'O') group by 1")
def _(t):
    path = scratch(t) + "/parts"
    sk.write_partitioned(t.orders, path, "o_orderstatus")
    rows = t.spark.read.parquet(path).where(F.col("o_orderstatus").isin("F", "O"))
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@case("FLT4_without_tests", f"with {LOG_SQL} select event, count(*) as n from good group by 1")
def _(t):
    flag = sm.payload_field(F.col("properties"), "istest").try_cast("boolean")
    return cl.without_tests(event_log(t), flag).groupBy("event").agg(F.count(F.lit(1)).alias("n"))


@case("FLT5_required_keys", f"with {LOG_SQL} select event, count(*) as n from log where days is not null and program_name is not null group by 1")
def _(t):
    return cl.having(event_log(t), "daysfromeulaapproval", "programname").groupBy("event").agg(F.count(F.lit(1)).alias("n"))


@case("FLT6_substring_predicate", "select p_partkey from part where p_name like '%ring%' or p_name like '%bolt%'")
def _(t):
    return t.part.where(cl.mentions_any(F.col("p_name"), ["ring", "bolt"])).select("p_partkey")


@case("FLT8_lower_bound", "select p_partkey, p_size from part where p_size > 40")
def _(t):
    return cl.greater_than(t.part.select("p_partkey", "p_size"), "p_size", 40)


@case("FLT9_dedup_by_key", "select o_custkey, o_orderkey, o_orderstatus from orders qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1")
def _(t):
    return cl.first_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")


@case("FLT9_distinct_rows", "select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def _(t):
    return cl.distinct_rows(t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber"))


HOLES_SQL = "holes as (select event_id, nullif(user_id % 7, 0) as u, case when event_id % 4 > 0 then value end as v, case when event_id % 3 > 0 then event_type end as kind from events)"


def holes(t):
    e = F.col("event_id")
    return t.events.select(
        "event_id", F.when(F.col("user_id") % 7 != 0, F.col("user_id") % 7).alias("u"),
        F.when(e % 4 > 0, F.col("value")).alias("v"), F.when(e % 3 > 0, F.col("event_type")).alias("kind"),
    )


@case("FLT10_drop_nulls", f"with {HOLES_SQL} select event_id from holes where v is not null and kind is not null")
def _(t):
    return cl.drop_nulls(holes(t), ["v", "kind"]).select("event_id")


@case("FLT11_exclude_list", f"with {HOLES_SQL} select event_id, kind from holes where kind is null or kind not in ('click', 'error')")
def _(t):
    return cl.exclude(holes(t), "kind", ["click", "error"]).select("event_id", "kind")


@case("FLT12_within_three_sigmas", "select event_id from events, (select avg(value) as m, stddev_pop(value) as s from events) where abs((value - m) / s) < 3")
def _(t):
    return cl.within_sigmas(t.events, ["value"]).select("event_id")


@case("FLT13_compound_predicate", "select l_orderkey, l_linenumber, l_partkey from lineitem where l_tax = 0 and l_quantity > 5")
def _(t):
    return t.lineitem.where((F.col("l_tax") == 0) & (F.col("l_quantity") > 5)).select("l_orderkey", "l_linenumber", "l_partkey")


@case("FLT14_class_subset", "select l_linenumber, count(*) as n, round(avg(l_quantity), 6) as q from lineitem where l_returnflag = 'R' group by 1")
def _(t):
    return t.lineitem.where(F.col("l_returnflag") == "R").groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("l_quantity"), 6).alias("q"))


@case("PRJ1_fill_nulls", f"with {HOLES_SQL} select event_id, coalesce(u, 0) as u, coalesce(v, 0) as v, coalesce(kind, 'unset') as kind from holes")
def _(t):
    return cl.fill_strings(cl.fill(holes(t), {"u": 0, "v": 0.0}))


@case("PRJ2_unknown_to_null", "select doc_id, case when doc_id % 4 = 0 or doc_id % 4 = 1 then null else lang end as lang from documents")
def _(t):
    raw = F.when(F.col("doc_id") % 4 == 0, "an Unknown one").when(F.col("doc_id") % 4 == 1, "").otherwise(F.col("lang"))
    return t.documents.select("doc_id", mp.unknown_to_null(raw).alias("lang"))


@case("PRJ3_clamp_at_zero", "select c_custkey, case when c_acctbal > 0 then c_acctbal else 0 end as balance from customer")
def _(t):
    return t.customer.select("c_custkey", mp.positive_or_zero(F.col("c_acctbal")).alias("balance"))


@case("PRJ4_derived_columns", "select l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / l_quantity, 9) as ratio, round(l_extendedprice * l_discount, 6) as product, case when l_tax > 0 then round(l_discount / l_tax, 6) end as safe from lineitem")
def _(t):
    c = F.col
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.try_divide("l_extendedprice", "l_quantity"), 9).alias("ratio"),
        F.round(c("l_extendedprice") * c("l_discount"), 6).alias("product"), F.round(F.try_divide("l_discount", "l_tax"), 6).alias("safe"),
    )


@case("PRJ5_reshape", "select 0 as month_1, n_name as state, n_nationkey from nation")
def _(t):
    return cl.reshape(t.nation, {"n_name": "state"}, ["n_regionkey"], ["month_1"], ["month_1", "state", "n_nationkey"])


@case("JN8_group_counts", "select p_partkey, count(*) over (partition by p_brand) as count from part")
def _(t):
    return cl.with_group_count(t.part, ["p_brand"]).select("p_partkey", "count")


@case("MAP3_minority_by_count", "select p_partkey, case when count(*) over (partition by p_brand) < 80 then 'MinorityCategory' else p_brand end as p_brand from part")
def _(t):
    return cl.minority_by_count(t.part, "p_brand", 80).select("p_partkey", "p_brand")


@case("MAP4_minority_by_share", "select p_partkey, case when count(*) over (partition by p_brand) / (select count(*) from part) <= 0.039 then 'minority' else p_brand end as p_brand, case when count(*) over (partition by p_size) / (select count(*) from part) <= 0.02 then 'minority' else cast(p_size as varchar) end as p_size from part")
def _(t):
    return cl.minority_by_share(t.part, ["p_brand", "p_size"], 0.02).select("p_partkey", "p_size").join(
        cl.minority_by_share(t.part, ["p_brand"], 0.039).select("p_partkey", "p_brand"), "p_partkey"
    )


@case("ARR3_struct_pairs", "select p_brand, cast(sum(p_size) as bigint) as trial, max(p_size) as success, count(*) as n from part group by 1")
def _(t):
    pair = F.struct(F.col("p_size").alias("trial"), F.col("p_size").alias("success"))
    rows = t.part.withColumn("pair", pair)
    return rows.groupBy("p_brand").agg(F.sum(F.col("pair")["trial"]).alias("trial"), F.max(F.col("pair").getField("success")).alias("success"), F.sum(F.size(F.array("pair"))).alias("n"))
