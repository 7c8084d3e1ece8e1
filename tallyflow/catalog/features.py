"""Encodings, screens, splits and click-log preparation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyflow.catalog import case
from tallyflow.catalog.profiling import installs, rounded
from tallyflow.operators import features as fe
from tallyflow.operators import models as md
from tallyflow.operators import profile as pf
from tallyflow.operators import splits as spl
from tallyflow.plans import clicks as ck


@case("FE1_frequency_index", "with d as (select p_brand, row_number() over (order by count(*) desc, p_brand) - 1 as idx from part group by 1) select p_partkey, idx as idx_brand from part join d using (p_brand)")
def _(t):
    return fe.with_index(t.part, "p_brand", fe.frequency_dictionary(t.part, "p_brand"), "idx_brand").select("p_partkey", "idx_brand")


def order_sql(column):
    return f"select {column}, (row_number() over (order by count(*) desc, {column}) - 1)::double as i from part group by 1"


@case("FE1_string_indexer", f"with b as ({order_sql('p_brand')}), y as ({order_sql('p_type')}) select p_partkey, b.i as idx_p_brand, y.i as idx_p_type from part join b using (p_brand) join y using (p_type)")
def _(t):
    cats = ["p_brand", "p_type"]
    return md.indexers(cats).fit(t.part).transform(t.part).select("p_partkey", "idx_p_brand", "idx_p_type")


@case("FE2_one_hot", f"with y as ({order_sql('p_type')}) select p_partkey, list_aggregate(list_transform(range((select count(*) + 1 from y)), lambda k: case when k = i then '1' else '0' end), 'string_agg', '') as slots from part join y using (p_type)")
def _(t):
    stages = [md.indexers(["p_type"]), md.encoders(["p_type"])]
    out = Pipeline(stages=stages).fit(t.part).transform(t.part)
    return out.select("p_partkey", vector_to_array("enc_p_type").alias("v")).select("p_partkey", F.array_join(F.transform("v", lambda x: x.cast("int").cast("string")), "").alias("slots"))


@case("FE2_one_hot_long", "select p_partkey, p_size as \"index\", 1 as value from part")
def _(t):
    return fe.one_hot_long(t.part, "p_partkey", "p_size")


@case("FE3_assembled_vector", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::double as first, l_discount::double as second from lineitem")
def _(t):
    out = md.assembler(["l_quantity", "l_discount"]).transform(t.lineitem)
    v = vector_to_array("features")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", v[0].alias("first"), v[1].alias("second"))


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO"]


@case("FE4_dummies", "select p_partkey, " + ", ".join(f"cast(p_type = '{v}' as integer) as p_type_{v}" for v in TYPES) + " from part")
def _(t):
    return fe.dummies(t.part.select("p_partkey", "p_type"), "p_type", TYPES)


@case("FE5_interactions", "select l_orderkey, l_linenumber, l_partkey, round(l_quantity * l_discount, 6) as l_quantity_l_discount_interaction, round(l_quantity * l_tax, 6) as l_quantity_l_tax_interaction, round(l_discount * l_tax, 6) as l_discount_l_tax_interaction from lineitem")
def _(t):
    out = fe.interactions(t.lineitem, ["l_quantity", "l_discount", "l_tax"])
    made = [c for c in out.columns if c.endswith("_interaction")]
    return rounded(out.select("l_orderkey", "l_linenumber", "l_partkey", *made), *made)


@case("FE6_composites", "select c_custkey, coalesce(case when c_custkey % 3 > 0 then c_mktsegment end, 'unknown') || '_' || c_nationkey as segment_nation from customer")
def _(t):
    rows = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("s"), "c_nationkey")
    return fe.composites(rows, {"segment_nation": ["s", "c_nationkey"]}).select("c_custkey", "segment_nation")


@case("FE7_binary_codes", "select l_orderkey, l_linenumber, l_partkey, cast(l_linestatus = 'O' as integer) as code from lineitem")
def _(t):
    return fe.binary_codes(t.lineitem, "l_linestatus", "code").select("l_orderkey", "l_linenumber", "l_partkey", "code")


@case("FE8_cyclical", "select event_id, round(sin(hour(ts) * 2 * pi() / (select count(distinct hour(ts)) from events)), 8) as hour_sin, round(cos(hour(ts) * 2 * pi() / (select count(distinct hour(ts)) from events)), 8) as hour_cos from events")
def _(t):
    out = fe.cyclical(t.events.select("event_id", F.hour("ts").alias("hour")), "hour")
    return rounded(out.select("event_id", "hour_sin", "hour_cos"), "hour_sin", "hour_cos", places=8)


@case("FE9_category_ids", "select p_partkey, dense_rank() over (order by p_name) - 1 as name_id from part")
def _(t):
    return fe.with_index(t.part, "p_name", fe.sorted_dictionary(t.part, "p_name"), "name_id").select("p_partkey", "name_id")


@case("FE9_embedding_widths", "select c as \"column\", n as cardinality, case when n <= 10 then 3 when n <= 100 then 5 else 10 end as width from (select 'p_type' as c, count(distinct p_type) as n from part union all select 'p_brand', count(distinct p_brand) from part union all select 'p_partkey', count(distinct p_partkey) from part)")
def _(t):
    return fe.embedding_widths(t.part, ["p_type", "p_brand", "p_partkey"])


SLOT_SQL = "('0x' || substr(md5(p_name), 1, 8))::bigint % 200"


@case("FE10_hashed_categories", f"select p_partkey, {SLOT_SQL} as slot, lpad(bin({SLOT_SQL}), 8, '0') as bits from part")
def _(t):
    return t.part.select("p_partkey", fe.hash_index(F.col("p_name"), 200).alias("slot"), fe.hash_bits(F.col("p_name"), 200).alias("bits"))


@case("FE11_varying_columns", "select c as \"column\", round(v, 8) as variance from (select 'l_quantity' as c, var_pop(l_quantity) as v from lineitem union all select 'l_discount', var_pop(l_discount) from lineitem union all select 'l_tax', var_pop(l_tax) from lineitem) where v > 0.0008")
def _(t):
    return rounded(fe.varying_columns(t.lineitem, ["l_quantity", "l_discount", "l_tax"], 0.0008), "variance", places=8)


INSTALLS_SQL = "with d as (select distinct o_custkey as dev, p_brand as app from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey)"


@case("FE11_varying_names", INSTALLS_SQL + " select app, round(p * (1 - p), 8) as variance from (select app, count(*) / (select count(*) from customer) as p from d group by 1) where p * (1 - p) > 0.2")
def _(t):
    return rounded(fe.varying_names(installs(t), t.customer, "dev", "app", 0.2), "variance", places=8)


@case("FE12_min_max", "select l_orderkey, l_linenumber, l_partkey, round((l_quantity - lo) / (hi - lo), 8) as l_quantity from lineitem, (select min(l_quantity) as lo, max(l_quantity) as hi from lineitem)")
def _(t):
    return rounded(fe.min_max(t.lineitem, ["l_quantity"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), "l_quantity", places=8)


def people(t):
    return t.customer.withColumnRenamed("c_custkey", "dev")


@case("FE13_without_preinstalled", INSTALLS_SQL + """, n as (select c_nationkey, count(*) as n from customer group by 1), k as (
  select c_nationkey, app, count(*) as k from d join customer on c_custkey = dev group by 1, 2), top as (
  select c_nationkey, app from k join n using (c_nationkey) where n > 55 and k / n > 0.75)
  select dev, app from d join customer on c_custkey = dev where not exists (select 1 from top where top.c_nationkey = customer.c_nationkey and top.app = d.app)""")
def _(t):
    top = pf.top_by_property(installs(t), people(t), "dev", "c_nationkey", "app", 55, 0.75)
    return fe.without_preinstalled(installs(t), people(t), "dev", "c_nationkey", "app", top).select("dev", "app")


@case("FE14_without_name_tokens", INSTALLS_SQL + " select dev, 'com.' || replace(app, '#', '.') as app from d where split_part(app, '#', 2) not in (select cast(r_regionkey as varchar) from region) and app not like '%21%'")
def _(t):
    named = installs(t).withColumn("app", F.concat(F.lit("com."), F.replace("app", F.lit("#"), F.lit("."))))
    tokens = t.region.select(F.col("r_regionkey").cast("string").alias("token"))
    return fe.without_name_tokens(named, "app", tokens, "token", ["21"]).select("dev", "app")


@case("FE15_usable_rows", INSTALLS_SQL + " select dev, cast(c_mktsegment = 'BUILDING' as integer) as y, app, 1 as v from d join customer on c_custkey = dev where c_acctbal > 0")
def _(t):
    labels = people(t).select("dev", F.when(F.col("c_acctbal") > 0, (F.col("c_mktsegment") == "BUILDING").cast("int")).alias("y"))
    return fe.usable_rows(labels, installs(t).withColumn("v", F.lit(1)), "dev", "y", "app", "v")


SHARE = "(('0x' || substr(md5(cast({k} as varchar)), 1, 8))::bigint / 4294967296.0)"


@case("SPL1_random_split", f"select event_id, case when {SHARE.format(k='event_id')} < 0.6 then 'train' when {SHARE.format(k='event_id')} < 0.8 then 'validate' else 'test' end as part from events")
def _(t):
    return spl.with_part(t.events, ["event_id"], ["train", "validate", "test"], [0.6, 0.2, 0.2]).select("event_id", "part")


@case("SPL2_stratified_split", "select o_orderkey, o_orderstatus, case when row_number() over (partition by o_orderstatus order by md5(cast(o_orderkey as varchar)), o_orderkey) - 1 < floor(count(*) over (partition by o_orderstatus) * 0.3) then 'test' else 'train' end as part from orders")
def _(t):
    return spl.stratified(t.orders, ["o_orderkey"], "o_orderstatus", 0.3).select("o_orderkey", "o_orderstatus", "part")


@case("SPL3_chronological_split", "select o_orderkey, case when row_number() over (order by o_orderdate, o_orderkey) - 1 < floor((select count(*) from orders) * 0.8) then 'train' else 'test' end as part from orders")
def _(t):
    return spl.chronological(t.orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "part")


@case("SPL4_sample_rows", "select event_id from events order by md5(cast(event_id as varchar)), event_id limit 2500")
def _(t):
    return spl.sample_rows(t.events.select("event_id"), ["event_id"], 2500)


@case("SET2_balanced_sample", "select doc_id, quality from labels where quality in (0, 1) qualify row_number() over (partition by quality order by md5(cast(doc_id as varchar)), doc_id) <= 50")
def _(t):
    return spl.balanced(t.labels, ["doc_id"], "quality", 50).select("doc_id", "quality")


@case("SET3_labelled_union", "select item_id as id, text, 1 as label from benchmark union all select doc_id, text, 0 from documents")
def _(t):
    return spl.labelled_union(t.documents.select(F.col("doc_id").alias("id"), "text"), t.benchmark.select(F.col("item_id").alias("id"), "text"))


@case("JOB10_click_preparation", f"""with base as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, p_type, p_brand, cast(l_returnflag = 'R' as integer) as clicks, l_quantity as impressions,
    cast(l_linestatus = 'O' as integer) as code, isodow(l_shipdate) - 1 as dow, p_type || '_' || p_brand as type_brand
  from lineitem join part on l_partkey = p_partkey)
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, dense_rank() over (order by p_type) - 1 as p_type, dense_rank() over (order by type_brand) - 1 as type_brand, code as l_linestatus,
    round(sin(dow * 2 * pi() / 7), 6) as dow_sin, round(cos(dow * 2 * pi() / 7), 6) as dow_cos, clicks, impressions from base""")
def _(t):
    return rounded(ck.prepare(click_rows(t), CLICK_SPEC, keep=CLICK_KEYS), "dow_sin", "dow_cos")


CLICK_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
CLICK_SPEC = ck.ClickSpec(
    categorical=["p_type"], composite={"type_brand": ["p_type", "p_brand"]}, binary=["l_linestatus"], cyclical=["dow"],
    label="clicks", weight="impressions",
)


def click_rows(t):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        *CLICK_KEYS, "p_type", "p_brand", "l_linestatus", F.weekday("l_shipdate").alias("dow"),
        (F.col("l_returnflag") == "R").cast("int").alias("clicks"), F.col("l_quantity").alias("impressions"),
    )


@case("JOB10_category_widths", """with base as (select p_type, p_type || '_' || p_brand as type_brand from lineitem join part on l_partkey = p_partkey),
  n as (select 'p_type' as "column", count(distinct p_type) as categories from base union all select 'type_brand', count(distinct type_brand) from base)
  select *, case when categories <= 10 then 3 when categories <= 100 then 5 else 10 end as width from n""")
def _(t):
    return ck.category_widths(click_rows(t), CLICK_SPEC)


@case("JOB10_part_rates", f"""with base as (select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as id, cast(l_returnflag = 'R' as integer) as clicks, l_quantity as w
    from lineitem join part on l_partkey = p_partkey), parted as (select *, {SHARE.format(k='id')} as u from base)
  select case when u < 0.6 then 'train' when u < 0.8 then 'validation' else 'test' end as part, count(*) as n, round(sum(clicks * w) / sum(w), 9) as rate
  from parted group by 1""")
def _(t):
    rows = click_rows(t).withColumn("id", F.concat_ws("-", *CLICK_KEYS))
    return rounded(ck.part_rates(rows, CLICK_SPEC, ["id"]), "rate", places=9)
