"""Texts: short-text features, similarity, close strings and buckets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyflow.catalog import case
from tallyflow.catalog.profiling import rounded
from tallyflow.functions import text as tx
from tallyflow.operators import clustering as cu
from tallyflow.operators import neighbours as nb
from tallyflow.operators import similarity as sm
from tallyflow.operators.splits import hash_share
from tallyflow.plans import alerts as al
from tallyflow.session import staged


def q(text: str) -> str:
    return text.replace("'", "''")


FEATURE_SQL = f"""select doc_id, length(text) as tweet_length, len(regexp_extract_all(text, '{q(tx.HASHTAG)}')) as num_of_hashtags,
  len(regexp_extract_all(text, '{q(tx.MENTION)}')) as num_of_user_tags, cast(regexp_matches(text, '{q(tx.CURRENCY)}') as integer) as got_money_sign,
  len(regexp_extract_all(text, '!')) as exclamation_mark_count, len(regexp_extract_all(text, '\\?')) as question_mark_count,
  len(regexp_extract_all(text, '{q(tx.EMOJI)}')) as num_of_emojis from documents"""


@case("STR9_short_text_features", FEATURE_SQL)
def _(t):
    return t.documents.select("doc_id", *[c.alias(n) for n, c in tx.short_text_features(F.col("text")).items() if n != "got_link"])


@case("STR8_links_and_tags", f"select page_id, cast(regexp_matches(html, '{q(tx.LINK)}') as integer) as got_link, len(regexp_extract_all(html, '{q(tx.MENTION)}')) as num_of_user_tags, len(regexp_extract_all(html, '{q(tx.HASHTAG)}')) as num_of_hashtags from pages")
def _(t):
    made = tx.short_text_features(F.col("html"))
    return t.pages.select("page_id", *[made[n].alias(n) for n in ("got_link", "num_of_user_tags", "num_of_hashtags")])


@case("STR10_tokens", f"select doc_id, len(regexp_extract_all(text, '{q(tx.TOKEN)}')) as n, md5(array_to_string(regexp_extract_all(text, '{q(tx.TOKEN)}'), ' ')) as digest from documents")
def _(t):
    found = tx.tokens(F.col("text"))
    return t.documents.select("doc_id", F.size(found).alias("n"), F.md5(F.array_join(found, " ")).alias("digest"))


STOPS = "[" + ", ".join(f"'{q(w)}'" for w in tx.STOP_WORDS) + "]"


def clean_sql(text: str) -> str:
    kept = f"array_to_string(list_filter(regexp_split_to_array(lower({text}), '\\s+'), lambda x: not list_contains({STOPS}, x)), ' ')"
    return f"trim(regexp_replace({kept}, '[^a-z]+', ' ', 'g'))"


@case("STR11_clean_description", f"select doc_id, md5({clean_sql('text')}) as digest from documents")
def _(t):
    return t.documents.select("doc_id", F.md5(tx.clean_description(F.col("text"))).alias("digest"))


TF_SQL = f"""with c as (select doc_id, {clean_sql('text')} as text from documents), w as (
  select doc_id, unnest(string_split(text, ' ')) as token from c), n as (select doc_id, token, count(*) as n from w where token <> '' group by 1, 2),
  tf as (select doc_id, token, n / sum(n) over (partition by doc_id) as tf from n),
  idf as (select token, case when length(token) > 1 and not list_contains({STOPS}, token) then count(*) else 0 end as df from tf group by 1),
  vec as (select doc_id, token, tf * (ln((1 + (select count(*) from documents)) / (1 + df)) + 1) as weight from tf join idf using (token))"""


@case("SIM1_term_frequencies", TF_SQL + " select doc_id, count(*) as tokens, round(max(tf), 8) as top_tf from tf group by 1")
def _(t):
    tf = sm.term_frequencies(t.documents, "doc_id", "text")
    return rounded(tf.groupBy("doc_id").agg(F.count(F.lit(1)).alias("tokens"), F.max("tf").alias("top_tf")), "top_tf", places=8)


@case("SIM2_tf_idf", TF_SQL + " select doc_id, token, round(weight, 8) as weight from vec")
def _(t):
    return rounded(sm.tf_idf(t.documents, "doc_id", "text"), "weight", places=8)


BUCKET_SQL = "cast(('0x' || substr(md5(token), 1, 8))::bigint % 900 as varchar)"


@case("SIM3_hashed_vectors", TF_SQL + f" select doc_id, {BUCKET_SQL} as token, round(sum(weight), 8) as weight from vec group by 1, 2")
def _(t):
    return rounded(sm.hashed(sm.tf_idf(t.documents, "doc_id", "text"), "doc_id"), "weight", places=8)


PAIR_SQL = TF_SQL.replace("from documents), w as", "from documents), first as (select text, min(doc_id) as doc_id, count(*) as copies from c group by 1), w as").replace(
    "as token from c)", "as token from first)").replace(
    "then count(*) else 0 end as df from tf group by 1", "then sum(copies) else 0 end as df from tf join first using (doc_id) group by 1") + """,
  u as (select doc_id, token, weight / sqrt(sum(weight * weight) over (partition by doc_id)) as weight from vec),
  s as (select a.doc_id as a, b.doc_id as b, sum(a.weight * b.weight) as similarity from u a join u b on a.token = b.token and a.doc_id < b.doc_id group by 1, 2)"""  # fmt: skip


def one_per_text(t):
    return sm.distinct_texts(t.documents, "doc_id", "text")


# pairs of equal texts are those of one representative
@case("SIM4_text_members", TF_SQL.split(", w as (")[0] + " select doc_id, min(doc_id) over (partition by text) as representative, count(*) over (partition by text) as copies from c")
def _(t):
    return sm.text_members(t.documents, "doc_id", "text")


@case("SIM4_similar_pairs", PAIR_SQL + """ select a, b, round(similarity, 6) as similarity, x.copies as a_copies, y.copies as b_copies
  from s join first x on x.doc_id = a join first y on y.doc_id = b where similarity >= 0.7""")
def _(t):
    items = staged(one_per_text(t))
    vectors = sm.unit(sm.tf_idf(items, "doc_id", "text", cleaned=True, copies="copies"), "doc_id")
    pairs = sm.similar_pairs(vectors, "doc_id", 0.7, items.select("doc_id", "copies"))
    return rounded(pairs, "similarity").select("b", "a", "similarity", "a_copies", "b_copies")


BENCH_SQL = TF_SQL.replace("from documents), w as", "from (select 'd' || doc_id as doc_id, text from documents union all select 'b' || item_id, text from benchmark)), w as").replace(
    "(select count(*) from documents)", "(select count(*) from c)") + """,
  u as (select doc_id, token, weight / sqrt(sum(weight * weight) over (partition by doc_id)) as weight from vec),
  s as (select a.doc_id as query, b.doc_id as item, round(sum(a.weight * b.weight), 9) as similarity from u a join u b on a.token = b.token where a.doc_id like 'b%' group by 1, 2)
  select query, item, row_number() over (partition by query order by similarity desc, item) as rank, round(similarity, 6) as similarity from s
  qualify row_number() over (partition by query order by similarity desc, item) <= 5"""  # fmt: skip


def corpus(t):
    return t.documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("item"), "text").unionByName(
        t.benchmark.select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("item"), "text")
    )


def queries_of(t):
    return t.benchmark.select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("query"))


@case("ORD3_most_similar_items", BENCH_SQL)
def _(t):
    vectors = sm.unit(sm.tf_idf(corpus(t), "item", "text"), "item")
    out = sm.most_similar(vectors, queries_of(t), "item", 5)
    return rounded(out.select("query", "item", "rank", "similarity"), "similarity")


@case("JOB9_similar_descriptions", BENCH_SQL.replace("sum(weight * weight) over (partition by doc_id)) as weight from vec)", f"sum(weight * weight) over (partition by doc_id)) as weight from (select doc_id, {BUCKET_SQL} as token, sum(weight) as weight from vec group by 1, 2))"))
def _(t):
    vectors = sm.unit(sm.hashed(sm.tf_idf(corpus(t), "item", "text"), "item"), "item")
    return rounded(sm.most_similar(vectors, queries_of(t), "item", 5).select("query", "item", "rank", "similarity"), "similarity")


CLOSE_SQL = """select a.s as a, b.s as b, levenshtein(a.s, b.s) as distance from (select distinct p_name as s from part union select distinct p_brand from part) a
  join (select distinct p_name as s from part union select distinct p_brand from part) b on a.s < b.s and levenshtein(a.s, b.s) <= 2"""


def names(t):
    return t.part.select(F.col("p_name").alias("s")).union(t.part.select("p_brand"))


@case("JN16_close_strings", CLOSE_SQL)
def _(t):
    return sm.close_strings(names(t), "s", 2)


@case("JN16_distance_three", CLOSE_SQL.replace("<= 2", "<= 3"))
def _(t):
    return sm.close_strings(names(t), "s", 3)


@case("CLU1_exemplar_buckets")
def _(t):
    return cu.cluster_numbers(cu.string_exemplars(t.part.select("p_type"), "p_type", 6))


@case("CLU1_string_buckets")
def _(t):
    return cu.cluster_numbers(cu.components(names(t), sm.close_strings(names(t), "s", 1)))


@case("CLU2_k_means_sweep")
def _(t):
    rows = t.part.select(F.col("p_size").cast("double").alias("x"), (F.col("p_retailprice") / 50).alias("y"))
    return rounded(cu.k_means_sweep(rows, ["x", "y"], al.TRIED_GROUPS), "calinski_harabasz", places=3)


def halves(t):
    rows = t.embeddings.withColumn("_u", hash_share("vec_id"))
    return rows.where("_u < 0.8").drop("_u"), rows.where("_u >= 0.8").drop("_u")


@case("MOD7_knn_regression", """with e as (select vec_id, embedding::double[] as v, label, (('0x' || substr(md5(cast(vec_id as varchar)), 1, 8))::bigint / 4294967296.0) as u from embeddings),
  d as (select a.vec_id as query, b.label, row_number() over (partition by a.vec_id order by list_distance(a.v, b.v), b.vec_id) as r from e a join e b on a.u >= 0.8 and b.u < 0.8)
  select query, avg(label) as prediction from d where r <= 5 group by 1""")
def _(t):
    train, test = halves(t)
    return nb.knn_regression(train, test, "vec_id", "embedding", "label")


def alerts(t):
    host = F.concat(F.lit("srv"), F.col("user_id").cast("string"), F.lit(".com"))
    return t.events.select(F.col("ts").alias("time"), host.alias("host"), F.col("event_type").alias("type"))


@case("JOB12_alert_grouping")
def _(t):
    return al.grouped(alerts(t), distance=4).groupBy("type", "combined_cluster_id", "prediction").agg(F.count(F.lit(1)).alias("n"))


@case("JOB12_group_sweep")
def _(t):
    return rounded(al.group_sweep(alerts(t), distance=4), "calinski_harabasz", places=3)


@case("JOB12_frequent_runs", """with a as (select cast(ts as date) as d, hour(ts) as h, regexp_replace('srv' || user_id || '.com', '[0-9]+', '', 'g') as host, event_type as type, min(ts) as t from events group by 1, 2, 3, 4),
  n as (select host || '_' || type as x, row_number() over (order by d, h, t, host || '_' || type) as i from a),
  r as (select n1.x || ' > ' || n2.x || ' > ' || n3.x || ' > ' || n4.x || ' > ' || n5.x || ' > ' || n6.x as gram from n n1 join n n2 on n2.i = n1.i + 1 join n n3 on n3.i = n1.i + 2
    join n n4 on n4.i = n1.i + 3 join n n5 on n5.i = n1.i + 4 join n n6 on n6.i = n1.i + 5)
  select gram, count(*) as cnt from r group by 1 order by cnt desc, gram limit 10""")
def _(t):
    return al.frequent_runs(alerts(t))
