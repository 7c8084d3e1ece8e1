"""One query for each operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm.tables import read_table, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.line_dedup import drop_common_lines

    kept = drop_common_lines(read_table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op1_token_store(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.token_store import read_token_store, write_token_store

    path = scratch_folder(spark)
    write_token_store(read_table(spark, folder, "documents").select("doc_id", "text"), path, end_id=1)
    stored = read_token_store(spark, path)
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.packing import pack_documents

    pieces = pack_documents(read_table(spark, folder, "documents").select("doc_id", "text"), end_id=2)
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.quality import quality_report

    return quality_report(read_table(spark, folder, "documents").select("doc_id", "text", "lang"))


def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.licences import scan_licences

    found = scan_licences(read_table(spark, folder, "documents").select("doc_id", "text"))
    places, base = F.col("phrases.start"), F.col("phrases.label")
    best = F.array_max(F.col("spans.cover"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("spans.label"))), ",").alias("labels"),
        F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
        "spans",
    )


def op10_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.order_minhash import fingerprint_report

    return fingerprint_report(read_table(spark, folder, "documents").select("doc_id", "text"))


def op8_prob_minhash(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.prob_minhash import near_duplicates

    return near_duplicates(read_table(spark, folder, "documents").select("doc_id", "text"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.toxicity import toxicity_scores

    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return toxicity_scores(docs, read_table(spark, folder, "labels"))


def op2_repeats(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.repeats import remove_repeats

    left = remove_repeats(read_table(spark, folder, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
with line as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
  from documents),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from line),
common as (
  select key, max(doc_id) as last from keyed where length(key) >= 40
  group by key having count(distinct doc_id) >= 5),
marked as (
  select k.*, coalesce(k.doc_id < c.last, false) as gone from keyed k left join common c on k.key = c.key)
select doc_id, count(*)::bigint as n_lines, (count(*) filter (where gone))::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.mixing import with_copies, word_count

    docs = read_table(spark, folder, "documents").select("doc_id", "source", word_count().alias("size"))
    return with_copies(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


OP9_SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
totals as (select source, sum(size)::bigint as source_size from sized group by source),
weighted as (
  select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w, source_size * 2 as cap,
         1.5::double * (sum(source_size) over ())::double as budget from totals),
tested as (
  select *, cap * sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following)
    <= (budget - coalesce(sum(cap) over (order by cap / w, source nulls last
                                         rows between unbounded preceding and 1 preceding), 0)) * w as full_
  from weighted),
target as (
  select source, source_size, case when full_ then cap::double else
    (budget - coalesce((sum(cap) filter (where full_) over ())::double, 0)) * w
      / (sum(w) filter (where not full_) over ())::double end as target,
    ('0x' || substr(md5('17/' || coalesce('=' || source, '')), 1, 8))::bigint / 4294967296.0::double as u
  from tested),
classed as (
  select *, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)) as class,
         md5('17:' || coalesce(doc_id::varchar, '')) as key from sized),
parted as (
  select *, ('0x' || substr(key, 1, 8))::bigint % ceil(count(*) over (partition by source, class) / 20000)::bigint as part
  from classed),
ranked as (
  select *, row_number() over (partition by source order by class, part, key, doc_id, size) as rnk from parted),
stepped as (
  select r.*, t.source_size, t.target, t.u,
         case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as step
  from ranked r join target t on r.source is not distinct from t.source)
select doc_id, size, source_size, target, copies * size as taken, copies from (
  select *, least((floor(u + step * rnk) - floor(u + step * (rnk - 1)))::bigint, 2) as copies from stepped)
"""


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.prefix_trie import numbered_turns, prefix_trie
    from tallyflow.llm.tables import staged

    turns = staged(numbered_turns(read_table(spark, folder, "conversations")))
    counts = staged(turns.groupBy("conv_id").agg(F.max("pos").alias("n")))
    return prefix_trie(counts.select("conv_id"), _rebuilt(turns, counts))


def _rebuilt(turns: DataFrame, counts: DataFrame) -> DataFrame:
    """Each conversation's first h = crc32(conv_id) % 9 turns replaced by those of conversation c - c % 5."""
    from tallyflow.llm.tables import staged

    base, head = F.col("conv_id") - F.col("conv_id") % 5, _digest("conv_id") % 9
    lent = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    heads = counts.select("conv_id", base.alias("base"), head.alias("h")).join(lent, "base", "left")
    heads = staged(heads.select("conv_id", "base", "h", F.when(F.col("base_n").isNotNull(), F.least("h", "base_n")).otherwise(0).alias("taken")))
    first = turns.where("pos <= 8").select(F.col("conv_id").alias("base"), "pos", "role", "text")
    borrowed = heads.where("taken > 0").join(first, "base").where("pos <= taken").select("conv_id", "pos", "role", "text")
    rest = turns.where(F.col("pos") > head).join(heads.select("conv_id", "taken"), "conv_id")
    own = rest.select("conv_id", (F.col("pos") - head + F.col("taken")).alias("pos"), "role", "text")
    return staged(borrowed.unionAll(own))


def op13_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.word_runs import with_runs

    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    text = F.when(_digest("doc_id") % 10 == 0, _periodic_tail(F.col("text"), F.floor(_digest("doc_id") / 10))).otherwise(F.col("text"))
    found = with_runs(docs.select("doc_id", text.alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("n"), (-r.start).alias("s"), (-r.period).alias("p"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("_best"), listed.alias("_listed"), "collapsed")
    return rows.select(
        "doc_id",
        "n_runs",
        (-F.col("_best.s")).alias("start"),
        F.col("_best.n").alias("length"),
        (-F.col("_best.p")).alias("period"),
        F.floor(1000 * F.col("_best.n") / -F.col("_best.p")).alias("exponent_milli"),
        F.sha2(F.array_join("_listed", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _digest(id: str) -> Column:
    """Unsigned crc32 of the decimal id; null for a null id."""
    return F.crc32(F.col(id).cast("string"))


def _periodic_tail(text: Column, g: Column) -> Column:
    """Each word i >= a becomes word a + (i - a) % p; a = g % n, p = 1 + floor((n - a) / (3 + g % 8))."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    # lambdas over arrays of one element bind the words and each number once
    def joined(s: Column) -> Column:
        return F.array_join(F.transform(s.w, lambda w, i: F.when(i < s.a, w).otherwise(F.get(s.w, (s.a + (i - s.a) % s.p).cast("int")))), " ")

    sized = F.transform(F.array(F.struct(words.alias("w"), g.alias("g"))), lambda s: F.struct(s.w.alias("w"), s.g.alias("g"), F.size(s.w).alias("n")))
    begun = F.transform(sized, lambda s: F.struct(s.w.alias("w"), s.g.alias("g"), s.n.alias("n"), (s.g % F.greatest(s.n, F.lit(1))).alias("a")))
    ready = F.transform(begun, lambda s: F.struct(s.w.alias("w"), s.a.alias("a"), (1 + F.floor((s.n - s.a) / (3 + s.g % 8))).alias("p")))
    return F.get(F.transform(ready, joined), 0)


def op11_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    from tallyflow.llm.host_reputation import judged

    pages = judged(read_table(spark, folder, "pages").select("page_id", "url"))
    rates = [F.round(c, 6).alias(c) for c in ("bad_rate", "bad_low")]
    return pages.select("page_id", "host", "path", "rule", "verdict", *rates)


def _weighed(rows: str, name: str) -> str:
    """SQL of one level: the prior's weight by moments, bounded by the size of what it comes from."""
    return f"""
{name}_w as (
  select *, n * above as e, n * above * (1 - above) as v from {rows}),
{name} as (
  select *, (bad + w * above) / (n + w) as rate, n + w as weight from (
    select *, least(greatest(coalesce(1 / nullif((
      select greatest(sum((bad - e) * (bad - e) - v), 0) / nullif(sum((n - 1) * v), 0) from {name}_w), 0) - 1, size), 1), size) as w
    from {name}_w))"""


OP11_SQL = f"""
with split as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as t from pages),
page as (
  select page_id, coalesce(translate(regexp_extract(t, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(t, '^[^/?#]*([^?#]*)', 1), '') as path from split),
ruled as (
  select *, case
    when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
    when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/' end as rule
  from page),
known as (
  select *, case when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 1 when rule is not null then 0 end as bad from ruled),
host as (
  select host, split_part(host, '.', -1) as suffix, array_to_string(string_split(host, '.')[-2:], '.') as domain,
         count(bad) as n, coalesce(sum(bad), 0) as bad from known group by host),
suffixes as (
  select suffix, sum(n) as n, sum(bad) as bad, (select (sum(bad) + 1) / (sum(n) + 2) from host) as above,
         (select sum(n) + 2.0::double from host) as size from host group by suffix),{_weighed("suffixes", "suffix_rate")},
domains as (
  select h.suffix, h.domain, sum(h.n) as n, sum(h.bad) as bad, any_value(s.rate) as above, any_value(s.weight) as size
  from host h join suffix_rate s using (suffix) group by h.suffix, h.domain),{_weighed("domains", "domain_rate")},
hosts as (
  select h.*, d.rate as above, d.weight as size from host h join domain_rate d using (suffix, domain)),{_weighed("hosts", "host_rate")},
bound as (
  select host, rate, greatest(rate - sqrt(9.0::double * rate * (1 - rate) / (weight + 1)), 0) as low from host_rate)
select page_id, host, path, rule, round(rate, 6) as bad_rate, round(low, 6) as bad_low,
       case when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 'block' when rule is not null then 'allow'
            when round(low, 9) > 0.5 then 'block' else 'allow' end as verdict
from known join bound using (host)
"""


OP12_SQL = """
with turn as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) as pos
  from conversations where conv_id is not null),
conv as (
  select conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 9 as h
  from (select distinct conv_id from turn)),
head as (
  select c.conv_id, t.pos, t.role, t.text from conv c join turn t on t.conv_id = c.conv_id - c.conv_id % 5 and t.pos <= c.h),
rebuilt as (
  select * from head
  union all
  select c.conv_id, t.pos - c.h + (select count(*) from head h where h.conv_id = c.conv_id), t.role, t.text
  from conv c join turn t on t.conv_id = c.conv_id and t.pos > c.h),
place as (
  select conv_id, pos as depth, strlen(text) as n_bytes,
         list(strlen(role)::varchar || ':' || role || text || '/' || strlen(text)::varchar) over (partition by conv_id order by pos) as key
  from rebuilt
  union all select conv_id, 0, 0, [] from conv),
node as (
  select key, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(n_bytes) as n_bytes from place group by key, depth),
named as (
  select p.conv_id as member, p.depth, n.conv_id from place p join node n on p.key = n.key and p.depth = n.depth),
linked as (
  select n.*, a.conv_id as parent_conv_id from node n left join named a on a.member = n.conv_id and a.depth = n.depth - 1),
kids as (select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n_children from linked where depth > 0 group by 1, 2),
full_node as (
  select l.*, coalesce(k.n_children, 0) as n_children from linked l left join kids k on l.conv_id = k.conv_id and l.depth = k.depth),
total as (
  select a.conv_id, a.depth, sum((n.n_children = 0)::int)::bigint as n_leaves, sum((n.n_convs - 1) * n.n_bytes)::bigint as saved_tokens
  from full_node n join named a on a.member = n.conv_id and a.depth <= n.depth group by 1, 2),
ended as (
  select a.conv_id, a.depth, string_agg(a.member::varchar, ',' order by a.member) as ids
  from named a join (select conv_id, max(depth) as depth from place group by 1) e on a.member = e.conv_id and a.depth = e.depth group by 1, 2)
select n.conv_id, n.depth::bigint as depth, n.parent_conv_id, n.n_convs, n.n_children::bigint as n_children, t.n_leaves, t.saved_tokens,
       sha256(coalesce(e.ids, '')) as ends_sha256
from full_node n join total t on n.conv_id = t.conv_id and n.depth = t.depth
left join ended e on n.conv_id = e.conv_id and n.depth = e.depth
"""


QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_token_store": (op1_token_store, None),
    "op2_repeats": (op2_repeats, None),
    "op7_packing": (op7_packing, None),
    "op3_toxicity": (op3_toxicity, None),
    "op4_line_dedup": (op4_line_dedup, OP4_SQL),
    "op5_quality": (op5_quality, None),
    "op6_licences": (op6_licences, None),
    "op8_prob_minhash": (op8_prob_minhash, None),
    "op9_mixing": (op9_mixing, OP9_SQL),
    "op10_order_minhash": (op10_order_minhash, None),
    "op11_host_reputation": (op11_host_reputation, OP11_SQL),
    "op12_prefix_trie": (op12_prefix_trie, OP12_SQL),
    "op13_word_runs": (op13_word_runs, None),
}
