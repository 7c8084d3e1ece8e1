"""Model metrics over scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyflow.catalog import case
from tallyflow.catalog.profiling import rounded
from tallyflow.operators import evaluation as ev

S_SQL = "with s as (select l_quantity / 100 + l_discount * 4 as score, cast(l_returnflag = 'R' as integer) as label, l_quantity as weight, l_orderkey * 10 + l_linenumber as id from lineitem)"


def scored(t, weighted=False):
    label = (F.col("l_returnflag") == "R").cast("int")
    score = F.col("l_quantity") / 100 + F.col("l_discount") * 4
    return ev.scored(t.lineitem, score, label, F.col("l_quantity") if weighted else None)


@case("EV1_score_label_pairs", S_SQL + " select round(score, 6) as score, cast(label as double) as label from s")
def _(t):
    return rounded(scored(t).select("score", "label"), "score")


AUC_SQL = """, g as (select score, sum(label * {w}) as pos, sum((1 - label) * {w}) as neg from s group by 1),
  c as (select *, sum(neg) over (order by score rows unbounded preceding) - neg as before from g)
  select round(sum(pos * (before + neg / 2)) / (sum(pos) * sum(neg)), 8) as auc from c"""


@case("EV2_roc_auc", S_SQL + AUC_SQL.format(w="1.0"))
def _(t):
    return rounded(ev.roc_auc(scored(t)), "auc", places=8)


@case("EV2_weighted_roc_auc", S_SQL + AUC_SQL.format(w="weight"))
def _(t):
    return rounded(ev.roc_auc(scored(t, True)), "auc", places=8)


@case("EV3_calibration", S_SQL + " select round(sum(score) / sum(label), 8) as calibration from s")
def _(t):
    return rounded(ev.calibration(scored(t)), "calibration", places=8)


@case("EV3_weighted_inverse_calibration", S_SQL + " select round(sum(label * weight) / sum(score * weight), 8) as calibration from s")
def _(t):
    return rounded(ev.calibration(scored(t, True), "actual_over_predicted"), "calibration", places=8)


@case("EV4_errors", S_SQL + " select round(avg(power(score - label, 2)), 8) as mse, round(sqrt(avg(power(score - label, 2))), 8) as rmse, round(avg(case when label = 1 then -ln(greatest(least(score, 1 - 1e-14), 1e-14)) else -ln(1 - greatest(least(score, 1 - 1e-14), 1e-14)) end), 8) as log_loss from s")
def _(t):
    return rounded(ev.errors(scored(t)), "mse", "rmse", "log_loss", places=8)


@case("EV5_confusion", S_SQL + " select label, cast(round_even(score, 0) as integer) as pred, count(*) as n from s group by 1, 2")
def _(t):
    return ev.confusion(scored(t))


@case("EV5_accuracy", S_SQL + " select round(avg(cast(round_even(score, 0) = label as integer)), 8) as accuracy from s")
def _(t):
    return rounded(ev.accuracy(scored(t)), "accuracy", places=8)


PR_SQL = """, g as (select score, sum(label) as pos, count(*) as n from s group by 1), c as (
  select score, pos, sum(pos) over (order by score desc rows unbounded preceding) as tp, sum(n) over (order by score desc rows unbounded preceding) as k, sum(pos) over () as p from g
), curve as (select score as threshold, tp / k as precision, tp / p as recall, pos / p as step from c)"""


@case("EV6_pr_curve", S_SQL + PR_SQL + " select round(threshold, 8) as threshold, round(precision, 8) as precision, round(recall, 8) as recall from curve")
def _(t):
    return rounded(ev.pr_curve(scored(t)).drop("step"), "threshold", "precision", "recall", places=8)


@case("EV6_average_precision", S_SQL + PR_SQL + " select round(sum(precision * step), 8) as average_precision from curve")
def _(t):
    return rounded(ev.average_precision(scored(t)), "average_precision", places=8)


@case("EV7_best_f1", S_SQL + PR_SQL + " select round(threshold, 8) as threshold, round(2 * precision * recall / (precision + recall), 8) as f1 from curve order by 2 * precision * recall / (precision + recall) desc, threshold limit 1")
def _(t):
    return rounded(ev.best_f1(scored(t)).select("threshold", "f1"), "threshold", "f1", places=8)


@case("EV7_class_report", S_SQL + """, p as (select label, cast(score > 0.4 as integer) as pred from s), m as (
  select k as class, count(*) filter (label = k and pred = k) as tp, count(*) filter (pred = k) as pp, count(*) filter (label = k) as support from p, (select unnest([0, 1]) as k) group by 1)
  select class, round(tp / pp, 8) as precision, round(tp / support, 8) as recall, round(2 * (tp / pp) * (tp / support) / (tp / pp + tp / support), 8) as f1, cast(support as double) as support from m""")
def _(t):
    return rounded(ev.class_report(scored(t), F.lit(0.4)), "precision", "recall", "f1", places=8)


@case("EV8_reliability", S_SQL + """, e as (select cast(range as integer) as b, (range - 1) / 10.0::double as lo, range / 10.0::double as hi from range(1, 11))
  select b as bin, round(avg(score), 8) as mean_predicted, round(avg(label), 8) as true_fraction, count(*) as n from s join e on score > lo and score <= hi group by 1 having sum(label) > 0""")
def _(t):
    return rounded(ev.reliability(scored(t), 10), "mean_predicted", "true_fraction", places=8)


@case("EV9_quantile_bins", S_SQL + """, e as (select cast(range as integer) as i, quantile_cont(score, range / 20.0) as q from s, range(0, 21) group by range),
  b as (select score, label, (select count(*) from e where q < score) as bin from s)
  select cast(bin as integer) as bin, round(avg(label), 8) as label, round(avg(score), 8) as pred, count(*) as n from b where bin > 0 group by 1""".replace(
    "select cast(range as integer) as i, quantile_cont(score, range / 20.0) as q from s, range(0, 21) group by range",
    "select unnest(quantile_cont(score, [0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1])) as q from s"))
def _(t):
    return rounded(ev.quantile_bins(scored(t)), "label", "pred", places=8)


@case("WN5_equal_count_bins", """with b as (select l_discount + l_quantity / 1000 as score, cast(l_returnflag = 'R' as integer) as label, ntile(20) over (order by l_discount + l_quantity / 1000 desc,
  l_orderkey * 100000000 + l_linenumber * 10000000 + l_partkey) as bin from lineitem) select cast(bin as integer) as bin, round(avg(score), 8) as mean_score, round(avg(label), 8) as mean_label, count(*) as n from b group by 1""")
def _(t):
    c = F.col
    rows = t.lineitem.select(
        (c("l_discount") + c("l_quantity") / 1000).alias("score"), (c("l_returnflag") == "R").cast("int").alias("label"),
        (c("l_orderkey") * 100000000 + c("l_linenumber") * 10000000 + c("l_partkey")).alias("id"),
    )
    return rounded(ev.equal_count_bins(rows, "score", "label", "id"), "mean_score", "mean_label", places=8)


@case("EV10_residual_histogram", S_SQL + """, r as (select label - score as r from s), m as (select min(r) as lo, max(r) as hi from r)
  select cast(least(floor((r - lo) * 50 / (hi - lo)), 49) as integer) as bin, count(*) as n, round(count(*) / ((select count(*) from r) * max((hi - lo) / 50)), 8) as density from r, m group by 1""")
def _(t):
    return rounded(ev.residual_histogram(scored(t)), "density", places=8)


@case("EV11_clicks_per_mille", S_SQL + " select round(1000 * sum(label * weight) / count(*), 6) as per_row, round(1000 * sum(label * weight) / sum(weight), 6) as per_weight from s")
def _(t):
    rows = scored(t, True)
    one = ev.clicks_per_mille(rows).withColumnRenamed("ctrpm", "per_row")
    return rounded(one.withColumn("per_weight", ev.clicks_per_mille(rows, "weight").scalar()), "per_row", "per_weight")
