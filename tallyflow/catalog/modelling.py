"""Fitted models and the jobs built on them; checked by invariants, not by SQL."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tallyflow.catalog import case
from tallyflow.catalog.basics import scratch
from tallyflow.catalog.features import CLICK_KEYS, click_rows
from tallyflow.catalog.profiling import installs, rounded
from tallyflow.operators import evaluation as ev
from tallyflow.operators import l1_path as lp
from tallyflow.operators import models as md
from tallyflow.plans import ablation as ab
from tallyflow.plans import adviews as av
from tallyflow.plans import churn as ch
from tallyflow.plans import clicks as ck
from tallyflow.plans import prices as pr
from tallyflow.plans import tweets as tw
from tallyflow.session import cut_lineage, spread
from tallyflow.sources import sinks as sk

TASK_ROWS = md.TASK_ROWS
# the same for the regressors: bagged points and residuals take about 1.1 KB a row, which a task reads again from memory
PRICE_ROWS = 100_000
CATS, NUMS = ["l_linestatus", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"]


def sold(t):
    rows = t.lineitem.withColumn("id", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    likely = (F.col("l_quantity") > 25).cast("int") + (F.col("l_discount") > 0.05).cast("int") + (F.col("l_returnflag") == "R").cast("int")
    return rows.withColumns({"y": (likely >= 2).cast("int"), "l_linenumber": F.col("l_linenumber").cast("string")})


def sold_features(t):
    return av.split_features(sold(t), "id", "y", CATS, NUMS)


def sold_split(t):
    train, test = sold_features(t)
    return spread(train, TASK_ROWS), spread(test, TASK_ROWS)


def metrics(model, test):
    out = md.classification_metrics(md.score_rows(model, test))
    return rounded(out, *out.columns, places=4)


def history(t, found):
    rows = [(str(sorted(p.items())), float(m)) for p, m in found]
    return t.spark.createDataFrame(rows, "parameters string, metric double")


@case("MOD1_logistic_search")
def _(t):
    train, test = sold_split(t)
    best, _ = md.logistic_search(train, n=3, folds=2)
    return metrics(best, test)


@case("MOD1_l1_path")
def _(t):
    train, _ = sold_features(t)
    rows = lp.counted(lp.sparse_rows(train, key=["id"]))
    path = lp.searched_path(rows, len(md.feature_names(train)))
    points = [(k, float(c), p, x, int((w != 0).sum())) for k, (c, p, x, w) in enumerate(zip(path.strengths, path.precision, path.log_loss, path.weights))]
    out = t.spark.createDataFrame(points, "point int, strength double, fold_precision double, fold_log_loss double, kept int")
    return rounded(out, "strength", "fold_precision", "fold_log_loss", places=4)


@case("MOD2_forest_search")
def _(t):
    train, test = sold_features(t)
    return metrics(md.forest_search(train, "id", n=2, folds=2)[0], md.counted(test))


@case("MOD3_boosting_search")
def _(t):
    train, test = sold_features(t)
    return metrics(md.boosting_search(train, "id")[0], md.counted(test))


@case("MOD4_parameter_sweep")
def _(t):
    train, test = sold_split(t)
    make = lambda **p: md.RandomForestClassifier(seed=30, **{"numTrees": 8, "maxDepth": 4, **p})
    return md.sweep(t.spark, make, {"numTrees": [2, 8], "maxDepth": [2, 6]}, train, test)


def priced(t):
    train, test = pr.split_features(t.orders.withColumn("region", F.lit("Albany")), "o_orderdate", "o_orderkey", "o_totalprice",
                                    ["o_orderpriority", "o_orderstatus", "month", "day_of_week"], ["o_custkey"], "region")
    return spread(train, PRICE_ROWS), spread(test, PRICE_ROWS)


@case("MOD5_regressors")
def _(t):
    return rounded(md.compare_regressors(*priced(t)), "rmse", places=2)


@case("MOD6_regression_search")
def _(t):
    train, _ = priced(t)
    found = md.regression_search(md.RandomForestRegressor(seed=30), {"numTrees": [4, 8], "maxDepth": [2, 4]}, train, n=2, folds=2)
    return history(t, found[1])


# one label for each of twelve horizons of the given orders
MONTHS = list(range(52, 76, 2))


def served(t):
    rows = t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    rows = rows.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("o_custkey", "a", "b", "c_mktsegment", "n_name")


@case("MOD8_model_per_label")
def _(t):
    rows = ch.labelled(served(t), "a", "b", months=MONTHS)
    return ch.horizon_models(rows, "o_custkey", ["c_mktsegment"], [f"month_{m}" for m in MONTHS])


@case("JOB15_churn_horizons")
def _(t):
    rows = ch.labelled(served(t), "a", "b", MONTHS)
    return ch.horizon_models(rows, "o_custkey", ["c_mktsegment", "n_name"], [f"month_{m}" for m in MONTHS])


def people(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("dev"), F.col("n_name").alias("carrier_name"), F.col("c_mktsegment").alias("device_model"),
        F.col("c_nationkey").cast("string").alias("device_vendor"), (F.col("c_acctbal") > 4000).cast("int").alias("y"),
    )


def named_installs(t):
    return installs(t).withColumn("app", F.concat(F.lit("com."), F.replace("app", F.lit("#"), F.lit("."))))


def ablate(t, rows):
    out = ab.ablation(named_installs(t), rows, "dev", "y", min_devices=50, cutoff=0.75, min_app_variance=0.2)
    return rounded(out, "average_precision", "train_precision", "fold_precision", places=4)


def quick(train):
    return md.LogisticRegression(regParam=0.01, elasticNetParam=1.0, maxIter=10).fit(train)


@case("MOD9_feature_set_ablation")
def _(t):
    return ablate(t, people(t))


@case("JOB11_segment_modelling")
def _(t):
    return ablate(t, ab.usable_people(people(t), named_installs(t), "dev", "y"))


@case("MOD10_weighted_click_model")
def _(t):
    rows = cut_lineage(ck.parted(click_rows(t).withColumn("id", F.concat_ws("-", *CLICK_KEYS)), ["id"]))
    model = md.hashed_click_model(rows.where("part = 'train'"), ["p_type", "p_brand", "l_linestatus"], "clicks", "impressions", buckets=256)
    scored = md.probability(model.transform(rows.where("part = 'test'")))
    pairs = ev.scored(scored, F.col("score"), F.col("clicks"), F.col("impressions"))
    return ev.roc_auc(pairs).withColumn("calibration", ev.calibration(pairs).scalar())


@case("MOD11_batch_scoring")
def _(t):
    rows = t.documents.join(t.labels, "doc_id", "left")
    return tw.classify(rows, "doc_id", "text", "quality")[1]


@case("JOB13_short_text_classifier")
def _(t):
    rows = t.documents.join(t.labels, "doc_id", "left")
    return tw.classify(rows, "doc_id", "text", "quality")[0]


@case("MOD12_weights_table")
def _(t):
    train, _ = sold_split(t)
    return md.weights_table(quick(train), train)


@case("SNK6_save_and_load_model", "select true as same, count(*) as n from lineitem")
def _(t):
    path = scratch(t) + "/model"
    rows = sold(t).withColumns({"label": F.col("y").cast("double"), "id": F.monotonically_increasing_id()})
    rows = cut_lineage(rows)
    stages = [*md.feature_stages(rows, CATS, NUMS), md.LogisticRegression(regParam=0.01, maxIter=10)]
    fitted = Pipeline(stages=stages).fit(rows)
    sk.save_model(fitted, path)
    again = sk.load_model(path)
    both = fitted.transform(rows).select("id", F.col("prediction").alias("a")).join(again.transform(rows).select("id", "prediction"), "id")
    return both.groupBy((F.col("a") == F.col("prediction")).alias("same")).agg(F.count(F.lit(1)).alias("n"))


@case("JOB16_price_regression")
def _(t):
    train, test = priced(t)
    return rounded(md.compare_regressors(train, test), "rmse", places=2)


@case("JOB17_ad_views")
def _(t):
    rows = av.cleaned(sold(t).withColumn("ad_screen_ratio", F.try_divide("l_extendedprice", "l_quantity")), CATS, ["ad_screen_ratio"], sigmas=3)
    train, test = av.split_features(rows, "id", "y", CATS, [*NUMS, "ad_screen_ratio"])
    models = {"logistic": md.LogisticRegression(regParam=0.01), "forest": md.RandomForestClassifier(numTrees=10, maxDepth=5, seed=30)}
    return av.compare(spread(train, TASK_ROWS), spread(test, TASK_ROWS), models)


@case("JOB18_expert_routing")
def _(t):
    rows = av.cleaned(sold(t), CATS, NUMS, required=["l_quantity"], fills={"l_discount": 0.0})
    train, test = av.split_features(rows, "id", "y", CATS, NUMS)
    models = {
        "logistic": md.LogisticRegression(regParam=0.01),
        "forest": md.RandomForestClassifier(numTrees=8, maxDepth=5, seed=30),
        "boosting": md.GBTClassifier(maxIter=4, maxDepth=3, seed=30),
    }
    return av.compare(spread(train, TASK_ROWS), spread(test, TASK_ROWS), models)
