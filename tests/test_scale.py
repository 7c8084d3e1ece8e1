"""Shared steps that must not grow faster than their input: partitions, shuffles and repeated scoring."""

from __future__ import annotations

import json
import math
from collections import Counter
from datetime import date, datetime

import numpy as np
from pyspark.sql import functions as F

from tallyflow.llm.mixing import word_count
from tallyflow.operators import clustering as cu
from tallyflow.operators import models as md
from tallyflow.operators import similarity as sm
from tallyflow.plans import flatten, separation
from tallyflow.plans import installs as ins
from tallyflow.session import spread


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_in_few_partitions_are_spread(spark):
    one = spark.range(10).coalesce(1)
    out = spread(one, 3)
    assert out.rdd.getNumPartitions() == 4
    assert sorted(r[0] for r in out.collect()) == list(range(10))
    assert spread(one, 10).rdd.getNumPartitions() == 1


def test_one_large_partition_among_many_is_spread(spark):
    # as many partitions as the rows ask for, but one task would read 20 of 24 rows
    dealt = spark.sparkContext.parallelize(range(5), 5).flatMap(lambda i: [(k,) for k in range(20)] if i == 0 else [(20 + i,)])
    out = spread(spark.createDataFrame(dealt, "id int"), 5)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 8 and out.rdd.getNumPartitions() == 5
    assert sorted(r[0] for r in out.collect()) == [*range(20), *range(21, 25)]
    assert spread(spark.range(0), 5).count() == 0


def test_k_means_runs_in_as_many_tasks_as_its_rows_ask_for(spark, monkeypatch):
    monkeypatch.setattr(cu, "TASK_ROWS", 10)
    rows = spark.range(40).coalesce(1).select((F.col("id") % 2 * 100 + F.col("id") / 100).alias("x"))
    out = cu.k_means(rows, ["x"], 2)
    assert out.rdd.getNumPartitions() == 4
    assert sorted(r["count"] for r in out.groupBy("prediction").count().collect()) == [20, 20]


def test_texts_move_once_for_their_vectors(spark):
    rows = spark.createDataFrame([(1, "red blue red"), (2, "blue sky"), (None, "red"), (1, "green")], "id int, t string")
    tf = sm.term_frequencies(rows, "id", "t")
    assert plan(tf).count("Exchange hashpartitioning") == 1
    assert {(r.id, r.token): r.tf for r in tf.collect()} == {
        (1, "red"): 0.5, (1, "blue"): 0.25, (1, "green"): 0.25, (2, "blue"): 0.5, (2, "sky"): 0.5,
    }
    vectors = sm.unit(sm.hashed(sm.tf_idf(rows, "id", "t"), "id"), "id")
    assert plan(vectors).count("Exchange hashpartitioning") == 1
    norms = vectors.groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert {r.id: round(r.n, 9) for r in norms} == {1: 1.0, 2: 1.0}


def test_names_move_as_maps(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), ("a", "z", 1), ("b", None, 1), ("c", "y.1", 1)], "deviceId string, name string, value int")
    wide = ins.pivot_names(rows, ["x", "y.1"])
    assert "pivotfirst" not in plan(wide)
    assert sorted(map(tuple, wide.collect())) == [("a", 2, 0), ("b", 0, 0), ("c", 0, 1)]
    assert sorted(map(tuple, ins.pivot_names(rows, ["x"], binary=True).collect())) == [("a", 1), ("b", 0), ("c", 0)]


def test_only_frequent_values_meet_the_rows(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None), ("d", None), ("e", "y")], "deviceId string, name string")
    out = ins.frequent_names(rows, 1)
    assert "LeftSemi" in plan(out)
    assert sorted(r.deviceId for r in out.collect()) == ["a", "b", "c", "d"]


def test_metrics_score_the_rows_once(spark):
    rows = spark.range(8).select((F.col("id") / 10).alias("score"), (F.col("id") % 2).cast("double").alias("label"), F.lit(1.0).alias("weight"))
    out = md.classification_metrics(rows)
    assert "Range" not in plan(out)
    assert out.columns == ["mse", "rmse", "log_loss", "auc", "average_precision", "calibration", "accuracy"]


def test_the_joins_parse_the_log_once(spark):
    def event(kind, minute, message, **payload):
        body = {"istest": False, "deviceid": "d", "daysfromeulaapproval": 5, "timestamp": f"2024-01-02 10:{minute:02d}:00", "messageid": message, **payload}
        return "contentitem_" + kind, datetime(2024, 1, 2, 10, minute), json.dumps({"properties": body})

    rows = [
        event("sent", 0, "a"), event("sent", 0, "a"), event("sent", 1, "b"), event("sent", 1, None), event("view", 3, "a"), event("view", 2, "a"),
        event("click", 4, "a", actionid="share"), event("click", 4, "a", actionid="share"), event("dismiss", 5, "c"),
    ]
    out = flatten.flatten_by_joins(spark.createDataFrame(rows, "event string, time timestamp_ntz, properties string"), date(2024, 1, 1), date(2024, 2, 1))
    assert "from_json(StructField" not in plan(out) and "ExistingRDD" not in plan(out)
    got = {r.message_id: (r.view, r.view_timestamp, r.dismiss, r.actions and len(r.actions)) for r in out.collect()}
    assert got == {"a": (1, 1704189720000, 0, 2), "b": (0, None, 0, None)}


def test_percentiles_meet_the_rows_without_a_shuffle(spark):
    rows = spark.createDataFrame([(1, "x", 1.0, 5.0), (2, "x", 3.0, None), (2, None, 2.0, 1.0), (None, "y", 4.0, 4.0)], "device_id int, message_type string, a double, b double")
    out = separation.with_percentiles(rows, ["a", "b"])
    assert "Exchange hashpartitioning" not in plan(out) and "ExistingRDD" not in plan(out)
    got = {(r.device_id, r.message_type, r.a, r.median_a, r.median_b) for r in out.collect()}
    assert got == {(1, "x", 1.0, 2.0, 5.0), (2, "x", 3.0, 2.0, 5.0), (2, None, 2.0, 2.0, 1.0), (None, "y", 4.0, 4.0, 4.0)}


def test_several_metrics_are_separated_from_one_aggregation(spark):
    rows = [(u, f"d{(u * k) % 4}", float((u * 7 + k * 3) % 10), float((u + k * 5) % 7)) for u in range(20) for k in range(1, 6)]
    data = separation.with_percentiles(spark.createDataFrame(rows, "device_id int, message_type string, a double, b double"), ["a", "b"])
    out = separation.separation_tests(data, ["a", "b"])
    assert "device_id" not in plan(out)
    single = [separation.separation_test(data, m).collect() for m in ("a", "b")]
    assert sorted(map(tuple, out.collect())) == sorted(tuple(r) for rows in single for r in rows) != []


def test_words_are_counted_without_an_array_of_them(spark):
    texts = [None, "", " ", "a", " a\tb\n", "\U0001f600 x\x85y  ", " " * 1000, "a " * 1000]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(word_count())
    assert [r[0] for r in rows.collect()] == [0, 0, 0, 1, 2, 2, 0, 1000]
    assert "regexp_extract_all" not in plan(rows)


def test_groups_meet_without_a_shuffle_of_vectors(spark, monkeypatch):
    monkeypatch.setattr(sm, "GROUP_ITEMS", 4)
    monkeypatch.setattr(sm, "GROUP_WEIGHTS", 30)
    rng = np.random.default_rng(5)
    full = rng.random((33, 12)) * (rng.random((33, 12)) < 0.6)
    full[:, 0] = 0.3
    full /= np.linalg.norm(full, axis=1)[:, None]
    rows = [(f"k{i:02d}", f"t{j}", float(full[i, j])) for i in range(33) for j in range(12) if full[i, j]]
    vectors = spark.createDataFrame(rows, "id string, token string, weight double")
    # a key with two counts of copies, one without any
    copies = spark.createDataFrame([(f"k{i:02d}", i) for i in range(32)] + [("k03", 70)], "id string, n int")
    out = sm.similar_pairs(vectors.repartition(12), "id", 0.8, copies)
    assert "Exchange" not in plan(out) and out.columns == ["a", "b", "similarity", "a_copies", "b_copies"]
    counts = {i: [i] if i != 3 else [3, 70] for i in range(32)}
    product = full @ full.T
    want = sorted((f"k{i:02d}", f"k{j:02d}", c, d) for i in range(32) for j in range(i + 1, 32) if product[i, j] >= 0.8 for c in counts[i] for d in counts[j])
    assert sorted((r.a, r.b, r.a_copies, r.b_copies) for r in out.collect()) == want != []
    assert sm.similar_pairs(vectors.where("false"), "id", 0.8).collect() == []


def test_vectors_do_not_move_to_their_idf(spark, monkeypatch):
    texts = ["aa bb cc dd", "aa bb cc ee", "aa bb ff x", "aa gg gg x", "", None, "aa bb cc hh ii"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    found = []
    # all tokens known, some, and none of them
    for known in (100, 3, 1):
        monkeypatch.setattr(sm, "KNOWN_TOKENS", known)
        out = sm.tf_idf(rows, "id", "t")
        assert "hashpartitioning(token" not in plan(out) and ("element_at" in plan(out)) == (known != 100)
        found.append({(r.id, r.token): round(r.weight, 9) for r in out.collect()})
    counts = {i: Counter(t.split()) for i, t in enumerate(texts) if t}
    df = Counter(w for c in counts.values() for w in c)
    idf = {w: math.log((1 + len(texts)) / (1 + (n if len(w) > 1 else 0))) + 1 for w, n in df.items()}
    want = {(i, w): round(n / sum(c.values()) * idf[w], 9) for i, c in counts.items() for w, n in c.items()}
    assert found == [want, want, want]


def test_nearest_items_are_found_where_their_vectors_lie(spark, monkeypatch):
    base = spark.range(40).select("id", F.explode(F.sequence(F.lit(0), F.col("id") % 5 + 1)).alias("j"))
    token = F.concat(F.lit("t"), ((F.col("id") * F.col("j")) % 7).cast("string"))
    vectors = base.select(F.col("id").cast("string").alias("item"), token.alias("token"), (F.col("j") + 1.0).alias("w")).groupBy("item", "token").agg(F.sum("w").alias("weight"))
    queries = spark.createDataFrame([("3",), ("11",), ("none",), ("0",), ("3",)], "q string")
    own = {}
    for r in vectors.collect():
        own.setdefault(r["item"], {})[r["token"]] = r["weight"]
    want = set()
    for q in ("3", "11", "0"):
        near = {i: sum(w * own[q].get(t, 0.0) for t, w in v.items()) for i, v in own.items() if v.keys() & own[q].keys()}
        want |= {(q, i, s, n) for n, (i, s) in enumerate(sorted(near.items(), key=lambda x: (-x[1], x[0]))[:4], 1)}
    for rows, products in ((1_000_000, 1 << 22), (3, 40)):
        monkeypatch.setattr(sm, "QUERY_ROWS", rows)
        monkeypatch.setattr(sm, "MOST_PRODUCTS", products)
        out = sm.most_similar(vectors, queries, "item", 4)
        # one block of queries: no vector is written
        assert ("Range" in plan(out)) == (rows > 3)
        assert {(r["query"], r["item"], r["similarity"], r["rank"]) for r in out.collect()} == want
    assert sm.most_similar(vectors, queries.where("q = 'none'"), "item", 4).collect() == []


def vector_rows(spark, n=300):
    rng = np.random.default_rng(2)
    rows = [(i, float(rng.random() < 0.2 + 0.1 * (a + b)), float(a), float(b)) for i in range(n) for a, b in [rng.integers(0, 4, 2)]]
    return md.assembler(["a", "b"]).transform(spark.createDataFrame(rows, "id int, label double, a double, b double")).select("id", "label", "features")


def test_equal_rows_weigh_as_many_as_they_are(spark, monkeypatch):
    monkeypatch.setattr(md, "COUNTED_ROWS", 20)
    rows = vector_rows(spark)
    own = md.counted(rows)
    assert own.count() <= 32 and own.agg({"n": "sum"}).first()[0] == 300
    boosted = md.GBTClassifier(maxIter=4, maxDepth=3, minWeightFractionPerNode=0.1, seed=30)
    one, two = boosted.fit(rows), boosted.copy().setWeightCol("n").fit(own)
    scores = [{r.features: r.score for r in md.probability(m.transform(rows)).collect()} for m in (one, two)]
    assert scores[0].keys() == scores[1].keys() and all(abs(scores[0][k] - scores[1][k]) < 1e-9 for k in scores[0])
    plain, weighed = (md.classification_metrics(md.score_rows(one, r)).first() for r in (rows, own))
    assert all(abs(a - b) < 1e-9 for a, b in zip(plain, weighed, strict=True))
    folds = md.counted(rows, "id", 3).groupBy("fold").agg(F.sum("n")).collect()
    assert sorted(r[0] for r in folds) == [0, 1, 2] and sum(r[1] for r in folds) == 300


def test_boosting_search_draws_all_of_the_reference(spark, monkeypatch):
    asked = {}

    def found(estimator, grid, train, folds, **options):
        asked.update(grid=grid, folds=folds, columns=train.columns)
        return estimator, []

    monkeypatch.setattr(md, "search", found)
    md.boosting_search(vector_rows(spark), "id")
    assert len(asked["grid"]) == 20 and asked["folds"] == 3 and asked["columns"] == ["label", "features", "fold", "n"]
    assert max(g["maxIter"] for g in asked["grid"]) == 200 and max(g["maxDepth"] for g in asked["grid"]) > 20
    assert {g["featureSubsetStrategy"] for g in asked["grid"]} == {"1"}
    monkeypatch.undo()
    best, history = md.search(md.GBTClassifier(maxIter=2), [{"maxDepth": 1}, {"maxDepth": 2}], md.counted(vector_rows(spark), "id", 2), 2)
    assert len(history) == 2 and best.getWeightCol() == "n"


def test_forests_draw_their_rows_from_counted_ones(spark, monkeypatch):
    # any number of draws is a weight: with one draw for each row, every tree is that of all rows
    rows = vector_rows(spark)
    whole = md.RandomForestClassifier(numTrees=1, maxDepth=2, bootstrap=False, featureSubsetStrategy="all", minInstancesPerNode=5, seed=30).fit(rows)
    monkeypatch.setattr(md, "_draws", lambda trees, seed: lambda n, place: F.array_repeat(n, trees))
    forest = md.BaggedForest(numTrees=3, maxDepth=2, featureSubsetStrategy="all", minInstancesPerNode=5, seed=30)
    own = forest.fit(md.counted(rows))
    assert own.getNumTrees == 3 and own.numClasses == 2 and own.numFeatures == 2
    scores = [{r.features: r.score for r in md.probability(m.transform(rows)).collect()} for m in (whole, own)]
    assert all(abs(scores[0][k] - scores[1][k]) < 1e-9 for k in scores[0])
    monkeypatch.undo()
    drawn = [r[0] for r in spark.range(4000, numPartitions=2).select(md._draws(5, 1)(F.lit(3.0), "id")).collect()]
    flat = np.array(drawn)
    assert flat.shape == (4000, 5) and abs(flat.mean() - 3) < 0.1 and abs(flat.var() - 3) < 0.2
    # 300 rows are 32 counted ones at most a fold
    seen = []
    search = md.search
    monkeypatch.setattr(md, "search", lambda e, g, r, *a, **b: seen.append(r.columns) or search(e, g, r, *a, **b))
    best, history = md.forest_search(rows, "id", n=1, folds=2)
    assert seen == [["label", "features", "fold", "n"]] and len(history) == 1 and len(best.trees) == best.getNumTrees > 1
    md.forest_search(rows.limit(20), "id", n=1, folds=2)
    assert "n" not in seen[1]
