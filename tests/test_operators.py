import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyflow.operators import clustering as cu
from tallyflow.operators import evaluation as ev
from tallyflow.operators import marginals as mg
from tallyflow.operators import neighbours as nb
from tallyflow.operators import ordering as order
from tallyflow.operators import priors as pri
from tallyflow.operators import profile as pf
from tallyflow.operators import similarity as sm
from tallyflow.operators import splits as spl
from tallyflow.operators.cleaning import exclude, first_per_key, minority_by_share, within_sigmas
from tallyflow.operators.ordering import exact_quantiles, numbered, running_max, running_totals
from tallyflow.operators.skyline import frontier
from tallyflow.sources import schemas


def skewed(spark, n=3000):
    rng = random.Random(4)
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}", rng.randint(0, 40)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, key string, v int"), rows


def test_numbered_is_a_row_number_with_a_hot_key(spark):
    df, rows = skewed(spark)
    got = {r["id"]: r["idx"] for r in numbered(df, ["v", "id"], ["key"]).collect()}
    for key in {r[1] for r in rows}:
        ordered = sorted((r[2], r[0]) for r in rows if r[1] == key)
        assert [got[i] for _, i in ordered] == list(range(len(ordered)))


def test_running_totals_and_max(spark):
    rows = [(i, (i * 37) % 101) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v long")
    sums = {r["k"]: r["v_before"] for r in running_totals(df, ["k"], ["v"]).collect()}
    tops = {r["k"]: r["v_before"] for r in running_max(df, ["k"], "v").collect()}
    total, top = 0, None
    for k, v in rows:
        assert sums[k] == total and tops[k] == top
        total, top = total + v, v if top is None else max(top, v)


def test_quantiles_match_linear_interpolation(spark):
    import numpy as np

    df, rows = skewed(spark)
    probs = [0.0, 0.33, 0.5, 0.67, 1.0]
    for r in exact_quantiles(df, "v", probs, ["key"]).collect():
        values = [x[2] for x in rows if x[1] == r["key"]]
        assert r["q"] == pytest.approx(np.quantile(values, r["p"]))


def test_empty_input(spark):
    df, _ = skewed(spark, 3)
    none = df.where("false")
    assert numbered(none, ["id"]).count() == 0
    assert exact_quantiles(none, "v", [0.5]).count() == 0
    assert first_per_key(none, ["key"], ["id"]).count() == 0


def test_first_per_key_and_exclude(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), (None, 5, "z")], "k string, o int, v string")
    assert sorted(map(tuple, first_per_key(df, ["k"], ["o"]).collect()), key=str) == [("a", 1, None), (None, 5, "z")]
    assert exclude(df, "v", ["x"]).count() == 2


def test_minority_keeps_null_and_boundary(spark):
    rows = [("a",)] * 98 + [("b",)] + [(None,)]
    out = minority_by_share(spark.createDataFrame(rows, "c string"), ["c"], 0.01)
    assert {(r[0], r[1]) for r in out.groupBy("c").count().collect()} == {("a", 98), ("minority", 1), (None, 1)}


def test_sigmas_drop_the_outlier(spark):
    df = spark.createDataFrame([(float(i % 5),) for i in range(100)] + [(1000.0,)], "x double")
    assert within_sigmas(df, ["x"]).count() == 100


def test_grams_cross_block_edges(spark):
    import tallyflow.operators.ordering as od

    seq = [(i, "abc"[i * i % 3]) for i in range(60)]
    df = spark.createDataFrame(seq, "i int, t string")
    old = od.in_blocks.__defaults__
    od.in_blocks.__defaults__ = (7,)
    try:
        got = {r["gram"]: r["cnt"] for r in pf.gram_counts(df, "t", ["i"], 3).collect()}
    finally:
        od.in_blocks.__defaults__ = old
    want = {}
    for i in range(58):
        g = " > ".join(t for _, t in seq[i : i + 3])
        want[g] = want.get(g, 0) + 1
    assert got == want


def test_auc_equals_the_library_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(2)
    rows = [(round(rng.random(), 2), float(rng.random() < 0.4)) for _ in range(800)]
    df = spark.createDataFrame(rows, "score double, label double")
    mine = ev.roc_auc(ev.scored(df, F.col("score"), F.col("label"))).first()[0]
    lib = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert mine == pytest.approx(lib, abs=1e-9)


def test_reliability_excludes_zero_and_bins_without_positives(spark):
    rows = [(0.0, 1.0), (0.1, 1.0), (0.15, 0.0), (0.95, 1.0), (1.0, 0.0)]
    df = spark.createDataFrame(rows, "score double, label double").withColumn("weight", F.lit(1.0))
    got = {r["bin"]: (r["n"], r["true_fraction"]) for r in ev.reliability(df).collect()}
    assert got == {1: (1, 1.0), 10: (2, 0.5)}


def test_prefix_filter_finds_every_similar_pair(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    docs = {i: [rng.choice(words[: rng.choice([8, 60])]) for _ in range(12)] for i in range(80)}
    docs.update({100 + i: docs[i] + ["extra"] for i in range(10)})
    rows = [(i, w, float(n.count(w))) for i, n in docs.items() for w in set(n)]
    vectors = sm.unit(spark.createDataFrame(rows, "id int, token string, weight double"), "id")
    got = {(r["a"], r["b"]) for r in sm.similar_pairs(vectors, "id", 0.6).collect()}
    unit = {}
    for r in vectors.collect():
        unit.setdefault(r["id"], {})[r["token"]] = r["weight"]
    dot = lambda a, b: sum(w * unit[b].get(t, 0.0) for t, w in unit[a].items())
    want = {(a, b) for a in unit for b in unit if a < b and dot(a, b) >= 0.6}
    assert got == want and len(want) > 10


def test_close_strings_against_brute_force(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(0, 7))) for _ in range(60)}
    df = spark.createDataFrame([(w,) for w in words], "s string")

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    for d in (1, 2):
        got = {(r["a"], r["b"], r["distance"]) for r in sm.close_strings(df, "s", d).collect()}
        assert got == {(a, b, lev(a, b)) for a in words for b in words if a < b and lev(a, b) <= d}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(40)] + [("hub", f"s{i}") for i in range(30)]
    vertices = spark.createDataFrame([(v,) for e in edges for v in e] + [("alone",)], "v string")
    got = {r["vertex"]: r["cluster"] for r in cu.components(vertices, spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got["c040"] == "c000" and got["s7"] == "hub" and got["alone"] == "alone"
    assert len(set(got.values())) == 3


def test_priors_equal_the_plain_loop(spark):
    rng = random.Random(5)
    rows = [(f"p{g}", 100 + i % 7, rng.randint(10, 60)) for g in range(3) for i in range(40 * (g + 1))]
    df = spark.createDataFrame(rows, "p string, trial long, success long")
    got = {r["p"]: r for r in pri.beta_priors(df, ["p"]).collect()}
    for p in ("p0", "p1", "p2"):
        n = np.array([r[1] for r in rows if r[0] == p], float)
        s = np.array([r[2] for r in rows if r[0] == p], float)
        a = b = pri.START
        for step in range(1, pri.MAX_ITERATIONS + 2):
            bottom = sum(pri._psi(x + a + b) - pri._psi(np.float64(a + b)) for x in n)
            new_a = a * sum(pri._psi(x + a) - pri._psi(np.float64(a)) for x in s) / bottom
            new_b = b * sum(pri._psi(x + b) - pri._psi(np.float64(b)) for x in n - s) / bottom
            done = abs(a - new_a) < pri.TOLERANCE and abs(b - new_b) < pri.TOLERANCE
            a, b = new_a, new_b
            if done:
                break
        assert (got[p]["alpha"], got[p]["beta"]) == (pytest.approx(a, rel=1e-6), pytest.approx(b, rel=1e-6))
        assert got[p]["n_iter"] == step


def test_pieces_grow_in_number_and_not_in_size(spark, monkeypatch):
    monkeypatch.setattr(order, "PIECE_ROWS", 200)
    for rows in (1_000, 10_000):
        df = spark.range(rows).withColumn("k", (F.col("id") * 7919) % rows)
        sizes = [r["count"] for r in order.with_pieces(df, ["k"]).groupBy("_piece").count().collect()]
        assert sum(sizes) == rows and max(sizes) < 4 * 200
        got = order.numbered(df, ["k"]).where("idx != k").count()
        assert got == 0


def test_hash_keys_tell_nulls_and_bars_apart(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("a|b", None, None), ("a", "", "b"), (None, "a", "b"), ("", "a", "b")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    assert df.select(order.hash_key("x", "y", "z").alias("h")).distinct().count() == len(rows)


def test_conforming_inside_structs_and_arrays(spark):
    df = spark.sql("select named_struct('a', 1, 'extra', 'x') as s, array(named_struct('b', 2, 'c', null)) as l, 3 as gone")
    target = schemas.schema_from_example({"s": {"a": 1.5, "new": "t"}, "l": [{"b": 1, "c": "t", "d": True}], "more": [1]})
    row = schemas.conform(df, target).first().asDict(recursive=True)
    assert row == {"l": [{"b": 2, "c": None, "d": None}], "more": None, "s": {"a": 1.0, "new": None}}
    with pytest.raises(TypeError):
        schemas.conform(df, schemas.schema_from_example({"s": {"a": "text"}}))


def test_fitting_meets_both_marginals(spark):
    cells = spark.createDataFrame([(a, b, float(a * 3 + b + 1)) for a in range(4) for b in range(5)], "x int, y int, m double")
    scaled = cells.withColumn("m", F.col("m") * (F.col("x") + 1) * (F.col("y") + 2))
    targets = mg.marginal_totals(scaled, ("x", "y"), "m")
    errors = []
    for sweeps in (1, 4):
        w = mg.fit_weights(cells, ("x", "y"), "m", targets, sweeps=sweeps)
        rows = mg.reconciliation(mg.fitted_totals(cells, ("x", "y"), "m", w), targets).collect()
        errors.append(max(r["max_error"] for r in rows))
    assert errors[1] <= errors[0] and errors[1] < 1e-3


def test_frontier_keeps_equal_points(spark):
    rows = [(5, 1), (4, 1), (4, 0), (3, 7), (3, 7), (2, 6), (1, 7)]
    got = {tuple(r) for r in frontier(spark.createDataFrame(rows, "x int, y int"), "x", "y").collect()}
    assert got == {(5, 1, 1), (4, 1, 1), (3, 7, 2), (1, 7, 1)}


def test_nearest_over_several_blocks(spark):
    rng = random.Random(9)
    pts = [(i, [rng.random() for _ in range(3)], float(i)) for i in range(90)]
    df = spark.createDataFrame(pts, "id int, v array<double>, y double")
    train, test = df.where("id < 70"), df.where("id >= 70")
    got = {}
    for r in nb.nearest(train, test, "id", "v", "y", k=3, block=16).collect():
        got.setdefault(r["query"], set()).add(r["id"])
    for q, v, _ in pts[70:]:
        near = sorted(pts[:70], key=lambda p: sum((a - b) ** 2 for a, b in zip(p[1], v)))[:3]
        assert got[q] == {p[0] for p in near}


def test_splits_do_not_depend_on_partitioning(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 4).alias("label"))
    a = {(r["id"], r["part"]) for r in spl.stratified(df, ["id"], "label", 0.3).collect()}
    b = {(r["id"], r["part"]) for r in spl.stratified(df.repartition(7), ["id"], "label", 0.3).collect()}
    assert a == b and sum(p == "test" for _, p in a) == 300
    train, test = spl.random_split(df, ["id"], [0.7, 0.3])
    assert train.count() + test.count() == 1000 and spl.sample_rows(df, ["id"], 123).count() == 123


def test_similar_pairs_makes_no_candidate_rows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    # two dense and many rare tokens, slices and product blocks that end inside an item
    monkeypatch.setattr(sm, "COMMON_TOKENS", 2)
    monkeypatch.setattr(sm, "SLICE_ITEMS", 3)
    monkeypatch.setattr(sm, "MOST_PRODUCTS", 7)
    full = rng.random((60, 25)) * (rng.random((60, 25)) < 0.3)
    full[:, 0] = 0.5
    full[40:50] = full[40] + 0.01 * rng.random((10, 25))
    full /= np.linalg.norm(full, axis=1)[:, None]
    rows = [(i, f"t{j}", float(full[i, j])) for i in range(60) for j in range(25) if full[i, j]]
    out = sm.similar_pairs(spark.createDataFrame(rows, "id int, token string, weight double"), "id", 0.5)
    product = full @ full.T
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if product[i, j] >= 0.5}
    got = {(r["a"], r["b"]): r["similarity"] for r in out.collect()}
    assert got.keys() == want and all(abs(got[k] - product[k]) < 1e-12 for k in want)
    assert "Join" not in out._jdf.queryExecution().toString()
