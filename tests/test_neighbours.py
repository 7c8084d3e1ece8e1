import numpy as np
import pytest

from tallyflow.operators import neighbours as nb


@pytest.mark.parametrize("k, block, pivots", [(1, 2048, 16), (5, 16, 9), (40, 8, 256)])
def test_nearest_rows_against_brute_force(spark, k, block, pivots):
    rng = np.random.default_rng(k)
    train = [*rng.normal(0, 1, (120, 3)), *[np.ones(3)] * 40, *rng.normal(6, 0.2, (30, 3))]  # a third of the rows is one point
    asked = [*rng.normal(0, 2, (25, 3)), np.ones(3), np.full(3, 50.0)]
    rows = spark.createDataFrame([(i, v.tolist(), float(i % 7)) for i, v in enumerate(train)], "id long, v array<double>, y double")
    queries = spark.createDataFrame([(1000 + i, v.tolist()) for i, v in enumerate(asked)], "id long, v array<double>")
    got = {}
    for r in nb.nearest(rows, queries, "id", "v", "y", k, block, pivots).collect():
        got[r["query"], r["rank"]] = (r["id"], r["target"])
        assert r["distance"] == pytest.approx(np.linalg.norm(train[r["id"]] - asked[r["query"] - 1000]))
    assert len(got) == k * len(asked)
    for i, q in enumerate(asked):
        order = sorted(range(len(train)), key=lambda j: (np.sqrt(((q - train[j]) ** 2).sum()), j))[:k]
        assert [got[1000 + i, n + 1][0] for n in range(k)] == order


def test_nearest_of_nothing(spark):
    none = spark.createDataFrame([], "id long, v array<double>, y double")
    some = spark.createDataFrame([(1, [0.0], 2.0)], "id long, v array<double>, y double")
    assert nb.nearest(none, some, "id", "v", "y").count() == 0 and nb.nearest(some, none, "id", "v", "y").count() == 0
    assert nb.knn_regression(some, some, "id", "v", "y").collect() == [(1, 2.0)]
