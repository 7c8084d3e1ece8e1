import numpy as np
import pytest

from tallyflow.operators import l1_path as lp
from tallyflow.session import cut_lineage


def plain_fit(x, y, strength, steps=6000):
    """Accelerated proximal gradient of one problem: summed log loss + |w| / C, free intercept."""
    a = np.hstack([np.ones((len(x), 1)), x])
    limit = np.full(a.shape[1], 1 / strength)
    limit[0] = 0
    height = np.linalg.eigvalsh(a.T @ a)[-1] / 4
    w = z = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(steps):
        to = z - a.T @ (1 / (1 + np.exp(-a @ z)) - y) / height
        to = np.sign(to) * np.maximum(abs(to) - limit / height, 0)
        t = 1.0 if (z - to) @ (to - w) > 0 else t
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = to + (t - 1) / after * (to - w), to, after
    return w


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(0)
    n, d = 600, 12
    x = (rng.random((n, d)) < rng.uniform(0.1, 0.5, d)).astype(float)
    x[:, 1] = np.where(rng.random(n) < 0.9, x[:, 0], x[:, 1])
    w = np.where(rng.random(d) < 0.5, rng.normal(0, 1.5, d), 0)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ w - 1)))).astype(float)
    fold = rng.integers(0, 3, n)
    lists = [(float(y[i]), int(fold[i]), np.flatnonzero(x[i]).tolist(), [1.0] * int(x[i].sum())) for i in range(n)]
    rows = cut_lineage(spark.createDataFrame(lists, "label double, fold int, idx array<int>, val array<double>"))
    return x, y, fold, rows, lp.fit_path(rows, d, lp.strengths_of(rows, 6, 500.0), 3)


def test_each_point_and_fold_equals_a_fit_of_its_own(fitted):
    x, y, fold, rows, path = fitted
    assert path.strengths[0] == pytest.approx(2 / np.abs(x.T @ (2 * y - 1)).max())
    assert path.passes < 60
    for k in (0, 1, 5):
        for f in (0, 2, None):
            own = fold != f if f is not None else np.ones(len(y), bool)
            want = plain_fit(x[own], y[own], path.strengths[k])
            got = (path.weights[k], path.intercepts[k]) if f is None else (path.fold_weights[f, k], path.fold_intercepts[f, k])
            assert np.abs(np.append(got[0], got[1]) - np.append(want[1:], want[0])).max() < 1e-4


def test_few_seed_features_and_blocks_find_the_same_path(fitted):
    x, y, fold, rows, path = fitted
    small = lp.fit_path(rows, x.shape[1], path.strengths, 3, seed_features=2)
    assert small.working_set > 2 and np.abs(small.weights - path.weights).max() < 1e-4
    split = lp.fit_path(rows, x.shape[1], path.strengths[:2], 3, block=8, tolerance=1e-3)
    assert np.abs(split.weights - path.weights[:2]).max() < 0.05


def test_fold_scores(fitted):
    x, y, fold, rows, path = fitted
    lp.with_fold_scores(path, rows)
    for k in (1, 4):
        each = []
        for f in range(3):
            own = fold == f
            score = x[own] @ path.fold_weights[f, k] + path.fold_intercepts[f, k]
            label, found, seen, total = y[own], 0.0, 0, 0
            for s in sorted(set(np.round(score, 12)), reverse=True):
                at = np.round(score, 12) == s
                total, seen = total + at.sum(), seen + label[at].sum()
                found += label[at].sum() * seen / total
            each.append(found / label.sum())
        assert path.precision[k] == pytest.approx(np.mean(each), abs=1e-6)
    assert path.precision[path.best] == max(path.precision)
    scored = path.score(rows).collect()
    assert len(scored) == len(y) and all(0 < r["score"] < 1 for r in scored)


def test_equal_rows_count_as_often_as_they_come(spark, monkeypatch):
    monkeypatch.setattr(lp, "TASK_ROWS", 5)
    rng = np.random.default_rng(4)
    x = (rng.random((400, 3)) < 0.5).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(1 - x @ [2.0, -1.0, 0.5]))).astype(float)
    lists = [(float(y[i]), int(i % 3), np.flatnonzero(x[i]).tolist(), [1.0] * int(x[i].sum())) for i in range(400)]
    rows = cut_lineage(spark.createDataFrame(lists, "label double, fold int, idx array<int>, val array<double>"))
    own = lp.counted(rows)
    assert own.count() <= 48 and own.agg({"n": "sum"}).first()[0] == 400 and own.rdd.getNumPartitions() > 4
    one, two = (lp.searched_path(r, 3, points=4, folds=3, top=50.0) for r in (rows, own))
    assert one.strengths == pytest.approx(two.strengths)
    assert np.abs(one.weights - two.weights).max() < 1e-6 and np.abs(one.fold_weights - two.fold_weights).max() < 1e-6
    assert one.precision == pytest.approx(two.precision) and one.log_loss == pytest.approx(two.log_loss)
    assert two.score(own).agg({"weight": "sum"}).first()[0] == 400
