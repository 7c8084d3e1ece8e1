import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyflow.operators import clustering as cu
from tallyflow.operators import similarity as sm


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def some_names(rng, n):
    names = {"", "a", "ab"}
    while len(names) < n:
        name = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 12)))
        for _ in range(rng.randint(0, 3)):
            names.add(name)
            at = rng.randint(0, len(name))
            name = name[:at] + rng.choice(["", "x", "yz"]) + name[at + rng.randint(0, 2) :]
    return sorted(names)


@pytest.mark.parametrize("distance", [1, 2, 3, 5])
def test_close_strings_of_any_distance(spark, distance):
    names = some_names(random.Random(distance), 130)
    want = {(a, b, d) for k, a in enumerate(names) for b in names[k + 1 :] if (d := edit_distance(a, b)) <= distance}
    got = sm.close_strings(spark.createDataFrame([(n,) for n in [*names, names[3], None]], "s string"), "s", distance).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def dense_exemplars(s, damping=0.7, rounds=300, stable=15):
    """Affinity propagation on a full matrix, with the choice of the middle member; -inf where there is no edge."""
    n = len(s)
    a, r, same, last = np.zeros((n, n)), np.zeros((n, n)), 0, None
    for _ in range(rounds):
        v = a + s
        first = v.argmax(axis=1)
        best = v[np.arange(n), first]
        v[np.arange(n), first] = -np.inf
        other = np.repeat(best[:, None], n, 1)
        second = v.max(axis=1)
        other[np.arange(n), first] = np.where(np.isinf(second), 0, second)
        r = damping * r + (1 - damping) * np.where(np.isinf(s), -np.inf, s - other)
        p = np.maximum(r, 0)
        np.fill_diagonal(p, 0)
        new = np.minimum(0, np.diag(r)[None, :] + p.sum(axis=0)[None, :] - p)
        np.fill_diagonal(new, p.sum(axis=0))
        a = damping * a + (1 - damping) * new
        heads = tuple(np.flatnonzero(np.diag(a) + np.diag(r) > 0))
        same, last = (same + 1 if heads == last else 0), heads
        if same >= stable + 5 and heads:
            break

    def choose(heads):
        t = s[:, heads].copy()
        t[heads, np.arange(len(heads))] = np.inf
        return np.array(heads)[t.argmax(axis=1)]

    label = choose(list(heads))
    middle = []
    for h in heads:
        own = np.flatnonzero(label == h)
        middle.append(own[s[np.ix_(own, own)].sum(axis=0).argmax()])
    return choose(sorted({*middle}))


def test_exemplars_equal_the_dense_version(spark):
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(c, 0.5, (8, 2)) for c in ((0, 0), (5, 0), (0, 6))])
    s = -((points[:, None] - points[None]) ** 2).sum(axis=2)
    edges = [(i, j, float(s[i, j])) for i in range(24) for j in range(i + 1, 24)]
    np.fill_diagonal(s, np.median([e[2] for e in edges]))
    vertices = spark.createDataFrame([(i,) for i in range(24)], "v int")
    got = cu.exemplars(vertices, spark.createDataFrame(edges, "a int, b int, similarity double")).collect()
    assert [c for _, c in sorted(tuple(r) for r in got)] == dense_exemplars(s).tolist()
    assert len({r["cluster"] for r in got}) == 3


def test_string_exemplars(spark):
    names = ["alpha", "alphb", "alphab", "omega", "omegas", "lonely-one", None]
    got = {r["vertex"]: r["cluster"] for r in cu.string_exemplars(spark.createDataFrame([(n,) for n in names * 2], "s string"), "s", 2).collect()}
    assert set(got) == {n for n in names if n}
    assert got["lonely-one"] == "lonely-one" and got["omega"] == got["omegas"]
    assert len({got["alpha"], got["alphb"], got["alphab"]}) < 3
    assert all(got[c] == c for c in got.values())
    assert cu.string_exemplars(spark.createDataFrame([], "s string"), "s", 2).count() == 0
