"""Exact k-nearest-neighbour regression as a metric join: cells around pivots, far cells left out."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.operators.similarity import top_k_per_group
from tallyflow.session import cut_lineage

#: Rows of a piece of a cell, of a block of queries, and most pivots.
BLOCK_ROWS = 2048
PIVOTS = 256
#: Chosen pairs whose distances are summed at a time.
CHOSEN = 1 << 16


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all of ``b`` from one matrix product."""
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


def _placed(rows: DataFrame, pivots: np.ndarray, schema: str) -> DataFrame:
    """Rows (key, v, ...) with their nearest pivot ``cell`` and its distance ``far``."""

    def place(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            d = distances(np.stack(pdf["v"].to_list()), pivots)
            cell = d.argmin(axis=1)
            yield pdf.assign(cell=cell.astype(np.int32), far=d[np.arange(len(pdf)), cell])

    return rows.mapInPandas(place, f"{schema}, cell int, far double")


def _in_cells(left: DataFrame, right: DataFrame, key: str, key_type: str, k: int) -> DataFrame:
    """(query, key, target, distance): of each block of queries, the ``k`` nearest rows of each piece that it is sent to."""

    def closest(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if q.empty or t.empty:
            return pd.DataFrame({"query": [], key: [], "target": [], "distance": []})
        t = t.sort_values(key)
        a, b = np.stack(q["v"].to_list()), np.stack(t["v"].to_list())
        keep = min(k, len(t))
        # the product only chooses; the chosen distances are summed exactly, and of ties the smallest keys stay
        d = distances(a, b)
        limit = np.partition(d, keep - 1, axis=1)[:, keep - 1]
        row, col = np.nonzero(d <= limit[:, None] + 1e-6 * (1.0 + limit[:, None]))
        exact = np.concatenate([np.sqrt(((a[row[i : i + CHOSEN]] - b[col[i : i + CHOSEN]]) ** 2).sum(axis=1)) for i in range(0, len(row), CHOSEN)])
        order = np.lexsort((col, exact, row))
        row, col, exact = row[order], col[order], exact[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        row, col, exact = row[place < keep], col[place < keep], exact[place < keep]
        return pd.DataFrame({"query": q["query"].to_numpy()[row], key: t[key].to_numpy()[col], "target": t["target"].to_numpy()[col], "distance": exact})

    found = left.groupBy("cell", "piece", "block").cogroup(right.groupBy("cell", "piece", "block")).applyInPandas(
        closest, f"query {key_type}, `{key}` {key_type}, target double, distance double"
    )
    return top_k_per_group(found, ["query"], ["distance", key], k)


def _dealt(queries: DataFrame, train: DataFrame, sizes: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Queries (query, v, cell) and training rows dealt to (cell, piece, block): each pair of a cell meets once."""
    asked = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    plan = cut_lineage(sizes.join(asked, "cell").select("cell", F.ceil(F.col("n") / block).cast("int").alias("pieces"), "blocks"))
    number = lambda name, n: F.pmod(F.xxhash64(name), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = queries.join(plan, "cell").withColumn("block", number("query", "blocks")).withColumn("piece", every("pieces"))
    right = train.join(plan, "cell").withColumn("piece", number("key", "pieces")).withColumn("block", every("blocks"))
    return left.select("query", "v", "cell", "piece", "block"), right


def nearest(train: DataFrame, queries: DataFrame, key: str, vector: str, target: str, k: int = 5, block: int = BLOCK_ROWS, pivots: int = PIVOTS) -> DataFrame:
    """(query, key, target, distance, rank): the ``k`` nearest training rows of each query row; ties by key.

    Training rows lie in the cell of their nearest pivot; pivots are the rows with the smallest key digests, at most
    ``pivots`` and about the root of the number of rows. A query first meets the nearest cells that hold ``k`` rows
    together; the k-th distance there bounds what it needs. It then meets only cells that can hold
    something nearer: those whose pivot is at most bound plus radius away, and not farther from the query
    than its nearest pivot by over twice the bound. Cells are cut into pieces and their queries into blocks
    of about ``block`` rows, each pair of them one small task that keeps ``k`` rows a query, so a cell of a third of
    all rows is spread, and no pair list is written.
    """
    (key_type,) = [f.dataType.simpleString() for f in train.select(key).schema]
    flat = F.col(vector).cast("array<double>").alias("v")
    rows = train.select(F.col(key).alias("key"), F.col(target).cast("double").alias("target"), flat)
    total = rows.count()
    if not total:
        return queries.sparkSession.createDataFrame([], f"query {key_type}, `{key}` {key_type}, target double, distance double, rank int")
    count = int(min(pivots, max(1, round(total**0.5))))
    chosen = rows.orderBy(F.md5(F.col("key").cast("string")), "key").limit(count).select("v").collect()
    centres = np.unique(np.array([r["v"] for r in chosen]), axis=0)
    placed = cut_lineage(_placed(rows, centres, f"key {key_type}, target double, v array<double>"))
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"))
    known = {r["cell"]: (r["n"], r["radius"]) for r in sizes.collect()}  # one row per pivot
    n = np.array([known.get(c, (0, 0.0))[0] for c in range(len(centres))])
    radius = np.array([known.get(c, (0, 0.0))[1] for c in range(len(centres))])
    asked = queries.select(F.col(key).alias("query"), flat)

    def first(batches):
        for pdf in batches:
            if not pdf.empty:
                order = np.argsort(distances(np.stack(pdf["v"].to_list()), centres), axis=1, kind="stable")
                held = np.cumsum(n[order], axis=1)
                enough = 1 + (held < min(k, total)).sum(axis=1)
                yield pdf.assign(cells=[o[:e].astype(np.int32) for o, e in zip(order, enough, strict=True)])

    def rest(batches):
        slack = 1e-6
        for pdf in batches:
            if not pdf.empty:
                d = distances(np.stack(pdf["v"].to_list()), centres)
                order = np.argsort(d, axis=1, kind="stable")
                bound = pdf["bound"].to_numpy()[:, None] + slack * (1.0 + d)
                open_ = (n > 0) & (d - radius <= bound) & (d - d.min(axis=1, keepdims=True) <= 2 * bound)
                for row, (o, seen) in enumerate(zip(order, np.cumsum(n[order], axis=1), strict=True)):
                    open_[row, o[: 1 + int((seen < min(k, total)).sum())]] = False  # met before
                yield pdf.drop(columns="bound").assign(cells=[np.flatnonzero(x).astype(np.int32) for x in open_])

    kind = f"query {key_type}, v array<double>"
    spread = lambda df: df.select("query", "v", F.explode("cells").alias("cell"))
    table = placed.withColumn(key, F.col("key")) if key != "key" else placed
    begun = cut_lineage(spread(asked.mapInPandas(first, f"{kind}, cells array<int>")))
    near = cut_lineage(_in_cells(*_dealt(begun, table, sizes, block), key, key_type, k))
    bounds = near.groupBy("query").agg(F.max("distance").alias("bound"))
    left = asked.join(bounds, "query").select("query", "v", "bound")
    more = cut_lineage(spread(left.mapInPandas(rest, f"{kind}, cells array<int>")))
    other = _in_cells(*_dealt(more, table, sizes, block), key, key_type, k)
    return top_k_per_group(near.drop("rank").unionByName(other.drop("rank")), ["query"], ["distance", key], k)


def knn_regression(train: DataFrame, queries: DataFrame, key: str, vector: str, target: str, k: int = 5) -> DataFrame:
    """(query, prediction): mean target of the ``k`` nearest training rows."""
    return nearest(train, queries, key, vector, target, k).groupBy("query").agg(F.avg("target").alias("prediction"))
