"""L1 logistic regression along a whole path: all points and folds advance together, one pass over the rows a step."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.operators.ordering import hash_key, running_totals
from tallyflow.session import cut_lineage, spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Features that begin in the working set, features whose curvature is one matrix, numbers held per slice of rows.
SEED_FEATURES, BLOCK_FEATURES, SLICE = 1000, 1000, 1 << 21
#: Gradient that may remain, as a share of the strongest penalty; gain of a step, as a share
#: of the loss, below which a problem is done; most steps; most updates of an inner
#: problem, and sweeps between two looks at what is solved.
TOLERANCE, LEAST_GAIN, MOST_STEPS, MOST_UPDATES, SWEEPS = 2e-6, 1e-9, 60, 2_000, 4
#: Least curvature of a row, a share of the greatest, 1/4; steps from one sum of the curvature to the next.
LEAST_CURVATURE, RENEWED = 0.0005, 3
#: Rows of a task of a pass, which holds the margins of all problems for each of them.
TASK_ROWS = 20_000


@dataclass
class L1Path:
    """Fitted path: ``strengths`` C, ``weights`` (points x features) and ``intercepts`` of all rows, the scores of the folds."""

    strengths: np.ndarray
    weights: np.ndarray
    intercepts: np.ndarray
    fold_weights: np.ndarray
    fold_intercepts: np.ndarray
    passes: int
    working_set: int
    steps: int
    precision: list[float] | None = None
    log_loss: list[float] | None = None
    best: int = 0

    def score(self, rows: DataFrame) -> DataFrame:
        """(score, label, weight) of sparse rows under the best point of all rows."""
        return _scores(rows, self.weights[[self.best]], self.intercepts[[self.best]], None).select("score", "label", F.col("n").alias("weight"))


def sparse_rows(prepared: DataFrame, features: str = "features", label: str = "label", key: Sequence[str] | None = None, folds: int = 4) -> DataFrame:
    """(label, fold, idx, val) from a vector column; the fold is the digest of ``key`` (all plain columns) modulo ``folds``."""
    dense = vector_to_array(F.col(features))
    every = F.transform(dense, lambda x, i: F.struct(i.alias("i"), x.alias("v")))
    full = F.filter(every, lambda e: e.v != 0)
    named = key or [f.name for f in prepared.schema if f.name not in (features,) and f.dataType.typeName() in ("string", "long", "integer", "double")]
    rows = prepared.select(F.col(label).cast("double").alias("label"), fold_of(named, folds).alias("fold"), full.alias("_e"))
    return rows.select("label", "fold", F.transform("_e", lambda e: e.i).alias("idx"), F.transform("_e", lambda e: e.v).alias("val"))


def counted(rows: DataFrame) -> DataFrame:
    """Sparse rows, those of equal label, fold and values as one with their number ``n``, in tasks of about TASK_ROWS.

    All sums of the path over the rows are sums over these, each times its ``n``.
    """
    return spread(rows.groupBy("label", "fold", "idx", "val").agg(F.count(F.lit(1)).cast("double").alias("n")), TASK_ROWS)


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``n``; plain ones stand for themselves."""
    return rows if "n" in rows.columns else rows.withColumn("n", F.lit(1.0))


def fold_of(key: Sequence[str], folds: int):
    return (F.conv(F.substring(hash_key(*key), 1, 8), 16, 10).cast("long") % folds).cast("int")


def _slices(batches: Iterator[pa.RecordBatch], place: np.ndarray, width: int, problems: int):
    """(X, label, fold, n, others) of slices of rows: a dense part for the placed features, (row, feature, value) of the rest."""
    count = max(1, SLICE // max(width, problems, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, count):
            part = batch.slice(at, count)
            lists = part.column("idx")
            idx = lists.flatten().to_numpy(zero_copy_only=False)
            val = part.column("val").flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
            row = np.repeat(np.arange(part.num_rows), sizes)
            x = np.zeros((part.num_rows, width))
            x[:, 0] = 1.0
            to = place[idx]
            inside = to >= 0
            x[row[inside], to[inside]] = val[inside]
            rest = row[~inside], idx[~inside], val[~inside]
            yield x, part.column("label").to_numpy(), part.column("fold").to_numpy(), part.column("n").to_numpy(), rest


def _residuals(x, label, fold, n, weights, left_out):
    """Loss per problem and d loss / d margin, ``n`` times for each row, zero in the rows that a problem leaves out."""
    z = x @ weights
    inside = (fold[:, None] != left_out[None, :]) * n[:, None]
    positive = label[:, None]
    loss = (np.logaddexp(0.0, z) - positive * z) * inside
    return loss.sum(axis=0), (1.0 / (1.0 + np.exp(-z)) - positive) * inside


def _summed(rows: DataFrame, groups: int, work, size: int) -> np.ndarray:
    """The sum of one array per task: tasks' arrays are added up in groups before the driver adds the groups."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(size)
        work(batches, total)
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId() % groups], pa.int32()), "body": pa.array([total.tobytes()], pa.binary())})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for body in batch.column("body"):
                total += np.frombuffer(body.as_buffer(), np.float64)
        yield pa.RecordBatch.from_pydict({"body": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(partial, "part int, body binary")
    parts = parts if groups == 1 else parts.repartition(groups, "part")
    out = np.zeros(size)
    for r in parts.mapInArrow(added, "body binary").collect():
        out += np.frombuffer(r["body"], np.float64)
    return out


def _gradients(rows, groups, place, weights, left_out) -> tuple[np.ndarray, np.ndarray]:
    """Losses and gradients (features x problems) of all problems, from one pass."""
    width, problems = weights.shape

    def work(batches, total):
        loss, gradient = total[:problems], total[problems:].reshape(width, problems)
        for x, label, fold, n, _ in _slices(batches, place, width, problems):
            own, residual = _residuals(x, label, fold, n, weights, left_out)
            loss += own
            gradient += x.T @ residual

    total = _summed(rows, groups, work, problems * (width + 1))
    return total[:problems], total[problems:].reshape(width, problems)


def _curvatures(rows, groups, place, weights, left_out, folds, blocks) -> np.ndarray:
    """Per left-out fold (the last: none) and block of features, the sum of h x x' over the rows.

    h is the mean of p (1 - p) over the fold's problems, and never below a share of its greatest value, 1/4.
    """
    sizes = [len(b) ** 2 for b in blocks]
    width, problems = weights.shape

    def work(batches, total):
        for x, _, fold, n, _ in _slices(batches, place, width, problems):
            p = 1.0 / (1.0 + np.exp(-(x @ weights)))
            h = p * (1 - p)
            for f in range(folds + 1):
                own = left_out == f
                if not own.any():
                    continue
                height = np.sqrt(np.maximum(h[:, own].mean(axis=1), LEAST_CURVATURE) * (fold != f) * n)
                bent = x * height[:, None]
                at = f * sum(sizes)
                for b, size in zip(blocks, sizes, strict=True):
                    total[at : at + size] += (bent[:, b].T @ bent[:, b]).ravel()
                    at += size

    return _summed(rows, groups, work, (folds + 1) * sum(sizes)).reshape(folds + 1, -1)


def _violators(rows, place, weights, left_out, penalty) -> list[int]:
    """Features outside the working set whose gradient exceeds a problem's penalty; summed and tested on the executors."""
    width, problems = weights.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for x, label, fold, n, (row, idx, val) in _slices(batches, place, width, problems):
            if len(idx):
                _, residual = _residuals(x, label, fold, n, weights, left_out)
                order = np.argsort(idx, kind="stable")
                row, idx, val = row[order], idx[order], val[order]
                firsts = np.flatnonzero(np.concatenate([[True], idx[1:] != idx[:-1]]))
                for a, b in zip(firsts.tolist(), [*firsts[1:].tolist(), len(idx)], strict=True):
                    own = val[a:b] @ residual[row[a:b]]
                    j = int(idx[a])
                    sums[j] = sums[j] + own if j in sums else own
        yield pa.RecordBatch.from_pydict({"j": pa.array(list(sums), pa.int32()), "body": pa.array([s.tobytes() for s in sums.values()], pa.binary())})

    def tested(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_buffer(), np.float64) for b in table.column("body"))
        bad = bool((np.abs(total) > penalty * (1 + 1e-6)).any())
        return pa.table({"j": pa.array(table.column("j").to_pylist()[:1] if bad else [], pa.int32())})

    sums = rows.mapInArrow(partial, "j int, body binary")
    return sorted(r["j"] for r in sums.groupBy("j").applyInArrow(tested, "j int").collect())


def _soft(x, limit):
    return np.sign(x) * np.maximum(np.abs(x) - limit, 0.0)


def _inner(gradient, weights, curvature, scale, penalty, tolerance):
    """Minimises g'd + scale / 2 d'Hd + penalty |w + d| for all problems (columns) of one fold.

    Sweeps over the coordinates of all unsolved problems at once; a problem leaves when a sweep moves it too little.
    """
    new, product = weights.copy(), np.zeros_like(weights)
    diagonal = np.diag(curvature)
    used = np.flatnonzero(diagonal > 0)
    todo = np.arange(weights.shape[1])
    for _ in range(max(10, MOST_UPDATES // max(SWEEPS * len(used), 1))):
        own, moving = new[:, todo], product[:, todo]
        for _ in range(SWEEPS):
            moved = np.zeros(len(todo))
            for j in used:
                height = scale[todo] * diagonal[j]
                step = _soft(own[j] - (gradient[j, todo] + scale[todo] * moving[j]) / height, penalty[j, todo] / height) - own[j]
                if step.any():
                    own[j] += step
                    moving += curvature[:, j, None] * step
                    np.maximum(moved, np.abs(step) * height, out=moved)
        new[:, todo], product[:, todo] = own, moving
        todo = todo[moved > tolerance]
        if not len(todo):
            break
    return new, product


def fit_path(
    rows: DataFrame, size: int, strengths: Sequence[float], folds: int = 4, seed_features: int = SEED_FEATURES,
    tolerance: float = TOLERANCE, block: int = BLOCK_FEATURES,
) -> L1Path:
    """Weights that minimise the summed log loss + |w| / C, for every C and every left-out fold, and for all rows.

    ``rows`` holds (label 0 or 1, fold, idx, val): sparse rows over ``size`` features, fold below ``folds``; with ``n``, a row counts so often.
    All (C, fold) problems are columns of one weight matrix. A step is one pass over the rows: the matrix product gives all
    margins, another one all gradients. The curvature matrix of a fold, at the mean p (1 - p) of its problems, is summed
    every RENEWED steps over the problems still open; it makes the step's quadratic problem, which the driver solves by coordinates. A step
    that the next pass finds above its quadratic value is taken back and the problem's curvature doubled, in the end to
    1/4 for every row, which bounds the loss. After MOST_STEPS a problem stays as it is. A problem whose optimality conditions hold, or that a step improved by
    less than LEAST_GAIN of its loss (flat valleys of equal features), leaves the passes.

    Points advance side by side, so none waits for its neighbour. Features enter by the size of their
    gradient at no weights; when all problems are solved, one pass sums the gradients of the features left
    out, on the executors, and those that break the optimality conditions join, until none does; the
    weights so far are kept. So the driver holds weights and curvature of features that matter. Beyond ``block``
    features the curvature is kept in diagonal blocks, whose number times their sum is a bound too.
    """
    rows = _numbered(rows)
    strengths = np.asarray(strengths, float)
    points = len(strengths)
    left_out = np.repeat(np.arange(folds + 1), points)  # the last: no fold is left out
    penalty = np.tile(1.0 / strengths, folds + 1)
    first = rows.groupBy("fold").agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("pos")).collect()
    n, positive = np.zeros(folds), np.zeros(folds)
    for r in first:
        n[r["fold"]], positive[r["fold"]] = r["n"], r["pos"]
    n, positive = np.append(n.sum() - n, n.sum()), np.append(positive.sum() - positive, positive.sum())
    share = np.clip((positive + 1e-9) / (n + 2e-9), 1e-6, 1 - 1e-6)
    centred = F.col("e.val") * (F.col("label") - float(share[-1])) * F.col("n")
    found = rows.select("label", "n", F.explode(F.arrays_zip("idx", "val")).alias("e")).groupBy(F.col("e.idx").alias("j")).agg(F.abs(F.sum(centred)).alias("g"))
    active = sorted(r["j"] for r in found.orderBy(F.desc("g"), "j").limit(seed_features).collect())
    passes, steps = 2, 0
    known: dict[int, np.ndarray] = {}
    problems, slack = len(penalty), tolerance * penalty.max()
    intercept = np.log(share / (1 - share))[left_out]
    groups = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    while True:
        width = len(active) + 1
        place = np.full(size, -1, np.int64)
        place[active] = np.arange(1, width)
        weights = np.zeros((width, problems))
        weights[0] = intercept
        for k, j in enumerate(active, 1):
            if j in known:
                weights[k] = known[j]
        blocks = [np.arange(a, min(a + block, width)) for a in range(0, width, block)]
        cuts = np.cumsum([0, *[len(b) ** 2 for b in blocks]])
        limit = np.zeros((width, problems))
        limit[1:] = penalty
        live = np.arange(problems)
        trial, bound = weights.copy(), np.full(problems, np.inf)
        gradient, value = np.zeros_like(weights), np.full(problems, np.inf)
        scale = np.ones(problems)
        for step in range(MOST_STEPS):
            loss, slopes = _gradients(rows, groups, place, trial[:, live], left_out[live])
            passes, steps = passes + 1, steps + 1
            now = loss + (limit[:, live] * np.abs(trial[:, live])).sum(axis=0)
            good = now <= bound[live] + 1e-9 * np.abs(now)
            still = good & (value[live] - now < LEAST_GAIN * (1.0 + np.abs(now)))
            taken, back = live[good], live[~good]
            weights[:, taken], gradient[:, taken], value[taken] = trial[:, taken], slopes[:, good], now[good]
            scale[back] = np.minimum(2 * scale[back], 0.25 / LEAST_CURVATURE)
            rest = np.where(
                weights[:, live] != 0, np.abs(gradient[:, live] + limit[:, live] * np.sign(weights[:, live])),
                np.maximum(np.abs(gradient[:, live]) - limit[:, live], 0.0),
            ).max(axis=0)
            live = live[(rest > slack) & ~still]
            if not len(live):
                break
            if step % RENEWED == 0:
                flat = _curvatures(rows, groups, place, weights[:, live], left_out[live], folds, blocks)
                scale[:], passes = 1.0, passes + 1
            for f in range(folds + 1):
                own = live[left_out[live] == f]
                if not len(own):
                    continue
                bound[own] = value[own]
                for i, b in enumerate(blocks):
                    curvature = flat[f, cuts[i] : cuts[i + 1]].reshape(len(b), len(b)) * len(blocks)
                    new, product = _inner(
                        gradient[np.ix_(b, own)], weights[np.ix_(b, own)], curvature, scale[own], limit[np.ix_(b, own)], 0.2 * slack
                    )
                    change = new - weights[np.ix_(b, own)]
                    bound[own] += (gradient[np.ix_(b, own)] * change).sum(axis=0) + 0.5 * scale[own] * (change * product).sum(axis=0)
                    bound[own] += (limit[np.ix_(b, own)] * (np.abs(new) - np.abs(weights[np.ix_(b, own)]))).sum(axis=0)
                    trial[np.ix_(b, own)] = new
        outside = _violators(rows, place, weights, left_out, penalty) if len(active) < size else []
        passes += len(active) < size
        if not outside:
            break
        known = {j: weights[k] for k, j in enumerate(active, 1)}
        intercept = weights[0]
        active = sorted({*active, *outside})
    full = np.zeros((problems, size))
    full[:, active] = weights[1:].T
    whole = left_out == folds
    return L1Path(strengths, full[whole], weights[0, whole], full[~whole].reshape(folds, points, size), weights[0, ~whole].reshape(folds, points), passes, len(active), steps)


def _scores(rows: DataFrame, weights: np.ndarray, intercepts: np.ndarray, own_fold: int | None) -> DataFrame:
    """(point, score, label, n) of the rows, or of those of one fold, under each point."""
    used = np.flatnonzero((weights != 0).any(axis=0))
    place = np.full(max(weights.shape[1], 1), -1, np.int64)
    place[used] = np.arange(1, len(used) + 1)
    table = np.concatenate([intercepts[None, :], weights[:, used].T])
    points = len(intercepts)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, label, _, n, _ in _slices(batches, place, len(table), points):
            score = 1.0 / (1.0 + np.exp(-(x @ table)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(points, dtype=np.int32), len(x))), pa.array(score.ravel()), pa.array(np.repeat(label, points)), pa.array(np.repeat(n, points))],
                ["point", "score", "label", "n"],
            )

    rows = _numbered(rows)
    chosen = rows if own_fold is None else rows.where(F.col("fold") == own_fold)
    return chosen.mapInArrow(scored, "point int, score double, label double, n double")


def with_fold_scores(path: L1Path, rows: DataFrame) -> L1Path:
    """The path with the mean average precision and log loss of its points on the folds left out, and its best point.

    The rows of all folds and points are counted by score in one aggregation; the smallest C wins ties.
    """
    folds = path.fold_weights.shape[0]
    each = None
    for f in range(folds):
        scored = _scores(rows, path.fold_weights[f], path.fold_intercepts[f], f).withColumn("fold", F.lit(f))
        each = scored if each is None else each.unionAll(scored)
    loss = -(F.col("label") * F.log(F.greatest("score", F.lit(1e-15))) + (1 - F.col("label")) * F.log(F.greatest(1 - F.col("score"), F.lit(1e-15))))
    n = F.col("n")
    counts = cut_lineage(
        each.groupBy("fold", "point", "score").agg(F.sum(n * F.col("label")).alias("pos"), F.sum(n * (1 - F.col("label"))).alias("neg"), F.sum(n * loss).alias("loss"))
    )
    totals = counts.groupBy(F.col("fold").alias("_f"), F.col("point").alias("_p")).agg(
        F.sum("pos").alias("all"), F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("loss").alias("loss_sum")
    )
    curve = running_totals(counts.select("fold", "point", "score", "pos", "neg"), [-F.col("score")], ["pos", "neg"], ["fold", "point"])
    above = F.col("pos") + F.col("pos_before")
    gained = curve.groupBy("fold", "point").agg(F.sum(F.col("pos") * above / (above + F.col("neg") + F.col("neg_before"))).alias("ap"))
    joined = gained.join(totals, (F.col("fold") == F.col("_f")) & (F.col("point") == F.col("_p")))
    means = joined.groupBy("point").agg(F.avg(F.try_divide("ap", "all")).alias("ap"), (F.sum("loss_sum") / F.sum("n")).alias("loss"))
    found = {r["point"]: r for r in means.collect()}
    path.precision = [found[k]["ap"] if k in found and found[k]["ap"] is not None else 0.0 for k in range(len(path.strengths))]
    path.log_loss = [found[k]["loss"] if k in found else math.nan for k in range(len(path.strengths))]
    path.best = max(range(len(path.strengths)), key=lambda k: (round(path.precision[k], 12), -k))
    path.passes += 1
    return path


def strengths_of(rows: DataFrame, points: int = 50, top: float = 5000.0) -> list[float]:
    """C from the smallest useful one, 2 / max |X'(2y - 1)|, to ``top`` times it in equal steps."""
    signed = F.col("e.val") * (2 * F.col("label") - 1) * F.col("n")
    sums = _numbered(rows).select("label", "n", F.explode(F.arrays_zip("idx", "val")).alias("e")).groupBy("e.idx").agg(F.abs(F.sum(signed)).alias("g"))
    lowest = 2.0 / max(sums.agg(F.max("g")).first()[0] or 0.0, 1e-12)
    return [lowest + (lowest * top - lowest) * i / max(points - 1, 1) for i in range(points)]


def searched_path(rows: DataFrame, size: int, points: int = 50, folds: int = 4, top: float = 5000.0) -> L1Path:
    """The path over ``strengths_of`` with the point of the best mean average precision over the folds left out."""
    return with_fold_scores(fit_path(rows, size, strengths_of(rows, points, top), folds), rows)
