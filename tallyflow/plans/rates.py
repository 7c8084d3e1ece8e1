"""Hierarchical success rates with smoothed Beta-binomial priors, and their back-test."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.mapping import day_bin, success_flag
from tallyflow.functions.maths import LOOSE_EPS, log_loss, posterior_mean, smoothing_weight, squared_error
from tallyflow.operators.cleaning import fill_strings, first_per_key
from tallyflow.operators.priors import beta_priors
from tallyflow.session import cut_lineage
from tallyflow.streaming import with_late_outcomes

# Trials a child needs, and the model id of the logged baseline.
MIN_TRIALS = 200
BASELINE_MODEL = "waterfalltoprank"


PAYLOAD = (
    "properties struct<istest:string,timeonpage:string,modelid:string,installationsource:string,"
    "modelrecommendationprobability:string>"
)


def _kind(events: DataFrame, kind: str, start: date, end: date) -> DataFrame:
    """One kind of log row with year pruning, payload parsed once as ``p``.

    Test traffic and rows without id are dropped.
    """
    return (
        events.where(
            (F.col("event") == kind)
            & (F.col("year") >= start.year)
            & (F.col("year") <= end.year)
            & (F.col("time") >= F.lit(start))
            & (F.col("time") <= F.lit(end))
            & F.col("messageid").isNotNull()
        )
        .withColumn("p", F.from_json("properties", PAYLOAD).getField("properties"))
        .where(F.col("p.istest") == "false")
    )


def _trial_columns() -> list[Column]:
    return [
        F.col("time"),
        F.col("carriername").alias("carrier_name"),
        F.col("daysfromeulaapproval").cast("double").alias("days_from_eula"),
        F.col("messageid").alias("message_id"),
        F.col("messagetype").alias("message_type"),
        F.col("devicevendor").alias("device_vendor"),
    ]


def trial_notifications(events: DataFrame, start: date, end: date) -> DataFrame:
    """Received notifications, one row per message: the earliest."""
    rows = _kind(events, "contentitem_received", start, end).withColumn("_tie", F.xxhash64("properties"))
    return first_per_key(rows.select(*_trial_columns(), "_tie"), ["message_id"], ["time", "_tie"]).drop("_tie")


def baseline_notifications(events: DataFrame, start: date, end: date) -> DataFrame:
    """Notifications of the baseline model with its logged probability; missing strings are ``unset``."""
    rows = _kind(events, "contentitem_received", start, end).where(F.col("p.modelid") == BASELINE_MODEL)
    rows = rows.select(
        *_trial_columns(),
        F.col("programname").alias("program_name"),
        F.col("p.installationsource").alias("installation_source"),
        F.col("p.modelrecommendationprobability").try_cast("double").alias("waterfall_p"),
        F.xxhash64("properties").alias("_tie"),
    )
    return fill_strings(first_per_key(rows, ["message_id"], ["time", "_tie"]).drop("_tie"))


def with_day_bins(items: DataFrame) -> DataFrame:
    """Receive date and lettered day bin; rows without days are left out."""
    return (
        items.where(F.col("days_from_eula").isNotNull())
        .withColumns({"receive_date": F.to_date("time"), "days_from_eula_bin": day_bin(F.col("days_from_eula"))})
        .drop("time", "days_from_eula")
    )


def time_on_page(events: DataFrame, start: date, end: date) -> DataFrame:
    seconds = F.col("p.timeonpage").try_cast("double")
    rows = with_late_outcomes(_kind(events, "contentitem_timeonpage", start, end + timedelta(days=2)), "time", start, end)
    return (
        rows.where(seconds.isNotNull())
        .groupBy(F.col("messageid").alias("message_id"))
        .agg(F.max(seconds).alias("time_on_page"))
    )


def with_outcomes(items: DataFrame, seconds: DataFrame) -> DataFrame:
    """Every trial with its 0/1 success; a trial without outcome failed."""
    outcome = seconds.select("message_id", success_flag(F.col("time_on_page")).alias("success"))
    return items.join(outcome, "message_id", "left").na.fill(0, subset=["success"])


def training_rows(events: DataFrame, start: date, end: date) -> DataFrame:
    items = with_day_bins(trial_notifications(events, start, end))
    rows = with_outcomes(items, time_on_page(events, start, end))
    return fill_strings(rows).withColumn("trial", F.lit(1))


def sum_by(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("trial").alias("trial"), F.sum("success").alias("success"))


def smoothed(daily: DataFrame, gamma: float, day: str = "receive_date") -> DataFrame:
    """Add exponentially weighted counts; the lag runs back from the newest day in the data."""
    daily = cut_lineage(daily)
    last = daily.agg(F.max(day)).scalar()
    weight = smoothing_weight(gamma, F.col(day), last)
    return daily.withColumns({"trial_smooth": weight * F.col("trial"), "success_smooth": weight * F.col("success")})


def node_table(daily: DataFrame, hierarchy: Sequence[str]) -> DataFrame:
    """One row per node of every level, raw and smoothed sums; ``level`` is the number of keys set.

    Keys must not be null. Days are summed to leaves first, so the rollup expands leaves only.
    """
    names = ("trial", "success", "trial_smooth", "success_smooth")
    leaves = daily.groupBy(*hierarchy).agg(*[F.sum(n).alias(n) for n in names])
    level = F.lit(len(hierarchy)) - F.bit_count(F.grouping_id())
    return leaves.rollup(*hierarchy).agg(level.cast("int").alias("level"), *[F.sum(n).alias(n) for n in names])


def _parents(hierarchy: Sequence[str]) -> list[Column]:
    """Key columns of a node's parent: the node's own last key is blanked."""
    return [F.when(F.col("level") > i + 1, F.col(k)).alias("p_" + k) for i, k in enumerate(hierarchy)]


PriorFit = Callable[[DataFrame, Sequence[str]], DataFrame]


def prior_candidates(nodes: DataFrame, hierarchy: Sequence[str], min_trials: float, min_children: int = 5) -> DataFrame:
    """Nodes that may shape their parent's prior, with the parent's key and the smoothed pair."""
    parent = ["level", *["p_" + k for k in hierarchy]]
    busy = nodes.where((F.col("level") > 0) & (F.col("trial") > min_trials)).select(
        "level", *_parents(hierarchy), F.col("trial_smooth").alias("trial"), F.col("success_smooth").alias("success")
    )
    sizes = busy.groupBy(*[F.col(p).alias("_g_" + p) for p in parent]).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.where(F.col("_n") > min_children)
    on = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col("_g_" + p)) for p in parent])
    return busy.join(sizes, on).drop("_n", *["_g_" + p for p in parent])


def rate_model(
    daily: DataFrame,
    hierarchy: Sequence[str],
    min_trials: float = MIN_TRIALS,
    min_children: int = 5,
    fit: PriorFit = beta_priors,
) -> DataFrame:
    """Node table with the prior of each node's parent and the posterior probability.

    Nodes below the trial threshold still get a probability when their parent has a prior;
    a parent without prior has no child rows. The root keeps its plain rate. The node
    table is checkpointed, because every later step reads it: the trials are read once.
    """
    nodes = cut_lineage(node_table(daily, hierarchy))
    parent = ["level", *["p_" + k for k in hierarchy]]
    priors = fit(prior_candidates(nodes, hierarchy, min_trials, min_children), parent)
    children = nodes.where(F.col("level") > 0).select("*", *_parents(hierarchy))
    renamed = priors.select(*[F.col(p).alias("_q_" + p) for p in parent], "alpha", "beta")
    on = reduce(lambda a, b: a & b, [children[p].eqNullSafe(renamed["_q_" + p]) for p in parent])
    with_prior = children.join(renamed, on).select(*nodes.columns, "alpha", "beta")
    root = nodes.where(F.col("level") == 0).withColumns({"alpha": F.lit(0.0), "beta": F.lit(0.0)})
    return with_prior.unionByName(root).withColumn(
        "probability",
        posterior_mean(F.col("trial_smooth"), F.col("success_smooth"), F.col("alpha"), F.col("beta")),
    )


def published_rows(model: DataFrame, hierarchy: Sequence[str]) -> DataFrame:
    return model.select("level", *hierarchy, "probability")


def with_probability(rows: DataFrame, model: DataFrame, hierarchy: Sequence[str], out: str = "probability") -> DataFrame:
    """Probability of the deepest known key prefix; the root answers last.

    The levels are joined to the different key tuples only; the rows take part in one join.
    """
    keys = _looked_up(rows.select(*hierarchy).distinct(), model, hierarchy, "_p")
    keys = keys.select(*[F.col(k).alias("_k_" + k) for k in hierarchy], F.col("_p").alias("_p"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col("_k_" + k)) for k in hierarchy])
    return rows.join(keys, on, "left").select(*rows.columns, F.col("_p").alias(out))


def _looked_up(rows: DataFrame, model: DataFrame, hierarchy: Sequence[str], out: str) -> DataFrame:
    found, looked = [], rows
    for depth in range(len(hierarchy), 0, -1):
        keys = hierarchy[:depth]
        level = model.where(F.col("level") == depth).select(
            *[F.col(k).alias(f"_{depth}_{k}") for k in keys], F.col("probability").alias(f"_p{depth}")
        )
        on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{depth}_{k}") for k in keys])
        looked = looked.join(level, on, "left")
        found.append(F.col(f"_p{depth}"))
    root = model.where(F.col("level") == 0).select("probability").scalar()
    return looked.select(*rows.columns, F.coalesce(*found, root).alias(out))


def with_baseline_errors(rows: DataFrame, p: str = "waterfall_p") -> DataFrame:
    return rows.withColumns(
        {
            "log_loss": log_loss(F.col(p), F.col("success"), LOOSE_EPS),
            "mse": squared_error(F.col(p), F.col("success")),
        }
    )


def baseline_metrics(rows: DataFrame, p: str = "waterfall_p") -> DataFrame:
    return with_baseline_errors(rows, p).agg(
        F.avg("log_loss").alias("baseline_log_loss"), F.avg("mse").alias("baseline_mse")
    )


def model_metrics(rows: DataFrame, model: DataFrame, hierarchy: Sequence[str]) -> DataFrame:
    """Mean log-loss and squared error of the looked-up probabilities.

    Rows with equal keys and outcome are counted once before the lookup, so a hot key is
    one row in every join.
    """
    grouped = rows.groupBy(*hierarchy, "success").agg(F.count(F.lit(1)).alias("n"))
    scored = _looked_up(grouped, model, hierarchy, "probability")
    mean = lambda e: F.try_divide(F.sum(e * F.col("n")), F.sum("n"))
    p, y = F.col("probability"), F.col("success")
    return scored.agg(
        mean(log_loss(p, y, LOOSE_EPS)).alias("model_log_loss"), mean(squared_error(p, y)).alias("model_mse")
    )


def train(events: DataFrame, end: date, days: int, gamma: float, hierarchy: Sequence[str], **options) -> DataFrame:
    """Model of the ``days`` up to ``end``."""
    rows = training_rows(events, end - timedelta(days=days), end)
    daily = smoothed(sum_by(rows, [*hierarchy, "receive_date"]), gamma)
    return rate_model(daily, hierarchy, **options)


def evaluation_rows(events: DataFrame, end: date) -> DataFrame:
    """Baseline notifications of the day after ``end`` with their outcomes."""
    items = with_day_bins(baseline_notifications(events, end, end + timedelta(days=1)))
    return with_outcomes(items, time_on_page(events, end, end + timedelta(days=1)))


def backtest(events: DataFrame, end: date, days: int, gamma: float, hierarchy: Sequence[str], **options) -> DataFrame:
    """One row: errors of the logged baseline and of the model on the next day."""
    model = train(events, end, days, gamma, hierarchy, **options)
    rows = evaluation_rows(events, end)
    base = baseline_metrics(rows)
    return model_metrics(rows, model, hierarchy).withColumns(
        {name: base.select(name).scalar() for name in base.columns}
    )
