"""Exact model metrics as aggregations over (score, label[, weight]) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.maths import log_loss, squared_error
from tallyflow.operators.ordering import exact_quantiles, numbered, running_totals
from tallyflow.operators.profile import histogram



def scored(df: DataFrame, score: Column, label: Column, weight: Column | None = None) -> DataFrame:
    """Rows in the shape every metric here reads."""
    w = F.lit(1.0) if weight is None else weight.cast("double")
    return df.select(score.cast("double").alias("score"), label.cast("double").alias("label"), w.alias("weight"))


def by_score(rows: DataFrame) -> DataFrame:
    """One row per distinct score: positive and negative weight."""
    return rows.groupBy("score").agg(
        F.sum(F.col("label") * F.col("weight")).alias("pos"),
        F.sum((1 - F.col("label")) * F.col("weight")).alias("neg"),
    )


def roc_auc(rows: DataFrame) -> DataFrame:
    """Tie-aware area under the ROC curve, weighted."""
    curve = running_totals(by_score(rows), ["score"], ["neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    return curve.agg(F.try_divide(wins, F.sum("pos") * F.sum("neg")).alias("auc"))


def pr_curve(rows: DataFrame) -> DataFrame:
    """(threshold, precision, recall, step) for every distinct score, counting scores at or above it."""
    points = by_score(rows)
    totals = points.agg(F.sum("pos")).scalar()
    curve = running_totals(points, [-F.col("score")], ["pos", "neg"])
    above_pos = F.col("pos") + F.col("pos_before")
    above = above_pos + F.col("neg") + F.col("neg_before")
    return curve.select(
        F.col("score").alias("threshold"),
        F.try_divide(above_pos, above).alias("precision"),
        F.try_divide(above_pos, totals).alias("recall"),
        F.try_divide(F.col("pos"), totals).alias("step"),
    )


def average_precision(rows: DataFrame) -> DataFrame:
    return pr_curve(rows).agg(F.sum(F.col("precision") * F.col("step")).alias("average_precision"))


def best_f1(rows: DataFrame) -> DataFrame:
    """The cutoff with the greatest F1; the lowest one on ties."""
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    scored_curve = pr_curve(rows).withColumn("f1", f1)
    best = F.max_by(F.struct("threshold", "precision", "recall", "f1"), F.struct(F.col("f1"), -F.col("threshold")))
    return scored_curve.agg(best.alias("b")).select("b.*")


def class_report(rows: DataFrame, cutoff: Column) -> DataFrame:
    """Precision, recall, F1 and support per class, predicting 1 above the cutoff."""
    cells = rows.withColumn("pred", (F.col("score") > cutoff).cast("int")).groupBy("label", "pred").agg(
        F.sum("weight").alias("n")
    )
    of = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0.0))
    per_class = [
        F.struct(
            F.lit(k).alias("class"),
            of((F.col("label") == k) & (F.col("pred") == k)).alias("tp"),
            of(F.col("pred") == k).alias("predicted"),
            of(F.col("label") == k).alias("support"),
        )
        for k in (0, 1)
    ]
    out = cells.agg(F.array(*per_class).alias("r")).select(F.inline("r"))
    precision, recall = F.try_divide("tp", "predicted"), F.try_divide("tp", "support")
    return out.select(
        "class", precision.alias("precision"), recall.alias("recall"),
        F.try_divide(2 * precision * recall, precision + recall).alias("f1"), "support",
    )


def calibration(rows: DataFrame, direction: str = "predicted_over_actual") -> DataFrame:
    """Weighted sum of predictions over sum of labels, or the inverse."""
    p, y = F.sum(F.col("score") * F.col("weight")), F.sum(F.col("label") * F.col("weight"))
    ratio = F.try_divide(p, y) if direction == "predicted_over_actual" else F.try_divide(y, p)
    return rows.agg(ratio.alias("calibration"))


def _mean(value: Column) -> Column:
    """Weighted mean of the values that are not null."""
    return F.try_divide(F.sum(value * F.col("weight")), F.sum(F.when(value.isNotNull(), F.col("weight"))))


def errors(rows: DataFrame) -> DataFrame:
    mse = _mean(squared_error(F.col("score"), F.col("label")))
    return rows.agg(
        mse.alias("mse"), F.sqrt(mse).alias("rmse"), _mean(log_loss(F.col("score"), F.col("label"))).alias("log_loss")
    )


def confusion(rows: DataFrame) -> DataFrame:
    """Counts per (label, predicted class); scores round half-even."""
    return rows.groupBy(
        F.col("label").cast("int").alias("label"), F.bround("score", 0).cast("int").alias("pred")
    ).agg(F.count(F.lit(1)).alias("n"))


def accuracy(rows: DataFrame) -> DataFrame:
    return rows.agg(_mean((F.bround("score", 0) == F.col("label")).cast("double")).alias("accuracy"))


def _below(edges: Column, value: Column) -> Column:
    return F.size(F.filter(edges, lambda e: e < value))


def reliability(rows: DataFrame, bins: int = 10) -> DataFrame:
    """Mean prediction and true fraction in bins ((b-1)/n, b/n]; bins without positives are left out.

    A score of exactly 0 is in no bin. Edges are compared as doubles, not recomputed.
    """
    edges = F.array(*[F.lit((b - 1) / float(bins)) for b in range(1, bins + 1)])
    return (
        rows.where((F.col("score") > 0) & (F.col("score") <= 1))
        .groupBy(_below(edges, F.col("score")).alias("bin"))
        .agg(F.avg("score").alias("mean_predicted"), F.avg("label").alias("true_fraction"), F.count(F.lit(1)).alias("n"))
        .where(F.col("true_fraction") > 0)
    )


def quantile_bins(rows: DataFrame, step: int = 5) -> DataFrame:
    """Mean label and prediction between successive quantiles (low, high]; the minimum is in none."""
    cuts = exact_quantiles(rows, "score", [i / 100 for i in range(0, 101, step)])
    edges = cuts.agg(F.array_sort(F.collect_list("q"))).scalar()
    return (
        rows.withColumn("_edges", edges)
        .withColumn("bin", _below(F.col("_edges"), F.col("score")))
        .where(F.col("bin") > 0)
        .groupBy("bin")
        .agg(F.avg("label").alias("label"), F.avg("score").alias("pred"), F.count(F.lit(1)).alias("n"))
    )


def equal_count_bins(df: DataFrame, score: str, label: str, tie: str, bins: int = 20) -> DataFrame:
    """Means over ``bins`` equal-count bins by falling score; the first bins take the remainder."""
    total = df.agg(F.count(F.lit(1))).scalar()
    placed = numbered(df.select(score, label, tie).withColumn("_n", total), [-F.col(score), tie])
    small, rest = F.floor(F.col("_n") / bins), F.col("_n") % bins
    big_rows = rest * (small + 1)
    bin_no = F.when(F.col("idx") < big_rows, F.floor(F.col("idx") / (small + 1))).otherwise(
        rest + F.floor(F.try_divide(F.col("idx") - big_rows, small))
    )
    return (
        placed.groupBy((bin_no + 1).cast("int").alias("bin"))
        .agg(F.avg(score).alias("mean_score"), F.avg(label).alias("mean_label"), F.count(F.lit(1)).alias("n"))
    )


def clicks_per_mille(rows: DataFrame, per: str = "rows") -> DataFrame:
    """1000 x weighted clicks per row, or per weight."""
    base = F.count(F.lit(1)) if per == "rows" else F.sum("weight")
    return rows.agg(F.try_divide(1000 * F.sum(F.col("label") * F.col("weight")), base).alias("ctrpm"))


def residual_histogram(rows: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(rows.withColumn("residual", F.col("label") - F.col("score")), "residual", bins)


