"""String buckets from close pairs, and k-means with its variance ratio."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyflow.operators.similarity import close_strings
from tallyflow.session import cut_lineage, spread

#: Rounds of messages between two looks at the exemplars.
CHECKED_ROUNDS = 5

#: Most rows of a task of k-means, on average.
TASK_ROWS = 100_000


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(vertex, cluster): connected components, named by their smallest vertex.

    Each round takes the smallest label among neighbours, then jumps to that label's own
    label, so long chains need few rounds. Labels only fall, so the rounds end when none does.
    Lineage is cut by a checkpoint per round.
    """
    both = cut_lineage(
        edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(edges.select("b", "a")).distinct()
    )
    labels = cut_lineage(vertices.select(F.col(vertices.columns[0]).alias("v")).distinct().withColumn("label", F.col("v")))
    while True:
        around = both.join(labels.select(F.col("v").alias("u"), F.col("label").alias("near")), "u")
        best = around.groupBy("v").agg(F.min("near").alias("near"))
        lower = labels.join(best, "v", "left").select("v", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("v").alias("new"), F.col("label").alias("jumped"))
        moved = cut_lineage(lower.join(jump, "new").select("v", F.least("new", "jumped").alias("next"), "label"))
        labels = moved.select("v", F.col("next").alias("label"))
        if moved.where(F.col("next") != F.col("label")).isEmpty():
            return labels.select(F.col("v").alias("vertex"), F.col("label").alias("cluster"))


def exemplars(
    vertices: DataFrame, edges: DataFrame, damping: float = 0.7, preference: float | None = None,
    max_rounds: int = 300, stable_rounds: int = 15, noise: float = 1e-9,
) -> DataFrame:
    """(vertex, cluster): each vertex with its exemplar, by passing messages over a sparse edge table.

    ``edges`` holds (a, b, similarity), each pair once; pairs without edge can't be of one cluster. A vertex's
    readiness to be an exemplar is ``preference``, by default the median similarity. Every edge carries, both
    ways, a responsibility (how well b suits a, against a's best other choice) and an availability (how many speak for b);
    a round is one window over the edges of each sender and one over those of each receiver, damped. Rounds are
    written in blocks of CHECKED_ROUNDS, and end when the exemplars have been the same for ``stable_rounds``.

    Then each vertex takes the most similar exemplar, the member that is nearest to all of a cluster becomes
    its exemplar, and vertices choose once more. Ties are broken by a hash of the pair, up to ``noise`` of the
    similarity, so that reruns agree. A vertex without edges is its own exemplar.
    """
    one = edges.select(F.col("a").alias("i"), F.col("b").alias("k"), F.col("similarity").cast("double").alias("s")).where("i != k")
    if preference is None:
        preference = one.agg(F.median("s")).first()[0]
    nodes = vertices.select(F.col(vertices.columns[0]).alias("i")).where(F.col("i").isNotNull()).distinct()
    if preference is None:  # no edges
        return nodes.select(F.col("i").alias("vertex"), F.col("i").alias("cluster"))
    both = one.unionAll(one.select("k", "i", "s")).unionAll(nodes.select("i", F.col("i").alias("k"), F.lit(float(preference)).alias("s")))
    tie = (F.pmod(F.xxhash64("i", "k"), F.lit(1 << 20)) / float(1 << 20)) * noise
    table = cut_lineage(both.withColumn("s", F.col("s") + (F.abs("s") + 1e-3) * tie).withColumns({"r": F.lit(0.0), "a": F.lit(0.0)}))
    sender, receiver = Window.partitionBy("i"), Window.partitionBy("k")
    own, keep = F.col("i") == F.col("k"), F.lit(damping)
    seen: list[tuple] = []
    for _ in range(0, max_rounds, CHECKED_ROUNDS):
        for _ in range(CHECKED_ROUNDS):
            table = table.withColumn("_v", F.col("a") + F.col("s")).withColumn("_n", F.row_number().over(sender.orderBy(F.desc("_v"), "k")))
            best, next_ = F.max("_v").over(sender), F.max(F.when(F.col("_n") > 1, F.col("_v"))).over(sender)
            other = F.coalesce(F.when(F.col("_n") == 1, next_).otherwise(best), F.lit(0.0))
            table = table.withColumn("r", keep * F.col("r") + (1 - keep) * (F.col("s") - other))
            speaks = F.when(own, F.lit(0.0)).otherwise(F.greatest("r", F.lit(0.0)))
            table = table.withColumn("_p", F.sum(speaks).over(receiver)).withColumn("_r", F.max(F.when(own, F.col("r"))).over(receiver))
            available = F.when(own, F.col("_p")).otherwise(F.least(F.lit(0.0), F.col("_r") + F.col("_p") - F.greatest("r", F.lit(0.0))))
            table = table.withColumn("a", keep * F.col("a") + (1 - keep) * available).select("i", "k", "s", "r", "a")
        table = cut_lineage(table)
        chosen = table.where(own & (F.col("a") + F.col("r") > 0))
        seen.append(tuple(chosen.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("k")), F.sum(F.pmod(F.xxhash64("k"), F.lit(1 << 30)))).first()))
        same = seen[-(stable_rounds // CHECKED_ROUNDS + 1) :]
        if len(same) > stable_rounds // CHECKED_ROUNDS and len({*same}) == 1 and same[-1][0]:
            break

    def assigned(heads: DataFrame) -> DataFrame:
        """Each vertex with the most similar head that it has an edge to; a head with itself."""
        met = table.join(heads, "k").withColumn("s", F.when(own, F.lit(float("inf"))).otherwise(F.col("s")))
        taken = met.groupBy("i").agg(F.max_by("k", F.struct("s", "k")).alias("k"))
        return nodes.join(taken, "i", "left").select("i", F.coalesce("k", "i").alias("k"))

    first = cut_lineage(assigned(chosen.select("k")))
    # edges inside a cluster, counted and summed per member that they lead to
    inside = table.join(first.withColumnRenamed("k", "_c"), "i").join(first.select(F.col("i").alias("k"), F.col("k").alias("_d")), "k")
    inside = inside.where(F.col("_c") == F.col("_d"))
    sizes = first.groupBy(F.col("k").alias("_c")).agg(F.count(F.lit(1)).alias("_size"))
    middle = inside.groupBy("_c", "k").agg(F.sum("s").alias("_s"), F.count(F.lit(1)).alias("_n")).join(sizes, "_c")
    # a head is linked to all its members, so there is one such member at least
    heads = middle.where(F.col("_n") == F.col("_size")).groupBy("_c").agg(F.max_by("k", F.struct("_s", "k")).alias("k"))
    last = assigned(cut_lineage(heads.select("k").distinct()))
    return last.select(F.col("i").alias("vertex"), F.col("k").alias("cluster"))


def string_exemplars(df: DataFrame, column: str, distance: int, damping: float = 0.7, max_rounds: int = 300) -> DataFrame:
    """(vertex, cluster) of the distinct strings: exemplars over the negative edit distances up to ``distance``.

    Distances are whole numbers with many ties; a hundredth of noise parts them and lets the messages settle.
    """
    pairs = close_strings(df, column, distance).select("a", "b", (-F.col("distance")).alias("similarity"))
    return exemplars(df.select(column), cut_lineage(pairs), damping, max_rounds=max_rounds, noise=0.01)


def cluster_numbers(clusters: DataFrame) -> DataFrame:
    """Add ``cluster_id``: clusters numbered by name."""
    from tallyflow.operators.ordering import numbered

    ids = numbered(clusters.select("cluster").distinct(), ["cluster"], out="cluster_id")
    return clusters.join(ids, "cluster")


def column_means(rows: DataFrame, columns: Sequence[str]) -> dict:
    return rows.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first().asDict()


def variance_ratio(assigned: DataFrame, columns: Sequence[str], cluster: str = "prediction", means: dict | None = None) -> DataFrame:
    """Calinski-Harabasz index of an assignment, from per-cluster sums of the columns less their means."""
    means = means or column_means(assigned, columns)
    assigned = assigned.select(cluster, *[(F.col(c).cast("double") - F.lit(means[c])).alias(c) for c in columns])
    sums = assigned.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias("s_" + c) for c in columns],
        *[F.sum(F.col(c) * F.col(c)).alias("q_" + c) for c in columns],
    )
    n, k = F.sum("n"), F.count(F.lit(1))
    within = sum(F.sum(F.col("q_" + c) - F.col("s_" + c) * F.col("s_" + c) / F.col("n")) for c in columns)
    between = sum(
        F.sum(F.col("s_" + c) * F.col("s_" + c) / F.col("n")) - F.sum("s_" + c) * F.sum("s_" + c) / n for c in columns
    )
    return sums.agg(
        k.alias("k"), F.try_divide(between * (n - k), within * (k - 1)).alias("calinski_harabasz")
    )


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="skip").transform(df)


def k_means(df: DataFrame, columns: Sequence[str], k: int, seed: int = 1) -> DataFrame:
    """Rows with their group number ``prediction``."""
    vectors = assemble(spread(df, TASK_ROWS), columns)
    return KMeans(k=k, seed=seed).fit(vectors).transform(vectors).drop("features")


def k_means_sweep(df: DataFrame, columns: Sequence[str], ks: Sequence[int], seed: int = 1) -> DataFrame:
    """(tried, k, calinski_harabasz), one row per tried k."""
    # not cached here: a fit keeps its points by itself, as points, and reads cached rows anew in every pass
    vectors = assemble(spread(df, TASK_ROWS), columns)
    means, rows = column_means(vectors, columns), []
    for k in ks:
        assigned = KMeans(k=k, seed=seed).fit(vectors).transform(vectors)
        found = variance_ratio(assigned, columns, means=means).first()
        rows.append((k, found["k"], found["calinski_harabasz"]))
    spark: SparkSession = df.sparkSession
    return spark.createDataFrame(rows, "tried int, k bigint, calinski_harabasz double")
