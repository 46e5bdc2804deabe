"""Client segments: clustering, cluster profiles and names."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.quantiles import exact_quantiles

# fixed values: segment names from lowest to highest value
SEGMENT_NAMES = ["Low Value Individual", "Mid Value Individual", "High Value Individual"]

#: Points on which the elbow is fitted.
CORESET = 20_000
#: Tasks among which they are dealt at most, as fitting is many short rounds.
FITTING = 8


def _assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="_features").transform(df)


def fit_kmeans(df: DataFrame, columns: list[str], k: int, seed: int = 42, max_iter: int = 100) -> KMeansModel:
    """KMeans on scaled columns; the input is kept in memory and on disk while it iterates."""
    points = _assembled(df, columns).select("_features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_features", predictionCol="cluster").fit(points)
    finally:
        points.unpersist()


def kmeans_segments(df: DataFrame, columns: list[str], k: int, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Rows with their cluster, and the centroids as (cluster, attribute, value)."""
    model = fit_kmeans(df, columns, k, seed)
    labelled = model.transform(_assembled(df, columns)).drop("_features")
    centers = [(i, c, float(v)) for i, center in enumerate(model.clusterCenters()) for c, v in zip(columns, center)]
    return labelled, df.sparkSession.createDataFrame(centers, "cluster int, attribute string, value double")


def nearest(columns: list[str], centroids: list[list[float]]) -> Column:
    """Struct of the squared distance to the nearest centroid and its number; of equally near ones the first."""
    def distance(center: list[float]) -> Column:
        parts = [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(columns, center)]
        return sum(parts[1:], parts[0])

    return F.array_min(F.array(*[F.struct(distance(center).alias("distance"), F.lit(i).alias("cluster")) for i, center in enumerate(centroids)]))


def squared_errors(df: DataFrame, columns: list[str], models: dict[int, list[list[float]]]) -> DataFrame:
    """(k, sse): the sum of squared distances to the nearest centroid for each set of centroids, all in one pass."""
    sums = [F.struct(F.lit(k).alias("k"), F.coalesce(F.sum(nearest(columns, c)["distance"]), F.lit(0.0)).alias("sse")) for k, c in models.items()]
    return df.agg(F.array(*sums).alias("s")).select(F.inline("s"))


def coreset(df: DataFrame, columns: list[str], size: int = CORESET, seed: int = 42) -> DataFrame:
    """About ``size`` weighted points that stand for all rows when clusters are sought; all rows with weight 1 if there are no more.

    A row is drawn with a probability of half its share of the rows and half its share of the squared distances to the mean, and weighs
    the inverse, so far rows are not lost and sums over the weighted points are those of the rows on average. The size does not grow with the rows.
    """
    squares = [F.var_pop(c) * F.count(c) for c in columns]
    found = df.agg(F.count(F.lit(1)).alias("n"), sum(squares[1:], squares[0]).alias("spread"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    points = df.select(*columns)
    if found["n"] <= size:
        return points.withColumn("_weight", F.lit(1.0))
    away = nearest(columns, [[found[f"m{i}"] for i in range(len(columns))]])["distance"]
    share = F.lit(0.5 / found["n"]) + (away * (0.5 / found["spread"]) if found["spread"] else F.lit(0.5 / found["n"]))
    chance = F.least(F.lit(1.0), share * size)
    drawn = points.withColumn("_chance", chance).where(F.rand(seed) < F.col("_chance"))
    return drawn.withColumn("_weight", 1 / F.col("_chance")).drop("_chance")


def elbow(df: DataFrame, columns: list[str], ks: range = range(1, 9), seed: int = 42, max_iter: int = 100, size: int = CORESET) -> DataFrame:
    """Sum of squared distances of all rows per number of clusters.

    The centroids of every k are fitted on one coreset of bounded size in a few tasks, however many drew it, side by side; one more pass over the rows
    sums the errors of all of them.
    """
    spark = df.sparkSession
    rows = df.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    points = _assembled(coreset(rows, columns, size, seed), columns).select("_features", "_weight").persist(StorageLevel.MEMORY_AND_DISK)
    few = None

    @inheritable_thread_target(spark)
    def centroids(k: int) -> list[list[float]]:
        means = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_features", weightCol="_weight") if k > 1 else None
        centers = means.fit(few).clusterCenters() if means else [few.select(Summarizer.mean(F.col("_features"), F.col("_weight"))).first()[0]]
        return [[float(v) for v in center] for center in centers]

    try:
        points.count()  # drawn by all tasks before they become few
        few = points if points.rdd.getNumPartitions() <= FITTING else points.coalesce(FITTING).persist(StorageLevel.MEMORY_AND_DISK)
        few.count()
        with ThreadPool(max(1, len(ks))) as pool:
            models = dict(zip(ks, pool.map(centroids, ks, chunksize=1)))
        errors = [tuple(r) for r in squared_errors(rows, columns, models).collect()]  # one row per k
    finally:
        if few is not None:
            few.unpersist()
        points.unpersist()
        rows.unpersist()
    return spark.createDataFrame(errors, "k int, sse double")


def melt_profile(df: DataFrame, ids: list[str], columns: list[str], attribute: str = "attribute", value: str = "value") -> DataFrame:
    """Long form: one row per row and column."""
    doubles = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(ids, columns, attribute, value)


def cluster_profile(df: DataFrame, cluster: str, columns: list[str]) -> DataFrame:
    """Per cluster and attribute: clients, mean, sum and quartiles."""
    long = melt_profile(df, [cluster], columns)
    moments = long.groupBy(cluster, "attribute").agg(
        F.count("value").alias("clients"), F.avg("value").alias("mean"), F.sum("value").alias("total")
    )
    quartiles = exact_quantiles(long, [cluster, "attribute"], "value", [0.25, 0.5, 0.75], few_keys=True)
    return moments.join(quartiles, [cluster, "attribute"], "left").select(
        cluster, "attribute", "clients", "mean", "total", F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("q2"), F.col("quantiles")[2].alias("q3"),
    )


def cluster_sizes(df: DataFrame, cluster: str, by: list[str]) -> DataFrame:
    """Number of clients per cluster and type."""
    return df.groupBy(cluster, *by).agg(F.count(F.lit(1)).alias("clients"))


def cluster_means_wide(df: DataFrame, cluster: str, columns: list[str], clusters: list) -> DataFrame:
    """Attributes as rows and clusters as columns, with the mean in each cell."""
    long = melt_profile(df, [cluster], columns)
    return long.groupBy("attribute").pivot(cluster, clusters).agg(F.avg("value"))


def relative_importance(df: DataFrame, cluster: str, columns: list[str]) -> DataFrame:
    """Cluster mean over population mean, minus 1, per cluster and attribute.

    One pass: sums and counts per cluster and attribute are added up to those of the population.
    """
    sums = melt_profile(df, [cluster], columns).groupBy(cluster, "attribute").agg(
        F.sum("value").alias("_s"), F.count("value").alias("_c")
    )
    population = sums.groupBy("attribute").agg((F.sum("_s") / F.sum("_c")).alias("_population"))
    return sums.join(population, "attribute").select(
        cluster, "attribute",
        (F.col("_s") / F.col("_c") / F.nullif(F.col("_population"), F.lit(0.0)) - 1).alias("importance"),
    )


def label_segments(df: DataFrame, cluster: str, value: str, names: list[str] | None = None,
                   label: str = "segment") -> DataFrame:
    """Clusters named from the lowest to the highest mean ``value``.

    There are as many clusters as names, so the ranking is a table of that size.
    """
    names = names or SEGMENT_NAMES
    means = df.groupBy(cluster).agg(F.avg(value).alias("mean"))
    ranked = means.agg(F.array_sort(F.collect_list(F.struct("mean", cluster))).alias("r"))
    order = F.transform("r", lambda x: x[cluster])
    named = ranked.select(F.posexplode(order).alias("_rank", "_cluster")).select(
        "_cluster", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_rank") + 1).alias(label)
    )
    return df.join(F.broadcast(named), F.col(cluster) == F.col("_cluster"), "left").drop("_cluster")


def export_segments(df: DataFrame, path: str, columns: list[str]) -> None:
    """Client and segment as CSV."""
    df.select(*columns).write.mode("overwrite").option("header", "true").csv(path)


