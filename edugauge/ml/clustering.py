"""Municipality profiles, k-means with the number of clusters by silhouette, cluster reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edugauge.functions.labels import lookup
from edugauge.ml.features import PROFILE_FEATURES
from edugauge.operators.aggregates import crosstab, group_profile
from edugauge.operators.joins import left_join_dim
from edugauge.session import cut_lineage

#: Rows of a partition of the vectors that are clustered, at most and about.
CLUSTER_ROWS = 1 << 17


def profile_table(goals_vs_results: DataFrame, external: DataFrame, year: int) -> DataFrame:
    """Complete profiles of one year: rows with any missing feature are left out."""
    rows = goals_vs_results.filter(F.col("ANO_REFERENCIA") == year).select(
        "CO_MUNICIPIO", "NO_MUNICIPIO", "SG_UF", "REGIAO", "PC_ALUNO_ALFABETIZADO", "DISTANCIA_META_2030"
    )
    joined = left_join_dim(rows, external, [("CO_MUNICIPIO", "CO_MUNICIPIO")], unique=False)
    return joined.na.drop(subset=PROFILE_FEATURES)


def standardised(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add a ``features`` vector of z-scores (population deviation)."""
    moments = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in features]).first()
    scaled = df.withColumns(
        {f"_z_{c}": (F.col(c) - F.lit(moments[c]["m"])) / F.lit(moments[c]["s"] or 1.0) for c in features}
    )
    vector = VectorAssembler(inputCols=[f"_z_{c}" for c in features], outputCol="features")
    return vector.transform(scaled).drop(*[f"_z_{c}" for c in features])


def fits_side_by_side(vectors: DataFrame, starts: Sequence[tuple[int, int]]) -> list[KMeansModel]:
    """A model for each ``(k, seed)`` of ``starts``, in their order.

    An iteration is one short job, so one fit alone mostly waits for the scheduler. The vectors are stored once, in partitions of
    about ``CLUSTER_ROWS`` rows, and as many fits run at a time as keep the cores busy: one when the rows alone do.
    """
    spark = vectors.sparkSession
    cores = spark.sparkContext.defaultParallelism
    features = vectors.select("features")
    parts = max(1, -(-features.count() // CLUSTER_ROWS))
    if parts > cores // 2:  # one fit at a time, on all cores
        parts = max(parts, cores)
    stored = cut_lineage(features.repartition(parts)).coalesce(parts)

    @inheritable_thread_target(spark)
    def one(start: tuple[int, int]) -> KMeansModel:
        k, seed = start
        return KMeans(k=k, seed=seed, maxIter=300, tol=1e-4).fit(stored)

    with ThreadPool(min(max(1, cores // parts), len(starts))) as pool:
        return pool.map(one, starts, chunksize=1)


def best_of_restarts(vectors: DataFrame, k: int, restarts: int = 10, seed: int = 42) -> KMeansModel:
    """The restart with the lowest within-cluster cost."""
    models = fits_side_by_side(vectors, [(k, seed + i) for i in range(restarts)])
    return min(models, key=lambda model: model.summary.trainingCost)


@dataclass
class Clustering:
    scores: DataFrame
    k: int
    model: KMeansModel


def choose_clusters(
    vectors: DataFrame, k_min: int = 3, k_max: int = 8, restarts: int = 10, seed: int = 42
) -> Clustering:
    """Best silhouette over ``k_min..k_max``; equal scores keep the smaller k.

    The silhouette uses squared Euclidean distance, which has a closed form over cluster sums
    and is one linear pass. Plain Euclidean distance would compare every pair of rows.
    """
    evaluator = ClusteringEvaluator(distanceMeasure="squaredEuclidean")
    # The largest k first: its fits take longest.
    starts = [(k, seed + i) for k in range(k_max, k_min - 1, -1) for i in range(restarts)]
    fitted = list(zip(starts, fits_side_by_side(vectors, starts)))
    best, rows = None, []
    for k in range(k_min, k_max + 1):
        model = min((m for (size, _), m in fitted if size == k), key=lambda m: m.summary.trainingCost)
        score = evaluator.evaluate(model.transform(vectors))
        rows.append((k, score, model.summary.trainingCost))
        if best is None or score > best[0]:
            best = (score, k, model)
    scores = vectors.sparkSession.createDataFrame(rows, "k int, silhouette double, cost double")
    return Clustering(scores, best[1], best[2])


def assign(vectors: DataFrame, clustering: Clustering, order_by: str) -> DataFrame:
    """Cluster number per row. Raw labels are arbitrary, so clusters are numbered by falling
    mean of ``order_by``; at most ``k`` means reach the driver."""
    raw = clustering.model.transform(vectors)
    means = raw.groupBy("prediction").agg(F.avg(order_by).alias("m")).collect()
    order = sorted(means, key=lambda row: (-row["m"], row["prediction"]))
    number = {row["prediction"]: i for i, row in enumerate(order)}
    return raw.withColumn("CLUSTER", lookup(number, "prediction")).drop("prediction", "features")


def cluster_profile(assigned: DataFrame, features: Sequence[str] = tuple(PROFILE_FEATURES)) -> DataFrame:
    """Rounded feature means and size per cluster."""
    return group_profile(assigned, "CLUSTER", list(features), size="N_MUNICIPIOS").orderBy("CLUSTER")


def cluster_by_region(assigned: DataFrame, regions: Sequence[str]) -> DataFrame:
    """Percentage of each region within each cluster."""
    return crosstab(assigned, "CLUSTER", "REGIAO", list(regions), percent=True).orderBy("CLUSTER")
