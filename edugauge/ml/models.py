"""Weighted classifiers, scenario comparison and evaluation of fitted models."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edugauge.ml.features import Preprocessor, Statistics, fit_preprocessor
from edugauge.ml.forest import MAX_DEPTH, Binned, GrownForest, bin_rows, grow
from edugauge.operators.evaluation import binary_metrics, confusion, group_metrics
from edugauge.session import cut_lineage, scratch_path

# Tuned forests of the pupil and the municipality model.
PUPIL_FOREST = {"numTrees": 148, "maxDepth": MAX_DEPTH, "minInstancesPerNode": 98}
MUNICIPALITY_FOREST = {"numTrees": 300, "maxDepth": MAX_DEPTH, "minInstancesPerNode": 20}


@dataclass
class Spec:
    """A named algorithm with its parameters."""

    algorithm: str
    params: Mapping = field(default_factory=dict)
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or self.algorithm


LOGISTIC = Spec("LogisticRegression")


def forest(params: Mapping, seed: int = 42) -> Spec:
    return Spec("RandomForest", {"seed": seed, **params})


@dataclass
class Fitted:
    """Preprocessing and classifier; adds ``score`` P(1), ``risk`` P(0) and ``prediction``."""

    preprocessor: Preprocessor
    model: Model | GrownForest

    def transform(self, df: DataFrame) -> DataFrame:
        prepared = self.preprocessor.transform(df)
        if isinstance(self.model, GrownForest):
            score = self.model.scores(df.sparkSession, "features", [(self.model.getNumTrees, MAX_DEPTH)])
            scored = prepared.withColumn("_scores", score).withColumn("_score", F.get("_scores", F.lit(0)))
            names = {"_score": "score", "_risk": "risk", "_prediction": "prediction"}
            scored = scored.withColumns({"_risk": 1.0 - F.col("_score"), "_prediction": (F.col("_score") > 0.5).cast("int")})
            return scored.drop(*[c for c in scored.columns if c not in df.columns and c not in names], *names.values()).withColumnsRenamed(names)
        scored = self.model.transform(prepared)
        probability = vector_to_array("probability")
        extra = [c for c in scored.columns if c not in df.columns]
        out = scored.withColumns({"_score": probability[1], "_risk": probability[0], "_prediction": F.col("prediction").cast("int")})
        return out.drop(*extra).withColumnsRenamed({"_score": "score", "_risk": "risk", "_prediction": "prediction"})


def fit_logistic(train: DataFrame, preprocessor: Preprocessor, params: Mapping) -> Model:
    """L2-penalised logistic regression with unit inverse strength: ``1 / sum(weight)``.

    Equal rows are merged first with their weights added, which leaves the loss unchanged and
    shrinks a pupil table to its distinct profiles before the iterations start.
    """
    features = preprocessor.numeric + preprocessor.categorical
    profiles = train.groupBy(*features, "label").agg(F.sum("weight").alias("weight"))
    prepared = preprocessor.transform(profiles).select("features", "label", "weight").persist()
    try:
        total = prepared.agg(F.sum("weight").alias("w")).first()["w"] or 1.0
        estimator = LogisticRegression(
            weightCol="weight", maxIter=1000, regParam=1.0 / total, elasticNetParam=0.0, standardization=False
        )
        return estimator.setParams(**params).fit(prepared) if params else estimator.fit(prepared)
    finally:
        prepared.unpersist()


#: Split candidates of a continuous column; ``params`` may hold another number.
MAX_BINS = 128
#: Memory of the node histograms of a task, in MB.
HISTOGRAM_MB = 256
#: Rows of a partition when trees are grown, at most and at least about: each partition adds a histogram of every node to the shuffle.
FOREST_ROWS, FOREST_ROWS_LEAST = 1 << 16, 1 << 10
#: Rows of a frame beyond which trees are grown whole by one task each: about where MLlib's node histograms outgrow the rows.
GROWN_ROWS = 1 << 15
#: Trees that are grown together, and the distance of the seeds of neighbouring trees.
FOREST_TREES, SEED_STEP = 25, 1_000_003


def forest_frame(prepared: DataFrame, cores: int) -> DataFrame:
    """``prepared`` in partitions that keep so many cores busy, or more if rows are many, or fewer if they are few."""
    rows = prepared.count()
    return prepared.repartition(max(1, -(-rows // FOREST_ROWS), min(cores, rows // FOREST_ROWS_LEAST)))


@contextmanager
def forest_rows(prepared: DataFrame, cores: int) -> Iterator[DataFrame | Binned]:
    """``prepared`` as :func:`fit_forest` takes it: binned and stored if it has more than ``GROWN_ROWS`` rows, else kept in memory."""
    if prepared.limit(GROWN_ROWS + 1).count() > GROWN_ROWS:
        yield bin_rows(prepared, MAX_BINS)
        return
    frame = forest_frame(prepared, cores).persist()
    try:
        yield frame
    finally:
        frame.unpersist()


def joined_forest(spark: SparkSession, stored: Sequence[tuple[str, int]]) -> RandomForestClassificationModel:
    """One model of the trees of stored forests ``(path, trees)``, in their order."""
    paths = [path for path, _ in stored]
    offsets = [sum(trees for _, trees in stored[:i]) for i in range(len(stored))]
    target = scratch_path(spark, "forest")
    for part, tree in (("treesMetadata", "_1"), ("data", "treeID")):
        numbered = [
            spark.read.parquet(f"{path}/{part}").withColumn(tree, (F.col(tree) + offset).cast("int"))
            for path, offset in zip(paths, offsets)
        ]
        reduce(lambda a, b: a.unionByName(b), numbered).write.parquet(f"{target}/{part}")
    metadata = json.loads(spark.read.text(f"{paths[0]}/metadata").first()[0])
    metadata["numTrees"] = metadata["paramMap"]["numTrees"] = sum(trees for _, trees in stored)
    spark.createDataFrame([(json.dumps(metadata),)], "value string").coalesce(1).write.text(f"{target}/metadata")
    return RandomForestClassificationModel.load(target)


def fit_forest(prepared: DataFrame | Binned, params: Mapping) -> Model | GrownForest:
    """Weighted random forest. Rows are not merged here: bootstrap and leaf size count rows.

    Binned rows (see :func:`forest_rows`) get a forest whose trees are each grown whole by one task. Others are fitted by MLlib:
    each row's node is kept from level to level, so tasks are not sent the trees grown so far. Trees do not depend on each other:
    they are grown ``FOREST_TREES`` at a time, each time with a seed of its own, so the node histograms of a task stay small enough
    for a processor's cache, and as many parts at once as keep the cores busy while another waits.
    """
    estimator = RandomForestClassifier(
        weightCol="weight", featureSubsetStrategy="sqrt", maxBins=MAX_BINS, maxMemoryInMB=HISTOGRAM_MB, cacheNodeIds=True, checkpointInterval=10
    ).setParams(**params)
    trees, seed = estimator.getNumTrees(), estimator.getSeed()
    if isinstance(prepared, Binned):
        if unknown := set(params) - {"numTrees", "maxDepth", "minInstancesPerNode", "seed", "bootstrap"}:
            raise ValueError(f"not known to forests of large frames: {sorted(unknown)}")
        return grow(prepared, trees, estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), seed, estimator.getBootstrap())
    if trees <= FOREST_TREES:
        return estimator.fit(prepared)
    spark = prepared.sparkSession
    side_by_side = max(2, 1 + spark.sparkContext.defaultParallelism // prepared.rdd.getNumPartitions())
    parts = [(min(FOREST_TREES, trees - start), seed + start * SEED_STEP) for start in range(0, trees, FOREST_TREES)]

    @inheritable_thread_target(spark)
    def one(part: tuple[int, int]) -> tuple[str, int]:
        path = scratch_path(spark, "forest")
        estimator.copy({estimator.numTrees: part[0], estimator.seed: part[1]}).fit(prepared).save(path)
        return path, part[0]

    with ThreadPool(min(side_by_side, len(parts))) as pool:
        return joined_forest(spark, pool.map(one, parts, chunksize=1))


def fit(
    train: DataFrame, spec: Spec, numeric: Sequence[str], categorical: Sequence[str], statistics: Statistics | None = None
) -> Fitted:
    """Fit preprocessing and classifier on a model frame (``label``, ``weight``, features)."""
    preprocessor = fit_preprocessor(train, numeric, categorical, statistics)
    if spec.algorithm == "LogisticRegression":
        return Fitted(preprocessor, fit_logistic(train, preprocessor, spec.params))
    if spec.algorithm == "RandomForest":
        cores = train.sparkSession.sparkContext.defaultParallelism
        share = max(1, cores * FOREST_TREES // max(FOREST_TREES, spec.params.get("numTrees", 1)))
        with forest_rows(preprocessor.transform(train).select("features", "label", "weight"), share) as prepared:
            return Fitted(preprocessor, fit_forest(prepared, spec.params))
    raise ValueError(f"unknown algorithm {spec.algorithm}")


def evaluate(fitted: Fitted, test: DataFrame, weight: str | None = "weight") -> DataFrame:
    """Weighted metrics of a fitted model on held-out rows, in one row. Rows are scored once: the metrics read the scores several times."""
    scored = cut_lineage(fitted.transform(test).select("label", "prediction", "score", *([weight] if weight else [])))
    return binary_metrics(scored, "label", "prediction", weight, score="score")


def compare(
    train: DataFrame,
    test: DataFrame,
    specs: Sequence[Spec],
    scenarios: Mapping[str, tuple[Sequence[str], Sequence[str]]],
    weight: str | None = "weight",
) -> tuple[DataFrame, dict[tuple[str, str], Fitted]]:
    """Every algorithm in every feature scenario: metric rows and the fitted models.

    ``train`` and ``test`` are read once per fit; hand in stored or checkpointed frames. The figures that preprocessing needs
    are taken once, for the columns of all scenarios.
    """
    rows, models = [], {}
    columns = [list(dict.fromkeys(c for groups in scenarios.values() for c in groups[kind])) for kind in (0, 1)]
    statistics = Statistics.of(train, *columns)
    for order, spec in enumerate(specs):
        for step, (scenario, (numeric, categorical)) in enumerate(scenarios.items()):
            fitted = fit(train, spec, numeric, categorical, statistics)
            models[(spec.label, scenario)] = fitted
            rows.append(
                evaluate(fitted, test, weight).withColumns(
                    {
                        "model": F.lit(spec.label),
                        "scenario": F.lit(scenario),
                        "position": F.lit(order * len(scenarios) + step),
                    }
                )
            )
    return reduce(lambda a, b: a.unionByName(b), rows), models


def confusion_report(fitted: Fitted, test: DataFrame, weight: str | None = "weight") -> DataFrame:
    return confusion(fitted.transform(test), "label", "prediction", weight)


def group_report(fitted: Fitted, test: DataFrame, group: str, weight: str | None = "weight") -> DataFrame:
    return group_metrics(fitted.transform(test), group, "label", "prediction", weight)
