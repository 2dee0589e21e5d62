"""Seeded random search and grid search over forest parameters with stratified folds."""

from __future__ import annotations

import json
import random
from collections.abc import Mapping, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edugauge.ml.features import fit_preprocessor
from edugauge.ml.forest import MAX_DEPTH, Binned
from edugauge.ml.ledger import Ledger, fingerprint, trial_key
from edugauge.ml.models import FOREST_TREES, GROWN_ROWS, MAX_BINS, fit_forest, forest_rows
from edugauge.ml.nested import nested_scores

# Search spaces. A range excludes its upper bound.
PUPIL_SPACE = {"numTrees": (100, 400), "maxDepth": [10, 15, 20, 30, MAX_DEPTH], "minInstancesPerNode": (10, 200)}
PUPIL_DRAWS = 10
PUPIL_SAMPLE_ROWS = 300_000
MUNICIPALITY_GRID = {"numTrees": [100, 200, 300], "maxDepth": [4, 6, 8, MAX_DEPTH], "minInstancesPerNode": [5, 20, 50]}

#: Parameters whose smaller values are contained in a forest of larger ones.
NESTED = ("numTrees", "maxDepth")


def grid(space: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of a grid."""
    return [dict(zip(space, values)) for values in product(*space.values())]


def draws(space: Mapping[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """``n`` seeded draws: a tuple is an integer range, a list a choice."""
    rng = random.Random(seed)
    return [
        {k: rng.randrange(*v) if isinstance(v, tuple) else rng.choice(v) for k, v in space.items()} for _ in range(n)
    ]


def families(params: Sequence[Mapping]) -> list[tuple[dict, list[dict]]]:
    """Candidates that differ in the number of trees and the depth only, under the largest forest that holds them all."""
    grouped: dict[str, list[dict]] = {}
    for candidate in params:
        rest = {k: v for k, v in candidate.items() if k not in NESTED}
        members = grouped.setdefault(json.dumps(rest, sort_keys=True), [])
        if candidate not in members:
            members.append(dict(candidate))
    return [({**members[0], **{k: max(m[k] for m in members) for k in NESTED}}, members) for members in grouped.values()]


def search(
    df: DataFrame,
    params: Sequence[Mapping],
    numeric: Sequence[str],
    categorical: Sequence[str],
    fold: str = "fold",
    folds: int = 3,
    seed: int = 42,
    parallelism: int | None = None,
    ledger: str | None = None,
) -> tuple[DataFrame, dict]:
    """Cross-validated ROC AUC per parameter set, best first, and the best parameters.

    The fit is weighted, the score is not. Preprocessing depends on the fold only, so it is fitted once per fold and shared by
    all parameter sets. Candidates that differ in ``numTrees`` and ``maxDepth`` only are scored from one forest, the largest of
    them (see :mod:`edugauge.ml.nested`): every candidate gets its own score on every row of every fold. Fits run side by side, as
    many as leave no core idle. Only one number per candidate and fold reaches the driver.

    ``ledger`` is a folder of finished trials: those of the same data, parameters and seed are read from there, and new ones are
    added after each fit.
    """
    spark = df.sparkSession
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    trials = Ledger(spark, ledger)
    data = fingerprint(df) if ledger else ""
    settings = {"seed": seed, "folds": folds, "numeric": list(numeric), "categorical": list(categorical), "bins": MAX_BINS, "together": FOREST_TREES, "grown_beyond": GROWN_ROWS}
    key = lambda candidate, k: trial_key(data, candidate, k, settings)
    for k in range(folds):
        open_families = []
        for _, members in families(params):
            members = [m for m in members if key(m, k) not in trials.known]
            open_families += families(members) if members else []
        if not open_families:
            continue
        train, valid = df.filter(F.col(fold) != k), df.filter(F.col(fold) == k)
        preprocessor = fit_preprocessor(train, numeric, categorical)
        cores = spark.sparkContext.defaultParallelism
        # Forests are grown in parts, which run side by side too.
        parts = max(-(-largest["numTrees"] // FOREST_TREES) for largest, _ in open_families)
        share = max(1, cores // min(parallelism or cores, len(open_families) * parts))
        scored_on = preprocessor.transform(valid).select("features", "label").persist()
        try:
            with forest_rows(preprocessor.transform(train).select("features", "label", "weight"), share) as fitted_on:

                @inheritable_thread_target(spark)
                def one(family):
                    largest, members = family
                    model = fit_forest(fitted_on, {"seed": seed, **largest})
                    cuts = [(m["numTrees"], m["maxDepth"]) for m in members]
                    scored = nested_scores(model, scored_on, cuts).persist()
                    try:
                        return [
                            (key(m, k), m, k, evaluator.evaluate(scored.select(F.col(f"s{i}").alias("score"), F.col("label").cast("double"))))
                            for i, m in enumerate(members)
                        ]
                    finally:
                        scored.unpersist()

                # A forest of binned rows keeps all cores busy but for its last trees and its scores.
                own = 2 if isinstance(fitted_on, Binned) else max(1, cores // (fitted_on.rdd.getNumPartitions() * parts))
                with ThreadPool(min(parallelism or own, len(open_families))) as pool:
                    for finished in pool.imap_unordered(one, open_families):
                        trials.add(finished)
        finally:
            scored_on.unpersist()
    scores = [[trials.known[key(p, k)] for k in range(folds)] for p in params]
    means = [fmean(s) for s in scores]
    ranks = [1 + sum(other > mean for other in means) for mean in means]
    names = list(params[0])
    rows = [
        (*[p[n] for n in names], mean, pstdev(s), rank) for p, s, mean, rank in zip(params, scores, means, ranks)
    ]
    schema = ", ".join(f"{n} int" for n in names) + ", mean_auc double, std_auc double, rank int"
    best = dict(params[means.index(max(means))])
    return spark.createDataFrame(rows, schema).orderBy("rank", *names), best
