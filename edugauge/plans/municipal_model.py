"""Municipality analyses: goal model, search, next-cycle risk and clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edugauge.functions.dictionaries import STATE_REGIONS
from edugauge.ml import clustering, models, municipal, tuning
from edugauge.ml.attribution import shapley_values
from edugauge.ml.features import GOAL_CATEGORICAL, GOAL_NUMERIC, PROFILE_FEATURES
from edugauge.operators import attribution, evaluation, sampling
from edugauge.operators.aggregates import alert_counts
from edugauge.session import cut_lineage

# Label years of the temporal split, profile year, seed.
TRAIN_YEAR, TEST_YEAR = 2024, 2025
SEED = 42
KEYS = ("ANO_REFERENCIA", "CO_MUNICIPIO")


def split(goals_vs_results: DataFrame, external: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train on one label year, test on the next, from one stored frame."""
    frame = cut_lineage(municipal.labelled(municipal.lag_dataset(goals_vs_results, external)))
    return sampling.temporal_split(frame, "ANO_REFERENCIA", TRAIN_YEAR, TEST_YEAR)


def goal_model(train: DataFrame, test: DataFrame, forest: dict | None = None) -> tuple[dict[str, DataFrame], models.Fitted]:
    """Unweighted comparison, class report, confusion and thresholds of the better model."""
    specs = [models.LOGISTIC, models.forest(forest or models.MUNICIPALITY_FOREST, SEED)]
    results, fitted = models.compare(train, test, specs, {"goal": (GOAL_NUMERIC, GOAL_CATEGORICAL)}, weight=None)
    results = cut_lineage(results)
    winner = evaluation.best_scenario(results, ["position"]).first()
    best = fitted[(winner["model"], "goal")]
    scored = best.transform(test)
    return {
        "comparison": results,
        "class_report": evaluation.class_report(scored, "label", "prediction"),
        "confusion": evaluation.confusion(scored, "label", "prediction"),
        "thresholds": evaluation.threshold_report(scored, "label", "risk", target=0, min_recall=0.80),
    }, best


def explain(fitted: models.Fitted, train: DataFrame, test: DataFrame, background_rows: int | None = None, permutations: int | None = None) -> DataFrame:
    """Importance per variable over the whole test year: all coalitions of the eleven variables, against all of ``train``."""
    rows = test.withColumn("row_id", F.concat_ws("|", *KEYS))
    phi = shapley_values(fitted, rows, "row_id", train, KEYS, background_rows, permutations, seed=SEED)
    importance = attribution.importance_by_feature(phi, rows.agg(F.count(F.lit(1))))
    return attribution.importance_by_variable(importance)


def tune(
    train: DataFrame, test: DataFrame, candidates: Sequence[dict] | None = None, folds: int = 5, ledger: str | None = None
) -> dict[str, DataFrame]:
    """Grid search on the train year; the winner on the untouched test year. ``ledger`` is a folder of finished trials."""
    folded = cut_lineage(sampling.stratified_folds(train, "label", KEYS, folds, SEED))
    table, best = tuning.search(
        folded, candidates or tuning.grid(tuning.MUNICIPALITY_GRID), GOAL_NUMERIC, GOAL_CATEGORICAL, folds=folds, seed=SEED, ledger=ledger
    )
    fitted = models.fit(train, models.forest(best, SEED), GOAL_NUMERIC, GOAL_CATEGORICAL)
    return {"search": table, "metrics": models.evaluate(fitted, test, weight=None)}


def risk(
    goals_vs_results: DataFrame, external: DataFrame, levels: DataFrame, forest: dict | None = None, year: int = TEST_YEAR
) -> dict[str, DataFrame]:
    """Ranking of the next cycle, alert counts and agreement with the structural index."""
    dataset = cut_lineage(municipal.lag_dataset(goals_vs_results, external))
    fitted = municipal.fit_risk(dataset, models.forest(forest or models.MUNICIPALITY_FOREST, SEED))
    ranking = municipal.risk_ranking(fitted, municipal.projection(goals_vs_results, external, year), year)
    ranking = cut_lineage(ranking)
    return {
        "ranking": ranking,
        "alerts": alert_counts(ranking, ["ALERTA_F1_OTIMO", "ALERTA_RECALL_80"]),
        "top": sampling.top_k(ranking, "PROBABILIDADE_RISCO_NAO_ATINGIR_META", 15, ["CO_MUNICIPIO"]),
        "agreement": municipal.risk_agreement(ranking, levels, year),
    }


def clusters(
    goals_vs_results: DataFrame, external: DataFrame, year: int = TEST_YEAR, k_min: int = 3, k_max: int = 8, restarts: int = 10
) -> dict[str, DataFrame]:
    """Clusters of complete municipality profiles, numbered by falling literacy."""
    profiles = clustering.profile_table(goals_vs_results, external, year)
    vectors = cut_lineage(clustering.standardised(cut_lineage(profiles), PROFILE_FEATURES))
    found = clustering.choose_clusters(vectors, k_min, k_max, restarts, SEED)
    assigned = clustering.assign(vectors, found, "PC_ALUNO_ALFABETIZADO")
    regions = sorted(set(STATE_REGIONS.values()))
    return {
        "scores": found.scores,
        "profile": clustering.cluster_profile(assigned),
        "by_region": clustering.cluster_by_region(assigned, regions),
        "members": assigned,
    }
