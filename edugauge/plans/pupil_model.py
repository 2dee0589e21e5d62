"""Pupil literacy model: comparison, group breakdown, search and attribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edugauge.ml import features as ft
from edugauge.ml import models, tuning
from edugauge.ml.attribution import shapley_values
from edugauge.operators import attribution, evaluation, sampling
from edugauge.operators.aggregates import collapse_profiles
from edugauge.session import cut_lineage

# Modelling year, test share, seed.
MODEL_YEAR = 2025
TEST_FRACTION = 0.30
SEED = 42
KEYS = ("SK_ALUNO",)


def year_frame(fact: DataFrame, year: int = MODEL_YEAR, keys: Sequence[str] = KEYS) -> DataFrame:
    """Key, features, label and weight of one year (partition-pruned on a stored fact)."""
    rows = fact.filter(F.col("ANO_REFERENCIA") == year)
    return ft.model_frame(rows, ft.feature_columns(True, True), keys)


def split(fact: DataFrame, year: int = MODEL_YEAR, keys: Sequence[str] = KEYS) -> tuple[DataFrame, DataFrame]:
    """Stratified train/test frames. The narrow frame is stored before it is ranked and once
    more with its part, because every fit reads it again."""
    frame = cut_lineage(year_frame(fact, year, keys))
    parts = cut_lineage(
        sampling.stratified_part(frame, "label", keys, fraction=TEST_FRACTION, seed=SEED, column="is_test")
    )
    return parts.filter(~F.col("is_test")).drop("is_test"), parts.filter("is_test").drop("is_test")


def compare(train: DataFrame, test: DataFrame, forest: dict | None = None) -> dict[str, DataFrame]:
    """Two algorithms with and without enrichment; the best one by region and by state."""
    specs = [models.LOGISTIC, models.forest(forest or models.PUPIL_FOREST, SEED)]
    scenarios = {"plain": ft.feature_groups(False), "enriched": ft.feature_groups(True)}
    results, fitted = models.compare(train, test, specs, scenarios)
    results = cut_lineage(results)
    winner = evaluation.best_scenario(results, ["position"]).first()
    best = fitted[(winner["model"], winner["scenario"])]
    spec = next(s for s in specs if s.label == winner["model"])
    with_schools = models.fit(train, spec, *ft.feature_groups(True, True))
    by_state = models.group_report(best, test, "SG_UF")
    schools_by_state = models.group_report(with_schools, test, "SG_UF")
    return {
        "comparison": results,
        "confusion": models.confusion_report(best, test),
        "by_region": models.group_report(best, test, "REGIAO"),
        "by_state": by_state,
        "degenerate": evaluation.degenerate_groups(by_state),
        "infrastructure": models.evaluate(with_schools, test),
        "infrastructure_by_state": schools_by_state,
        "infrastructure_degenerate": evaluation.degenerate_groups(schools_by_state),
    }


def tune(
    train: DataFrame,
    test: DataFrame,
    keys: Sequence[str] = KEYS,
    sample_rows: int = tuning.PUPIL_SAMPLE_ROWS,
    candidates: Sequence[dict] | None = None,
    folds: int = 3,
    ledger: str | None = None,
) -> dict[str, DataFrame]:
    """Random search on a stratified sample; the winner is refitted on all of ``train``. ``ledger`` is a folder of finished trials."""
    candidates = candidates or tuning.draws(tuning.PUPIL_SPACE, tuning.PUPIL_DRAWS, SEED)
    numeric, categorical = ft.feature_groups(True)
    sample = sampling.stratified_sample(train, "label", keys, sample_rows, SEED)
    folded = cut_lineage(sampling.stratified_folds(sample, "label", keys, folds, SEED))
    table, best = tuning.search(folded, candidates, numeric, categorical, folds=folds, seed=SEED, ledger=ledger)
    fitted = models.fit(train, models.forest(best, SEED), numeric, categorical)
    by_state = models.group_report(fitted, test, "SG_UF")
    return {
        "search": table,
        "metrics": models.evaluate(fitted, test),
        "by_state": by_state,
        "degenerate": evaluation.degenerate_groups(by_state),
    }


def explain(
    train: DataFrame,
    test: DataFrame,
    keys: Sequence[str] = KEYS,
    sample_rows: int | None = None,
    forest: dict | None = None,
    background_rows: int | None = None,
) -> dict[str, DataFrame]:
    """Attribution of the enriched forest on all test rows, or a seeded sample of ``sample_rows``, against all training rows.

    The rows are collapsed to their distinct feature profiles, those are explained once, and
    the values are joined back to the rows.
    """
    numeric, categorical = ft.feature_groups(True)
    fitted = models.fit(train, models.forest(forest or models.PUPIL_FOREST, SEED), numeric, categorical)
    variables = numeric + categorical
    chosen = test if sample_rows is None else sampling.seeded_sample(test, keys, sample_rows, SEED)
    profile_id = F.sha2(F.to_json(F.struct(*variables), {"ignoreNullFields": "false"}), 256)
    tagged = cut_lineage(chosen.select(*keys, *variables).withColumn("profile_id", profile_id))
    profiles = collapse_profiles(tagged, ["profile_id", *variables])
    phi = shapley_values(fitted, profiles, "profile_id", train, keys, background_rows, seed=SEED)
    members = tagged.select(F.col("profile_id").alias("row_id"), F.concat_ws("|", *keys).alias("_member"))
    per_row = cut_lineage(phi.join(members, "row_id").drop("row_id").withColumnRenamed("_member", "row_id"))
    importance = attribution.importance_by_feature(per_row, tagged.agg(F.count(F.lit(1))))
    rows = tagged.withColumn("_id", F.concat_ws("|", *keys))
    return {
        "values": per_row,
        "expanded": sampling.top_k(importance, "importance", 15, ["feature"]),
        "importance": attribution.importance_by_variable(importance),
        "region_effect": attribution.effect_by_category(per_row, rows, "_id", "REGIAO"),
    }
