"""Tables behind the charts. Drawing is left to the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edugauge.operators.aggregates import zscore
from edugauge.operators.evaluation import confusion_shares

# Columns where a high value is bad; label texts of a scenario.
INVERTED_COLUMNS = ["PC_FAMILIAS_POBREZA"]
ENRICHED_TEXT, PLAIN_TEXT = "com enriq.", "sem enriq."


def importance_bars(importance: DataFrame, name: str = "variable", digits: int = 6) -> DataFrame:
    """Importances in drawing order, smallest first."""
    return importance.select(name, F.round("importance", digits).alias("importance")).orderBy("importance", name)


def group_bars(metrics: DataFrame, group: str, metric: str, upper: float = 0.99) -> DataFrame:
    """Metric per group in drawing order with a mark on all-or-nothing groups."""
    degenerate = (F.col(metric) == 0) | (F.col(metric) >= upper)
    return metrics.select(group, metric, F.coalesce(degenerate, F.lit(False)).alias("degenerate")).orderBy(metric, group)


def scenario_long(
    results: DataFrame, model: str, enriched: str, metrics: Sequence[str] = ("accuracy", "f1", "roc_auc")
) -> DataFrame:
    """Scenario label with one row per metric."""
    text = F.when(F.col(enriched), ENRICHED_TEXT).otherwise(PLAIN_TEXT)
    label = F.concat(F.col(model), F.lit(" ("), text, F.lit(")"))
    return results.withColumn("scenario", label).unpivot(["scenario"], list(metrics), "metric", "value")


def confusion_heat(matrix: DataFrame) -> DataFrame:
    """Confusion cells with the share of the total."""
    return confusion_shares(matrix)


def cluster_heat(
    profile: DataFrame, cluster: str, features: Sequence[str], inverted: Sequence[str] = tuple(INVERTED_COLUMNS)
) -> DataFrame:
    """Z-score of every cluster mean, one row per (cluster, feature), next to the real value."""
    scored = zscore(profile, features, [c for c in inverted if c in features])
    long = scored.unpivot([cluster], list(features), "feature", "zscore")
    values = profile.unpivot([cluster], list(features), "feature", "value")
    return long.join(values, [cluster, "feature"])
