"""Municipality goal model: lagged dataset, next-cycle risk ranking and its cross-check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edugauge.ml.features import GOAL_CATEGORICAL, GOAL_NUMERIC, GOAL_TARGET
from edugauge.ml.models import MUNICIPALITY_FOREST, Fitted, Spec, fit, forest
from edugauge.operators.joins import calendar_lag, left_join_dim

LAGGED = ["PC_ALUNO_ALFABETIZADO", "DIF_META_ALFABETIZACAO", "IN_META_ATINGIDA"]

# Alert cut-offs on the risk of missing the goal.
CUT_BEST_F1 = 0.4612
CUT_RECALL_80 = 0.4412


def lag_dataset(goals_vs_results: DataFrame, external: DataFrame) -> DataFrame:
    """Result of a year next to the indicators of the year before and the external columns."""
    current = goals_vs_results.select("ANO_REFERENCIA", "CO_MUNICIPIO", "SG_UF", "REGIAO", *LAGGED)
    paired = calendar_lag(current, ["CO_MUNICIPIO"], "ANO_REFERENCIA", LAGGED)
    # The external dimension is one row per municipality by construction.
    return left_join_dim(paired, external, [("CO_MUNICIPIO", "CO_MUNICIPIO")], unique=False)


def labelled(dataset: DataFrame) -> DataFrame:
    """Model frame of the lagged dataset; every municipality has weight 1."""
    return dataset.select(
        "ANO_REFERENCIA", "CO_MUNICIPIO", *GOAL_NUMERIC, *GOAL_CATEGORICAL,
        F.col(GOAL_TARGET).cast("int").alias("label"), F.lit(1.0).alias("weight"),
    )


def projection(goals_vs_results: DataFrame, external: DataFrame, year: int) -> DataFrame:
    """Indicators of ``year`` in the place of the previous year: input for the next cycle."""
    latest = goals_vs_results.filter(F.col("ANO_REFERENCIA") == year).select(
        "CO_MUNICIPIO", "SG_UF", "REGIAO", *[F.col(c).alias(f"{c}_ANTERIOR") for c in LAGGED]
    )
    return left_join_dim(latest, external, [("CO_MUNICIPIO", "CO_MUNICIPIO")], unique=False)


def fit_risk(dataset: DataFrame, spec: Spec | None = None) -> Fitted:
    """Fit on every available pair of years (scoring the present, not measuring the model)."""
    return fit(labelled(dataset), spec or forest(MUNICIPALITY_FOREST), GOAL_NUMERIC, GOAL_CATEGORICAL)


def risk_ranking(
    fitted: Fitted, projected: DataFrame, year: int, best_f1: float = CUT_BEST_F1, recall_80: float = CUT_RECALL_80
) -> DataFrame:
    """Municipalities by falling probability of missing the next goal, with two alerts."""
    risk = F.col("PROBABILIDADE_RISCO_NAO_ATINGIR_META")
    return (
        fitted.transform(projected)
        .select(
            "CO_MUNICIPIO", "SG_UF", "REGIAO",
            F.col("PC_ALUNO_ALFABETIZADO_ANTERIOR").alias(f"PC_ALUNO_ALFABETIZADO_{year}"),
            F.col("risk").alias("PROBABILIDADE_RISCO_NAO_ATINGIR_META"),
        )
        .withColumns({"ALERTA_F1_OTIMO": risk >= best_f1, "ALERTA_RECALL_80": risk >= recall_80})
        .orderBy(risk.desc(), "CO_MUNICIPIO")
    )


def risk_agreement(ranking: DataFrame, levels: DataFrame, year: int) -> DataFrame:
    """Correlation of the model's risk with the independently computed structural index."""
    index = levels.filter(F.col("ANO_REFERENCIA") == year).select("CO_MUNICIPIO", "INDICE_RISCO_ESTRUTURAL")
    return ranking.join(index, "CO_MUNICIPIO", "inner").agg(
        F.corr("PROBABILIDADE_RISCO_NAO_ATINGIR_META", "INDICE_RISCO_ESTRUTURAL").alias("corr"),
        F.count(F.lit(1)).alias("n"),
    )
