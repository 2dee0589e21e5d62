"""Exploratory tables over the pupil fact. Every entry is a lazy frame of report size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edugauge.operators import aggregates as agg
from edugauge.operators import quality, sampling

# Columns correlated with the target, and the socio-economic ones.
CORRELATED = [
    "VL_PROFICIENCIA_LP", "DIF_MEDIA_MUNICIPIO", "DIF_MEDIA_ESTADO", "IN_ACIMA_MEDIA_MUNICIPIO", "IN_ACIMA_MEDIA_ESTADO",
    "PC_ALUNO_ALFABETIZADO", "PC_ALUNO_ALFABETIZADO_ESTADO", "DIF_ALFABETIZACAO_MUNICIPIO", "VL_MEDIA_LP",
    "VL_MEDIA_LP_ESTADO",
]
SOCIOECONOMIC = ["PC_FAMILIAS_POBREZA", "RENDA_PER_CAPITA_MEDIA", "MEDIA_INSE"]
TARGET, WEIGHT, SCORE, YEAR = "TARGET", "VL_PESO_ALUNO_LP", "VL_PROFICIENCIA_LP", "ANO_REFERENCIA"
PRIVATE = "Privada"


def public_network(fact: DataFrame) -> DataFrame:
    """Everything but the private network; rows without a network stay."""
    return fact.filter(~F.col("DS_DEPENDENCIA").eqNullSafe(PRIVATE))


def rates(df: DataFrame, *by: str) -> DataFrame:
    """Weighted literacy rate, best first."""
    out = agg.weighted_rate(df, TARGET, WEIGHT, by)
    return out.orderBy(F.desc_nulls_last("rate"), *by) if by else out


def municipality_rollup(fact: DataFrame) -> DataFrame:
    return agg.rollup_first(fact, "CO_MUNICIPIO", TARGET, SOCIOECONOMIC, "N_ALUNOS", "TAXA_ALFABETIZACAO")


def explore(fact: DataFrame, model_year: int = 2025) -> dict[str, DataFrame]:
    """The report tables. Store or persist ``fact`` first: each table is one scan of it."""
    public = public_network(fact)
    one_year = public.filter(F.col(YEAR) == model_year)
    towns = municipality_rollup(fact)
    return {
        "overview": agg.distinct_counts(fact, [YEAR, "SG_UF", "CO_MUNICIPIO"]),
        "top_nulls": sampling.top_k(agg.null_profile(fact), "null_pct", 12, ["column_name"]),
        "rate_by_year": rates(fact, YEAR),
        "rate_all_years": rates(fact),
        "rate_by_state_model_year": rates(one_year, "SG_UF"),
        "target_shares": agg.value_counts(fact, [TARGET], share="share"),
        "participation": agg.value_counts(fact, ["DS_PARTICIPACAO"]),
        "target_of_unassessed": agg.value_counts(fact.filter(F.col(SCORE).isNull()), [TARGET]),
        "score_histogram": agg.histogram(fact, SCORE, 60),
        "score_summary": agg.describe_exact(fact, SCORE),
        "dependency": agg.value_counts(fact, ["DS_DEPENDENCIA"]),
        "rate_by_region": rates(public, "REGIAO"),
        "rate_by_state": rates(public, "SG_UF"),
        "correlation": agg.correlation_vector(fact, CORRELATED, TARGET).orderBy(F.desc_nulls_last("corr")),
        "leakage": quality.leakage_table(fact.filter(F.col(SCORE).isNotNull()), SCORE, TARGET),
        "municipalities": towns,
        "coverage": agg.coverage(towns, SOCIOECONOMIC),
        "correlation_municipality": agg.correlation_vector(towns, SOCIOECONOMIC, "TAXA_ALFABETIZACAO"),
        "correlation_pupil": agg.correlation_vector(fact, SOCIOECONOMIC, TARGET),
        "regression": agg.regression_line(towns, SOCIOECONOMIC, "TAXA_ALFABETIZACAO"),
    }
