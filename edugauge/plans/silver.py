"""Silver layer: bands, texts and flags, plus the checks a table has to pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edugauge.functions import (
    DEPENDENCY_NAMES,
    STATE_REGIONS,
    count_present,
    flag01,
    joined_label,
    lookup,
    present_flag,
    right_closed_band,
    yes_no,
    zero_padded,
)
from edugauge.functions.dictionaries import (
    GRADE_NAMES,
    LEVEL_DEFAULT,
    LITERACY_BANDS,
    MEAN_BANDS,
    SCORE_BANDS,
    YES_NO_NAMES,
)
from edugauge.operators import quality
from edugauge.plans.bronze import GOAL_COLUMNS, LEVEL_COLUMNS


def _load_date(df: DataFrame) -> DataFrame:
    return df.withColumns({"ANO_CARGA": F.year("TS_PROCESSAMENTO"), "MES_CARGA": F.month("TS_PROCESSAMENTO")})


def _reference_year(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("NU_ANO_AVALIACAO", "ANO_REFERENCIA")


def pupils(bronze: DataFrame) -> DataFrame:
    """Score band, participation, dependency, grade and region texts. A projection."""
    took_part = (F.col("IN_PRESENCA_LP") == 1) & (F.col("IN_PREENCHIMENTO_LP") == 1)
    rows = bronze.withColumns(
        {
            "FAIXA_PROFICIENCIA": right_closed_band("VL_PROFICIENCIA_LP", *SCORE_BANDS, null_label="Não avaliado"),
            "IN_PARTICIPOU_AVALIACAO": flag01(took_part),
            "DS_PARTICIPACAO": yes_no(took_part, "Participou", "Não Participou"),
            "DS_SITUACAO_AVALIACAO": yes_no(F.col("VL_PROFICIENCIA_LP").isNotNull(), "Avaliado", "Não Avaliado"),
            "CO_MUNICIPIO_IBGE": zero_padded("CO_MUNICIPIO", 7),
            "NO_MUNICIPIO_UF": joined_label("NO_MUNICIPIO", "SG_UF"),
            "DS_DEPENDENCIA": lookup(DEPENDENCY_NAMES, F.col("TP_DEPENDENCIA").cast("int")),
            "DS_SERIE": lookup(GRADE_NAMES, "TP_SERIE", fallback=F.col("TP_SERIE").cast("string")),
            "DS_ALFABETIZADO": lookup(YES_NO_NAMES, F.col("IN_ALFABETIZADO").cast("int")),
            "REGIAO": lookup(STATE_REGIONS, "SG_UF"),
        }
    )
    return _reference_year(_load_date(rows))


def _territory_bands(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "FAIXA_MEDIA_LP": right_closed_band("VL_MEDIA_LP", *MEAN_BANDS),
            "FAIXA_ALFABETIZACAO": right_closed_band("PC_ALUNO_ALFABETIZADO", *LITERACY_BANDS),
            "IN_POSSUI_DISTRIBUICAO_NIVEIS": present_flag(*LEVEL_COLUMNS),
            "REGIAO": lookup(STATE_REGIONS, "SG_UF"),
        }
    )


def municipalities(bronze: DataFrame) -> DataFrame:
    rows = _territory_bands(bronze).withColumn("NO_MUNICIPIO_UF", joined_label("NO_MUNICIPIO", "SG_UF"))
    return _reference_year(_load_date(rows))


def states(bronze: DataFrame) -> DataFrame:
    return _reference_year(_load_date(_territory_bands(bronze)))


def _goal_counts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"QTD_METAS_DEFINIDAS": count_present(GOAL_COLUMNS), "IN_POSSUI_META": present_flag(*GOAL_COLUMNS)}
    )


def national_goals(bronze: DataFrame) -> DataFrame:
    return _goal_counts(bronze).withColumn("IN_POSSUI_RESULTADO", present_flag("PC_ALUNO_ALFABETIZADO_2024"))


def state_goals(bronze: DataFrame) -> DataFrame:
    return _goal_counts(bronze.withColumn("REGIAO", lookup(STATE_REGIONS, "SIGLA_UF")))


def municipality_goals(bronze: DataFrame) -> DataFrame:
    level = F.when(F.col("CO_NIVEL_ALFABETIZACAO") == 0, LEVEL_DEFAULT).otherwise(
        F.concat(F.lit("Nível "), F.col("CO_NIVEL_ALFABETIZACAO").cast("string"))
    )
    return _goal_counts(bronze).withColumn("DS_NIVEL_ALFABETIZACAO", level)


def build(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All silver tables from the bronze tables."""
    return {
        "TS_ALUNO": pupils(bronze["TS_ALUNO"]),
        "TS_MUNICIPIO": municipalities(bronze["TS_MUNICIPIO"]),
        "TS_ESTADO": states(bronze["TS_ESTADO"]),
        "METAS_BR": national_goals(bronze["METAS_BR"]),
        "METAS_UF": state_goals(bronze["METAS_UF"]),
        "METAS_MUNICIPIO": municipality_goals(bronze["METAS_MUNICIPIO"]),
    }


def checks(silver: dict[str, DataFrame]) -> DataFrame:
    """Keys, nulls and years of the silver tables, one row per check."""
    keyed = [("TS_ALUNO", "SK_ALUNO"), ("TS_MUNICIPIO", "SK_MUNICIPIO"), ("TS_ESTADO", "SK_ESTADO")]
    rows = []
    for table, key in keyed:
        rows += [
            quality.check_primary_key(silver[table], [key], table),
            quality.check_not_null(silver[table], [key, "ANO_REFERENCIA"], table),
            quality.check_years(silver[table], "ANO_REFERENCIA", table),
        ]
    rows += [
        quality.check_not_null(silver["METAS_BR"], ["ANO_REFERENCIA"], "METAS_BR"),
        quality.check_primary_key(silver["METAS_UF"], ["ANO_REFERENCIA", "SIGLA_UF"], "METAS_UF"),
        quality.check_primary_key(silver["METAS_MUNICIPIO"], ["ANO_REFERENCIA", "CO_MUNICIPIO"], "METAS_MUNICIPIO"),
    ]
    return quality.union_checks(rows)
