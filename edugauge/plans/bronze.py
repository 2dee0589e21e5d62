"""Bronze layer: typed, cleaned and keyed rows from string scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edugauge.functions import (
    NETWORK_NAMES,
    clean_goal,
    concat_key,
    lookup,
    nullable_int,
    sha256_key,
    sheet_int,
    strict_int,
    strip,
    title_case,
    tolerant_double,
    tolerant_int,
)
from edugauge.functions.dictionaries import ASSESSMENT_YEARS, GOAL_YEARS
from edugauge.operators.windows import dedupe_first
from edugauge.sources import INGEST_ORDER, read_sheet, read_yearly, stamp

# Columns of the raw pupil file that are used.
PUPIL_COLUMNS = [
    "NU_ANO_AVALIACAO", "CO_UF", "SG_UF", "ID_ALUNO", "TP_SERIE", "ID_ESCOLA", "TP_DEPENDENCIA",
    "CO_MUNICIPIO", "NO_MUNICIPIO", "IN_PRESENCA_LP", "IN_PREENCHIMENTO_LP", "VL_PESO_ALUNO_LP",
    "VL_PROFICIENCIA_LP", "IN_ALFABETIZADO",
]
LEVEL_COLUMNS = [f"PC_ALUNO_NIVEL_{i}_LP" for i in range(9)]
MEASURE_COLUMNS = ["PC_ALUNO_ALFABETIZADO", "VL_MEDIA_LP", *LEVEL_COLUMNS]
GOAL_COLUMNS = [f"META_FINAL_{y}" for y in GOAL_YEARS]
RESULT_COLUMNS = [f"PC_ALUNO_ALFABETIZADO_{y}" for y in ASSESSMENT_YEARS]
NATION_NAME = "Brasil"


def _clean_name(c: str) -> Column:
    return title_case(strip(c))


def _clean_code(c: str) -> Column:
    return F.upper(strip(c))


def pupils(raw: DataFrame, processed_at=None) -> DataFrame:
    """One row per pupil and year. A projection: no shuffle."""
    typed = raw.select(
        strict_int("NU_ANO_AVALIACAO").alias("NU_ANO_AVALIACAO"),
        strict_int("CO_UF").alias("CO_UF"),
        _clean_code("SG_UF").alias("SG_UF"),
        strict_int("ID_ALUNO", "bigint").alias("ID_ALUNO"),
        strict_int("TP_SERIE").alias("TP_SERIE"),
        nullable_int("ID_ESCOLA").alias("ID_ESCOLA"),
        nullable_int("TP_DEPENDENCIA").alias("TP_DEPENDENCIA"),
        nullable_int("CO_MUNICIPIO").alias("CO_MUNICIPIO"),
        _clean_name("NO_MUNICIPIO").alias("NO_MUNICIPIO"),
        tolerant_int("IN_PRESENCA_LP").alias("IN_PRESENCA_LP"),
        tolerant_int("IN_PREENCHIMENTO_LP").alias("IN_PREENCHIMENTO_LP"),
        tolerant_double("VL_PESO_ALUNO_LP").alias("VL_PESO_ALUNO_LP"),
        tolerant_double("VL_PROFICIENCIA_LP").alias("VL_PROFICIENCIA_LP"),
        tolerant_int("IN_ALFABETIZADO").alias("IN_ALFABETIZADO"),
    )
    return stamp(typed.withColumn("SK_ALUNO", concat_key("NU_ANO_AVALIACAO", "ID_ALUNO")), processed_at)


def _aggregate_rows(raw: DataFrame, place: Sequence[str], place_key: str, surrogate: str, order: str, processed_at) -> DataFrame:
    keys = ["NU_ANO_AVALIACAO", place_key, "TP_SERIE", "ID_TIPO_REDE"]
    integers = ["NU_ANO_AVALIACAO", *place, "TP_SERIE", "ID_TIPO_REDE"]
    typed = raw.withColumns(
        {
            **{c: strict_int(c) for c in integers},
            **{c: tolerant_double(c) for c in MEASURE_COLUMNS},
            "SG_UF": _clean_code("SG_UF"),
            **({"NO_MUNICIPIO": _clean_name("NO_MUNICIPIO")} if "NO_MUNICIPIO" in raw.columns else {}),
        }
    )
    first = dedupe_first(typed, keys, order).drop(order)
    keyed = first.withColumns(
        {"DS_TIPO_REDE": lookup(NETWORK_NAMES, "ID_TIPO_REDE"), surrogate: sha256_key(*keys)}
    )
    return stamp(keyed, processed_at)


def municipalities(raw: DataFrame, order: str = INGEST_ORDER, processed_at=None) -> DataFrame:
    """Municipality results, first row per year, municipality, grade and network."""
    return _aggregate_rows(raw, ["CO_UF", "CO_MUNICIPIO"], "CO_MUNICIPIO", "SK_MUNICIPIO", order, processed_at)


def states(raw: DataFrame, order: str = INGEST_ORDER, processed_at=None) -> DataFrame:
    """State results, first row per year, state, grade and network."""
    return _aggregate_rows(raw, ["CO_UF"], "CO_UF", "SK_ESTADO", order, processed_at)


def _clean_goals(df: DataFrame) -> DataFrame:
    numbers = [*GOAL_COLUMNS, *RESULT_COLUMNS, "PC_AVALIADOS_LP"]
    return df.withColumns({c: clean_goal(c) for c in numbers})


def national_goals(sheet: DataFrame, processed_at=None) -> DataFrame:
    """The national row(s) of the state goal sheet."""
    rows = _clean_goals(sheet.filter(F.col("NOME_UF") == NATION_NAME))
    named = rows.withColumns({"REDE": _clean_name("REDE"), "ANO_REFERENCIA": sheet_int("ANO")})
    keyed = named.withColumn("SK_META_ALFABETIZACAO", sha256_key("ANO_REFERENCIA", F.upper("REDE")))
    return stamp(keyed, processed_at)


def state_goals(sheet: DataFrame, processed_at=None) -> DataFrame:
    """The state rows of the state goal sheet."""
    rows = _clean_goals(sheet.filter(F.col("NOME_UF") != NATION_NAME))
    named = rows.withColumns(
        {
            "SIGLA_UF": _clean_code("SIGLA_UF"),
            "CO_UF": sheet_int("CD_UF"),
            "REDE": _clean_name("REDE"),
            "ANO_REFERENCIA": sheet_int("ANO"),
        }
    )
    keyed = named.withColumn("SK_META_ESTADO", sha256_key("ANO_REFERENCIA", "SIGLA_UF", F.upper("REDE")))
    return stamp(keyed, processed_at)


def municipality_goals(sheet: DataFrame, processed_at=None) -> DataFrame:
    """Goals per municipality; note rows without a municipality are dropped."""
    rows = _clean_goals(sheet.filter(F.col("CO_MUNICIPIO").isNotNull()))
    named = rows.withColumns(
        {
            "CO_UF": sheet_int("CO_UF"),
            "SG_UF": _clean_code("SG_UF"),
            "CO_MUNICIPIO": sheet_int("CO_MUNICIPIO"),
            "NO_MUNICIPIO": _clean_name("NO_MUNICIPIO"),
            "NO_TP_REDE": _clean_name("NO_TP_REDE"),
            "ANO_REFERENCIA": sheet_int("ANO"),
            "CO_NIVEL_ALFABETIZACAO": sheet_int("CO_NIVEL_ALFABETIZACAO"),
        }
    )
    return stamp(named.withColumn("SK_META_MUNICIPIO", sha256_key("ANO_REFERENCIA", "CO_MUNICIPIO")), processed_at)


def scan(spark: SparkSession, raw_path: str, years: Sequence[int] = tuple(ASSESSMENT_YEARS)) -> dict[str, DataFrame]:
    """The raw string frames of a raw folder (yearly files and exported goal sheets)."""
    base = f"{raw_path}/DADOS"
    return {
        "pupils": read_yearly(spark, base, "TS_ALUNO.csv", years, PUPIL_COLUMNS),
        "municipalities": read_yearly(spark, base, "TS_MUNICIPIO.csv", years, ingest_order=True),
        "states": read_yearly(spark, base, "TS_ESTADO.csv", years, ingest_order=True),
        "state_sheet": read_sheet(spark, f"{raw_path}/metas_ufs.csv", "NOME_UF"),
        "municipality_sheet": read_sheet(spark, f"{raw_path}/metas_municipios.csv", "CO_MUNICIPIO"),
    }


def build(raw: dict[str, DataFrame], order: str = INGEST_ORDER, processed_at=None) -> dict[str, DataFrame]:
    """All bronze tables from the raw frames."""
    return {
        "TS_ALUNO": pupils(raw["pupils"], processed_at),
        "TS_MUNICIPIO": municipalities(raw["municipalities"], order, processed_at),
        "TS_ESTADO": states(raw["states"], order, processed_at),
        "METAS_BR": national_goals(raw["state_sheet"], processed_at),
        "METAS_UF": state_goals(raw["state_sheet"], processed_at),
        "METAS_MUNICIPIO": municipality_goals(raw["municipality_sheet"], processed_at),
    }
