"""Gold layer: the pupil fact, the municipality tables and the external dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edugauge.functions import (
    descending_label,
    flag01,
    gap,
    level_profiles,
    lookup,
    pick_by_year,
    polarisation_index,
    share_of_parts,
    structural_risk_index,
    yes_no,
)
from edugauge.functions.dictionaries import (
    DEFAULT_GOAL,
    GOAL_YEARS,
    LEVEL_DEFAULT,
    LEVEL_ORDER,
    LEVEL_THRESHOLDS,
    RELATIVE_DEFAULT,
    RELATIVE_THRESHOLDS,
)
from edugauge.operators.aggregates import flag_shares, group_mean
from edugauge.operators.joins import attach_single_row, left_join_dim, truncated_code_join
from edugauge.operators.windows import change_vs_previous, latest_per_key, trend_label
from edugauge.plans.bronze import GOAL_COLUMNS, LEVEL_COLUMNS

MUNICIPAL_NETWORK = 3
TOTAL_NETWORKS = [0, 5]
ACTIVE_SCHOOL = 1
REGISTER_COUNTS = ["QT_FAMILIAS_POBREZA_FAIXA_PBF", "QT_FAMILIAS_ATE_MEIO_SM", "QT_FAMILIAS_ACIMA_MEIO_SM"]


def external_dimension(
    income: DataFrame, school_index: DataFrame, register: DataFrame, census: DataFrame
) -> DataFrame:
    """One row per municipality of the income table with poverty, school index and school
    infrastructure. School-level inputs are aggregated before they are joined.

    The infrastructure columns are fractions (0..1) in spite of their ``PC_`` prefix; the
    poverty share is a percentage.
    """
    schools = group_mean(school_index, ["CO_MUNICIPIO"], "MEDIA_INSE")
    poverty = register.select(
        F.col("CO_MUNICIPIO").alias("CO_MUNICIPIO_6"),
        share_of_parts(REGISTER_COUNTS[0], REGISTER_COUNTS).alias("PC_FAMILIAS_POBREZA"),
    )
    infrastructure = flag_shares(
        census,
        ["CO_MUNICIPIO"],
        {
            "PC_ESCOLAS_BIBLIOTECA": "IN_BIBLIOTECA",
            "PC_ESCOLAS_LAB_INFORMATICA": "IN_LABORATORIO_INFORMATICA",
            "PC_ESCOLAS_INTERNET_ALUNOS": "IN_INTERNET_ALUNOS",
        },
        F.col("TP_SITUACAO_FUNCIONAMENTO") == ACTIVE_SCHOOL,
    )
    key = [("CO_MUNICIPIO", "CO_MUNICIPIO")]
    dim = income.select("CO_MUNICIPIO", "RENDA_PER_CAPITA_MEDIA")
    # Aggregates are unique on their key already; only the register is checked.
    dim = left_join_dim(dim, schools, key, unique=False)
    dim = truncated_code_join(dim, poverty, "CO_MUNICIPIO", "CO_MUNICIPIO_6")
    return left_join_dim(dim, infrastructure, key, unique=False)


def _same_network_state(states: DataFrame) -> DataFrame:
    return states.select(
        "ANO_REFERENCIA",
        "CO_UF",
        "ID_TIPO_REDE",
        F.col("PC_ALUNO_ALFABETIZADO").alias("PC_ALUNO_ALFABETIZADO_ESTADO"),
        F.col("VL_MEDIA_LP").alias("VL_MEDIA_LP_ESTADO"),
    )


def pupil_fact(
    pupils: DataFrame,
    municipalities: DataFrame,
    states: DataFrame,
    external: DataFrame,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Pupil rows with the results of their municipality and state in the same network.

    Three left joins from the widest table to dimensions. Over stored layers pass
    ``broadcast_rows``: each dimension is measured and, within the bound, broadcast, so the
    pupil rows are never shuffled.
    """
    town = municipalities.select(
        "ANO_REFERENCIA", "CO_MUNICIPIO", "ID_TIPO_REDE",
        "PC_ALUNO_ALFABETIZADO", "VL_MEDIA_LP", "FAIXA_ALFABETIZACAO", "FAIXA_MEDIA_LP",
    )
    rows = left_join_dim(
        pupils,
        town,
        [("ANO_REFERENCIA", "ANO_REFERENCIA"), ("CO_MUNICIPIO", "CO_MUNICIPIO"), ("TP_DEPENDENCIA", "ID_TIPO_REDE")],
        broadcast_rows,
    )
    rows = left_join_dim(
        rows,
        _same_network_state(states),
        [("ANO_REFERENCIA", "ANO_REFERENCIA"), ("CO_UF", "CO_UF"), ("TP_DEPENDENCIA", "ID_TIPO_REDE")],
        broadcast_rows,
    )
    rows = rows.withColumns(
        {
            "DIF_MEDIA_MUNICIPIO": gap("VL_PROFICIENCIA_LP", "VL_MEDIA_LP"),
            "DIF_MEDIA_ESTADO": gap("VL_PROFICIENCIA_LP", "VL_MEDIA_LP_ESTADO"),
            "IN_ACIMA_MEDIA_MUNICIPIO": flag01(F.col("VL_PROFICIENCIA_LP") >= F.col("VL_MEDIA_LP")),
            "IN_ACIMA_MEDIA_ESTADO": flag01(F.col("VL_PROFICIENCIA_LP") >= F.col("VL_MEDIA_LP_ESTADO")),
            # State minus municipality here; the municipality table has the opposite sign.
            "DIF_ALFABETIZACAO_MUNICIPIO": gap("PC_ALUNO_ALFABETIZADO_ESTADO", "PC_ALUNO_ALFABETIZADO"),
            "TARGET": F.col("IN_ALFABETIZADO"),
            "IN_PROVA_VALIDA": flag01((F.col("IN_PRESENCA_LP") == 1) & (F.col("IN_PREENCHIMENTO_LP") == 1)),
            "IN_POSSUI_PROFICIENCIA": F.col("VL_PROFICIENCIA_LP").isNotNull().cast("int"),
        }
    ).withColumn(
        "DESEMPENHO_RELATIVO",
        descending_label("DIF_MEDIA_ESTADO", RELATIVE_THRESHOLDS, RELATIVE_DEFAULT, null_label=None),
    )
    return left_join_dim(rows, external, [("CO_MUNICIPIO", "CO_MUNICIPIO")], broadcast_rows)


def _latest_goals(goals: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    latest = latest_per_key(goals.select(*keys, "ANO_REFERENCIA", *GOAL_COLUMNS), keys, "ANO_REFERENCIA")
    return latest.select(*keys, *[F.col(f"META_FINAL_{y}").alias(f"{prefix}_{y}") for y in GOAL_YEARS])


def _goal_of_year(prefix: str):
    return pick_by_year("ANO_REFERENCIA", {y: f"{prefix}_{y}" for y in GOAL_YEARS})


def municipality_indicator(
    municipalities: DataFrame,
    states: DataFrame,
    national_goals: DataFrame,
    state_goals: DataFrame,
    municipality_goals: DataFrame,
) -> DataFrame:
    """Municipality x network x year against the goals of its year, its state and its past."""
    rows = municipalities.filter(~F.col("ID_TIPO_REDE").isin(TOTAL_NETWORKS))
    rows = left_join_dim(
        rows, _latest_goals(municipality_goals, ["CO_MUNICIPIO"], "META_MUNICIPIO"),
        [("CO_MUNICIPIO", "CO_MUNICIPIO")], unique=False,
    )
    rows = left_join_dim(
        rows, _latest_goals(state_goals, ["SIGLA_UF"], "META_UF"),
        [("SG_UF", "SIGLA_UF")], unique=False, keep_right_keys=True,
    )
    nation = _latest_goals(national_goals, [], "META_BRASIL")
    rows = attach_single_row(rows, nation, nation.columns)
    rows = left_join_dim(
        rows,
        _same_network_state(states),
        [("ANO_REFERENCIA", "ANO_REFERENCIA"), ("CO_UF", "CO_UF"), ("ID_TIPO_REDE", "ID_TIPO_REDE")],
    )
    scopes = ("MUNICIPIO", "UF", "BRASIL")
    rows = rows.withColumns({f"META_ALFABETIZACAO_{s}": _goal_of_year(f"META_{s}") for s in scopes})
    rows = rows.withColumns(
        {f"DIF_META_ALFABETIZACAO_{s}": gap("PC_ALUNO_ALFABETIZADO", f"META_ALFABETIZACAO_{s}") for s in scopes}
    )
    rows = rows.withColumns(
        {
            # Without a goal the answer is "Não" in this table.
            **{f"ATINGIU_META_{s}": yes_no(F.col(f"DIF_META_ALFABETIZACAO_{s}") >= 0) for s in scopes},
            "CLASSIFICACAO": descending_label(
                "PC_ALUNO_ALFABETIZADO", LEVEL_THRESHOLDS, LEVEL_DEFAULT, null_label=LEVEL_DEFAULT
            ),
            "DIF_ALFABETIZACAO_ESTADO": gap("PC_ALUNO_ALFABETIZADO", "PC_ALUNO_ALFABETIZADO_ESTADO"),
            "DIF_MEDIA_LP_ESTADO": gap("VL_MEDIA_LP", "VL_MEDIA_LP_ESTADO"),
        }
    )
    rows = rows.withColumns(
        {
            "ORDEM_CLASSIFICACAO": lookup(LEVEL_ORDER, "CLASSIFICACAO"),
            "ACIMA_MEDIA_ESTADO": yes_no(F.col("DIF_MEDIA_LP_ESTADO") >= 0),
        }
    )
    rows = change_vs_previous(
        rows,
        ["CO_MUNICIPIO", "ID_TIPO_REDE"],
        "ANO_REFERENCIA",
        {"VARIACAO_ALFABETIZACAO": "PC_ALUNO_ALFABETIZADO", "VARIACAO_MEDIA_LP": "VL_MEDIA_LP"},
    )
    return rows.withColumn("TENDENCIA", trend_label("VARIACAO_ALFABETIZACAO"))


def goals_vs_results(
    municipalities: DataFrame, municipality_goals: DataFrame, default_goal: float = DEFAULT_GOAL
) -> DataFrame:
    """Municipal network against its goal; a missing goal is replaced by ``default_goal``."""
    rows = municipalities.filter(F.col("ID_TIPO_REDE") == MUNICIPAL_NETWORK)
    rows = left_join_dim(
        rows, _latest_goals(municipality_goals, ["CO_MUNICIPIO"], "META_FINAL"),
        [("CO_MUNICIPIO", "CO_MUNICIPIO")], unique=False,
    )
    fallback = F.lit(float(default_goal))
    rows = rows.withColumn("META_ANO_AVALIACAO", _goal_of_year("META_FINAL"))
    rows = rows.withColumns(
        {
            "DIF_META_ALFABETIZACAO": gap("PC_ALUNO_ALFABETIZADO", F.coalesce("META_ANO_AVALIACAO", fallback)),
            "DISTANCIA_META_2030": gap("PC_ALUNO_ALFABETIZADO", F.coalesce("META_FINAL_2030", fallback)),
        }
    )
    return rows.withColumns(
        {
            "IN_META_ATINGIDA": flag01(F.col("DIF_META_ALFABETIZACAO") >= 0),
            "IN_META_2030_ATINGIDA": flag01(F.col("DISTANCIA_META_2030") >= 0),
        }
    )


def level_analysis(municipalities: DataFrame) -> DataFrame:
    """Municipal network: five profiles, polarisation and structural risk. A projection."""
    rows = municipalities.filter(F.col("ID_TIPO_REDE") == MUNICIPAL_NETWORK)
    rows = rows.withColumns(level_profiles(LEVEL_COLUMNS))
    return rows.withColumns(
        {
            "INDICE_POLARIZACAO": polarisation_index("PC_TAXA_EXCELENCIA", "PC_PERFIL_EXTREMA_DEFASAGEM"),
            "INDICE_RISCO_ESTRUTURAL": structural_risk_index(
                LEVEL_COLUMNS, "PC_PERFIL_EXTREMA_DEFASAGEM", "PC_PERFIL_EM_DESENVOLVIMENTO"
            ),
        }
    )


def build(
    silver: dict[str, DataFrame], external: DataFrame, broadcast_rows: int | None = None
) -> dict[str, DataFrame]:
    """The four gold tables from the silver tables and the external dimension."""
    return {
        "FT_MACHINE_LEARNING": pupil_fact(
            silver["TS_ALUNO"], silver["TS_MUNICIPIO"], silver["TS_ESTADO"], external, broadcast_rows
        ),
        "FT_INDICADOR_MUNICIPIO": municipality_indicator(
            silver["TS_MUNICIPIO"], silver["TS_ESTADO"],
            silver["METAS_BR"], silver["METAS_UF"], silver["METAS_MUNICIPIO"],
        ),
        "FT_INDICADOR_MUNICIPIO_META_VS_RESULTADO": goals_vs_results(
            silver["TS_MUNICIPIO"], silver["METAS_MUNICIPIO"]
        ),
        "ANALISE_NIVEIS_MUNICIPIO": level_analysis(silver["TS_MUNICIPIO"]),
    }
