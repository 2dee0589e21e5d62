"""The layer tables, whole, over the stand-in inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from edugauge import functions as fn
from edugauge.functions.dictionaries import GOAL_YEARS
from edugauge.ml import clustering, municipal
from edugauge.ml.features import PROFILE_FEATURES, mode_table
from edugauge.operators.quality import table_profile
from edugauge.plans import silver as silver_plan
from edugauge.session import cut_lineage
from workloads.registry import query
from workloads.standin import duck, external_frame, gold_frame, relation, silver_frame, silver_frames

_TITLE = (
    "list_aggregate(list_transform(regexp_extract_all(lower({c}), '(\\p{{L}}+|[^\\p{{L}}]+)'), "
    "lambda x: upper(x[1]) || x[2:]), 'string_agg', '')"
)
_STRIP = r"regexp_replace({c}, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')"


def _title(c: str) -> str:
    return _TITLE.format(c=_STRIP.format(c=c))


def _num(c: str) -> str:
    return f"try_cast(trim({c}) AS double)"


def _goal(c: str) -> str:
    return f"try_cast(trim(replace(nullif(trim({c}), '-'), '>', '')) AS double)"


_LEVELS = [f"PC_ALUNO_NIVEL_{i}_LP" for i in range(9)]
_MEASURES = ["PC_ALUNO_ALFABETIZADO", "VL_MEDIA_LP", *_LEVELS]
_NETWORK = "CASE ID_TIPO_REDE WHEN 0 THEN 'Total' WHEN 2 THEN 'Estadual' WHEN 3 THEN 'Municipal' WHEN 4 THEN 'Privada' WHEN 5 THEN 'Total (Estadual+Municipal)' END"
_MEAN_BAND = "CASE WHEN VL_MEDIA_LP <= 699.99 THEN '< 700' WHEN VL_MEDIA_LP <= 742.99 THEN '700-742' WHEN VL_MEDIA_LP <= 799.99 THEN '743-799' WHEN VL_MEDIA_LP > 799.99 THEN '800+' END"
_LIT_BAND = "CASE WHEN PC_ALUNO_ALFABETIZADO <= 39.99 THEN 'Muito Baixa' WHEN PC_ALUNO_ALFABETIZADO <= 59.99 THEN 'Baixa' WHEN PC_ALUNO_ALFABETIZADO <= 79.99 THEN 'Boa' WHEN PC_ALUNO_ALFABETIZADO > 79.99 THEN 'Excelente' END"
_HAS_LEVELS = "cast(" + " OR ".join(f"{c} IS NOT NULL" for c in _LEVELS) + " AS int)"
_GOALS = [f"META_FINAL_{y}" for y in GOAL_YEARS]
_GOAL_NUMBERS = ", ".join(
    f"{_goal(c)} AS {c}" for c in [*_GOALS, *(f"PC_ALUNO_ALFABETIZADO_{y}" for y in (2023, 2024, 2025)), "PC_AVALIADOS_LP"]
)
_GOAL_COUNT = " + ".join(f"({c} IS NOT NULL)::int" for c in _GOALS)

_SILVER = f"""s_aluno AS (SELECT a.*, r.regiao AS REGIAO, 2025::int AS ANO_CARGA, 12::int AS MES_CARGA,
    CASE WHEN VL_PROFICIENCIA_LP IS NULL THEN 'Não avaliado' WHEN VL_PROFICIENCIA_LP <= 649.99 THEN '< 650'
      WHEN VL_PROFICIENCIA_LP <= 699.99 THEN '650-699' WHEN VL_PROFICIENCIA_LP <= 742.99 THEN '700-742'
      WHEN VL_PROFICIENCIA_LP <= 799.99 THEN '743-799' ELSE '800+' END AS FAIXA_PROFICIENCIA,
    coalesce(IN_PRESENCA_LP = 1 AND IN_PREENCHIMENTO_LP = 1, false)::int AS IN_PARTICIPOU_AVALIACAO,
    CASE WHEN IN_PRESENCA_LP = 1 AND IN_PREENCHIMENTO_LP = 1 THEN 'Participou' ELSE 'Não Participou' END AS DS_PARTICIPACAO,
    CASE WHEN VL_PROFICIENCIA_LP IS NOT NULL THEN 'Avaliado' ELSE 'Não Avaliado' END AS DS_SITUACAO_AVALIACAO,
    cast(CO_MUNICIPIO AS varchar) AS CO_MUNICIPIO_IBGE, NO_MUNICIPIO || ' - ' || SG_UF AS NO_MUNICIPIO_UF,
    CASE TP_DEPENDENCIA WHEN 1 THEN 'Federal' WHEN 2 THEN 'Estadual' WHEN 3 THEN 'Municipal' WHEN 4 THEN 'Privada' END AS DS_DEPENDENCIA,
    CASE WHEN TP_SERIE = 2 THEN '2º Ano do Ensino Fundamental' ELSE cast(TP_SERIE AS varchar) END AS DS_SERIE,
    CASE IN_ALFABETIZADO WHEN 1 THEN 'Sim' WHEN 0 THEN 'Não' END AS DS_ALFABETIZADO
  FROM (SELECT cast(NU_ANO_AVALIACAO AS int) AS ANO_REFERENCIA, cast(CO_UF AS int) AS CO_UF, upper(trim(SG_UF)) AS SG_UF,
      cast(ID_ALUNO AS bigint) AS ID_ALUNO, cast(TP_SERIE AS int) AS TP_SERIE, cast(ID_ESCOLA AS bigint) AS ID_ESCOLA,
      cast(TP_DEPENDENCIA AS bigint) AS TP_DEPENDENCIA, cast(CO_MUNICIPIO AS bigint) AS CO_MUNICIPIO, {_title('NO_MUNICIPIO')} AS NO_MUNICIPIO,
      cast({_num('IN_PRESENCA_LP')} AS bigint) AS IN_PRESENCA_LP, cast({_num('IN_PREENCHIMENTO_LP')} AS bigint) AS IN_PREENCHIMENTO_LP,
      {_num('VL_PESO_ALUNO_LP')} AS VL_PESO_ALUNO_LP, {_num('VL_PROFICIENCIA_LP')} AS VL_PROFICIENCIA_LP,
      cast({_num('IN_ALFABETIZADO')} AS bigint) AS IN_ALFABETIZADO, concat_ws('|', NU_ANO_AVALIACAO, ID_ALUNO) AS SK_ALUNO
    FROM raw_aluno) a LEFT JOIN regions r ON a.SG_UF = r.uf),
s_municipio AS (SELECT m.*, {_NETWORK} AS DS_TIPO_REDE, {_MEAN_BAND} AS FAIXA_MEDIA_LP, {_LIT_BAND} AS FAIXA_ALFABETIZACAO,
    {_HAS_LEVELS} AS IN_POSSUI_DISTRIBUICAO_NIVEIS, r.regiao AS REGIAO, NO_MUNICIPIO || ' - ' || SG_UF AS NO_MUNICIPIO_UF,
    2025::int AS ANO_CARGA, 12::int AS MES_CARGA
  FROM (SELECT cast(NU_ANO_AVALIACAO AS int) AS ANO_REFERENCIA, cast(CO_UF AS int) AS CO_UF, upper(trim(SG_UF)) AS SG_UF,
      cast(CO_MUNICIPIO AS int) AS CO_MUNICIPIO, {_title('NO_MUNICIPIO')} AS NO_MUNICIPIO, cast(TP_SERIE AS int) AS TP_SERIE,
      cast(ID_TIPO_REDE AS int) AS ID_TIPO_REDE, {', '.join(f'{_num(c)} AS {c}' for c in _MEASURES)},
      sha256(concat_ws('|', NU_ANO_AVALIACAO, CO_MUNICIPIO, TP_SERIE, ID_TIPO_REDE)) AS SK_MUNICIPIO
    FROM raw_municipio QUALIFY row_number() OVER (PARTITION BY NU_ANO_AVALIACAO, CO_MUNICIPIO, TP_SERIE, ID_TIPO_REDE ORDER BY ordem) = 1) m
  LEFT JOIN regions r ON m.SG_UF = r.uf),
s_estado AS (SELECT e.*, {_NETWORK} AS DS_TIPO_REDE, {_MEAN_BAND} AS FAIXA_MEDIA_LP, {_LIT_BAND} AS FAIXA_ALFABETIZACAO,
    {_HAS_LEVELS} AS IN_POSSUI_DISTRIBUICAO_NIVEIS, r.regiao AS REGIAO, 2025::int AS ANO_CARGA, 12::int AS MES_CARGA
  FROM (SELECT cast(NU_ANO_AVALIACAO AS int) AS ANO_REFERENCIA, cast(CO_UF AS int) AS CO_UF, upper(trim(SG_UF)) AS SG_UF,
      cast(TP_SERIE AS int) AS TP_SERIE, cast(ID_TIPO_REDE AS int) AS ID_TIPO_REDE, {', '.join(f'{_num(c)} AS {c}' for c in _MEASURES)},
      sha256(concat_ws('|', NU_ANO_AVALIACAO, CO_UF, TP_SERIE, ID_TIPO_REDE)) AS SK_ESTADO FROM raw_estado) e
  LEFT JOIN regions r ON e.SG_UF = r.uf),
s_metas_br AS (SELECT *, {_GOAL_COUNT} AS QTD_METAS_DEFINIDAS, ({_GOAL_COUNT} > 0)::int AS IN_POSSUI_META,
    (PC_ALUNO_ALFABETIZADO_2024 IS NOT NULL)::int AS IN_POSSUI_RESULTADO,
    sha256(concat_ws('|', ANO_REFERENCIA, upper(REDE))) AS SK_META_ALFABETIZACAO
  FROM (SELECT cast(ANO AS int) AS ANO_REFERENCIA, NOME_UF, {_title('REDE')} AS REDE, {_GOAL_NUMBERS} FROM sheet_uf WHERE NOME_UF = 'Brasil') b),
s_metas_uf AS (SELECT m.*, {_GOAL_COUNT} AS QTD_METAS_DEFINIDAS, ({_GOAL_COUNT} > 0)::int AS IN_POSSUI_META, r.regiao AS REGIAO,
    sha256(concat_ws('|', ANO_REFERENCIA, SIGLA_UF, upper(REDE))) AS SK_META_ESTADO
  FROM (SELECT cast(ANO AS int) AS ANO_REFERENCIA, NOME_UF, upper(trim(SIGLA_UF)) AS SIGLA_UF, cast(CD_UF AS int) AS CO_UF, {_title('REDE')} AS REDE,
    {_GOAL_NUMBERS} FROM sheet_uf WHERE NOME_UF <> 'Brasil') m LEFT JOIN regions r ON m.SIGLA_UF = r.uf),
s_metas_municipio AS (SELECT *, {_GOAL_COUNT} AS QTD_METAS_DEFINIDAS, ({_GOAL_COUNT} > 0)::int AS IN_POSSUI_META,
    CASE WHEN CO_NIVEL_ALFABETIZACAO = 0 THEN 'Abaixo do Nível 1' ELSE 'Nível ' || cast(CO_NIVEL_ALFABETIZACAO AS varchar) END AS DS_NIVEL_ALFABETIZACAO,
    sha256(concat_ws('|', ANO_REFERENCIA, CO_MUNICIPIO)) AS SK_META_MUNICIPIO
  FROM (SELECT cast(ANO AS int) AS ANO_REFERENCIA, cast(CO_UF AS int) AS CO_UF, upper(trim(SG_UF)) AS SG_UF, cast(CO_MUNICIPIO AS int) AS CO_MUNICIPIO,
    {_title('NO_MUNICIPIO')} AS NO_MUNICIPIO, {_title('NO_TP_REDE')} AS NO_TP_REDE, cast(CO_NIVEL_ALFABETIZACAO AS int) AS CO_NIVEL_ALFABETIZACAO,
    {_GOAL_NUMBERS} FROM sheet_municipio WHERE CO_MUNICIPIO IS NOT NULL) m),
latest_mun AS (SELECT * FROM s_metas_municipio QUALIFY row_number() OVER (PARTITION BY CO_MUNICIPIO ORDER BY ANO_REFERENCIA DESC) = 1),
latest_uf AS (SELECT * FROM s_metas_uf QUALIFY row_number() OVER (PARTITION BY SIGLA_UF ORDER BY ANO_REFERENCIA DESC) = 1),
latest_br AS (SELECT * FROM s_metas_br ORDER BY ANO_REFERENCIA DESC LIMIT 1),
externa AS (SELECT i.CO_MUNICIPIO, i.RENDA_PER_CAPITA_MEDIA, round_even(x.idx, 6) AS MEDIA_INSE,
    g.QT_FAMILIAS_POBREZA_FAIXA_PBF / nullif(g.QT_FAMILIAS_POBREZA_FAIXA_PBF + g.QT_FAMILIAS_ATE_MEIO_SM + g.QT_FAMILIAS_ACIMA_MEIO_SM, 0) * 100 AS PC_FAMILIAS_POBREZA,
    c.lib AS PC_ESCOLAS_BIBLIOTECA, c.lab AS PC_ESCOLAS_LAB_INFORMATICA, c.net AS PC_ESCOLAS_INTERNET_ALUNOS
  FROM ext_income i LEFT JOIN (SELECT CO_MUNICIPIO, avg(MEDIA_INSE) AS idx FROM ext_index GROUP BY 1) x USING (CO_MUNICIPIO)
  LEFT JOIN ext_register g ON i.CO_MUNICIPIO // 10 = g.CO_MUNICIPIO
  LEFT JOIN (SELECT CO_MUNICIPIO, avg(IN_BIBLIOTECA) AS lib, avg(IN_LABORATORIO_INFORMATICA) AS lab, avg(IN_INTERNET_ALUNOS) AS net
    FROM ext_census WHERE TP_SITUACAO_FUNCIONAMENTO = 1 GROUP BY 1) c USING (CO_MUNICIPIO))"""

_STAMPS = ["DT_PROCESSAMENTO", "TS_PROCESSAMENTO"]


def _silver(name, table, sql_name, drop=()):
    @query(name, duck(f"SELECT * FROM {sql_name}", _SILVER))
    def run(spark, sf):
        return silver_frame(spark, sf, table).drop(*_STAMPS, *drop)

    return run


_silver("silver_pupils", "TS_ALUNO", "s_aluno")
_silver("silver_municipalities", "TS_MUNICIPIO", "s_municipio")
_silver("silver_states", "TS_ESTADO", "s_estado")
_silver("silver_national_goals", "METAS_BR", "s_metas_br", ["ANO", "SIGLA_UF", "CD_UF"])
_silver("silver_state_goals", "METAS_UF", "s_metas_uf", ["ANO", "CD_UF"])
_silver("silver_municipality_goals", "METAS_MUNICIPIO", "s_metas_municipio", ["ANO"])


@query(
    "silver_checks",
    duck(
        """
SELECT 'primary_key(SK_ALUNO)' AS check, 'TS_ALUNO' AS table, cast(count(*) - count(DISTINCT SK_ALUNO) AS bigint) AS n_bad FROM s_aluno
UNION ALL SELECT unnest(['not_null(SK_ALUNO)', 'not_null(ANO_REFERENCIA)', 'years(ANO_REFERENCIA)']), 'TS_ALUNO', 0
UNION ALL SELECT unnest(['primary_key(SK_MUNICIPIO)', 'not_null(SK_MUNICIPIO)', 'not_null(ANO_REFERENCIA)', 'years(ANO_REFERENCIA)']), 'TS_MUNICIPIO', 0
UNION ALL SELECT unnest(['primary_key(SK_ESTADO)', 'not_null(SK_ESTADO)', 'not_null(ANO_REFERENCIA)', 'years(ANO_REFERENCIA)']), 'TS_ESTADO', 0
UNION ALL SELECT 'not_null(ANO_REFERENCIA)', 'METAS_BR', 0
UNION ALL SELECT 'primary_key(ANO_REFERENCIA,SIGLA_UF)', 'METAS_UF', 0
UNION ALL SELECT 'primary_key(ANO_REFERENCIA,CO_MUNICIPIO)', 'METAS_MUNICIPIO', 0""",
        _SILVER,
    ),
)
def silver_checks(spark, sf):
    return silver_plan.checks(silver_frames(spark, sf))


@query(
    "ft_machine_learning",
    duck(
        """
SELECT a.*, m.PC_ALUNO_ALFABETIZADO, m.VL_MEDIA_LP, m.FAIXA_ALFABETIZACAO, m.FAIXA_MEDIA_LP,
  e.PC_ALUNO_ALFABETIZADO AS PC_ALUNO_ALFABETIZADO_ESTADO, e.VL_MEDIA_LP AS VL_MEDIA_LP_ESTADO,
  round_even(a.VL_PROFICIENCIA_LP - m.VL_MEDIA_LP, 2) AS DIF_MEDIA_MUNICIPIO, round_even(a.VL_PROFICIENCIA_LP - e.VL_MEDIA_LP, 2) AS DIF_MEDIA_ESTADO,
  coalesce(a.VL_PROFICIENCIA_LP >= m.VL_MEDIA_LP, false)::int AS IN_ACIMA_MEDIA_MUNICIPIO,
  coalesce(a.VL_PROFICIENCIA_LP >= e.VL_MEDIA_LP, false)::int AS IN_ACIMA_MEDIA_ESTADO,
  round_even(e.PC_ALUNO_ALFABETIZADO - m.PC_ALUNO_ALFABETIZADO, 2) AS DIF_ALFABETIZACAO_MUNICIPIO,
  CASE WHEN round_even(a.VL_PROFICIENCIA_LP - e.VL_MEDIA_LP, 2) >= 30 THEN 'Muito Acima' WHEN round_even(a.VL_PROFICIENCIA_LP - e.VL_MEDIA_LP, 2) >= 10 THEN 'Acima'
    WHEN round_even(a.VL_PROFICIENCIA_LP - e.VL_MEDIA_LP, 2) >= -10 THEN 'Na Média' WHEN round_even(a.VL_PROFICIENCIA_LP - e.VL_MEDIA_LP, 2) >= -30 THEN 'Abaixo'
    WHEN a.VL_PROFICIENCIA_LP - e.VL_MEDIA_LP IS NOT NULL THEN 'Muito Abaixo' END AS DESEMPENHO_RELATIVO,
  a.IN_ALFABETIZADO AS TARGET, a.IN_PARTICIPOU_AVALIACAO AS IN_PROVA_VALIDA, (a.VL_PROFICIENCIA_LP IS NOT NULL)::int AS IN_POSSUI_PROFICIENCIA,
  x.RENDA_PER_CAPITA_MEDIA, x.MEDIA_INSE, x.PC_FAMILIAS_POBREZA, x.PC_ESCOLAS_BIBLIOTECA, x.PC_ESCOLAS_LAB_INFORMATICA, x.PC_ESCOLAS_INTERNET_ALUNOS
FROM s_aluno a
LEFT JOIN s_municipio m ON a.ANO_REFERENCIA = m.ANO_REFERENCIA AND a.CO_MUNICIPIO = m.CO_MUNICIPIO AND a.TP_DEPENDENCIA = m.ID_TIPO_REDE
LEFT JOIN s_estado e ON a.ANO_REFERENCIA = e.ANO_REFERENCIA AND a.CO_UF = e.CO_UF AND a.TP_DEPENDENCIA = e.ID_TIPO_REDE
LEFT JOIN externa x ON a.CO_MUNICIPIO = x.CO_MUNICIPIO""",
        _SILVER,
    ),
)
def ft_machine_learning(spark, sf):
    fact = gold_frame(spark, sf, "FT_MACHINE_LEARNING")
    return fact.withColumn("MEDIA_INSE", fn.round_half_even("MEDIA_INSE", 6)).drop(*_STAMPS)


def _wide(alias: str, prefix: str) -> str:
    return ", ".join(f"{alias}.META_FINAL_{y} AS {prefix}_{y}" for y in GOAL_YEARS)


def _own_year(prefix: str) -> str:
    return "CASE ANO_REFERENCIA " + " ".join(f"WHEN {y} THEN {prefix}_{y}" for y in GOAL_YEARS) + " END"


_INDICATOR = f"""wide AS (SELECT m.*, {_wide('gm', 'META_MUNICIPIO')}, gu.SIGLA_UF, {_wide('gu', 'META_UF')}, {_wide('gb', 'META_BRASIL')},
    e.PC_ALUNO_ALFABETIZADO AS PC_ALUNO_ALFABETIZADO_ESTADO, e.VL_MEDIA_LP AS VL_MEDIA_LP_ESTADO
  FROM s_municipio m LEFT JOIN latest_mun gm ON m.CO_MUNICIPIO = gm.CO_MUNICIPIO LEFT JOIN latest_uf gu ON m.SG_UF = gu.SIGLA_UF
  CROSS JOIN latest_br gb
  LEFT JOIN s_estado e ON m.ANO_REFERENCIA = e.ANO_REFERENCIA AND m.CO_UF = e.CO_UF AND m.ID_TIPO_REDE = e.ID_TIPO_REDE
  WHERE m.ID_TIPO_REDE NOT IN (0, 5)),
goal AS (SELECT *, {_own_year('META_MUNICIPIO')} AS META_ALFABETIZACAO_MUNICIPIO, {_own_year('META_UF')} AS META_ALFABETIZACAO_UF,
    {_own_year('META_BRASIL')} AS META_ALFABETIZACAO_BRASIL FROM wide),
gaps AS (SELECT *, round_even(PC_ALUNO_ALFABETIZADO - META_ALFABETIZACAO_MUNICIPIO, 2) AS DIF_META_ALFABETIZACAO_MUNICIPIO,
    round_even(PC_ALUNO_ALFABETIZADO - META_ALFABETIZACAO_UF, 2) AS DIF_META_ALFABETIZACAO_UF,
    round_even(PC_ALUNO_ALFABETIZADO - META_ALFABETIZACAO_BRASIL, 2) AS DIF_META_ALFABETIZACAO_BRASIL,
    CASE WHEN PC_ALUNO_ALFABETIZADO >= 80 THEN 5 WHEN PC_ALUNO_ALFABETIZADO >= 70 THEN 4 WHEN PC_ALUNO_ALFABETIZADO >= 60 THEN 3
      WHEN PC_ALUNO_ALFABETIZADO >= 50 THEN 2 WHEN PC_ALUNO_ALFABETIZADO >= 40 THEN 1 ELSE 0 END::int AS ORDEM_CLASSIFICACAO,
    round_even(PC_ALUNO_ALFABETIZADO - PC_ALUNO_ALFABETIZADO_ESTADO, 2) AS DIF_ALFABETIZACAO_ESTADO,
    round_even(VL_MEDIA_LP - VL_MEDIA_LP_ESTADO, 2) AS DIF_MEDIA_LP_ESTADO,
    round_even(PC_ALUNO_ALFABETIZADO - lag(PC_ALUNO_ALFABETIZADO) OVER w, 2) AS VARIACAO_ALFABETIZACAO,
    round_even(VL_MEDIA_LP - lag(VL_MEDIA_LP) OVER w, 2) AS VARIACAO_MEDIA_LP
  FROM goal WINDOW w AS (PARTITION BY CO_MUNICIPIO, ID_TIPO_REDE ORDER BY ANO_REFERENCIA))"""


@query(
    "ft_indicador_municipio",
    duck(
        """
SELECT *, CASE WHEN DIF_META_ALFABETIZACAO_MUNICIPIO >= 0 THEN 'Sim' ELSE 'Não' END AS ATINGIU_META_MUNICIPIO,
  CASE WHEN DIF_META_ALFABETIZACAO_UF >= 0 THEN 'Sim' ELSE 'Não' END AS ATINGIU_META_UF,
  CASE WHEN DIF_META_ALFABETIZACAO_BRASIL >= 0 THEN 'Sim' ELSE 'Não' END AS ATINGIU_META_BRASIL,
  CASE WHEN ORDEM_CLASSIFICACAO = 0 THEN 'Abaixo do Nível 1' ELSE 'Nível ' || cast(ORDEM_CLASSIFICACAO AS varchar) END AS CLASSIFICACAO,
  CASE WHEN DIF_MEDIA_LP_ESTADO >= 0 THEN 'Sim' ELSE 'Não' END AS ACIMA_MEDIA_ESTADO,
  CASE WHEN VARIACAO_ALFABETIZACAO > 0 THEN 'Melhorou' WHEN VARIACAO_ALFABETIZACAO < 0 THEN 'Piorou' WHEN VARIACAO_ALFABETIZACAO = 0 THEN 'Estável' END AS TENDENCIA
FROM gaps""",
        _SILVER + ",\n" + _INDICATOR,
    ),
)
def ft_indicador_municipio(spark, sf):
    return gold_frame(spark, sf, "FT_INDICADOR_MUNICIPIO").drop(*_STAMPS)


@query(
    "meta_vs_resultado",
    duck(
        f"""
SELECT *, (coalesce(DIF_META_ALFABETIZACAO >= 0, false))::int AS IN_META_ATINGIDA, (coalesce(DISTANCIA_META_2030 >= 0, false))::int AS IN_META_2030_ATINGIDA
FROM (SELECT *, round_even(PC_ALUNO_ALFABETIZADO - coalesce(META_ANO_AVALIACAO, 80), 2) AS DIF_META_ALFABETIZACAO,
    round_even(PC_ALUNO_ALFABETIZADO - coalesce(META_FINAL_2030, 80), 2) AS DISTANCIA_META_2030
  FROM (SELECT *, {_own_year('META_FINAL')} AS META_ANO_AVALIACAO FROM (
    SELECT m.*, {_wide('g', 'META_FINAL')} FROM s_municipio m LEFT JOIN latest_mun g ON m.CO_MUNICIPIO = g.CO_MUNICIPIO WHERE m.ID_TIPO_REDE = 3) a) b) c""",
        _SILVER,
    ),
)
def meta_vs_resultado(spark, sf):
    return gold_frame(spark, sf, "FT_INDICADOR_MUNICIPIO_META_VS_RESULTADO").drop(*_STAMPS)


_N = [f"PC_ALUNO_NIVEL_{i}_LP" for i in range(9)]


@query(
    "analise_niveis",
    duck(
        f"""
SELECT *, round_even(PC_TAXA_EXCELENCIA / (PC_PERFIL_EXTREMA_DEFASAGEM + 0.01::double), 2) AS INDICE_POLARIZACAO,
  CASE WHEN PC_PERFIL_EXTREMA_DEFASAGEM + PC_PERFIL_EM_DESENVOLVIMENTO = 0 THEN 0
    ELSE round_even(({_N[0]} * 4 + {_N[1]} * 3 + {_N[2]} * 2 + {_N[3]}) / 400, 4) END::double AS INDICE_RISCO_ESTRUTURAL
FROM (SELECT *, round_even({_N[0]} + {_N[1]}, 2) AS PC_PERFIL_EXTREMA_DEFASAGEM, round_even({_N[2]} + {_N[3]}, 2) AS PC_PERFIL_EM_DESENVOLVIMENTO,
    round_even({_N[4]} + {_N[1]}, 2) AS PC_PERFIL_LIMITROFE, round_even({_N[5]} + {_N[6]}, 2) AS PC_PERFIL_AVANCADO,
    round_even({_N[7]} + {_N[8]}, 2) AS PC_TAXA_EXCELENCIA FROM s_municipio WHERE ID_TIPO_REDE = 3) t""",
        _SILVER,
    ),
)
def analise_niveis(spark, sf):
    return gold_frame(spark, sf, "ANALISE_NIVEIS_MUNICIPIO").drop(*_STAMPS)


_META = f"""meta AS (SELECT *, (coalesce(DIF_META_ALFABETIZACAO >= 0, false))::int AS IN_META_ATINGIDA FROM (
  SELECT *, round_even(PC_ALUNO_ALFABETIZADO - coalesce(META_ANO_AVALIACAO, 80), 2) AS DIF_META_ALFABETIZACAO,
    round_even(PC_ALUNO_ALFABETIZADO - coalesce(META_FINAL_2030, 80), 2) AS DISTANCIA_META_2030
  FROM (SELECT *, {_own_year('META_FINAL')} AS META_ANO_AVALIACAO FROM (
    SELECT m.*, {_wide('g', 'META_FINAL')} FROM s_municipio m LEFT JOIN latest_mun g ON m.CO_MUNICIPIO = g.CO_MUNICIPIO WHERE m.ID_TIPO_REDE = 3) a) b) c)"""
_EXTERNAL = "x.RENDA_PER_CAPITA_MEDIA, x.MEDIA_INSE, x.PC_FAMILIAS_POBREZA, x.PC_ESCOLAS_BIBLIOTECA, x.PC_ESCOLAS_LAB_INFORMATICA, x.PC_ESCOLAS_INTERNET_ALUNOS"


def _meta_and_external(spark, sf):
    """The goals table, stored because the lagged dataset reads it twice, and the external dimension."""
    external = external_frame(spark, sf).withColumn("MEDIA_INSE", fn.round_half_even("MEDIA_INSE", 6))
    return cut_lineage(gold_frame(spark, sf, "FT_INDICADOR_MUNICIPIO_META_VS_RESULTADO")), external


@query(
    "lag_dataset",
    duck(
        f"""
SELECT a.ANO_REFERENCIA, a.CO_MUNICIPIO, a.SG_UF, a.REGIAO, a.PC_ALUNO_ALFABETIZADO, a.DIF_META_ALFABETIZACAO, a.IN_META_ATINGIDA,
  b.PC_ALUNO_ALFABETIZADO AS PC_ALUNO_ALFABETIZADO_ANTERIOR, b.DIF_META_ALFABETIZACAO AS DIF_META_ALFABETIZACAO_ANTERIOR,
  b.IN_META_ATINGIDA AS IN_META_ATINGIDA_ANTERIOR, {_EXTERNAL}
FROM meta a JOIN meta b ON a.CO_MUNICIPIO = b.CO_MUNICIPIO AND a.ANO_REFERENCIA = b.ANO_REFERENCIA + 1
LEFT JOIN externa x ON a.CO_MUNICIPIO = x.CO_MUNICIPIO""",
        _SILVER + ",\n" + _META,
    ),
)
def lag_dataset(spark, sf):
    return municipal.lag_dataset(*_meta_and_external(spark, sf))


@query(
    "profile_table",
    duck(
        f"""
SELECT * FROM (SELECT a.CO_MUNICIPIO, a.NO_MUNICIPIO, a.SG_UF, a.REGIAO, a.PC_ALUNO_ALFABETIZADO, a.DISTANCIA_META_2030, {_EXTERNAL}
  FROM meta a LEFT JOIN externa x ON a.CO_MUNICIPIO = x.CO_MUNICIPIO WHERE a.ANO_REFERENCIA = 2025) t
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in PROFILE_FEATURES)}""",
        _SILVER + ",\n" + _META,
    ),
)
def profile_table(spark, sf):
    return clustering.profile_table(*_meta_and_external(spark, sf), 2025)


@query(
    "mode_fill",
    duck(
        "SELECT column_name, value FROM (SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) AS rn FROM long GROUP BY column_name, value) t WHERE rn = 1",
        """long AS (SELECT 'uf' AS column_name, uf AS value FROM pupil UNION ALL
  SELECT 'dep', CASE WHEN NOT incompleto THEN cast(dep AS varchar) END FROM pupil WHERE NOT incompleto)""",
    ),
)
def mode_fill(spark, sf):
    p = relation(spark, sf, "pupil").withColumn("dep", F.when(~F.col("incompleto"), F.col("dep")))
    return mode_table(p, ["uf", "dep"])


@query(
    "table_profile_target",
    duck("SELECT target, count(*) AS n, count(*) / (SELECT count(*) FROM pupil) AS share FROM pupil GROUP BY 1"),
)
def table_profile_target(spark, sf):
    p = relation(spark, sf, "pupil").select("pupil_key", "ano", "target", "score")
    return table_profile(p, "ano", "target", ["pupil_key"])["target"]
