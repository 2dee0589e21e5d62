"""Assessment-shaped inputs derived from the star-schema tables.

The tables stand in for the yearly files: a line item is a pupil, a customer a municipality, a
nation a state, an order a school. The derivation is one SQL text for both engines (only a few
function names differ), so both sides of a comparison start from the same raw rows; everything
after the raw rows is computed independently. Everything is derived from the whole tables.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edugauge.functions.dictionaries import GOAL_YEARS, STATE_CODES, STATE_REGIONS
from edugauge.plans import bronze, gold, silver
from edugauge.session import compile_wide_projections, cut_lineage
from edugauge.sources import spread

SPARK = {"explode": "explode", "array": "array", "elem": "element_at", "idiv": "div"}
DUCK = {"explode": "unnest", "array": "list_value", "elem": "list_extract", "idiv": "//"}

PROCESSED_AT = datetime(2025, 12, 1, 10, 30)
NBSP = " "
_STATES = list(STATE_CODES)[:25]
_UFS = ", ".join(f"'{s}'" for s in _STATES)
_CODES = ", ".join(str(STATE_CODES[s]) for s in _STATES)


def _dec2(hundredths: str) -> str:
    """Text with two decimals of a whole number of hundredths; null stays null."""
    return f"(cast(({hundredths}) $idiv 100 as string) || '.' || lpad(cast(({hundredths}) % 100 as string), 2, '0'))"


def _goal(points: str, missing: str) -> str:
    return f"CASE WHEN {missing} THEN ' - ' WHEN {points} > 80 THEN '> 80' ELSE cast({points} as string) || '.5' END"


_LEVEL_COUNTS = ",\n    ".join(
    f"sum(CASE WHEN avaliado AND nivel = {i} THEN 1 ELSE 0 END) AS n{i}" for i in range(9)
)


def _measures(hide: str) -> str:
    rate = "hits * 10000 $idiv total"
    mean = "soma $idiv nullif(avaliados, 0)"
    levels = ", ".join(
        f"CASE WHEN NOT ({hide} % 17 = 0) THEN {_dec2(f'n{i} * 10000 $idiv nullif(avaliados, 0)')} END AS PC_ALUNO_NIVEL_{i}_LP"
        for i in range(9)
    )
    return (
        f"CASE WHEN NOT ({hide} % 19 = 0) THEN {_dec2(rate)} ELSE 'x' END AS PC_ALUNO_ALFABETIZADO, "
        f"{_dec2(mean)} AS VL_MEDIA_LP, {levels}"
    )


_AGGREGATES = f"""count(*) AS total, sum(CASE WHEN avaliado THEN 1 ELSE 0 END) AS avaliados,
    sum(CASE WHEN avaliado AND cents >= 74300 THEN 1 ELSE 0 END) AS hits,
    sum(CASE WHEN avaliado THEN cents ELSE 0 END) AS soma,
    {_LEVEL_COUNTS}"""

_CTES: dict[str, str] = {
    "pupil_base": f"""
  SELECT 2023 + (year(o.o_orderdate) - 1995) % 3 AS ano,
    $elem($array({_UFS}), n.n_nationkey + 1) AS uf,
    $elem($array({_CODES}), n.n_nationkey + 1) AS couf,
    n.n_nationkey AS nk, c.c_custkey AS ck, c.c_name, c.c_mktsegment,
    (100000 + c.c_custkey) * 10 + c.c_custkey % 10 AS mun,
    l.l_orderkey * 10 + l.l_linenumber AS id_aluno, l.l_suppkey AS escola, l.l_partkey AS partkey,
    $elem($array(1, 2, 3, 3, 3, 2, 4), l.l_linenumber) AS dep,
    (l.l_partkey % 97 = 0) AS incompleto,
    CASE WHEN l.l_suppkey % 50 = 0 THEN 3 ELSE 2 END AS serie,
    (l.l_tax > 0.065) AS ausente, (l.l_discount > 0.095) AS rasurado,
    NOT (l.l_tax > 0.065) AND NOT (l.l_discount > 0.095) AS avaliado,
    60000 + cast(round(l.l_extendedprice * 100) as bigint) % 25000 AS cents,
    cast(l.l_quantity as bigint) * 625 AS peso
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "pupil": """
  SELECT ano, uf, couf, nk, ck, mun, id_aluno, escola, serie, dep, incompleto, avaliado,
    CASE WHEN avaliado THEN cents / cast(100 as double) END AS score,
    CASE WHEN avaliado THEN peso / cast(10000 as double) END AS weight,
    CASE WHEN avaliado AND cents >= 74300 THEN 1 ELSE 0 END AS target,
    cast(id_aluno as string) || '-' || cast(partkey as string) || '-' || cast(escola as string) AS pupil_key
  FROM pupil_base""",
    "scored": """
  SELECT pupil_key, uf, dep, ano, target AS label, (cents_mix % 1000) / cast(1000 as double) AS score,
    CASE WHEN cents_mix % 1000 >= 500 THEN 1 ELSE 0 END AS prediction, coalesce(weight, 1) AS weight
  FROM (SELECT p.*, (ck * 37 + escola * 11 + dep * 101 + target * 173) AS cents_mix FROM pupil p) s""",
    "raw_aluno": f"""
  SELECT cast(ano as string) AS NU_ANO_AVALIACAO, cast(couf as string) AS CO_UF,
    ' ' || lower(uf) || ' ' AS SG_UF, cast(id_aluno as string) AS ID_ALUNO, cast(serie as string) AS TP_SERIE,
    CASE WHEN NOT incompleto THEN cast(escola as string) END AS ID_ESCOLA,
    CASE WHEN NOT incompleto THEN cast(dep as string) END AS TP_DEPENDENCIA,
    CASE WHEN NOT incompleto THEN cast(mun as string) END AS CO_MUNICIPIO,
    ' ' || c_mktsegment || '-d''ÁGUA DO ' || c_name || '{NBSP}' AS NO_MUNICIPIO,
    CASE WHEN ausente THEN '0' ELSE '1' END AS IN_PRESENCA_LP,
    CASE WHEN rasurado THEN 'x' ELSE '1' END AS IN_PREENCHIMENTO_LP,
    CASE WHEN avaliado THEN cast(peso $idiv 10000 as string) || '.' || lpad(cast(peso % 10000 as string), 4, '0') END AS VL_PESO_ALUNO_LP,
    CASE WHEN avaliado THEN {_dec2('cents')} ELSE '' END AS VL_PROFICIENCIA_LP,
    CASE WHEN avaliado AND cents >= 74300 THEN '1' ELSE '0' END AS IN_ALFABETIZADO
  FROM pupil_base""",
    "network_rows": """
  SELECT ano, uf, couf, nk, ck, mun, c_name, avaliado, cents, least((cents - 60000) $idiv 2800, 8) AS nivel,
    $explode(CASE WHEN dep IN (2, 3) THEN $array(dep, 0, 5) ELSE $array(dep, 0) END) AS rede
  FROM pupil_base WHERE NOT incompleto AND dep <> 1""",
    "municipio_groups": f"""
  SELECT ano, uf, couf, ck, mun, c_name, rede, {_AGGREGATES}
  FROM network_rows GROUP BY ano, uf, couf, ck, mun, c_name, rede""",
    "raw_municipio": f"""
  SELECT cast(ano as string) AS NU_ANO_AVALIACAO, cast(couf as string) AS CO_UF, lower(uf) || ' ' AS SG_UF,
    cast(mun as string) AS CO_MUNICIPIO, upper(c_name) || ' ' AS NO_MUNICIPIO, '2' AS TP_SERIE,
    cast(rede as string) AS ID_TIPO_REDE, {_measures('ck')}, ordem
  FROM (SELECT *, $explode(CASE WHEN ck % 40 = 0 THEN $array(1, 2) ELSE $array(1) END) AS ordem FROM municipio_groups) g""",
    "estado_groups": f"""
  SELECT ano, uf, couf, nk, rede, {_AGGREGATES}
  FROM network_rows GROUP BY ano, uf, couf, nk, rede""",
    "raw_estado": f"""
  SELECT cast(ano as string) AS NU_ANO_AVALIACAO, cast(couf as string) AS CO_UF, lower(uf) AS SG_UF,
    '2' AS TP_SERIE, cast(rede as string) AS ID_TIPO_REDE, {_measures('(nk + 1)')}, 1 AS ordem
  FROM estado_groups""",
    "sheet_uf": "\n  UNION ALL\n".join(
        f"""
  SELECT cast(ANO as string) AS ANO, {name} AS NOME_UF, {code} AS SIGLA_UF, {number} AS CD_UF, ' pública' AS REDE,
    '55.3' AS PC_ALUNO_ALFABETIZADO_2023, '-' AS PC_ALUNO_ALFABETIZADO_2024, '' AS PC_ALUNO_ALFABETIZADO_2025,
    '91.2' AS PC_AVALIADOS_LP,
    {', '.join(f"{_goal(f'({base} + ANO - 2024 + {4 * (y - 2024)})', f'nk % 9 = 8 AND {y} < 2026')} AS META_FINAL_{y}" for y in GOAL_YEARS)}
  FROM (SELECT n_nationkey AS nk, n_name, $elem($array({_UFS}), n_nationkey + 1) AS uf,
    $elem($array({_CODES}), n_nationkey + 1) AS couf, $explode($array(2024, 2025)) AS ANO FROM nation) s {where}"""
        for name, code, number, base, where in [
            ("n_name", "' ' || lower(uf)", "cast(couf as string)", "45 + nk", ""),
            ("'Brasil'", "cast(NULL as string)", "cast(NULL as string)", "60", "WHERE nk = 0"),
        ]
    ),
    "sheet_municipio": f"""
  SELECT cast(ANO as string) AS ANO, cast(couf as string) AS CO_UF, lower(uf) AS SG_UF,
    CASE WHEN ck % 101 = 50 THEN cast(NULL as string) ELSE cast(mun as string) END AS CO_MUNICIPIO,
    lower(c_name) AS NO_MUNICIPIO, ' municipal' AS NO_TP_REDE, cast(ck % 6 as string) AS CO_NIVEL_ALFABETIZACAO,
    '55.3' AS PC_ALUNO_ALFABETIZADO_2023, ' - ' AS PC_ALUNO_ALFABETIZADO_2024, '' AS PC_ALUNO_ALFABETIZADO_2025,
    '>80' AS PC_AVALIADOS_LP,
    {', '.join(f"{_goal(f'(40 + ck % 40 + ANO - 2024 + {3 * (y - 2024)})', f'(ck + {y}) % 7 = 0')} AS META_FINAL_{y}" for y in GOAL_YEARS)}
  FROM (SELECT c_custkey AS ck, c_name, (100000 + c_custkey) * 10 + c_custkey % 10 AS mun,
    $elem($array({_UFS}), c_nationkey + 1) AS uf, $elem($array({_CODES}), c_nationkey + 1) AS couf,
    $explode($array(2024, 2025)) AS ANO FROM customer) s WHERE ck % 11 <> 0""",
    "ext_income": """
  SELECT (100000 + c_custkey) * 10 + c_custkey % 10 AS CO_MUNICIPIO, c_acctbal AS RENDA_PER_CAPITA_MEDIA
  FROM customer WHERE c_custkey % 13 <> 0""",
    "ext_index": """
  SELECT (100000 + o_custkey) * 10 + o_custkey % 10 AS CO_MUNICIPIO,
    CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice / 100000 END AS MEDIA_INSE FROM orders""",
    "ext_register": """
  SELECT 100000 + c_custkey AS CO_MUNICIPIO,
    sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS QT_FAMILIAS_POBREZA_FAIXA_PBF,
    sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS QT_FAMILIAS_ATE_MEIO_SM,
    sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS QT_FAMILIAS_ACIMA_MEIO_SM
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
    "ext_census": """
  SELECT (100000 + o_custkey) * 10 + o_custkey % 10 AS CO_MUNICIPIO,
    CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS TP_SITUACAO_FUNCIONAMENTO,
    CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END AS IN_BIBLIOTECA,
    CASE WHEN o_orderpriority LIKE '2%' THEN 1 WHEN o_orderpriority LIKE '5%' THEN NULL ELSE 0 END AS IN_LABORATORIO_INFORMATICA,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS IN_INTERNET_ALUNOS FROM orders""",
}

#: Pupils that one task groups by municipality, about.
GROUP_ROWS = 1 << 19

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels")


def _needed(text: str) -> list[str]:
    """Names of the derivations that ``text`` uses, directly or through others."""
    seen: set[str] = set()
    open_texts = [text]
    while open_texts:
        current = open_texts.pop()
        for name, body in _CTES.items():
            if name not in seen and re.search(rf"\b{name}\b", current):
                seen.add(name)
                open_texts.append(body)
    return [name for name in _CTES if name in seen]


def ctes(dialect: dict[str, str], sql: str, extra: str = "", given: Sequence[str] = ()) -> str:
    """``sql`` with the derivations it needs in a WITH clause, but for those ``given`` as views."""
    parts = [f"{name} AS ({_CTES[name]})" for name in _needed(f"{sql}\n{extra}") if name not in given]
    text = Template(",\n".join(parts)).substitute(dialect)
    text = ",\n".join(part for part in (text, extra) if part)
    return f"WITH {text}\n{sql}"


_REGION_ROWS = ", ".join(f"('{state}', '{region}')" for state, region in STATE_REGIONS.items())


def duck(sql: str, extra: str = "") -> str:
    """DuckDB text that may name any stand-in relation, and ``regions(uf, regiao)``."""
    lookups = f"regions AS (SELECT * FROM (VALUES {_REGION_ROWS}) t(uf, regiao))"
    return ctes(DUCK, sql, lookups + (",\n" + extra if extra else ""))


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def relation(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One stand-in relation as a lazy Spark frame."""
    compile_wide_projections(spark)
    sql = f"SELECT * FROM {name}"
    text = ctes(SPARK, sql)
    for table in ("nation", "customer", "orders", "lineitem"):
        if re.search(rf"\b{table}\b", text):
            rows = read(spark, sf, table)
            (spread(rows) if table == "lineitem" else rows).createOrReplaceTempView(table)
    if "municipio_groups" in _needed(sql):
        _dealt_by_town(spark, sf).createOrReplaceTempView("pupil_base")
        text = ctes(SPARK, sql, given=["pupil_base"])
    return spark.sql(text)


def _dealt_by_town(spark: SparkSession, sf: str) -> DataFrame:
    """The pupils, dealt by municipality and year into as many parts as their number asks for.

    Pupils of a municipality are in no order, so a partial aggregate in front of the shuffle reduces next to nothing and holds
    a wide row for every network of every pupil of its task. Dealt first, one by one, a task holds its own groups only.
    """
    parts = max(spark.sparkContext.defaultParallelism, -(-read(spark, sf, "lineitem").count() // GROUP_ROWS))
    return spark.sql(ctes(SPARK, "SELECT * FROM pupil_base")).repartition(parts, "ck", "ano")


def silver_frame(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """One silver table through its bronze step."""
    at = F.lit(PROCESSED_AT)
    if table == "TS_ALUNO":
        return silver.pupils(bronze.pupils(relation(spark, sf, "raw_aluno"), at))
    if table == "TS_MUNICIPIO":
        return silver.municipalities(bronze.municipalities(relation(spark, sf, "raw_municipio"), "ordem", at))
    if table == "TS_ESTADO":
        return silver.states(bronze.states(relation(spark, sf, "raw_estado"), "ordem", at))
    if table == "METAS_BR":
        return silver.national_goals(bronze.national_goals(relation(spark, sf, "sheet_uf"), at))
    if table == "METAS_UF":
        return silver.state_goals(bronze.state_goals(relation(spark, sf, "sheet_uf"), at))
    if table == "METAS_MUNICIPIO":
        return silver.municipality_goals(bronze.municipality_goals(relation(spark, sf, "sheet_municipio"), at))
    raise KeyError(table)


SILVER_TABLES = ("TS_ALUNO", "TS_MUNICIPIO", "TS_ESTADO", "METAS_BR", "METAS_UF", "METAS_MUNICIPIO")


def silver_frames(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {table: silver_frame(spark, sf, table) for table in SILVER_TABLES}


def external_frame(spark: SparkSession, sf: str) -> DataFrame:
    return gold.external_dimension(
        *[relation(spark, sf, name) for name in ("ext_income", "ext_index", "ext_register", "ext_census")]
    )


def gold_frame(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """One gold table from the silver tables it needs."""

    def need(*tables: str) -> list[DataFrame]:
        return [silver_frame(spark, sf, t) for t in tables]

    if table == "FT_MACHINE_LEARNING":
        # A few rows for each state: as a stored table it is seen to be small, and the wide pupil rows are not shuffled for it.
        pupils, towns, states = need("TS_ALUNO", "TS_MUNICIPIO", "TS_ESTADO")
        return gold.pupil_fact(pupils, towns, cut_lineage(states), external_frame(spark, sf))
    if table == "FT_INDICADOR_MUNICIPIO":
        return gold.municipality_indicator(*need("TS_MUNICIPIO", "TS_ESTADO", "METAS_BR", "METAS_UF", "METAS_MUNICIPIO"))
    if table == "FT_INDICADOR_MUNICIPIO_META_VS_RESULTADO":
        return gold.goals_vs_results(*need("TS_MUNICIPIO", "METAS_MUNICIPIO"))
    if table == "ANALISE_NIVEIS_MUNICIPIO":
        return gold.level_analysis(*need("TS_MUNICIPIO"))
    raise KeyError(table)
