"""Column functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from edugauge import functions as fn
from edugauge.functions import dictionaries as d
from workloads.registry import query
from workloads.standin import NBSP, duck, read, relation

_DIRTY = """CASE WHEN c_custkey % 5 = 0 THEN ' - ' WHEN c_custkey % 5 = 1 THEN '> ' || cast(c_nationkey as string)
  WHEN c_custkey % 5 = 2 THEN '' WHEN c_custkey % 5 = 3 THEN ' ' || cast(c_custkey as string) || '.25 ' ELSE '1d' END"""


#: Whole numbers as exports write them, next to cells that are none.
_WHOLE = "CASE WHEN c_custkey % 3 = 0 THEN 'n/a' ELSE cast(c_custkey AS varchar(20)) || '.0' END"


@query(
    "coerce_clean",
    f"""
WITH t AS (SELECT c_custkey, {_DIRTY} AS dirty FROM customer),
s AS (SELECT *, nullif(trim(dirty), '-') AS cell FROM t)
SELECT c_custkey,
  try_cast(trim(dirty) AS double) AS number,
  try_cast({_WHOLE} AS double)::bigint AS whole,
  try_cast(trim(replace(cell, '>', '')) AS double) AS goal,
  cast(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey * 2 END AS bigint) AS nullable,
  cast(c_custkey AS int) AS strict
FROM s""",
)
def coerce_clean(spark, sf):
    rows = read(spark, sf, "customer").withColumn("dirty", F.expr(_DIRTY))
    doubled = F.when(F.col("c_custkey") % 7 != 0, (F.col("c_custkey") * 2).cast("string"))
    return rows.select(
        "c_custkey",
        fn.tolerant_double("dirty").alias("number"),
        fn.tolerant_int(F.expr(_WHOLE)).alias("whole"),
        fn.clean_goal("dirty").alias("goal"),
        fn.nullable_int(doubled).alias("nullable"),
        fn.strict_int(F.col("c_custkey").cast("string"), name="c_custkey").alias("strict"),
    )


_NAME = f"'{NBSP} ' || upper(c_name) || '-d''ÁGUA ' || lower(c_mktsegment) || ' {NBSP}'"
_STRIPPED = r"regexp_replace(name, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g')"


@query(
    "title_trim_keys",
    f"""
WITH t AS (SELECT c_custkey, c_nationkey, {_NAME} AS name FROM customer),
s AS (SELECT *, {_STRIPPED} AS clean FROM t)
SELECT c_custkey, clean,
  list_aggregate(list_transform(regexp_extract_all(lower(clean), '(\\p{{L}}+|[^\\p{{L}}]+)'),
    lambda x: upper(x[1]) || x[2:]), 'string_agg', '') AS title,
  upper(clean) AS code,
  concat_ws('|', c_nationkey, c_custkey) AS plain_key,
  sha256(concat_ws('|', c_nationkey, c_custkey)) AS hash_key,
  CASE WHEN length(cast(c_custkey AS varchar)) >= 7 THEN cast(c_custkey AS varchar) ELSE lpad(cast(c_custkey AS varchar), 7, '0') END AS padded,
  CASE WHEN c_custkey % 9 <> 0 THEN clean || ' - ' || cast(c_nationkey AS varchar) END AS labelled
FROM s""",
)
def title_trim_keys(spark, sf):
    clean = fn.strip(F.expr(_NAME))
    code = F.col("c_nationkey").cast("string")
    rows = read(spark, sf, "customer").withColumn("clean", clean)
    return rows.select(
        "c_custkey",
        "clean",
        fn.title_case("clean").alias("title"),
        F.upper("clean").alias("code"),
        fn.concat_key("c_nationkey", "c_custkey").alias("plain_key"),
        fn.sha256_key("c_nationkey", "c_custkey").alias("hash_key"),
        fn.zero_padded("c_custkey", 7).alias("padded"),
        fn.joined_label(F.when(F.col("c_custkey") % 9 != 0, F.col("clean")), code).alias("labelled"),
    )


@query(
    "code_lookup",
    duck("""
SELECT p.pupil_key, p.uf, r.regiao,
  CASE p.dep WHEN 1 THEN 'Federal' WHEN 2 THEN 'Estadual' WHEN 3 THEN 'Municipal' WHEN 4 THEN 'Privada' END AS dependency,
  CASE p.dep WHEN 2 THEN 'Estadual' WHEN 3 THEN 'Municipal' WHEN 4 THEN 'Privada' END AS network,
  CASE WHEN p.serie = 2 THEN '2º Ano do Ensino Fundamental' ELSE cast(p.serie AS varchar) END AS grade,
  CASE p.target WHEN 1 THEN 'Sim' WHEN 0 THEN 'Não' END AS literate, p.couf AS state_code
FROM pupil p LEFT JOIN regions r ON p.uf = r.uf"""),
)
def code_lookup(spark, sf):
    p = relation(spark, sf, "pupil")
    return p.select(
        "pupil_key",
        "uf",
        fn.lookup(d.STATE_REGIONS, "uf").alias("regiao"),
        fn.lookup(d.DEPENDENCY_NAMES, "dep").alias("dependency"),
        fn.lookup(d.NETWORK_NAMES, "dep").alias("network"),
        fn.lookup(d.GRADE_NAMES, "serie", fallback=F.col("serie").cast("string")).alias("grade"),
        fn.lookup(d.YES_NO_NAMES, "target").alias("literate"),
        fn.lookup(d.STATE_CODES, "uf").alias("state_code"),
    )


@query(
    "bands",
    duck("""
SELECT pupil_key, score,
  CASE WHEN score IS NULL THEN 'Não avaliado' WHEN score <= 649.99 THEN '< 650' WHEN score <= 699.99 THEN '650-699'
    WHEN score <= 742.99 THEN '700-742' WHEN score <= 799.99 THEN '743-799' ELSE '800+' END AS score_band,
  CASE WHEN score <= 699.99 THEN '< 700' WHEN score <= 742.99 THEN '700-742' WHEN score <= 799.99 THEN '743-799'
    WHEN score > 799.99 THEN '800+' END AS mean_band,
  CASE WHEN pct <= 39.99 THEN 'Muito Baixa' WHEN pct <= 59.99 THEN 'Baixa' WHEN pct <= 79.99 THEN 'Boa'
    WHEN pct > 79.99 THEN 'Excelente' END AS literacy_band,
  CASE WHEN pct >= 80 THEN 'Nível 5' WHEN pct >= 70 THEN 'Nível 4' WHEN pct >= 60 THEN 'Nível 3'
    WHEN pct >= 50 THEN 'Nível 2' WHEN pct >= 40 THEN 'Nível 1' ELSE 'Abaixo do Nível 1' END AS level,
  CASE WHEN diff >= 30 THEN 'Muito Acima' WHEN diff >= 10 THEN 'Acima' WHEN diff >= -10 THEN 'Na Média'
    WHEN diff >= -30 THEN 'Abaixo' WHEN diff < -30 THEN 'Muito Abaixo' END AS relative,
  CASE WHEN diff >= 0 THEN 'Sim' ELSE 'Não' END AS reached
FROM (SELECT pupil_key, score, (score - 600) / 2.5 AS pct, score - 720 AS diff FROM pupil) s"""),
)
def bands(spark, sf):
    p = relation(spark, sf, "pupil")
    pct, diff = (F.col("score") - 600) / 2.5, F.col("score") - 720
    return p.select(
        "pupil_key",
        "score",
        fn.right_closed_band("score", *d.SCORE_BANDS, null_label="Não avaliado").alias("score_band"),
        fn.right_closed_band("score", *d.MEAN_BANDS).alias("mean_band"),
        fn.right_closed_band(pct, *d.LITERACY_BANDS).alias("literacy_band"),
        fn.descending_label(pct, d.LEVEL_THRESHOLDS, d.LEVEL_DEFAULT, d.LEVEL_DEFAULT).alias("level"),
        fn.descending_label(diff, d.RELATIVE_THRESHOLDS, d.RELATIVE_DEFAULT, None).alias("relative"),
        fn.yes_no(diff >= 0).alias("reached"),
    )


@query(
    "flags_nulls",
    duck("""
SELECT pupil_key,
  cast(coalesce(score >= 743, false) AS int) AS above,
  cast(coalesce(score >= 743 AND dep = 3, false) AS int) AS above_municipal,
  cast(score IS NOT NULL AS int) AS has_score,
  coalesce(weight, 1.0) AS model_weight,
  coalesce(score, 80.0) AS filled,
  CASE WHEN coalesce(score >= 743, false) THEN 'Sim' ELSE 'Não' END AS text_flag,
  score IS NOT NULL AND score >= 0.4612 * 1600 AS alert
FROM pupil"""),
)
def flags_nulls(spark, sf):
    p = relation(spark, sf, "pupil")
    above = F.col("score") >= d.LITERACY_CUT
    return p.select(
        "pupil_key",
        fn.flag01(above).alias("above"),
        fn.flag01(above & (F.col("dep") == 3)).alias("above_municipal"),
        F.col("score").isNotNull().cast("int").alias("has_score"),
        F.coalesce("weight", F.lit(1.0)).alias("model_weight"),
        F.coalesce("score", F.lit(d.DEFAULT_GOAL)).alias("filled"),
        fn.yes_no(above).alias("text_flag"),
        F.coalesce(F.col("score") >= 0.4612 * 1600, F.lit(False)).alias("alert"),
    )


@query(
    "gap_round",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round_even(l_extendedprice - l_quantity * 1000.125, 2) AS gap2, round_even(l_quantity / 8, 2) AS half_even
FROM lineitem""",
)
def gap_round(spark, sf):
    l = read(spark, sf, "lineitem")
    return l.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        fn.gap("l_extendedprice", F.col("l_quantity") * 1000.125).alias("gap2"),
        fn.round_half_even(F.col("l_quantity") / 8).alias("half_even"),
    )


_STATUS = ("F", "O", "P")


@query(
    "share_of_three",
    """SELECT c_custkey, n_f / nullif(n_f + n_o + n_p, 0) * 100 AS share FROM (
  SELECT c_custkey, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o,
    count(*) FILTER (o_orderstatus = 'P') AS n_p
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND c_custkey % 10 <> 0 GROUP BY c_custkey) t""",
)
def share_of_three(spark, sf):
    orders = read(spark, sf, "orders").filter(F.col("o_custkey") % 10 != 0)
    counts = orders.groupBy("o_custkey").agg(
        *[F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s.lower()}") for s in _STATUS]
    )
    parts = [F.coalesce(f"n_{s.lower()}", F.lit(0)) for s in _STATUS]
    rows = read(spark, sf, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", fn.share_of_parts(parts[0], parts).alias("share"))


_LEVELS_SQL = ", ".join(f"try_cast(PC_ALUNO_NIVEL_{i}_LP AS double) AS n{i}" for i in range(9))


@query(
    "level_profiles",
    duck(f"""
SELECT key, PC_PERFIL_EXTREMA_DEFASAGEM, PC_PERFIL_EM_DESENVOLVIMENTO, PC_PERFIL_LIMITROFE, PC_PERFIL_AVANCADO,
  PC_TAXA_EXCELENCIA,
  round_even(PC_TAXA_EXCELENCIA / (PC_PERFIL_EXTREMA_DEFASAGEM + 0.01::double), 2) AS polarisation,
  CASE WHEN PC_PERFIL_EXTREMA_DEFASAGEM + PC_PERFIL_EM_DESENVOLVIMENTO = 0 THEN 0.0
    ELSE round_even((n0 * 4 + n1 * 3 + n2 * 2 + n3) / 400, 4) END::double AS risk
FROM (SELECT *, round_even(n0 + n1, 2) AS PC_PERFIL_EXTREMA_DEFASAGEM, round_even(n2 + n3, 2) AS PC_PERFIL_EM_DESENVOLVIMENTO,
    round_even(n4 + n1, 2) AS PC_PERFIL_LIMITROFE, round_even(n5 + n6, 2) AS PC_PERFIL_AVANCADO,
    round_even(n7 + n8, 2) AS PC_TAXA_EXCELENCIA
  FROM (SELECT concat_ws('|', NU_ANO_AVALIACAO, CO_MUNICIPIO, ID_TIPO_REDE, ordem) AS key, {_LEVELS_SQL} FROM raw_municipio) a) b"""),
)
def level_profiles(spark, sf):
    raw = relation(spark, sf, "raw_municipio")
    levels = [f"n{i}" for i in range(9)]
    rows = raw.select(
        fn.concat_key("NU_ANO_AVALIACAO", "CO_MUNICIPIO", "ID_TIPO_REDE", "ordem").alias("key"),
        *[fn.tolerant_double(f"PC_ALUNO_NIVEL_{i}_LP").alias(f"n{i}") for i in range(9)],
    )
    profiles = fn.level_profiles(levels)
    low, developing = "PC_PERFIL_EXTREMA_DEFASAGEM", "PC_PERFIL_EM_DESENVOLVIMENTO"
    return rows.withColumns(profiles).select(
        "key",
        *profiles,
        fn.polarisation_index("PC_TAXA_EXCELENCIA", low).alias("polarisation"),
        fn.structural_risk_index(levels, low, developing).alias("risk"),
    )


@query(
    "nonnull_counts",
    duck("""
SELECT pupil_key,
  (score IS NOT NULL)::int + (weight IS NOT NULL)::int + (CASE WHEN NOT incompleto THEN dep END IS NOT NULL)::int AS present,
  (score IS NOT NULL OR weight IS NOT NULL)::int AS any_present
FROM pupil"""),
)
def nonnull_counts(spark, sf):
    p = relation(spark, sf, "pupil").withColumn("known_dep", F.when(~F.col("incompleto"), F.col("dep")))
    return p.select(
        "pupil_key",
        fn.count_present(["score", "weight", "known_dep"]).alias("present"),
        fn.present_flag("score", "weight").alias("any_present"),
    )


@query(
    "year_month",
    "SELECT event_id, cast(year(ts) AS int) AS load_year, cast(month(ts) AS int) AS load_month FROM events",
)
def year_month(spark, sf):
    e = read(spark, sf, "events")
    return e.select("event_id", F.year("ts").alias("load_year"), F.month("ts").alias("load_month"))
