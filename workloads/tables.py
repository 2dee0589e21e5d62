"""Sources, joins, windows and quality checks over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from edugauge import functions as fn
from edugauge.operators import aggregates as agg
from edugauge.operators import joins, quality, windows
from edugauge.session import scratch_path
from edugauge.sources import read_sharded, read_table, union_aligned, write_sharded, write_table
from workloads.registry import query
from workloads.standin import duck, external_frame, read, relation


@query(
    "scan_prune",
    """
SELECT l_linestatus, cast(year(l_shipdate) AS int) AS ano, count(*) AS n,
  cast(sum(cast(l_quantity AS bigint)) AS bigint) AS quantity
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY ALL""",
)
def scan_prune(spark, sf):
    recent = read(spark, sf, "lineitem").filter(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp"))
    return recent.groupBy("l_linestatus", F.year("l_shipdate").alias("ano")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


@query(
    "yearly_union",
    """
SELECT ano, count(*) AS n, count(o_orderpriority) AS with_priority, count(o_custkey) AS with_customer FROM (
  SELECT year(o_orderdate)::int AS ano, o_orderpriority, o_custkey FROM orders WHERE year(o_orderdate) = 1996
  UNION ALL SELECT year(o_orderdate)::int, NULL, o_custkey FROM orders WHERE year(o_orderdate) = 1997
  UNION ALL SELECT year(o_orderdate)::int, o_orderpriority, NULL FROM orders WHERE year(o_orderdate) NOT IN (1996, 1997)
) t GROUP BY ano""",
)
def yearly_union(spark, sf):
    orders = read(spark, sf, "orders").withColumn("ano", F.year("o_orderdate"))
    frames = [
        orders.filter(F.col("ano") == 1996).select("ano", "o_orderpriority", "o_custkey"),
        orders.filter(F.col("ano") == 1997).select("ano", "o_custkey"),
        orders.filter(~F.col("ano").isin(1996, 1997)).select("o_orderpriority", "ano"),
    ]
    return union_aligned(frames).groupBy("ano").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("o_orderpriority").alias("with_priority"),
        F.count("o_custkey").alias("with_customer"),
    )


@query(
    "csv_roundtrip",
    """SELECT cast(c_custkey AS varchar) AS c_custkey, c_name || ' Ção' AS c_name, cast(c_nationkey AS varchar) AS c_nationkey,
  c_mktsegment FROM customer""",
)
def csv_roundtrip(spark, sf):
    rows = read(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.concat("c_name", F.lit(" Ção")).alias("c_name"),
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        "c_mktsegment",
    )
    path = write_sharded(rows, scratch_path(spark, "shards"), max_bytes=1_000_000)
    return read_sharded(spark, path)


@query(
    "layer_roundtrip",
    """SELECT cast(year(o_orderdate) AS int) AS ANO_REFERENCIA, count(*) AS n, count(DISTINCT o_custkey) AS customers
FROM orders WHERE year(o_orderdate) = 1998 GROUP BY ALL""",
)
def layer_roundtrip(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("ANO_REFERENCIA"))
    layer = scratch_path(spark, "layer")
    write_table(orders, layer, "ORDERS", ["ANO_REFERENCIA"])
    one_year = read_table(spark, layer, "ORDERS", ["ANO_REFERENCIA", "o_custkey"]).filter(F.col("ANO_REFERENCIA") == 1998)
    return one_year.groupBy("ANO_REFERENCIA").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers")
    )


_PLACE_SQL = """place AS (SELECT ano, mun, rede, max(total) AS total, max(hits * 100 // total) AS pct FROM municipio_groups GROUP BY ALL),
state AS (SELECT ano, couf, rede, max(hits * 100 // total) AS pct_state FROM estado_groups GROUP BY ALL)"""


@query(
    "star_enrich",
    duck(
        """
SELECT p.pupil_key, m.pct, s.pct_state, e.RENDA_PER_CAPITA_MEDIA AS income
FROM pupil p
LEFT JOIN place m ON p.ano = m.ano AND CASE WHEN NOT p.incompleto THEN p.mun END = m.mun AND p.dep = m.rede
LEFT JOIN state s ON p.ano = s.ano AND p.couf = s.couf AND p.dep = s.rede
LEFT JOIN ext_income e ON CASE WHEN NOT p.incompleto THEN p.mun END = e.CO_MUNICIPIO""",
        _PLACE_SQL,
    ),
)
def star_enrich(spark, sf):
    pupils = relation(spark, sf, "pupil").select(
        "pupil_key", "ano", "couf", "dep", F.when(~F.col("incompleto"), F.col("mun")).alias("mun")
    )
    pct = F.expr("hits * 100 div total")
    towns = relation(spark, sf, "municipio_groups").select(
        F.col("ano").alias("m_ano"), F.col("mun").alias("m_mun"), F.col("rede").alias("m_rede"), pct.alias("pct")
    )
    states = relation(spark, sf, "estado_groups").select(
        F.col("ano").alias("s_ano"), "couf", F.col("rede").alias("s_rede"), pct.alias("pct_state")
    )
    income = relation(spark, sf, "ext_income").withColumnRenamed("RENDA_PER_CAPITA_MEDIA", "income")
    rows = joins.left_join_dim(pupils, towns, [("ano", "m_ano"), ("mun", "m_mun"), ("dep", "m_rede")])
    rows = joins.left_join_dim(rows, states, [("ano", "s_ano"), ("couf", "couf"), ("dep", "s_rede")])
    rows = joins.left_join_dim(rows, income, [("mun", "CO_MUNICIPIO")])
    return rows.select("pupil_key", "pct", "pct_state", "income")


@query(
    "preagg_dim",
    duck("""
SELECT i.CO_MUNICIPIO, i.RENDA_PER_CAPITA_MEDIA, round_even(x.idx, 6) AS MEDIA_INSE,
  r.QT_FAMILIAS_POBREZA_FAIXA_PBF / nullif(r.QT_FAMILIAS_POBREZA_FAIXA_PBF + r.QT_FAMILIAS_ATE_MEIO_SM + r.QT_FAMILIAS_ACIMA_MEIO_SM, 0) * 100 AS PC_FAMILIAS_POBREZA,
  c.lib AS PC_ESCOLAS_BIBLIOTECA, c.lab AS PC_ESCOLAS_LAB_INFORMATICA, c.net AS PC_ESCOLAS_INTERNET_ALUNOS
FROM ext_income i
LEFT JOIN (SELECT CO_MUNICIPIO, avg(MEDIA_INSE) AS idx FROM ext_index GROUP BY 1) x USING (CO_MUNICIPIO)
LEFT JOIN ext_register r ON i.CO_MUNICIPIO // 10 = r.CO_MUNICIPIO
LEFT JOIN (SELECT CO_MUNICIPIO, avg(IN_BIBLIOTECA) AS lib, avg(IN_LABORATORIO_INFORMATICA) AS lab, avg(IN_INTERNET_ALUNOS) AS net
  FROM ext_census WHERE TP_SITUACAO_FUNCIONAMENTO = 1 GROUP BY 1) c USING (CO_MUNICIPIO)"""),
)
def preagg_dim(spark, sf):
    return external_frame(spark, sf).withColumn("MEDIA_INSE", fn.round_half_even("MEDIA_INSE", 6))


@query(
    "truncated_code_join",
    duck("""
SELECT i.CO_MUNICIPIO, i.RENDA_PER_CAPITA_MEDIA, cast(r.QT_FAMILIAS_ATE_MEIO_SM AS bigint) AS families
FROM ext_income i LEFT JOIN ext_register r ON i.CO_MUNICIPIO // 10 = r.CO_MUNICIPIO"""),
)
def truncated_code_join(spark, sf):
    register = relation(spark, sf, "ext_register").select(
        F.col("CO_MUNICIPIO").alias("code6"), F.col("QT_FAMILIAS_ATE_MEIO_SM").alias("families")
    )
    return joins.truncated_code_join(relation(spark, sf, "ext_income"), register, "CO_MUNICIPIO", "code6")


@query(
    "cross_one_row",
    """SELECT s_suppkey, s_acctbal, t.top, t.n FROM supplier,
  (SELECT max(s_acctbal) AS top, count(*) AS n FROM supplier) t""",
)
def cross_one_row(spark, sf):
    suppliers = read(spark, sf, "supplier")
    one = suppliers.agg(F.max("s_acctbal").alias("top"), F.count(F.lit(1)).alias("n"))
    return joins.attach_single_row(suppliers.select("s_suppkey", "s_acctbal"), one, ["top", "n"])


_NATION_YEAR = """SELECT c_nationkey, ano, rate, goal_1996, goal_1997, goal_1998, goal_1999, goal_2000, goal_2001 FROM (
  SELECT c_nationkey, year(o_orderdate)::int AS ano, round_even(100 * count(*) FILTER (o_orderstatus = 'F') / count(*), 2) AS rate
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) f
JOIN (SELECT n_nationkey, """ + ", ".join(
    f"(30 + n_nationkey * {y - 1990} % 9)::double AS goal_{y}" for y in range(1996, 2002)
) + " FROM nation) g ON c_nationkey = n_nationkey"


def _nation_year(spark, sf):
    """Rate per nation and year with the nation's goals in wide columns (none for 1995)."""
    orders = read(spark, sf, "orders").select("o_custkey", "o_orderstatus", F.year("o_orderdate").alias("ano"))
    customers = read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    rate = fn.round_half_even(F.lit(100) * F.count_if(F.col("o_orderstatus") == "F") / F.count(F.lit(1)))
    facts = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "ano")
        .agg(rate.alias("rate"))
    )
    goals = read(spark, sf, "nation").select(
        "n_nationkey",
        *[(F.lit(30) + F.col("n_nationkey") * (y - 1990) % 9).cast("double").alias(f"goal_{y}") for y in range(1996, 2002)],
    )
    return joins.left_join_dim(facts, goals, [("c_nationkey", "n_nationkey")])


@query(
    "goal_of_year",
    f"""
WITH f AS ({_NATION_YEAR}),
long AS (SELECT n_nationkey, y, goal FROM (SELECT n_nationkey, unnest(range(1996, 2002)) AS y FROM nation) n
  JOIN LATERAL (SELECT (30 + n_nationkey * (y - 1990) % 9)::double AS goal) g ON true)
SELECT f.c_nationkey, f.ano, rate, goal, round_even(rate - goal, 2) AS gap,
  CASE WHEN rate - goal >= 0 THEN 'Sim' ELSE 'Não' END AS reached, round_even(rate - coalesce(goal, 35), 2) AS gap_or_default
FROM f LEFT JOIN long ON f.c_nationkey = long.n_nationkey AND f.ano = long.y""",
)
def goal_of_year(spark, sf):
    rows = _nation_year(spark, sf).withColumn("goal", fn.pick_by_year("ano", {y: f"goal_{y}" for y in range(1996, 2002)}))
    return rows.select(
        "c_nationkey", "ano", "rate", "goal",
        fn.gap("rate", "goal").alias("gap"),
        fn.yes_no(F.col("rate") - F.col("goal") >= 0).alias("reached"),
        fn.gap("rate", F.coalesce("goal", F.lit(35.0))).alias("gap_or_default"),
    )


@query(
    "calendar_lag",
    """
WITH f AS (SELECT o_custkey, year(o_orderdate)::int AS ano, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY ALL)
SELECT a.o_custkey, a.ano, a.n, a.top, b.n AS n_ANTERIOR, b.top AS top_ANTERIOR
FROM f a JOIN f b ON a.o_custkey = b.o_custkey AND a.ano = b.ano + 1""",
)
def calendar_lag(spark, sf):
    facts = (
        read(spark, sf, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("ano"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    )
    return joins.calendar_lag(facts, ["o_custkey"], "ano", ["n", "top"])


@query(
    "orphans",
    """SELECT o_orderkey, o_custkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS o_custkey FROM orders) o
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 10 <> 3)""",
)
def orphans(spark, sf):
    orders = read(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey")).alias("o_custkey")
    )
    known = read(spark, sf, "customer").filter(F.col("c_custkey") % 10 != 3)
    return joins.orphans(orders, known, "o_custkey", "c_custkey")


@query(
    "quality_checks",
    """
SELECT 'primary_key(l_orderkey,l_linenumber)' AS check, 'lineitem' AS table, cast(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS bigint) AS n_bad FROM lineitem
UNION ALL SELECT 'primary_key(o_orderkey)', 'orders', count(*) - count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'not_null(half)', 'orders', count(*) FILTER (o_orderkey % 2 = 1) FROM orders
UNION ALL SELECT 'not_null(o_custkey)', 'orders', 0
UNION ALL SELECT 'years(ano)', 'orders', 0
UNION ALL SELECT 'schema(missing_a,missing_b)', 'orders', 2
UNION ALL SELECT 'foreign_key(l_orderkey)', 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0)""",
)
def quality_checks(spark, sf):
    lines = read(spark, sf, "lineitem")
    orders = read(spark, sf, "orders").withColumns(
        {"ano": F.year("o_orderdate"), "half": F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey"))}
    )
    return quality.union_checks(
        [
            quality.check_primary_key(lines, ["l_orderkey", "l_linenumber"], "lineitem"),
            quality.check_primary_key(orders, ["o_orderkey"], "orders"),
            quality.check_not_null(orders, ["half", "o_custkey"], "orders"),
            quality.check_years(orders, "ano", "orders"),
            quality.check_schema(orders, ["o_orderkey", "missing_a", "missing_b"], "orders"),
            quality.check_foreign_key(lines, orders.filter(F.col("o_orderkey") % 3 != 0), "l_orderkey", "o_orderkey", "lineitem"),
        ]
    )


@query(
    "null_profile",
    duck("""
SELECT column_name, null_pct FROM (
  SELECT 'score' AS column_name, round_even(avg((score IS NULL)::int) * 100, 2) AS null_pct FROM pupil
  UNION ALL SELECT 'weight', round_even(avg((weight IS NULL)::int) * 100, 2) FROM pupil
  UNION ALL SELECT 'school', round_even(avg(incompleto::int) * 100, 2) FROM pupil
  UNION ALL SELECT 'uf', 0.0) t"""),
)
def null_profile(spark, sf):
    p = relation(spark, sf, "pupil").withColumn("school", F.when(~F.col("incompleto"), F.col("escola")))
    return agg.null_profile(p, ["score", "weight", "school", "uf"])


@query(
    "coverage",
    duck("""
SELECT 'MEDIA_INSE' AS column_name, round_even(avg((MEDIA_INSE IS NOT NULL)::int) * 100, 1) AS coverage_pct FROM ext_index
UNION ALL SELECT 'CO_MUNICIPIO', 100.0"""),
)
def coverage(spark, sf):
    return agg.coverage(relation(spark, sf, "ext_index"), ["MEDIA_INSE", "CO_MUNICIPIO"])


@query(
    "table_agreement",
    """
WITH a AS (SELECT * FROM orders WHERE o_orderkey % 20 <> 0),
b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders),
j AS (SELECT a.o_orderkey AS ka, b.o_orderkey AS kb, a.o_custkey IS NOT DISTINCT FROM b.o_custkey AS c1,
  a.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus AS c2 FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT count(ka) AS n_left, count(kb) AS n_right, 'o_custkey' AS column_name,
  avg((c1 AND ka IS NOT NULL AND kb IS NOT NULL)::int) * 100 AS equal_pct FROM j
UNION ALL SELECT count(ka), count(kb), 'o_orderstatus', avg((c2 AND ka IS NOT NULL AND kb IS NOT NULL)::int) * 100 FROM j""",
)
def table_agreement(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = orders.withColumns(
        {
            "o_custkey": F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")),
            "o_orderstatus": F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus")),
        }
    )
    return quality.table_agreement(
        orders.filter(F.col("o_orderkey") % 20 != 0), changed, ["o_orderkey"], ["o_custkey", "o_orderstatus"]
    )


@query(
    "leakage_check",
    duck("""
SELECT score >= 743 AS above_cut, target, count(*) AS n FROM pupil GROUP BY ALL
UNION ALL SELECT NULL, -1, count(*) FROM pupil WHERE target <> (CASE WHEN score >= 743 THEN 1 ELSE 0 END)"""),
)
def leakage_check(spark, sf):
    p = relation(spark, sf, "pupil")
    broken = quality.check_leakage(p, "score", "target").select(
        F.lit(None).cast("boolean").alias("above_cut"), F.lit(-1).alias("target"), F.col("n_bad").alias("n")
    )
    return quality.leakage_table(p, "score", "target").unionByName(broken)


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) t WHERE rn = 1""",
)
def latest_per_key(spark, sf):
    orders = read(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "o_orderstatus")
    return windows.latest_per_key(orders, ["o_custkey"], "o_orderdate")


@query(
    "change_trend",
    f"""
WITH f AS (SELECT c_nationkey, ano, rate FROM ({_NATION_YEAR}) x),
c AS (SELECT *, round_even(rate - lag(rate) OVER (PARTITION BY c_nationkey ORDER BY ano), 2) AS change FROM f)
SELECT c_nationkey, ano, rate, change,
  CASE WHEN change > 0 THEN 'Melhorou' WHEN change < 0 THEN 'Piorou' WHEN change = 0 THEN 'Estável' END AS trend FROM c""",
)
def change_trend(spark, sf):
    rows = _nation_year(spark, sf).select("c_nationkey", "ano", "rate")
    rows = windows.change_vs_previous(rows, ["c_nationkey"], "ano", {"change": "rate"})
    return rows.withColumn("trend", windows.trend_label("change"))


@query(
    "dedupe_first",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS rn
  FROM lineitem) t WHERE rn = 1""",
)
def dedupe_first(spark, sf):
    lines = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    return windows.dedupe_first(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query(
    "running_totals",
    """SELECT l_extendedprice AS price, n, cast(sum(n) OVER (ORDER BY l_extendedprice) AS bigint) AS upto
FROM (SELECT l_extendedprice, count(*) AS n FROM lineitem GROUP BY 1) t""",
)
def running_totals(spark, sf):
    counts = read(spark, sf, "lineitem").groupBy(F.col("l_extendedprice").alias("price")).agg(F.count(F.lit(1)).alias("n"))
    return windows.running_totals(counts, "price", {"upto": "n"})
