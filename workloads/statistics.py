"""Descriptive statistics over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from edugauge import functions as fn
from edugauge.functions import dictionaries as d
from edugauge.operators import aggregates as agg
from workloads.registry import query
from workloads.standin import duck, read, relation

r = fn.round_half_even


@query(
    "weighted_rate_by_group",
    duck("""
SELECT 'ano' AS level, cast(ano AS varchar) AS grp, round_even(sum(target * weight) / sum(weight) * 100, 6) AS rate FROM pupil GROUP BY ano
UNION ALL SELECT 'uf', uf, round_even(sum(target * weight) / sum(weight) * 100, 6) FROM pupil WHERE dep IS DISTINCT FROM 4 GROUP BY uf
UNION ALL SELECT 'regiao', regiao, round_even(sum(target * weight) / sum(weight) * 100, 6) FROM pupil JOIN regions USING (uf) WHERE dep IS DISTINCT FROM 4 GROUP BY regiao
UNION ALL SELECT 'all', 'all', round_even(sum(target * weight) / sum(weight) * 100, 6) FROM pupil"""),
)
def weighted_rate_by_group(spark, sf):
    p = relation(spark, sf, "pupil").withColumn("regiao", fn.lookup(d.STATE_REGIONS, "uf"))
    public = p.filter(~F.col("dep").eqNullSafe(4))

    def line(df, level, column):
        by = [column] if column else []
        name = F.col(column).cast("string") if column else F.lit(level)
        return agg.weighted_rate(df, "target", "weight", by).select(
            F.lit(level).alias("level"), name.alias("grp"), r("rate", 6).alias("rate")
        )

    parts = [line(p, "ano", "ano"), line(public, "uf", "uf"), line(public, "regiao", "regiao"), line(p, "all", None)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "value_shares",
    """SELECT o_orderpriority, o_orderstatus, count(*) AS n, count(*) / (SELECT count(*) FROM orders) AS share FROM orders GROUP BY ALL""",
)
def value_shares(spark, sf):
    return agg.value_counts(read(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], share="share")


@query(
    "value_counts_nulls",
    "SELECT CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS status, count(*) AS n FROM orders GROUP BY ALL",
)
def value_counts_nulls(spark, sf):
    orders = read(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus")).alias("status"))
    return agg.value_counts(orders, ["status"], dropna=False)


@query(
    "distinct_counts",
    duck("""
SELECT 'uf' AS column_name, count(DISTINCT uf) AS n_distinct FROM pupil UNION ALL SELECT 'mun', count(DISTINCT mun) FROM pupil
UNION ALL SELECT 'score', count(DISTINCT score) FROM pupil UNION ALL SELECT 'ano', count(DISTINCT ano) FROM pupil"""),
)
def distinct_counts(spark, sf):
    return agg.distinct_counts(relation(spark, sf, "pupil"), ["uf", "mun", "score", "ano"])


@query(
    "rollup_first",
    duck("""
SELECT CO_MUNICIPIO, count(*) AS n_rows, round_even(avg(target), 6) AS rate, any_value(income) AS income FROM (
  SELECT p.mun AS CO_MUNICIPIO, p.target, i.RENDA_PER_CAPITA_MEDIA AS income FROM pupil p LEFT JOIN ext_income i ON p.mun = i.CO_MUNICIPIO) t
GROUP BY 1"""),
)
def rollup_first(spark, sf):
    return _rolled(spark, sf).withColumn("rate", r("rate", 6))


def _enriched(spark, sf):
    income = relation(spark, sf, "ext_income").withColumnRenamed("RENDA_PER_CAPITA_MEDIA", "income")
    p = relation(spark, sf, "pupil").select(F.col("mun").alias("CO_MUNICIPIO"), "target", "score", "weight", "dep")
    return p.join(income, "CO_MUNICIPIO", "left")


def _rolled(spark, sf):
    return agg.rollup_first(_enriched(spark, sf), "CO_MUNICIPIO", "target", ["income"])


_ENRICHED_SQL = """enriched AS (SELECT p.mun AS CO_MUNICIPIO, p.target, p.score, p.weight, p.dep, i.RENDA_PER_CAPITA_MEDIA AS income
  FROM pupil p LEFT JOIN ext_income i ON p.mun = i.CO_MUNICIPIO),
rolled AS (SELECT CO_MUNICIPIO, count(*) AS n_rows, avg(target) AS rate, any_value(income) AS income FROM enriched GROUP BY 1)"""


@query(
    "corr_vector",
    duck(
        """
SELECT 'score' AS column_name, round_even(corr(score, target), 6) AS corr FROM enriched
UNION ALL SELECT 'weight', round_even(corr(weight, target), 6) FROM enriched
UNION ALL SELECT 'income', round_even(corr(income, target), 6) FROM enriched
UNION ALL SELECT 'dep', round_even(corr(dep, target), 6) FROM enriched
UNION ALL SELECT 'income_by_town', round_even(corr(income, rate), 6) FROM rolled""",
        _ENRICHED_SQL,
    ),
)
def corr_vector(spark, sf):
    pupil_level = agg.correlation_vector(_enriched(spark, sf), ["score", "weight", "income", "dep"], "target")
    town_level = agg.correlation_vector(_rolled(spark, sf), ["income"], "rate").withColumn("column_name", F.lit("income_by_town"))
    return pupil_level.unionByName(town_level).withColumn("corr", r("corr", 6))


@query(
    "regression_line",
    duck(
        """SELECT 'income' AS column_name, round_even(regr_slope(rate, income) * 1000, 6) AS slope, round_even(regr_intercept(rate, income), 6) AS intercept FROM rolled
UNION ALL SELECT 'n_rows', round_even(regr_slope(rate, n_rows) * 1000, 6), round_even(regr_intercept(rate, n_rows), 6) FROM rolled""",
        _ENRICHED_SQL,
    ),
)
def regression_line(spark, sf):
    lines = agg.regression_line(_rolled(spark, sf), ["income", "n_rows"], "rate")
    return lines.select("column_name", r(F.col("slope") * 1000, 6).alias("slope"), r("intercept", 6).alias("intercept"))


@query(
    "crosstab_counts",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
  count(*) FILTER (o_orderstatus = 'P') AS P, count(*) FILTER (o_orderstatus = 'Z') AS Z FROM orders GROUP BY 1""",
)
def crosstab_counts(spark, sf):
    return agg.crosstab(read(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P", "Z"])


@query(
    "crosstab_pct",
    """SELECT o_orderpriority, round_even(count(*) FILTER (o_orderstatus = 'F') / count(*), 3) * 100 AS F,
  round_even(count(*) FILTER (o_orderstatus = 'O') / count(*), 3) * 100 AS O,
  round_even(count(*) FILTER (o_orderstatus = 'P') / count(*), 3) * 100 AS P FROM orders GROUP BY 1""",
)
def crosstab_pct(spark, sf):
    return agg.crosstab(read(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"], percent=True)


@query(
    "describe",
    duck("""
SELECT unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS stat,
  unnest([count(score)::double, round_even(avg(score), 1), round_even(stddev_samp(score), 1), round_even(min(score), 1),
    round_even(quantile_cont(score, 0.25), 1), round_even(quantile_cont(score, 0.5), 1), round_even(quantile_cont(score, 0.75), 1),
    round_even(max(score), 1)]) AS value FROM pupil"""),
)
def describe(spark, sf):
    return agg.describe_exact(relation(spark, sf, "pupil"), "score")


@query(
    "exact_quantiles",
    """
SELECT c AS column_name, p, round_even(v, 6) AS value FROM (
  SELECT 'l_extendedprice' AS c, unnest([0.0, 0.1, 0.5, 0.99, 1.0]) AS p, unnest(quantile_cont(l_extendedprice, [0.0, 0.1, 0.5, 0.99, 1.0])) AS v FROM lineitem
  UNION ALL SELECT 'l_quantity', unnest([0.0, 0.1, 0.5, 0.99, 1.0]), unnest(quantile_cont(l_quantity, [0.0, 0.1, 0.5, 0.99, 1.0])) FROM lineitem) t""",
)
def exact_quantiles(spark, sf):
    values = agg.exact_quantiles(read(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], [0.0, 0.1, 0.5, 0.99, 1.0])
    return values.withColumn("value", r("value", 6))


@query(
    "histogram60",
    duck(
        """
SELECT b.bin, round_even(lo + (hi - lo) * b.bin / 60, 6) AS bin_start, count(x.score) AS n
FROM (SELECT unnest(range(60))::int AS bin) b CROSS JOIN e
LEFT JOIN (SELECT score, least(floor((score - lo) / (hi - lo) * 60), 59)::int AS bin FROM pupil, e WHERE score IS NOT NULL) x USING (bin)
GROUP BY ALL""",
        "e AS (SELECT min(score) AS lo, max(score) AS hi FROM pupil)",
    ),
)
def histogram60(spark, sf):
    return agg.histogram(relation(spark, sf, "pupil"), "score").withColumn("bin_start", r("bin_start", 6))


@query(
    "profile_collapse",
    duck(
        "SELECT count(*) AS n_profiles, avg(n) AS rows_per_profile, max(n) AS largest_profile FROM prof",
        "prof AS (SELECT uf, dep, ck % 10 AS d, count(*) AS n FROM pupil GROUP BY ALL)",
    ),
)
def profile_collapse(spark, sf):
    p = relation(spark, sf, "pupil").withColumn("d", F.col("ck") % 10)
    return agg.profile_summary(p, ["uf", "dep", "d"])


@query(
    "group_profile",
    """SELECT c_mktsegment, round_even(avg(c_acctbal), 2) AS c_acctbal, round_even(avg(c_nationkey), 2) AS c_nationkey, count(*) AS n_rows
FROM customer GROUP BY 1""",
)
def group_profile(spark, sf):
    return agg.group_profile(read(spark, sf, "customer"), "c_mktsegment", ["c_acctbal", "c_nationkey"])


@query(
    "zscore_table",
    """
WITH g AS (SELECT c_mktsegment, round_even(avg(c_acctbal), 2) AS bal, round_even(avg(c_nationkey), 2) AS nat FROM customer GROUP BY 1)
SELECT c_mktsegment, round_even((bal - (SELECT avg(bal) FROM g)) / (SELECT stddev_samp(bal) FROM g), 6) AS bal,
  round_even(-(nat - (SELECT avg(nat) FROM g)) / (SELECT stddev_samp(nat) FROM g), 6) AS nat FROM g""",
)
def zscore_table(spark, sf):
    profile = agg.group_profile(read(spark, sf, "customer"), "c_mktsegment", ["c_acctbal", "c_nationkey"])
    named = profile.select("c_mktsegment", F.col("c_acctbal").alias("bal"), F.col("c_nationkey").alias("nat"))
    scored = agg.zscore(named, ["bal", "nat"], inverted=["nat"])
    return scored.select("c_mktsegment", r("bal", 6).alias("bal"), r("nat", 6).alias("nat"))
