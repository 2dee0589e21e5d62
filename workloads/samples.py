"""Seeded samples, splits, folds and top-k over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from edugauge.operators import sampling
from workloads.registry import query
from workloads.standin import duck, read, relation

_HASH = "md5(pupil_key || '|42')"
_RANKED = f"""ranked AS (SELECT pupil_key, ano, target, row_number() OVER (PARTITION BY target ORDER BY {_HASH}, pupil_key) AS rn,
  count(*) OVER (PARTITION BY target) AS size, count(*) OVER () AS total FROM pupil WHERE ano = 2025)"""


def _year(spark, sf):
    return relation(spark, sf, "pupil").filter(F.col("ano") == 2025).select("pupil_key", "ano", "target")


@query(
    "stratified_split",
    duck("SELECT pupil_key, target, rn <= round_even(size * 0.3::double, 0) AS is_test FROM ranked", _RANKED),
)
def stratified_split(spark, sf):
    train, test = sampling.stratified_split(_year(spark, sf), "target", ["pupil_key"], 0.30, 42)
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return both.select("pupil_key", "target", "is_test")


@query(
    "stratified_sample",
    duck("SELECT pupil_key, target FROM ranked WHERE rn <= round_even(size * least(1.0::double, 5000.0::double / total), 0)", _RANKED),
)
def stratified_sample(spark, sf):
    return sampling.stratified_sample(_year(spark, sf), "target", ["pupil_key"], 5000, 42).select("pupil_key", "target")


@query(
    "kfold",
    duck(f"""SELECT pupil_key, target, cast(ntile(5) OVER (PARTITION BY target ORDER BY {_HASH}, pupil_key) - 1 AS int) AS fold FROM pupil WHERE ano = 2025"""),
)
def kfold(spark, sf):
    return sampling.stratified_folds(_year(spark, sf), "target", ["pupil_key"], 5, 42).select("pupil_key", "target", "fold")


@query(
    "seeded_sample",
    duck(f"SELECT pupil_key, score FROM pupil ORDER BY {_HASH}, pupil_key LIMIT 2000"),
)
def seeded_sample(spark, sf):
    return sampling.seeded_sample(relation(spark, sf, "pupil").select("pupil_key", "score"), ["pupil_key"], 2000, 42)


@query(
    "temporal_split",
    duck("SELECT ano, count(*) AS n, sum(target)::bigint AS hits FROM pupil WHERE ano IN (2024, 2025) GROUP BY 1"),
)
def temporal_split(spark, sf):
    train, test = sampling.temporal_split(relation(spark, sf, "pupil"), "ano", 2024, 2025)
    parts = [side.groupBy("ano").agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("hits")) for side in (train, test)]
    return parts[0].unionByName(parts[1])


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def topk(spark, sf):
    return sampling.top_k(read(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 15, ["o_orderkey"])
