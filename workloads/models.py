"""Seeded model training over the stand-in tables. No SQL twin: results depend on MLlib's
randomness; the parts around the fits have their own twins.

Every query runs its plan with the plan's own parameters: tuned forests, whole searches, all numbers of clusters.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from edugauge import functions as fn
from edugauge.functions import dictionaries as d
from edugauge.ml import models
from edugauge.ml.features import feature_groups
from edugauge.plans import municipal_model, pupil_model
from edugauge.session import cut_lineage
from workloads.registry import query
from workloads.standin import external_frame, gold_frame, relation

KEYS = ["pupil_key"]


def _pupils(spark, sf):
    """The columns of the pupil fact that the pupil model reads."""
    rows = relation(spark, sf, "pupil").select(
        "pupil_key",
        F.col("ano").alias("ANO_REFERENCIA"),
        F.when(~F.col("incompleto"), F.col("mun")).alias("CO_MUNICIPIO"),
        F.col("uf").alias("SG_UF"),
        fn.lookup(d.STATE_REGIONS, "uf").alias("REGIAO"),
        F.when(~F.col("incompleto"), F.col("dep")).alias("TP_DEPENDENCIA"),
        F.col("weight").alias("VL_PESO_ALUNO_LP"),
        F.col("target").alias("TARGET"),
    )
    return rows.join(external_frame(spark, sf), "CO_MUNICIPIO", "left")


def _split(spark, sf):
    return pupil_model.split(_pupils(spark, sf), keys=KEYS)


def _goals(spark, sf):
    return (
        cut_lineage(gold_frame(spark, sf, "FT_INDICADOR_MUNICIPIO_META_VS_RESULTADO")),
        cut_lineage(external_frame(spark, sf)),
    )


@query("lr_weighted")
def lr_weighted(spark, sf):
    train, test = _split(spark, sf)
    return models.evaluate(models.fit(train, models.LOGISTIC, *feature_groups(True)), test)


@query("rf_compare")
def rf_compare(spark, sf):
    return pupil_model.compare(*_split(spark, sf))["comparison"]


@query("rf_by_state")
def rf_by_state(spark, sf):
    train, test = _split(spark, sf)
    fitted = models.fit(train, models.forest(models.PUPIL_FOREST), *feature_groups(True, True))
    return models.group_report(fitted, test, "SG_UF")


@query("cv_search")
def cv_search(spark, sf):
    train, test = _split(spark, sf)
    return pupil_model.tune(train, test, KEYS)["search"]


@query("shapley")
def shapley(spark, sf):
    train, test = _split(spark, sf)
    return pupil_model.explain(train, test, KEYS)["importance"]


@query("goal_model")
def goal_model(spark, sf):
    train, test = municipal_model.split(*_goals(spark, sf))
    reports, _ = municipal_model.goal_model(train, test)
    return reports["comparison"]


@query("goal_thresholds")
def goal_thresholds(spark, sf):
    train, test = municipal_model.split(*_goals(spark, sf))
    reports, _ = municipal_model.goal_model(train, test)
    return reports["thresholds"]


@query("goal_explain")
def goal_explain(spark, sf):
    train, test = municipal_model.split(*_goals(spark, sf))
    _, best = municipal_model.goal_model(train, test)
    return municipal_model.explain(best, train, test)


@query("goal_grid_search")
def goal_grid_search(spark, sf):
    train, test = municipal_model.split(*_goals(spark, sf))
    return municipal_model.tune(train, test)["search"]


@query("risk_model")
def risk_model(spark, sf):
    levels = gold_frame(spark, sf, "ANALISE_NIVEIS_MUNICIPIO")
    return municipal_model.risk(*_goals(spark, sf), levels)["ranking"]


@query("risk_alerts")
def risk_alerts(spark, sf):
    levels = gold_frame(spark, sf, "ANALISE_NIVEIS_MUNICIPIO")
    return municipal_model.risk(*_goals(spark, sf), levels)["alerts"]


@query("risk_agreement")
def risk_agreement(spark, sf):
    levels = gold_frame(spark, sf, "ANALISE_NIVEIS_MUNICIPIO")
    return municipal_model.risk(*_goals(spark, sf), levels)["agreement"]


@query("kmeans_k")
def kmeans_k(spark, sf):
    return municipal_model.clusters(*_goals(spark, sf))["scores"]


@query("cluster_profile")
def cluster_profile(spark, sf):
    return municipal_model.clusters(*_goals(spark, sf))["profile"]


@query("cluster_by_region")
def cluster_by_region(spark, sf):
    return municipal_model.clusters(*_goals(spark, sf))["by_region"]


@query("cluster_members")
def cluster_members(spark, sf):
    return municipal_model.clusters(*_goals(spark, sf))["members"]
