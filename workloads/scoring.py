"""Evaluation of scored rows, rankings, attribution tables and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from edugauge import functions as fn
from edugauge.operators import aggregates as agg
from edugauge.operators import attribution, evaluation, reports, sampling
from edugauge.sources import read_report, write_report
from edugauge.session import scratch_path
from workloads.registry import query
from workloads.standin import duck, read, relation

r = fn.round_half_even

_CELLS = """cells AS (SELECT sum(weight) FILTER (label = 0 AND prediction = 0) AS tn, sum(weight) FILTER (label = 0 AND prediction = 1) AS fp,
  sum(weight) FILTER (label = 1 AND prediction = 0) AS fn, sum(weight) FILTER (label = 1 AND prediction = 1) AS tp FROM scored)"""


def _scored(spark, sf):
    return relation(spark, sf, "scored")


def _rounded(df, cols, digits=6):
    return df.withColumns({c: r(c, digits) for c in cols})


@query(
    "majority_share",
    duck("""SELECT round_even(max(w) / sum(w), 6) AS weighted, (SELECT round_even(max(n) / sum(n), 6) FROM (SELECT count(*) AS n FROM scored GROUP BY label) a) AS plain
FROM (SELECT sum(weight) AS w FROM scored GROUP BY label) t"""),
)
def majority_share(spark, sf):
    scored = _scored(spark, sf)
    plain = evaluation.majority_share(scored, "label", alias="plain").scalar()
    return _rounded(evaluation.majority_share(scored, "label", "weight", alias="weighted").withColumn("plain", plain), ["weighted", "plain"])


@query(
    "confusion",
    duck("""SELECT 'real_0' AS real, p AS predito, v AS value, round_even(v * 100 / (tn + fp + fn + tp), 6) AS pct FROM (
  SELECT *, unnest(['predito_0', 'predito_1']) AS p, unnest([tn, fp]) AS v FROM cells) a
UNION ALL SELECT 'real_1', p, v, round_even(v * 100 / (tn + fp + fn + tp), 6) FROM (
  SELECT *, unnest(['predito_0', 'predito_1']) AS p, unnest([fn, tp]) AS v FROM cells) b""", _CELLS),
)
def confusion(spark, sf):
    matrix = evaluation.confusion(_scored(spark, sf), "label", "prediction", "weight")
    return _rounded(reports.confusion_heat(matrix), ["pct"])


_AUC = """auc AS (SELECT sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS v FROM (
  SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp FROM (
    SELECT score, coalesce(sum(weight) FILTER (label = 1), 0) AS pos, coalesce(sum(weight) FILTER (label = 0), 0) AS neg FROM scored GROUP BY score) a) b)"""


@query(
    "class_metrics",
    duck("""SELECT round_even((tn + tp) / (tn + fp + fn + tp), 6) AS accuracy, round_even(greatest(tn + fp, fn + tp) / (tn + fp + fn + tp), 6) AS majority_share,
  round_even(tp / (tp + fp), 6) AS precision, round_even(tp / (tp + fn), 6) AS recall, round_even(2 * tp / (2 * tp + fp + fn), 6) AS f1,
  tn, fp, fn, tp, (SELECT round_even(v, 6) FROM auc) AS roc_auc FROM cells""", _CELLS + ",\n" + _AUC),
)
def class_metrics(spark, sf):
    out = evaluation.binary_metrics(_scored(spark, sf), "label", "prediction", "weight", score="score")
    return _rounded(out, ["accuracy", "majority_share", "precision", "recall", "f1", "roc_auc"])


@query(
    "class_report",
    duck("""
SELECT class, round_even(p, 6) AS precision, round_even(rc, 6) AS recall, round_even(f, 6) AS f1, support FROM (
  SELECT '0' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS rc, 2 * tn / (2 * tn + fn + fp) AS f, tn + fp AS support FROM cells
  UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM cells
  UNION ALL SELECT 'accuracy', (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp), tn + fp + fn + tp FROM cells
  UNION ALL SELECT 'macro avg', (tn / (tn + fn) + tp / (tp + fp)) / 2, (tn / (tn + fp) + tp / (tp + fn)) / 2,
    (2 * tn / (2 * tn + fn + fp) + 2 * tp / (2 * tp + fp + fn)) / 2, tn + fp + fn + tp FROM cells
  UNION ALL SELECT 'weighted avg', (tn / (tn + fn) * (tn + fp) + tp / (tp + fp) * (tp + fn)) / (tn + fp + fn + tp),
    (tn / (tn + fp) * (tn + fp) + tp / (tp + fn) * (tp + fn)) / (tn + fp + fn + tp),
    (2 * tn / (2 * tn + fn + fp) * (tn + fp) + 2 * tp / (2 * tp + fp + fn) * (tp + fn)) / (tn + fp + fn + tp), tn + fp + fn + tp FROM cells) t""", _CELLS),
)
def class_report(spark, sf):
    return _rounded(evaluation.class_report(_scored(spark, sf), "label", "prediction", "weight"), ["precision", "recall", "f1"])


_GROUPS = """grp AS (SELECT uf, count(*) AS n, sum(label * weight) / sum(weight) AS rate,
  coalesce(sum(weight) FILTER (label = prediction), 0) / sum(weight) AS acc,
  coalesce(coalesce(sum(weight) FILTER (label = 1 AND prediction = 1), 0) / nullif(coalesce(sum(weight) FILTER (prediction = 1), 0), 0), 0) AS prec,
  coalesce(coalesce(sum(weight) FILTER (label = 1 AND prediction = 1), 0) / nullif(coalesce(sum(weight) FILTER (label = 1), 0), 0), 0) AS rec
  FROM (SELECT CASE WHEN uf <> 'AC' THEN uf END AS uf, label, CASE WHEN uf IN ('SP', 'RJ') THEN 1 WHEN uf = 'CE' THEN 0 ELSE prediction END AS prediction, weight FROM scored) s
  WHERE uf IS NOT NULL GROUP BY uf)"""


def _group_metrics(spark, sf):
    forced = F.when(F.col("uf").isin("SP", "RJ"), 1).when(F.col("uf") == "CE", 0).otherwise(F.col("prediction"))
    scored = _scored(spark, sf).withColumns({"prediction": forced, "uf": F.when(F.col("uf") != "AC", F.col("uf"))})
    return evaluation.group_metrics(scored, "uf", "label", "prediction", "weight")


@query(
    "group_metrics",
    duck("SELECT uf, n, round_even(rate, 6) AS true_rate, round_even(acc, 6) AS accuracy, round_even(prec, 6) AS precision, round_even(rec, 6) AS recall FROM grp", _GROUPS),
)
def group_metrics(spark, sf):
    return _rounded(_group_metrics(spark, sf), ["true_rate", "accuracy", "precision", "recall"])


@query(
    "degenerate_groups",
    duck("SELECT count(*) FILTER (rec = 0) AS n_zero, count(*) FILTER (rec >= 0.99) AS n_full, count(*) FILTER (rec = 0 OR rec >= 0.99) AS n_degenerate, count(*) AS n_groups FROM grp", _GROUPS),
)
def degenerate_groups(spark, sf):
    return evaluation.degenerate_groups(_group_metrics(spark, sf))


@query(
    "group_bars",
    duck("SELECT uf, round_even(rec, 6) AS recall, rec = 0 OR rec >= 0.99 AS degenerate FROM grp", _GROUPS),
)
def group_bars(spark, sf):
    return _rounded(reports.group_bars(_group_metrics(spark, sf), "uf", "recall"), ["recall"])


@query("roc_auc", duck("SELECT round_even(v, 6) AS roc_auc FROM auc", _AUC))
def roc_auc(spark, sf):
    return _rounded(evaluation.roc_auc(_scored(spark, sf), "label", "score", "weight"), ["roc_auc"])


_CURVE = """totals AS (SELECT round_even(1 - score, 3) AS s, count(*) FILTER (label = 0) AS pos, count(*) FILTER (label <> 0) AS neg FROM scored GROUP BY 1),
curve AS (SELECT s, tp / (tp + fp) AS p, tp / (SELECT sum(pos) FROM totals) AS rc, 2 * tp / (tp + fp + (SELECT sum(pos) FROM totals)) AS f FROM (
  SELECT s, sum(pos) OVER (ORDER BY s DESC)::double AS tp, sum(neg) OVER (ORDER BY s DESC)::double AS fp FROM totals) a)"""


@query(
    "pr_thresholds",
    duck("""
SELECT strategy, threshold, round_even(p, 6) AS precision, round_even(rc, 6) AS recall, round_even(f, 6) AS f1 FROM (
  (SELECT 'padrao_0.5' AS strategy, 0.5::double AS threshold, p, rc, f FROM curve WHERE s >= 0.5 ORDER BY s LIMIT 1)
  UNION ALL (SELECT 'f1_otimo', s, p, rc, f FROM curve ORDER BY f DESC, s LIMIT 1)
  UNION ALL (SELECT 'recall_minimo_80%', s, p, rc, f FROM curve WHERE rc >= 0.8 ORDER BY p DESC, s LIMIT 1)) t""", _CURVE),
)
def pr_thresholds(spark, sf):
    scored = _scored(spark, sf).withColumn("risk", r(1 - F.col("score"), 3))
    return _rounded(evaluation.threshold_report(scored, "label", "risk", target=0, min_recall=0.80), ["precision", "recall", "f1"])


@query(
    "pr_curve",
    duck("SELECT s AS threshold, round_even(p, 6) AS precision, round_even(rc, 6) AS recall FROM curve", _CURVE),
)
def pr_curve(spark, sf):
    scored = _scored(spark, sf).withColumn("risk", r(1 - F.col("score"), 3))
    curve = evaluation.precision_recall_curve(scored, "label", "risk", target=0)
    return _rounded(curve.select("threshold", "precision", "recall"), ["precision", "recall"])


_SCENARIOS = """scen AS (SELECT CASE WHEN dep <= 2 THEN 'LogisticRegression' ELSE 'RandomForest' END AS model, dep % 2 = 0 AS enriched,
  round_even(avg((label = prediction)::int), 6) AS accuracy, round_even(avg(score), 6) AS f1, round_even(avg(1 - abs(label - score)), 6) AS roc_auc
  FROM scored GROUP BY 1, 2)"""


def _scenarios(spark, sf):
    scored = _scored(spark, sf)
    model = F.when(F.col("dep") <= 2, "LogisticRegression").otherwise("RandomForest")
    return scored.groupBy(model.alias("model"), (F.col("dep") % 2 == 0).alias("enriched")).agg(
        r(F.avg((F.col("label") == F.col("prediction")).cast("int")), 6).alias("accuracy"),
        r(F.avg("score"), 6).alias("f1"),
        r(F.avg(1 - F.abs(F.col("label") - F.col("score"))), 6).alias("roc_auc"),
    )


@query("best_scenario", duck("SELECT * FROM scen ORDER BY roc_auc DESC, model, enriched LIMIT 1", _SCENARIOS))
def best_scenario(spark, sf):
    return evaluation.best_scenario(_scenarios(spark, sf), ["model", "enriched"])


@query(
    "scenario_long",
    duck("""SELECT model || ' (' || CASE WHEN enriched THEN 'com enriq.' ELSE 'sem enriq.' END || ')' AS scenario, metric, value
FROM (SELECT model, enriched, unnest(['accuracy', 'f1', 'roc_auc']) AS metric, unnest([accuracy, f1, roc_auc]) AS value FROM scen) t""", _SCENARIOS),
)
def scenario_long(spark, sf):
    return reports.scenario_long(_scenarios(spark, sf), "model", "enriched")


_RISK = """risk AS (SELECT c_custkey, c_acctbal, round_even((c_custkey * 7919 % 10007) / 10007.0::double, 6) AS p FROM customer)"""


def _risk(spark, sf):
    p = r((F.col("c_custkey") * 7919 % 10007) / F.lit(10007.0), 6)
    rows = read(spark, sf, "customer").select("c_custkey", "c_acctbal", p.alias("p"))
    return rows.withColumns({"alert_f1": F.col("p") >= 0.4612, "alert_recall": F.col("p") >= 0.4412})


@query(
    "risk_rank_alerts",
    f"""WITH {_RISK} SELECT c_custkey, c_acctbal, p, p >= 0.4612 AS alert_f1, p >= 0.4412 AS alert_recall FROM risk ORDER BY p DESC, c_custkey LIMIT 15""",
)
def risk_rank_alerts(spark, sf):
    return sampling.top_k(_risk(spark, sf), "p", 15, ["c_custkey"])


@query(
    "alert_counts",
    f"""WITH {_RISK} SELECT 'alert_f1' AS alert, count(*) FILTER (p >= 0.4612) AS n FROM risk
UNION ALL SELECT 'alert_recall', count(*) FILTER (p >= 0.4412) FROM risk""",
)
def alert_counts(spark, sf):
    return agg.alert_counts(_risk(spark, sf), ["alert_f1", "alert_recall"])


_PHI = """phi AS (SELECT o_orderkey AS row_id, 'o_orderpriority=' || o_orderpriority AS feature, (o_orderkey * 31 % 201 - 100) / 128.0::double AS phi FROM orders
  UNION ALL SELECT o_orderkey, 'o_orderstatus=' || o_orderstatus, (o_orderkey * 17 % 101 - 50) / 128.0::double FROM orders
  UNION ALL SELECT o_orderkey, 'o_totalprice', (o_orderkey * 13 % 301 - 150) / 128.0::double FROM orders)"""


def _phi(spark, sf):
    orders = read(spark, sf, "orders")
    key = F.col("o_orderkey")

    def entry(name, factor, modulus, shift):
        value = (key * factor % modulus - shift) / F.lit(128.0)
        return F.struct(name.alias("feature"), value.alias("phi"))

    entries = F.array(
        entry(F.concat(F.lit("o_orderpriority="), "o_orderpriority"), 31, 201, 100),
        entry(F.concat(F.lit("o_orderstatus="), "o_orderstatus"), 17, 101, 50),
        entry(F.lit("o_totalprice"), 13, 301, 150),
    )
    return orders.select(key.alias("row_id"), F.inline(entries))


@query(
    "attribution_features",
    f"WITH {_PHI} SELECT feature, round_even(avg(abs(phi)), 6) AS importance FROM phi GROUP BY 1",
)
def attribution_features(spark, sf):
    return _rounded(attribution.importance_by_feature(_phi(spark, sf)), ["importance"])


@query(
    "attribution_rollup",
    f"""WITH {_PHI} SELECT split_part(feature, '=', 1) AS variable, round_even(sum(m), 6) AS importance FROM (
  SELECT feature, sum(abs(phi)) / (SELECT count(*) FROM orders) AS m FROM phi GROUP BY 1) t GROUP BY 1""",
)
def attribution_rollup(spark, sf):
    n = read(spark, sf, "orders").agg(F.count(F.lit(1)))
    importance = attribution.importance_by_feature(_phi(spark, sf), n)
    return _rounded(attribution.importance_by_variable(importance), ["importance"])


@query(
    "attribution_by_category",
    f"""WITH {_PHI} SELECT o_orderpriority AS category, count(*) AS n, round_even(avg(phi), 6) AS mean_phi
FROM phi JOIN orders ON row_id = o_orderkey AND feature = 'o_orderpriority=' || o_orderpriority GROUP BY 1""",
)
def attribution_by_category(spark, sf):
    effect = attribution.effect_by_category(_phi(spark, sf), read(spark, sf, "orders"), "o_orderkey", "o_orderpriority")
    return _rounded(effect, ["mean_phi"])


@query(
    "importance_bars",
    f"WITH {_PHI} SELECT feature, round_even(avg(abs(phi)), 4) AS importance FROM phi GROUP BY 1",
)
def importance_bars(spark, sf):
    return reports.importance_bars(_rounded(attribution.importance_by_feature(_phi(spark, sf)), ["importance"], 4), "feature")


_HEAT = """g AS (SELECT o_orderpriority AS cluster, round_even(avg(o_totalprice), 2) AS price, round_even(avg(o_custkey), 2) AS PC_FAMILIAS_POBREZA FROM orders GROUP BY 1)"""


@query(
    "cluster_heat",
    f"""WITH {_HEAT} SELECT cluster, 'price' AS feature, price AS value, round_even((price - (SELECT avg(price) FROM g)) / (SELECT stddev_samp(price) FROM g), 4) AS zscore FROM g
UNION ALL SELECT cluster, 'PC_FAMILIAS_POBREZA', PC_FAMILIAS_POBREZA,
  round_even(-(PC_FAMILIAS_POBREZA - (SELECT avg(PC_FAMILIAS_POBREZA) FROM g)) / (SELECT stddev_samp(PC_FAMILIAS_POBREZA) FROM g), 4) FROM g""",
)
def cluster_heat(spark, sf):
    orders = read(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("cluster"), F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("PC_FAMILIAS_POBREZA")
    )
    features = ["price", "PC_FAMILIAS_POBREZA"]
    return _rounded(reports.cluster_heat(agg.group_profile(orders, "cluster", features), "cluster", features), ["zscore"], 4)


@query(
    "report_roundtrip",
    "SELECT cast(o_orderpriority AS varchar) AS o_orderpriority, count(*) AS n FROM orders GROUP BY 1",
)
def report_roundtrip(spark, sf):
    counts = agg.value_counts(read(spark, sf, "orders"), ["o_orderpriority"])
    path = write_report(counts, scratch_path(spark, "report"))
    return read_report(spark, path, "o_orderpriority string, n bigint")
