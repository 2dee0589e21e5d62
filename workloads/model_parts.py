"""The parts of the municipality models that SQL can express: figures of preprocessing, and attribution in log-odds for stated coefficients."""

from __future__ import annotations

from pyspark.sql import functions as F

from edugauge import functions as fn
from edugauge.ml import attribution, municipal
from edugauge.ml.features import GOAL_CATEGORICAL, GOAL_NUMERIC, Statistics, fit_preprocessor, fit_statistics
from edugauge.session import cut_lineage
from workloads.layers import _EXTERNAL, _META, _SILVER, _meta_and_external
from workloads.registry import query
from workloads.standin import duck

TRAIN, TEST = 2024, 2025


def _frame(spark, sf):
    """The labelled dataset of the goal model, all years."""
    return cut_lineage(municipal.labelled(municipal.lag_dataset(*_meta_and_external(spark, sf))))


_LAG = f"""lagged AS (SELECT a.ANO_REFERENCIA AS ano, a.ANO_REFERENCIA || '|' || a.CO_MUNICIPIO AS row_id, a.SG_UF, a.REGIAO,
    b.PC_ALUNO_ALFABETIZADO AS PC_ALUNO_ALFABETIZADO_ANTERIOR, b.DIF_META_ALFABETIZACAO AS DIF_META_ALFABETIZACAO_ANTERIOR,
    b.IN_META_ATINGIDA AS IN_META_ATINGIDA_ANTERIOR, {_EXTERNAL}
  FROM meta a JOIN meta b ON a.CO_MUNICIPIO = b.CO_MUNICIPIO AND a.ANO_REFERENCIA = b.ANO_REFERENCIA + 1
  LEFT JOIN externa x ON a.CO_MUNICIPIO = x.CO_MUNICIPIO),
nums AS ({" UNION ALL ".join(f"SELECT ano, row_id, {i} AS nr, '{c}' AS column_name, {c}::double AS v FROM lagged" for i, c in enumerate(GOAL_NUMERIC))}),
cats AS ({" UNION ALL ".join(f"SELECT ano, row_id, {i} AS nr, '{c}' AS column_name, {c}::varchar AS v FROM lagged" for i, c in enumerate(GOAL_CATEGORICAL))})"""


def _figures(where: str) -> str:
    return f"""fills AS (SELECT column_name, coalesce(quantile_cont(v, 0.5), 0) AS fill FROM nums WHERE {where} GROUP BY 1),
num AS (SELECT column_name, nr, any_value(fill) AS fill, avg(coalesce(v, fill)) AS mean, stddev_pop(coalesce(v, fill)) AS deviation
  FROM nums JOIN fills USING (column_name) WHERE {where} GROUP BY 1, 2),
mode_of AS (SELECT column_name, nr, v AS mode FROM cats WHERE {where} AND v IS NOT NULL GROUP BY 1, 2, 3
  QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, v) = 1),
cat AS (SELECT column_name, nr, mode, (SELECT string_agg(DISTINCT v, '|' ORDER BY v) FROM cats c WHERE c.column_name = m.column_name AND {where}) AS categories FROM mode_of m)"""


@query(
    "fit_statistics",
    duck(
        """SELECT column_name, fill, round_even(mean, 6) AS mean, round_even(deviation, 6) AS deviation, NULL::varchar AS mode, NULL::varchar AS categories FROM num
UNION ALL SELECT column_name, NULL, NULL, NULL, mode, categories FROM cat""",
        ",\n".join((_SILVER, _META, _LAG, _figures("true"))),
    ),
)
def fit_statistics_of_goals(spark, sf):
    found = fit_statistics(_frame(spark, sf), GOAL_NUMERIC, GOAL_CATEGORICAL)
    rounded = {c: fn.round_half_even(c, 6) for c in ("mean", "deviation")}
    return found.withColumns({**rounded, "categories": F.array_join("categories", "|")})


def stated_coefficient(slot: int) -> float:
    """Coefficient of a slot of the feature vector, from a rule instead of a fit."""
    return ((slot * 7 + 3) % 11 - 5) / 10


INTERCEPT = 0.1
_SLOT = "((({slot}) * 7 + 3) % 11 - 5) / 10.0::double"


@query(
    "goal_log_odds",
    duck(
        f"""SELECT t.row_id, feature, round_even(term - mean_term, 6) AS phi, round_even(base, 6) AS base, round_even(prediction, 6) AS prediction
FROM terms t JOIN means USING (column_name) JOIN (SELECT row_id, {INTERCEPT} + sum(term) AS prediction FROM terms GROUP BY 1) p ON p.row_id = t.row_id
  CROSS JOIN (SELECT {INTERCEPT} + sum(mean_term) AS base FROM means) b WHERE t.ano = {TEST}""",
        ",\n".join(
            (
                _SILVER, _META, _LAG, _figures(f"ano = {TRAIN}"),
                f"""slots AS (SELECT column_name, v, {len(GOAL_NUMERIC)} + row_number() OVER (ORDER BY nr, v) - 1 AS slot FROM (SELECT DISTINCT column_name, nr, v FROM cats WHERE ano = {TRAIN} AND v IS NOT NULL) s),
terms AS (SELECT ano, row_id, column_name, column_name AS feature, {_SLOT.format(slot="num.nr")} * (coalesce(v, fill) - mean) / coalesce(nullif(deviation, 0), 1) AS term FROM nums JOIN num USING (column_name)
  UNION ALL SELECT ano, row_id, cats.column_name, cats.column_name || '=' || coalesce(cats.v, 'null'), coalesce({_SLOT.format(slot="slot")}, 0) FROM cats JOIN cat USING (column_name)
    LEFT JOIN slots ON slots.column_name = cats.column_name AND slots.v = coalesce(cats.v, mode)),
means AS (SELECT column_name, avg(term) AS mean_term FROM terms WHERE ano = {TRAIN} GROUP BY 1)""",
            )
        ),
    ),
)
def goal_log_odds(spark, sf):
    """Attribution of a logistic model with stated coefficients: test rows against all training rows."""
    frame = _frame(spark, sf)
    train, test = frame.filter(F.col("ANO_REFERENCIA") == TRAIN), frame.filter(F.col("ANO_REFERENCIA") == TEST)
    preprocessor = fit_preprocessor(train, GOAL_NUMERIC, GOAL_CATEGORICAL, Statistics.of(train, GOAL_NUMERIC, GOAL_CATEGORICAL))
    coefficients = [stated_coefficient(i) for i in range(len(preprocessor.feature_names))]
    others = train.withColumn("_w", 1 / train.agg(F.count(F.lit(1))).scalar())
    rows = test.withColumn("row_id", F.concat_ws("|", "ANO_REFERENCIA", "CO_MUNICIPIO"))
    sums = attribution.additive_sums(preprocessor, coefficients, INTERCEPT, rows, "row_id", others)
    values = attribution.long_values(sums, preprocessor)
    return values.withColumns({c: fn.round_half_even(c, 6) for c in ("phi", "base", "prediction")})
