"""Model-free evaluation on a scored table ``(label, prediction, score, weight[, group])``.

Every figure comes from conditional sums or from the table of distinct scores, so a scored
table of any length is reduced map-side first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edugauge.functions.numeric import safe_ratio
from edugauge.operators.windows import running_totals
from edugauge.session import cut_lineage


def _weight(weight: str | None) -> Column:
    return F.col(weight).cast("double") if weight else F.lit(1.0)


def _cells(label: str, prediction: str, weight: str | None) -> dict[str, Column]:
    """Weighted sums of the four cells of a binary confusion matrix."""
    w = _weight(weight)

    def cell(real: int, predicted: int) -> Column:
        hit = (F.col(label) == real) & (F.col(prediction) == predicted)
        return F.coalesce(F.sum(F.when(hit, w)), F.lit(0.0))

    return {"tn": cell(0, 0), "fp": cell(0, 1), "fn": cell(1, 0), "tp": cell(1, 1)}


def _ratios() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {
        "accuracy": safe_ratio(tn + tp, tn + fp + fn + tp),
        "precision": safe_ratio(tp, tp + fp),
        "recall": safe_ratio(tp, tp + fn),
        "f1": safe_ratio(2 * tp, 2 * tp + fp + fn),
    }


def majority_share(df: DataFrame, label: str, weight: str | None = None, alias: str = "majority_share") -> DataFrame:
    """Accuracy of always predicting the heaviest class."""
    per_class = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.sum(_weight(weight)).alias("_w"))
    return per_class.agg((F.max("_w") / F.nullif(F.sum("_w"), F.lit(0.0))).alias(alias))


def confusion(df: DataFrame, label: str, prediction: str, weight: str | None = None) -> DataFrame:
    """Weighted confusion matrix: one row per real class, one column per predicted class."""
    cells = df.agg(*[c.alias(n) for n, c in _cells(label, prediction, weight).items()])
    rows = F.array(
        F.struct(F.lit("real_0").alias("real"), F.col("tn").alias("predito_0"), F.col("fp").alias("predito_1")),
        F.struct(F.lit("real_1").alias("real"), F.col("fn").alias("predito_0"), F.col("tp").alias("predito_1")),
    )
    return cells.select(F.inline(rows))


def confusion_shares(matrix: DataFrame) -> DataFrame:
    """Tidy confusion cells with their percentage of the total."""
    cells = matrix.select(
        "real",
        F.inline(
            F.array(
                F.struct(F.lit("predito_0").alias("predito"), F.col("predito_0").alias("value")),
                F.struct(F.lit("predito_1").alias("predito"), F.col("predito_1").alias("value")),
            )
        ),
    )
    total = cells.agg(F.sum("value")).scalar()
    return cells.withColumn("pct", safe_ratio(F.col("value") * 100, total))


def binary_metrics(
    df: DataFrame, label: str, prediction: str, weight: str | None = None, score: str | None = None
) -> DataFrame:
    """Accuracy, majority share, precision, recall, F1 (and ROC AUC) of class 1, in one row."""
    w = _weight(weight)
    zero = F.coalesce(F.sum(F.when(F.col(label) == 0, w)), F.lit(0.0))
    one = F.coalesce(F.sum(F.when(F.col(label) == 1, w)), F.lit(0.0))
    sums = df.agg(
        *[c.alias(n) for n, c in _cells(label, prediction, weight).items()], zero.alias("_w0"), one.alias("_w1")
    )
    majority = safe_ratio(F.greatest("_w0", "_w1"), F.col("_w0") + F.col("_w1"))
    ratios = _ratios()
    out = sums.select(
        ratios["accuracy"].alias("accuracy"),
        majority.alias("majority_share"),
        *[ratios[n].alias(n) for n in ("precision", "recall", "f1")],
        "tn", "fp", "fn", "tp",
    )
    if score:
        out = out.withColumn("roc_auc", roc_auc(df, label, score, weight).scalar())
    return out


def class_report(df: DataFrame, label: str, prediction: str, weight: str | None = None) -> DataFrame:
    """Per-class precision, recall, F1 and support, with accuracy, macro and weighted averages."""
    cells = df.agg(*[c.alias(n) for n, c in _cells(label, prediction, weight).items()])
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def line(name: str, hit: Column, false_hit: Column, miss: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            safe_ratio(hit, hit + false_hit).alias("precision"),
            safe_ratio(hit, hit + miss).alias("recall"),
            safe_ratio(2 * hit, 2 * hit + false_hit + miss).alias("f1"),
            (hit + miss).alias("support"),
        )

    both = cells.select(line("0", tn, fn, fp).alias("a"), line("1", tp, fp, fn).alias("b"), "tn", "tp")
    total = F.col("a.support") + F.col("b.support")
    accuracy = safe_ratio(F.col("tn") + F.col("tp"), total)
    names = ("precision", "recall", "f1")
    macro = F.struct(
        F.lit("macro avg").alias("class"),
        *[((F.col(f"a.{n}") + F.col(f"b.{n}")) / 2).alias(n) for n in names],
        total.alias("support"),
    )
    weighted = F.struct(
        F.lit("weighted avg").alias("class"),
        *[
            safe_ratio(F.col(f"a.{n}") * F.col("a.support") + F.col(f"b.{n}") * F.col("b.support"), total).alias(n)
            for n in names
        ],
        total.alias("support"),
    )
    overall = F.struct(
        F.lit("accuracy").alias("class"), *[accuracy.alias(n) for n in names], total.alias("support")
    )
    return both.select(F.inline(F.array(F.col("a"), F.col("b"), overall, macro, weighted)))


def group_metrics(df: DataFrame, group: str, label: str, prediction: str, weight: str | None = None) -> DataFrame:
    """Size, true rate, accuracy, precision and recall per group, by ascending true rate.

    One partial aggregate of a handful of sums per group; rows without a group are left out.
    """
    w = _weight(weight)
    known = df.filter(F.col(group).isNotNull())
    sums = known.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(w).alias("_w"),
        F.sum(F.col(label) * w).alias("_hit"),
        *[c.alias(n) for n, c in _cells(label, prediction, weight).items()],
    )
    ratios = _ratios()
    return sums.select(
        group,
        "n",
        (F.col("_hit") / F.nullif(F.col("_w"), F.lit(0.0))).alias("true_rate"),
        *[ratios[n].alias(n) for n in ("accuracy", "precision", "recall")],
    ).orderBy(F.asc_nulls_last("true_rate"), F.asc(group))


def degenerate_groups(metrics: DataFrame, column: str = "recall", upper: float = 0.99) -> DataFrame:
    """How many groups are predicted all-or-nothing, out of how many."""
    degenerate = (F.col(column) == 0) | (F.col(column) >= upper)
    return metrics.agg(
        F.count_if(F.col(column) == 0).cast("bigint").alias("n_zero"),
        F.count_if(F.col(column) >= upper).cast("bigint").alias("n_full"),
        F.count_if(degenerate).cast("bigint").alias("n_degenerate"),
        F.count(F.lit(1)).alias("n_groups"),
    )


def score_totals(df: DataFrame, label: str, score: str, weight: str | None = None, target: int = 1) -> DataFrame:
    """Distinct scores with the positive and negative weight they carry."""
    w = _weight(weight)
    return (
        df.filter(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(
            F.coalesce(F.sum(F.when(F.col(label) == target, w)), F.lit(0.0)).alias("pos"),
            F.coalesce(F.sum(F.when(F.col(label) != target, w)), F.lit(0.0)).alias("neg"),
        )
    )


def roc_auc(df: DataFrame, label: str, score: str, weight: str | None = None, alias: str = "roc_auc") -> DataFrame:
    """Weighted area under the ROC curve; equal scores form one point of the curve.

    Sums, over distinct scores, the negative weight times the positive weight above it plus
    half of the tied positive weight.
    """
    curve = running_totals(
        score_totals(df, label, score, weight), "score", {"tp": "pos"}, descending=True
    )
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return curve.agg((area / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0.0))).alias(alias))


def precision_recall_curve(df: DataFrame, label: str, score: str, target: int = 0) -> DataFrame:
    """One row per distinct score taken as the threshold ``score >= t`` (unweighted)."""
    totals = cut_lineage(score_totals(df, label, score, None, target))
    positives = totals.agg(F.sum("pos")).scalar()
    curve = running_totals(totals, "score", {"tp": "pos", "fp": "neg"}, descending=True, stored=True)
    tp, fp = F.col("tp"), F.col("fp")
    return curve.select(
        F.col("score").alias("threshold"),
        "tp",
        "fp",
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, positives).alias("recall"),
        safe_ratio(2 * tp, tp + fp + positives).alias("f1"),
    )


def threshold_report(
    df: DataFrame,
    label: str,
    score: str,
    target: int = 0,
    min_recall: float = 0.80,
    default: float = 0.5,
) -> DataFrame:
    """Default threshold, F1-optimal threshold, and the most precise one with enough recall.

    ``score`` is the probability of ``target``. Equal figures go to the lowest threshold; the
    recall row is absent when no threshold reaches ``min_recall``. All three rows come out of
    one aggregate over the curve.
    """
    curve = precision_recall_curve(df, label, score, target)
    point = F.struct("threshold", "precision", "recall", "f1")
    enough = F.col("recall") >= F.lit(min_recall)
    picked = curve.agg(
        F.min(F.when(F.col("threshold") >= default, F.struct("threshold", "precision", "recall", "f1"))).alias("base"),
        F.max_by(point, F.struct(F.col("f1"), -F.col("threshold"))).alias("f1"),
        F.max_by(
            F.when(enough, point), F.when(enough, F.struct(F.col("precision"), -F.col("threshold")))
        ).alias("recall"),
    )
    zero = F.lit(0.0)

    def line(name: str, source: str, threshold: Column) -> Column:
        return F.struct(
            F.lit(name).alias("strategy"),
            threshold.alias("threshold"),
            *[F.coalesce(F.col(f"{source}.{m}"), zero).alias(m) for m in ("precision", "recall", "f1")],
        )

    rows = F.array(
        line(f"padrao_{default}", "base", F.lit(float(default))),
        line("f1_otimo", "f1", F.col("f1.threshold")),
        line(f"recall_minimo_{min_recall:.0%}", "recall", F.col("recall.threshold")),
    )
    return picked.select(F.inline(rows)).filter(F.col("threshold").isNotNull())


def best_scenario(results: DataFrame, order: Sequence[str], metric: str = "roc_auc") -> DataFrame:
    """Row with the greatest metric; among equals the first in ``order``."""
    return results.orderBy(F.desc_nulls_last(metric), *[F.asc(c) for c in order]).limit(1)
