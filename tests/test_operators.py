import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from edugauge.operators import aggregates as agg
from edugauge.operators import attribution, evaluation, joins, quality, reports, sampling, windows


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_guard_unique_raises_on_repeated_key(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    fact = spark.createDataFrame([(1,)], "f int")
    with pytest.raises(Exception, match="not unique"):
        joins.left_join_dim(fact, dim, [("f", "k")]).collect()


@pytest.mark.parametrize("limit", [None, 1, 100])
def test_left_join_keeps_rows_and_null_keys(spark, limit):
    fact = spark.createDataFrame([(1,), (2,), (None,), (1,)], "f int")
    dim = spark.createDataFrame([(1, "a"), (3, "c")], "k int, v string")
    out = joins.left_join_dim(fact, dim, [("f", "k")], broadcast_rows=limit)
    assert rows(out) == rows(spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, None)], "f int, v string"))


def test_broadcast_only_within_the_bound(spark):
    dim = spark.range(10)
    assert joins.broadcast_within(dim, 9) is dim
    hinted = joins.broadcast_within(dim, 10)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString()


def test_single_row_side(spark):
    df = spark.range(2)
    one = spark.createDataFrame([(5, "x")], "a int, b string")
    assert rows(joins.attach_single_row(df, one, ["a", "b"])) == [(0, 5, "x"), (1, 5, "x")]
    with pytest.raises(Exception, match="empty"):
        joins.attach_single_row(df, one.filter("a > 9"), ["a"]).collect()
    with pytest.raises(Exception):
        joins.attach_single_row(df, one.union(one), ["a"]).collect()


def test_calendar_lag_skips_gap_years_but_positional_change_does_not(spark):
    df = spark.createDataFrame([(1, 2023, 1.0), (1, 2025, 4.0), (2, 2024, 2.0), (2, 2025, 2.0)], "k int, y int, v double")
    assert rows(joins.calendar_lag(df, ["k"], "y", ["v"])) == [(2, 2025, 2.0, 2.0)]
    changed = windows.change_vs_previous(df, ["k"], "y", {"d": "v"}).withColumn("t", windows.trend_label("d"))
    assert rows(changed) == [
        (1, 2023, 1.0, None, None), (1, 2025, 4.0, 3.0, "Melhorou"), (2, 2024, 2.0, None, None), (2, 2025, 2.0, 0.0, "Estável"),
    ]


def test_truncated_code(spark):
    df = spark.createDataFrame([(1200013,), (1100023,)], "c int")
    dim = spark.createDataFrame([(120001, 9.0)], "s int, v double")
    assert rows(joins.truncated_code_join(df, dim, "c", "s")) == [(1100023, None), (1200013, 9.0)]


def test_latest_and_first(spark):
    df = spark.createDataFrame([(1, 2024, "a"), (1, 2025, None), (2, 2023, "z")], "k int, y int, v string")
    assert rows(windows.latest_per_key(df, ["k"], "y")) == [(1, 2025, None), (2, 2023, "z")]
    assert rows(windows.dedupe_first(df, ["k"], "y")) == [(1, 2024, "a"), (2, 2023, "z")]
    assert rows(windows.latest_per_key(df, [], "y")) == [(1, 2025, None)]
    assert rows(windows.latest_per_key(df.filter("k > 5"), [], "y")) == []


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_equal_brute_force_on_skewed_axis(spark, descending):
    rng = random.Random(1)
    data = {round(rng.random() ** 8, 6): rng.randint(1, 9) for _ in range(3000)}
    df = spark.createDataFrame(list(data.items()), "x double, n int").repartition(5)
    got = {r["x"]: r["upto"] for r in windows.running_totals(df, "x", {"upto": "n"}, descending=descending).collect()}
    total, expected = 0, {}
    for x in sorted(data, reverse=descending):
        total += data[x]
        expected[x] = total
    assert got == expected


def test_exact_quantiles_with_heavy_ties(spark):
    rng = np.random.default_rng(3)
    values = np.where(rng.random(2000) < 0.4, 7.0, np.round(rng.normal(10, 5, 2000), 2))
    df = spark.createDataFrame([(float(v), float(i)) for i, v in enumerate(values)], "a double, b double")
    got = {(r["column_name"], r["p"]): r["value"] for r in agg.exact_quantiles(df, ["a", "b"], [0, 0.25, 0.5, 0.9, 1]).collect()}
    for p in (0, 0.25, 0.5, 0.9, 1):
        assert got[("a", float(p))] == pytest.approx(np.quantile(values, p))
        assert got[("b", float(p))] == pytest.approx(np.quantile(np.arange(2000.0), p))


def test_weighted_rate_leaves_out_unweighted_rows(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 0, 2.0), ("a", 1, None), (None, 1, 1.0)], "g string, y int, w double")
    assert rows(agg.weighted_rate(df, "y", "w", ["g"])) == [("a", 50.0)]
    assert agg.weighted_rate(df, "y", "w").first()[0] == 60.0


def test_histogram_of_flat_and_empty_bins(spark):
    flat = agg.histogram(spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in flat] == [0, 0, 2, 0]
    ends = agg.histogram(spark.createDataFrame([(0.0,), (1.0,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in ends] == [1, 0, 0, 1]


def test_crosstab_has_zero_cells(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), (None, "x")], "r string, c string")
    assert rows(agg.crosstab(df, "r", "c", ["x", "y"])) == [("a", 2, 0), ("b", 0, 1)]
    assert rows(agg.crosstab(df, "r", "c", ["x", "y"], percent=True)) == [("a", 100.0, 0.0), ("b", 0.0, 100.0)]


def scored(spark, n=400, seed=5):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        score = round(rng.random(), 1)
        label = int(rng.random() < score)
        data.append((i, label, score, int(score >= 0.5), rng.choice([0.5, 1.0, 2.0]), rng.choice(["a", "b", None])))
    return data, spark.createDataFrame(data, "id int, label int, score double, pred int, w double, g string")


def test_auc_with_ties_equals_pairwise_definition(spark):
    data, df = scored(spark)
    num = den = 0.0
    for _, y1, s1, _, w1, _ in data:
        for _, y0, s0, _, w0, _ in data:
            if y1 == 1 and y0 == 0:
                den += w1 * w0
                num += w1 * w0 * (1.0 if s1 > s0 else 0.5 if s1 == s0 else 0.0)
    assert evaluation.roc_auc(df, "label", "score", "w").first()[0] == pytest.approx(num / den)


def test_metrics_and_confusion_add_up(spark):
    data, df = scored(spark)
    total = sum(r[4] for r in data)
    m = evaluation.binary_metrics(df, "label", "pred", "w", "score").first()
    assert m["tn"] + m["fp"] + m["fn"] + m["tp"] == pytest.approx(total)
    assert m["accuracy"] == pytest.approx(sum(r[4] for r in data if r[1] == r[3]) / total)
    heat = reports.confusion_heat(evaluation.confusion(df, "label", "pred", "w")).collect()
    assert sum(r["pct"] for r in heat) == pytest.approx(100)


def test_groups_without_predictions_or_positives_get_zero(spark):
    df = spark.createDataFrame([("a", 1, 0, 1.0), ("a", 0, 0, 3.0), ("b", 0, 1, 1.0), ("c", 1, 1, 1.0), (None, 1, 1, 1.0)], "g string, label int, pred int, w double")
    got = evaluation.group_metrics(df, "g", "label", "pred", "w")
    assert [tuple(r) for r in got.collect()] == [("b", 1, 0.0, 0.0, 0.0, 0.0), ("a", 2, 0.25, 0.75, 0.0, 0.0), ("c", 1, 1.0, 1.0, 1.0, 1.0)]
    assert tuple(evaluation.degenerate_groups(got).first()) == (2, 1, 3, 3)


def test_threshold_report_equals_brute_force(spark):
    data, df = scored(spark)
    risk = [(1 - r[1], round(1 - r[2], 1)) for r in data]
    df = df.withColumn("risk", F.round(1 - F.col("score"), 1))
    positives = sum(y for y, _ in risk)

    def at(t):
        hit = [y for y, s in risk if s >= t]
        p, r = (sum(hit) / len(hit) if hit else 0.0), sum(hit) / positives
        return p, r, 2 * p * r / (p + r) if p + r else 0.0

    cuts = sorted({s for _, s in risk})
    best = max(cuts, key=lambda t: (at(t)[2], -t))
    enough = max((t for t in cuts if at(t)[1] >= 0.8), key=lambda t: (at(t)[0], -t))
    got = {r["strategy"]: r for r in evaluation.threshold_report(df, "label", "risk").collect()}
    for name, t in (("padrao_0.5", 0.5), ("f1_otimo", best), ("recall_minimo_80%", enough)):
        assert got[name]["threshold"] == t
        assert (got[name]["precision"], got[name]["recall"], got[name]["f1"]) == pytest.approx(at(t))


def test_recall_row_is_absent_when_unreachable(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, risk double")
    assert {r["strategy"] for r in evaluation.threshold_report(df, "label", "risk").collect()} == {"padrao_0.5", "f1_otimo"}


def test_stratified_split_is_exact_and_independent_of_partitioning(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 < 3).cast("int"))
    train, test = sampling.stratified_split(df, "y", ["id"], 0.3)
    assert rows(test.groupBy("y").count()) == [(0, 210), (1, 90)]
    assert train.count() == 700 and train.join(test, "id").count() == 0
    again = sampling.stratified_split(df.repartition(7), "y", ["id"], 0.3)[1]
    assert rows(again) == rows(test)
    other = sampling.stratified_split(df, "y", ["id"], 0.3, seed=7)[1]
    assert rows(other) != rows(test)


def test_sample_and_folds(spark):
    df = spark.range(1003).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    sample = sampling.stratified_sample(df, "y", ["id"], 100)
    assert rows(sample.groupBy("y").count()) == [(0, 75), (1, 25)]
    folds = sampling.stratified_folds(df, "y", ["id"], 5)
    sizes = folds.groupBy("y", "fold").count().collect()
    assert len(sizes) == 10 and folds.count() == 1003
    for y in (0, 1):
        n = [r["count"] for r in sizes if r["y"] == y]
        assert max(n) - min(n) <= 1
    tiny = sampling.stratified_folds(spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id int, y int"), "y", ["id"], 5)
    assert sorted(r["fold"] for r in tiny.collect()) == [0, 0, 1]


def test_quality_checks_and_require(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (1, "a")], "k int, v string")
    checks = quality.union_checks(
        [quality.check_primary_key(df, ["k"], "t"), quality.check_not_null(df, ["k", "v"], "t"), quality.check_schema(df, ["z"], "t")]
    )
    assert {(r["check"], r["n_bad"]) for r in checks.collect()} == {("primary_key(k)", 2), ("not_null(k)", 0), ("not_null(v)", 1), ("schema(z)", 1)}
    with pytest.raises(quality.QualityError, match="primary_key"):
        quality.require(checks)
    quality.require(checks.filter("n_bad = 0"))
    assert quality.check_years(df.filter("k > 9").withColumnRenamed("k", "y"), "y").first()["n_bad"] == 1
    dim = spark.createDataFrame([(1,), (1,)], "d int")
    fact = spark.createDataFrame([(1,), (2,), (None,)], "f int")
    assert quality.check_foreign_key(fact, dim, "f", "d").first()["n_bad"] == 2


def test_leakage(spark):
    df = spark.createDataFrame([(743.0, 1), (742.9, 0), (None, 0), (800.0, 0), (None, 1)], "s double, t int")
    assert quality.check_leakage(df, "s", "t").first()["n_bad"] == 2
    assert quality.leakage_table(df, "s", "t").count() == 5


def test_table_profile_frames(spark):
    df = spark.createDataFrame([(1, 2023, 1), (2, 2024, None)], "id int, y int, t int")
    found = quality.table_profile(df, "y", "t", ["id"], 1)
    assert tuple(found["size"].first()) == (2, 3)
    assert found["nulls"].first()["column_name"] == "t" and found["sample"].count() == 1


def test_attribution_rollups(spark):
    phi = spark.createDataFrame([("r1", "c=a", 0.5), ("r2", "c=b", -0.25), ("r1", "n", 0.1), ("r2", "n", -0.3)], "row_id string, feature string, phi double")
    n = spark.range(2).agg(F.count("*"))
    importance = attribution.importance_by_feature(phi, n)
    assert {r["feature"]: r["importance"] for r in importance.collect()} == pytest.approx({"c=a": 0.25, "c=b": 0.125, "n": 0.2})
    assert {r["variable"]: r["importance"] for r in attribution.importance_by_variable(importance).collect()} == pytest.approx({"c": 0.375, "n": 0.2})
    cats = spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r3", "unseen")], "id string, c string")
    assert rows(attribution.effect_by_category(phi, cats, "id", "c")) == [("a", 1, 0.5), ("b", 1, -0.25)]


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_many_ranges_and_groups_of_ranges(spark, monkeypatch, descending):
    """Ranges of a few rows, groups of three ranges, a class with most of the rows, and a null class."""
    monkeypatch.setattr(windows, "RANGE_FANOUT", 3)
    rng = random.Random(8)
    rows = [(k, float(x), rng.randrange(5), rng.randrange(9)) for k, n in (("a", 150), ("b", 12), ("c", 1), (None, 9)) for x in rng.sample(range(1000), n)]
    df = spark.createDataFrame(rows, "k string, x double, n long, m long").repartition(3)
    got = windows.running_totals(df, "x", {"upto": "n", "others": "m"}, by="k", descending=descending, range_rows=7).collect()
    assert sorted(got[0].asDict()) == ["k", "m", "n", "others", "upto", "x"] and len(got) == len(rows)
    for r in got:
        before = [s for s in rows if s[0] == r["k"] and (s[1] >= r["x"] if descending else s[1] <= r["x"])]
        assert (r["upto"], r["others"]) == (sum(s[2] for s in before), sum(s[3] for s in before))
    assert windows.running_totals(df.limit(0), "x", {"upto": "n"}).count() == 0
