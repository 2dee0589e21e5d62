import threading

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from edugauge.functions.dictionaries import STATE_REGIONS
from edugauge.ml import attribution as shap
from edugauge.ml import clustering, features, models, municipal, nested, tuning
from edugauge.operators import evaluation, sampling


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(1200):
        region = ["N", "S", "E"][i % 3]
        x = float(np.round(rng.normal(), 1))
        y = int(rng.random() < 1 / (1 + np.exp(-(1.5 * x + (region == "N")))))
        rows.append((i, None if i % 50 == 0 else x, None if i % 40 == 1 else region, int(i % 2), y, float(rng.choice([0.5, 1.0, 2.0]))))
    return spark.createDataFrame(rows, "id int, x double, region string, dep int, label int, weight double").persist()


def test_roles_cover_fifty_columns_once():
    listed = [c for columns in features.COLUMN_ROLES.values() for c in columns]
    assert len(listed) == len(set(listed)) == 50
    assert features.feature_columns(False) == ["REGIAO", "SG_UF", "TP_DEPENDENCIA"]
    assert len(features.feature_columns(True, True)) == 9


def test_role_check_reports_unknown_columns(spark):
    with pytest.raises(ValueError, match="without a role"):
        features.check_roles(spark.range(1))


def test_preprocessing_uses_median_mode_and_population_scale(spark, frame):
    pre = features.fit_preprocessor(frame, ["x"], ["region", "dep"])
    assert pre.feature_names == ["x", "region=E", "region=N", "region=S", "dep=0", "dep=1"]
    xs = [r["x"] for r in frame.collect()]
    median = np.median([x for x in xs if x is not None])
    filled = np.array([median if x is None else x for x in xs])
    odd = spark.createDataFrame([(None, None, 0), (1.0, "unseen", 1)], "x double, region string, dep int")
    out = [r[0] for r in pre.transform(odd).select(vector_to_array("features")).collect()]
    regions = [r["region"] for r in frame.collect()]
    mode = min(set(regions) - {None}, key=lambda r: (-regions.count(r), r))
    assert out[0][0] == pytest.approx((median - filled.mean()) / filled.std())
    assert out[0][1:4] == [float(mode == r) for r in "ENS"]
    assert out[1][1:4] == [0.0, 0.0, 0.0] and out[1][4:] == [0.0, 1.0]


def test_logistic_on_merged_rows_is_the_penalised_optimum(frame):
    fitted = models.fit(frame, models.LOGISTIC, ["x"], ["region"])
    pdf = fitted.preprocessor.transform(frame).select(vector_to_array("features").alias("f"), "label", "weight").toPandas()
    X, y, w = np.stack(pdf.f), pdf.label.to_numpy(), pdf.weight.to_numpy()
    beta, b = fitted.model.coefficients.toArray(), fitted.model.intercept
    residual = w * (1 / (1 + np.exp(-(X @ beta + b))) - y)
    assert np.abs(X.T @ residual + beta).max() < 1e-2 and abs(residual.sum()) < 1e-2


def test_comparison_and_group_report(frame):
    train, test = sampling.stratified_split(frame, "label", ["id"], 0.3)
    small = models.forest({"numTrees": 5, "maxDepth": 4, "minInstancesPerNode": 5})
    scenarios = {"plain": ([], ["region"]), "enriched": (["x"], ["region"])}
    table, fitted = models.compare(train, test, [models.LOGISTIC, small], scenarios)
    rows = {(r["model"], r["scenario"]): r for r in table.collect()}
    assert len(rows) == 4 and rows[("LogisticRegression", "enriched")]["roc_auc"] > rows[("LogisticRegression", "plain")]["roc_auc"]
    report = models.group_report(fitted[("RandomForest", "enriched")], test, "region").collect()
    assert {r["region"] for r in report} == {"N", "S", "E"}


def test_search_space_and_ranking(frame):
    assert len(tuning.grid(tuning.MUNICIPALITY_GRID)) == 36
    drawn = tuning.draws(tuning.PUPIL_SPACE, 10)
    assert drawn == tuning.draws(tuning.PUPIL_SPACE, 10)
    assert all(100 <= p["numTrees"] < 400 and 10 <= p["minInstancesPerNode"] < 200 for p in drawn)
    folded = sampling.stratified_folds(frame, "label", ["id"], 3)
    candidates = [{"numTrees": 3, "maxDepth": 1, "minInstancesPerNode": 400}, {"numTrees": 5, "maxDepth": 4, "minInstancesPerNode": 5}]
    table, best = tuning.search(folded, candidates, ["x"], ["region"])
    rows = table.collect()
    assert best == candidates[1] and [r["rank"] for r in rows] == [1, 2] and rows[0]["mean_auc"] > 0.6


def test_forest_grown_in_parts_is_one_model_of_all_its_trees(frame, monkeypatch):
    monkeypatch.setattr(models, "FOREST_TREES", 3)
    met, made = threading.Barrier(2), models.RandomForestClassifier

    class Together(made):
        def fit(self, rows):
            if self.getNumTrees() == 3:
                met.wait(timeout=120)  # broken if one part waits for the end of another
            return super().fit(rows)

    monkeypatch.setattr(models, "RandomForestClassifier", Together)
    params = {"numTrees": 8, "maxDepth": 4, "minInstancesPerNode": 5}
    fitted = models.fit(frame, models.forest(params), ["x"], ["region"])
    model = fitted.model
    assert model.getNumTrees == len(model.trees) == 8 and len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) > 4
    rows = fitted.preprocessor.transform(frame).limit(20).select("features").collect()
    for r in rows:
        assert model.predictProbability(r["features"])[1] == pytest.approx(np.mean([t.predictProbability(r["features"])[1] for t in model.trees]))
    again = models.fit(frame, models.forest(params), ["x"], ["region"]).model
    assert again.toDebugString.split("\n", 1)[1] == model.toDebugString.split("\n", 1)[1]
    assert models.evaluate(fitted, frame).first()["roc_auc"] > 0.6


def test_evaluation_scores_the_rows_once(spark, frame, monkeypatch):
    fitted = models.fit(frame, models.LOGISTIC, ["x"], ["region"])
    scored = spark.sparkContext.accumulator(0)

    def counted(score):
        scored.add(1)
        return score

    plain = models.Fitted.transform
    slow = F.udf(counted, "double")
    monkeypatch.setattr(models.Fitted, "transform", lambda self, df: plain(self, df).withColumn("score", slow("score")))
    assert models.evaluate(fitted, frame).first()["roc_auc"] > 0.6
    assert scored.value == frame.count()


@pytest.mark.parametrize("exact", [True, False])
def test_attribution_adds_up_and_matches_brute_force(spark, frame, exact):
    fitted = models.fit(frame, models.forest({"numTrees": 5, "maxDepth": 4, "minInstancesPerNode": 5}), ["x"], ["region", "dep"])
    explained = frame.filter("id < 12")
    phi = shap.shapley_values(fitted, explained, "id", frame, ["id"], background_rows=6, permutations=None if exact else 8).collect()
    assert len(phi) == 36
    scores = {r["id"]: r["score"] for r in fitted.transform(explained).collect()}
    for i in range(12):
        own = [r for r in phi if r["row_id"] == i]
        assert own[0]["prediction"] == pytest.approx(scores[i])
        assert sum(r["phi"] for r in own) == pytest.approx(own[0]["prediction"] - own[0]["base"], abs=1e-9)
    if exact:
        pool = sampling.seeded_sample(frame, ["id"], 6).collect()
        row = explained.filter("id = 5").first()
        mixes = [("x", "region", "dep"), ("x", "region"), ("x", "dep"), ("region", "dep"), ("x",), ("region",), ("dep",), ()]
        data = [(k, *[row[v] if v in mix else b[v] for v in ("x", "region", "dep")]) for k, mix in enumerate(mixes) for b in pool]
        scored = fitted.transform(spark.createDataFrame(data, "k int, x double, region string, dep int"))
        value = {mixes[r["k"]]: r["v"] for r in scored.groupBy("k").agg(F.avg("score").alias("v")).collect()}
        expected = (
            (value[("x",)] - value[()]) / 3 + (value[("x", "region")] - value[("region",)]) / 6
            + (value[("x", "dep")] - value[("dep",)]) / 6 + (value[("x", "region", "dep")] - value[("region", "dep")]) / 3
        )
        assert next(r["phi"] for r in phi if r["row_id"] == 5 and r["feature"] == "x") == pytest.approx(expected)


def test_attribution_takes_all_background_rows_and_the_leaf_sums_equal_the_expansion(spark, frame):
    fitted = models.fit(frame, models.forest({"numTrees": 5, "maxDepth": 4, "minInstancesPerNode": 5}), ["x"], ["region", "dep"])
    mean = fitted.transform(frame).agg(F.avg("score")).first()[0]
    explained, variables = frame.filter("id in (0, 1, 2, 7)"), ["x", "region", "dep"]
    phi = {(r["row_id"], r["feature"].split("=")[0]): r for r in shap.shapley_values(fitted, explained, "id", frame, ["id"]).collect()}
    assert len(phi) == 12 and all(r["base"] == pytest.approx(mean) for r in phi.values())
    others = frame.groupBy(*variables).agg((F.count(F.lit(1)) / 1200).alias("_w"))
    for r in expanded_sums(fitted, explained, others, variables, shap.exact_coefficients(3)).collect():
        assert [phi[r["row_id"], v]["phi"] for v in variables] == pytest.approx([r[f"_phi{i}"] for i in range(3)], abs=1e-9)


def expanded_sums(fitted, rows, others, variables, table):
    """Brute force: every row scored with every background profile in every coalition."""
    n, full = len(variables), (1 << len(variables)) - 1
    spread = rows.select(F.col("id").alias("row_id"), F.struct(*variables).alias("_own")).crossJoin(others.select(F.struct(*variables).alias("_other"), "_w"))
    spread = spread.withColumn("_mask", F.explode(F.array(*[F.lit(mask) for mask in sorted(table)])))
    taken = [F.when(F.col("_mask").bitwiseAND(F.lit(1 << i)) != 0, F.col(f"_own.{v}")).otherwise(F.col(f"_other.{v}")).alias(v) for i, v in enumerate(variables)]
    scored = fitted.transform(spread.select("row_id", "_own", "_w", "_mask", *taken))
    coefficients = rows.sparkSession.createDataFrame([(m, *v) for m, v in sorted(table.items())], "_m int, " + ", ".join(f"_c{i} double" for i in range(n)))
    mean = F.col("score") * F.col("_w")
    return scored.join(coefficients, F.col("_mask") == F.col("_m")).groupBy("row_id").agg(
        F.sum(F.when(F.col("_mask") == 0, mean)).alias("base"), F.sum(F.when(F.col("_mask") == full, mean)).alias("prediction"),
        *[F.sum(F.col(f"_c{i}") * mean).alias(f"_phi{i}") for i in range(n)],
    )


def test_logistic_attribution_is_exact_in_log_odds(frame):
    fitted = models.fit(frame, models.LOGISTIC, ["x"], ["region", "dep"])
    rows = shap.shapley_values(fitted, frame.filter("id < 60"), "id", frame, ["id"]).collect()
    margin = lambda p: np.log(p / (1 - p))
    scores = {r["id"]: margin(r["score"]) for r in fitted.transform(frame).collect()}
    for i in range(60):
        own = [r for r in rows if r["row_id"] == i]
        assert own[0]["prediction"] == pytest.approx(scores[i]) and own[0]["base"] == pytest.approx(np.mean(list(scores.values())))
        assert sum(r["phi"] for r in own) == pytest.approx(own[0]["prediction"] - own[0]["base"], abs=1e-9)
    # The value of x is its coefficient times its distance from the mean of the filled and scaled column, which is 0.
    pdf = fitted.preprocessor.transform(frame.filter("id < 60")).select("id", vector_to_array("features").alias("f")).toPandas().set_index("id")
    for r in rows:
        if r["feature"] == "x":
            assert r["phi"] == pytest.approx(fitted.model.coefficients[0] * pdf.f[r["row_id"]][0], abs=1e-9)


def municipal_tables(spark):
    rng = np.random.default_rng(1)
    states = ["CE", "SP", "PA", "RS"]
    meta, external, levels = [], [], []
    for town in range(120):
        base = 30 + 50 * (town % 4) / 3 + rng.normal() * 3
        state = states[town % 4]
        for year in (2023, 2024, 2025):
            rate = float(np.round(base + 3 * (year - 2023) + rng.normal(), 2))
            gap = round(rate - 60, 2)
            meta.append((year, town, f"T{town}", state, STATE_REGIONS[state], rate, gap, int(gap >= 0), round(rate - 80, 2)))
            levels.append((year, town, round(1 - rate / 100, 4)))
        external.append((town, 900.0 + 10 * base, 5.0, None if town == 7 else 30.0 - base / 4, 0.4, 0.3, 0.5))
    return (
        spark.createDataFrame(meta, "ANO_REFERENCIA int, CO_MUNICIPIO int, NO_MUNICIPIO string, SG_UF string, REGIAO string, PC_ALUNO_ALFABETIZADO double, DIF_META_ALFABETIZACAO double, IN_META_ATINGIDA int, DISTANCIA_META_2030 double"),
        spark.createDataFrame(external, "CO_MUNICIPIO int, RENDA_PER_CAPITA_MEDIA double, MEDIA_INSE double, PC_FAMILIAS_POBREZA double, PC_ESCOLAS_BIBLIOTECA double, PC_ESCOLAS_LAB_INFORMATICA double, PC_ESCOLAS_INTERNET_ALUNOS double"),
        spark.createDataFrame(levels, "ANO_REFERENCIA int, CO_MUNICIPIO int, INDICE_RISCO_ESTRUTURAL double"),
    )


def test_municipal_chain(spark):
    from edugauge.plans import municipal_model

    meta, external, levels = municipal_tables(spark)
    dataset = municipal.lag_dataset(meta, external)
    assert dataset.count() == 240 and "IN_META_ATINGIDA_ANTERIOR" in dataset.columns
    small = {"numTrees": 10, "maxDepth": 4, "minInstancesPerNode": 5}
    train, test = municipal_model.split(meta, external)
    reports, best = municipal_model.goal_model(train, test, small)
    assert reports["comparison"].count() == 2 and reports["class_report"].count() == 5
    importance = municipal_model.explain(best, train, test.limit(20), 4, 4)
    assert {r["variable"] for r in importance.collect()} == set(features.GOAL_NUMERIC + features.GOAL_CATEGORICAL)
    risk = municipal_model.risk(meta, external, levels, small)
    ranked = [r["PROBABILIDADE_RISCO_NAO_ATINGIR_META"] for r in risk["top"].collect()]
    assert ranked == sorted(ranked, reverse=True) and risk["ranking"].count() == 120
    assert risk["agreement"].first()["corr"] > 0.5


def test_restarts_on_few_rows_run_side_by_side_and_keep_their_order(spark, monkeypatch):
    met, made = threading.Barrier(2), clustering.KMeans

    class Together(made):
        def fit(self, vectors):
            met.wait(timeout=60)  # broken if one fit waits for the end of another
            return super().fit(vectors)

    monkeypatch.setattr(clustering, "KMeans", Together)
    vectors = clustering.standardised(spark.createDataFrame([(float(i), float(i % 7)) for i in range(60)], "a double, b double"), ["a", "b"])
    assert [m.getK() for m in clustering.fits_side_by_side(vectors, [(3, 1), (2, 2)])] == [3, 2]
    found = clustering.choose_clusters(vectors, 2, 3, restarts=2)
    costs = {k: min(made(k=k, seed=42 + i, maxIter=300, tol=1e-4).fit(vectors).summary.trainingCost for i in range(2)) for k in (2, 3)}
    assert [(r["k"], pytest.approx(r["cost"], rel=0.2)) for r in found.scores.collect()] == list(costs.items())


def test_clusters_are_numbered_by_literacy_and_skip_incomplete_rows(spark):
    from edugauge.plans import municipal_model

    meta, external, _ = municipal_tables(spark)
    found = municipal_model.clusters(meta, external, k_min=3, k_max=4, restarts=2)
    assert found["members"].count() == 119
    means = [r["PC_ALUNO_ALFABETIZADO"] for r in found["profile"].collect()]
    assert means == sorted(means, reverse=True)
    assert {r["k"] for r in found["scores"].collect()} == {3, 4}
    for r in found["by_region"].collect():
        assert sum(v for k, v in r.asDict().items() if k != "CLUSTER") == pytest.approx(100, abs=0.5)


def test_best_restart_has_lowest_cost(spark):
    meta, external, _ = municipal_tables(spark)
    vectors = clustering.standardised(clustering.profile_table(meta, external, 2025), features.PROFILE_FEATURES)
    many = clustering.best_of_restarts(vectors, 3, restarts=3).summary.trainingCost
    one = clustering.best_of_restarts(vectors, 3, restarts=1).summary.trainingCost
    assert many <= one + 1e-9


def walked(tree, depth):
    """Score of a tree at the features ``f`` if it stops at ``depth``, sibling leaves of equal prediction folded, node by node."""

    def end(i, level):
        if tree["left"][i] < 0 or level >= depth:
            return True
        left, right = tree["left"][i], tree["right"][i]
        return end(left, level + 1) and end(right, level + 1) and tree["prediction"][left] == tree["prediction"][right]

    def score(f):
        i, level = 0, 0
        while not end(i, level):
            split = tree["split"][i]
            value, listed = f[split["featureIndex"]], split["leftCategoriesOrThreshold"]
            goes_left = value <= listed[0] if split["numCategories"] < 0 else value in listed
            i, level = tree["left" if goes_left else "right"][i], level + 1
        return tree["p"][i]

    return score


def test_nested_scores_are_those_of_the_cut_trees(spark, frame, tmp_path):
    fitted = models.fit(frame, models.forest({"numTrees": 6, "maxDepth": 12, "minInstancesPerNode": 3}), ["x"], ["region", "dep"])
    rows = fitted.preprocessor.transform(frame.filter("id < 200")).select("features", "label").persist()
    cuts = [(6, 30), (6, 12), (3, 12), (6, 2), (2, 3), (1, 1)]
    whole = nested.nested_scores(fitted.model, rows, cuts)
    fitted.model.save(str(tmp_path / "m"))
    nodes = spark.read.parquet(str(tmp_path / "m/data")).select("treeID", "nodeData.*").toPandas().sort_values(["treeID", "id"])
    trees = []
    for _, own in nodes.groupby("treeID"):
        own = own.reset_index(drop=True)
        trees.append({
            "left": own.leftChild, "right": own.rightChild, "prediction": own.prediction,
            "p": [s[1] / sum(s) for s in own.impurityStats], "split": own.split,
        })
    vectors = [r[0] for r in rows.select(vector_to_array("features")).collect()]
    expected = sorted(tuple(round(float(np.mean([walked(t, depth)(f) for t in trees[:n]])), 9) for n, depth in cuts) for f in vectors)
    assert sorted(tuple(round(r[f"s{i}"], 9) for i in range(len(cuts))) for r in whole.collect()) == expected
    direct = sorted(round(r["score"], 9) for r in fitted.transform(frame.filter("id < 200")).select("score").collect())
    assert direct == sorted(e[0] for e in expected)


def test_nested_and_direct_fits_agree(frame):
    """AUC within 0.02 of a forest that is fitted with the parameters themselves: as far apart as forests of two seeds are."""
    train, test = sampling.stratified_split(frame, "label", ["id"], 0.3)
    cuts = [(40, 3), (80, 3), (40, 12), (80, 12)]
    deep = models.fit(train, models.forest({"numTrees": 80, "maxDepth": 12, "minInstancesPerNode": 10}), ["x"], ["region", "dep"])
    rows = deep.preprocessor.transform(test).select("features", "label")
    scored = nested.nested_scores(deep.model, rows, cuts).persist()
    for i, (trees, depth) in enumerate(cuts):
        direct = models.fit(train, models.forest({"numTrees": trees, "maxDepth": depth, "minInstancesPerNode": 10}), ["x"], ["region", "dep"])
        expected = models.evaluate(direct, test, None).first()["roc_auc"]
        found = evaluation.roc_auc(scored, "label", f"s{i}").first()["roc_auc"]
        assert found == pytest.approx(expected, abs=0.02)


def test_interrupted_search_goes_on_without_repeating_a_fit(frame, tmp_path, monkeypatch):
    folded = sampling.stratified_folds(frame, "label", ["id"], 3)
    grid = [{"numTrees": n, "maxDepth": d, "minInstancesPerNode": m} for n in (3, 5) for d in (2, 4) for m in (5, 50)]
    fits, real = [], tuning.fit_forest

    def counted(prepared, params):
        if len(fits) == 3 and not fits.count("resumed"):
            raise RuntimeError("the cluster is gone")
        fits.append(params)
        return real(prepared, params)

    monkeypatch.setattr(tuning, "fit_forest", counted)
    ledger = str(tmp_path / "ledger")
    with pytest.raises(RuntimeError, match="gone"):
        tuning.search(folded, grid, ["x"], ["region"], parallelism=1, ledger=ledger)
    assert len(fits) == 3
    fits[:] = ["resumed"]
    table, best = tuning.search(folded, grid, ["x"], ["region"], parallelism=1, ledger=ledger)
    assert len(fits) == 1 + 3  # six forests in all: two leaf sizes by three folds
    assert table.count() == 8
    again, same = tuning.search(folded, grid, ["x"], ["region"], ledger=ledger)
    assert len(fits) == 4 and same == best and again.collect() == table.collect()
    tuning.search(folded.filter("id < 900"), grid[:1], ["x"], ["region"], ledger=ledger)  # other data, other trials
    assert len(fits) == 7


def test_statistics_of_odd_columns(spark):
    rows = [(None, 1.0, None, "b"), (None, 2.0, None, "b"), (None, None, None, None), (None, 10.0, None, "a")]
    df = spark.createDataFrame(rows, "empty double, some double, blank string, text string")
    found = features.Statistics.of(df, ["empty", "some"], ["blank", "text"])
    assert found.number("empty") == (0.0, 0.0, 1.0) and found.number("some") == pytest.approx((2.0, 3.75, np.std([1, 2, 2, 10])))
    assert found.texts("blank") == ("", [""]) and found.texts("text") == ("b", ["a", "b"])
    none = features.fit_preprocessor(df.limit(0), ["some"], ["text"])
    assert none.transform(df).select("features").count() == 4
