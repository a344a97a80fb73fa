"""Quantiles, samples, tests, fairness scores and impact on small inputs with known answers."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from evenhand.operators import disparity, fairness, forest, impact, models, quantiles, ranking, sampling, stats
from evenhand.session import written

MODELS = {"baseline": "pb", "fair": "pf"}


@pytest.mark.parametrize("shape", ["continuous", "hot", "few", "tails"])
def test_quantiles_are_exact(spark, shape):
    rng = random.Random(3)
    draw = {
        "continuous": rng.random,
        "hot": lambda: 5.0 if rng.random() < 0.4 else rng.uniform(0, 10),
        "few": lambda: float(rng.randrange(4)),
        "tails": lambda: math.exp(rng.gauss(0, 4)),
    }[shape]
    rows = [draw() for _ in range(5001)]
    df = spark.createDataFrame([(x, -x) for x in rows] + [(None, 1.0)], "a double, b double").repartition(5)
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    found = quantiles.exact_quantiles(df, ["a", "b"], probs).collect()
    assert len(found) == 2 * len(probs)
    for r in found:
        column = rows if r["column"] == "a" else [-x for x in rows] + [1.0]
        assert r["n"] == len(column)
        assert r["value"] == pytest.approx(np.quantile(column, r["prob"]), rel=1e-12, abs=1e-12)


def test_quantiles_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([(2.5, None)], "a double, b double")
    found = quantiles.exact_quantiles(df, ["a", "b"], (0.5,)).collect()
    assert [(r["column"], r["value"]) for r in found] == [("a", 2.5)]


def test_fixed_size_sample_is_the_lowest_hashes_and_repeats(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    digest = F.sha2("k", 256)
    expected = {r["k"] for r in df.orderBy(digest).limit(100).collect()}
    for n in (1, 9):
        assert {r["k"] for r in sampling.fixed_size(df.repartition(n), ["k"], 100).collect()} == expected
    assert sampling.fixed_size(df, ["k"], 30000).count() == 20000
    assert sampling.fixed_size(df.limit(0), ["k"], 5).count() == 0


def test_splits_are_whole_and_stable(spark):
    df = spark.range(5000)
    train, test = sampling.hash_split(df, ["id"])
    assert train.count() + test.count() == 5000 and train.intersect(test).count() == 0
    again, _ = sampling.hash_split(df.repartition(7), ["id"])
    assert train.exceptAll(again).count() == 0
    assert 3800 < train.count() < 4200
    assert sampling.bernoulli(df, 0.5).count() == sampling.bernoulli(df, 0.5).count()
    first, second = sampling.random_split(df)
    assert first.count() + second.count() == 5000


def test_stratified_sample_takes_whole_and_empty_strata(spark):
    df = spark.range(100).select(F.when(F.col("id") < 30, "a").otherwise("b").alias("g"))
    drawn = sampling.stratified(df, "g", {"a": 1.0, "b": 0.0}).groupBy("g").count().collect()
    assert [tuple(r) for r in drawn] == [("a", 30)]


def errors(spark, low, high):
    rows = [("low", float(x)) for x in low] + [("high", float(x)) for x in high] + [("low", None), (None, 1.0)]
    return spark.createDataFrame(rows, "g string, e double")


def test_t_tests_follow_their_formulas(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(1, 2, 60), rng.normal(0, 1, 45)
    va, vb, na, nb = a.var(ddof=1), b.var(ddof=1), 60, 45
    df = errors(spark, a, b)
    welch = stats.with_p_value(stats.with_effect(stats.compare_means(df, "e", "g", [("low", "high")]))).first()
    assert (welch["n_a"], welch["n_b"]) == (60, 45)
    assert welch["t_stat"] == pytest.approx((a.mean() - b.mean()) / math.sqrt(va / na + vb / nb))
    assert welch["df"] == pytest.approx((va / na + vb / nb) ** 2 / ((va / na) ** 2 / (na - 1) + (vb / nb) ** 2 / (nb - 1)))
    assert welch["cohens_d"] == pytest.approx((a.mean() - b.mean()) / math.sqrt((va + vb) / 2))
    assert welch["significant"] == (welch["p_value"] < 0.05)
    student = stats.compare_means(df, "e", "g", [("low", "high")], equal_var=True).first()
    pooled = ((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)
    assert student["t_stat"] == pytest.approx((a.mean() - b.mean()) / math.sqrt(pooled * (1 / na + 1 / nb)))
    assert student["df"] == na + nb - 2


def test_small_groups_are_not_tested(spark):
    few = stats.with_p_value(stats.compare_means(errors(spark, range(30), range(40)), "e", "g", [("low", "high")])).first()
    assert (few["n_a"], few["enough_rows"], few["t_stat"], few["df"], few["cohens_d"], few["p_value"]) == (30, False, None, None, None, None)
    enough = stats.compare_means(errors(spark, range(31), range(31)), "e", "g", [("low", "high")]).first()
    assert enough["enough_rows"] and enough["t_stat"] == 0.0
    absent = stats.compare_means(errors(spark, range(31), []), "e", "g", [("low", "high")]).first()
    assert (absent["n_b"], absent["enough_rows"], absent["t_stat"]) == (0, False, None)


def scored(spark):
    rows = [
        ("low", "A", 10.0, 12.0, 10.0, 1.00), ("low", "B", 20.0, 24.0, 21.0, 2.00), ("low", None, 10.0, 13.0, 10.0, 9.00),
        ("high", "A", 10.0, 10.0, 10.0, 1.05), ("high", "B", 20.0, 21.0, 19.0, 2.05), ("high", "B", 30.0, 30.0, 30.0, 2.50),
    ]
    df = spark.createDataFrame(rows, "income_category string, borough string, fare_amount double, pb double, pf double, trip_distance double")
    return disparity.with_errors(df.withColumn("trip_id", F.concat_ws("-", "income_category", "fare_amount", "trip_distance")), "fare_amount", MODELS)


def test_parity_and_odds(spark):
    groups = fairness.group_scores(scored(spark), MODELS)
    parity = {r["model"]: r for r in fairness.demographic_parity(groups).collect()}
    low, high = 49 / 3, 61 / 3
    assert parity["baseline"]["score_pop"] == pytest.approx(abs(low - high) / 2)
    assert parity["baseline"]["score"] == pytest.approx(abs(low - high) / math.sqrt(2))
    assert parity["baseline"]["group_means"] == pytest.approx({"low": low, "high": high})
    odds = {r["model"]: r for r in fairness.equalized_odds(groups).collect()}
    low_rmse, high_rmse = math.sqrt((4 + 16 + 9) / 3), math.sqrt(1 / 3)
    assert odds["baseline"]["disparity_ratio"] == pytest.approx(low_rmse / high_rmse)
    assert odds["baseline"]["score"] == pytest.approx((low_rmse - high_rmse) / 2)
    ratios = [r for r in fairness.parity_ratios(groups).collect() if r["model"] == "baseline"]
    assert [(r["group_a"], r["group_b"]) for r in ratios] == [("high", "low")]


def test_odds_ratio_is_infinite_when_a_group_has_no_error(spark):
    rows = [("low", 1.0, 2.0), ("high", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "income_category string, fare_amount double, p double")
    odds = fairness.equalized_odds(fairness.group_scores(df, {"m": "p"})).first()
    assert odds["disparity_ratio"] == math.inf


def test_individual_fairness_counts_pairs_and_violations(spark):
    pairs = fairness.partner_pairs(scored(spark), MODELS, ["trip_id"], sample=None)
    found = {r["model"]: r for r in fairness.individual_fairness(pairs, MODELS, threshold=2.5).collect()}
    # 1.00 pairs with 1.05 and 2.00 with 2.05; 9.00 has no partner
    assert found["baseline"]["comparisons"] == 2
    assert found["baseline"]["score"] == pytest.approx((2 + 3) / 2)
    assert (found["baseline"]["max_difference"], found["baseline"]["violation_count"]) == (3.0, 1)
    assert fairness.violation_examples(pairs, "pb", ["trip_id"], threshold=2.5).count() == 1


def test_no_pairs_give_zero_scores(spark):
    lonely = scored(spark).filter(F.col("income_category") == "low")
    row = fairness.individual_fairness(fairness.partner_pairs(lonely, MODELS, ["trip_id"]), MODELS).first()
    assert (row["comparisons"], row["score"], row["interpretation"]) == (0, 0.0, "GOOD")


def test_model_comparison_averages_the_gains(spark):
    rows = [("x", "baseline", 4.0), ("x", "fair", 1.0), ("y", "baseline", 0.0), ("y", "fair", 1.0)]
    table = fairness.compare_models(spark.createDataFrame(rows, "metric string, model string, score double"))
    assert {r["metric"]: r["improvement_pct"] for r in table.collect()} == {"x": 75.0, "y": 0.0, "overall": 37.5}


def test_impact_scales(spark):
    df = scored(spark)
    whole = impact.total(df, annual=600).first()
    assert (whole["annual_trips"], whole["avg_overcharge"], whole["annual_impact_usd"]) == (300.0, 3.0, 900.0)
    assert whole["annual_impact_inr"] == pytest.approx(900 * 83)
    assert impact.total(df, annual=600, sample_part=0.2).first()["annual_trips"] == pytest.approx(60.0)
    places = {r["borough"]: r["annual_impact_usd"] for r in impact.by_place(df, annual=600).collect()}
    assert places == pytest.approx({"A": 200.0, "B": 400.0})


def test_means_rounded_first_change_the_percentage(spark):
    rows = [("low", 0.114, 0.126, 0.126, 5.0)]
    df = spark.createDataFrame(rows, "g string, fare_amount double, pb double, pf double, trip_distance double")
    first = disparity.rounded_means_table(df, "g", MODELS).first()["baseline_oc_pct"]
    assert first == pytest.approx(18.2)  # 0.13 against 0.11
    exact = df.groupBy("g").agg(disparity.excess("pb").alias("p")).first()["p"]
    assert exact == pytest.approx(10.5)


def test_controlled_table_needs_enough_rows_and_keeps_both_ends(spark):
    df = spark.createDataFrame([("low", 10.0, 11.0, 10.0, d) for d in (4.49, 4.5, 5.5, 5.51)],
                               "g string, fare_amount double, pb double, pf double, trip_distance double")
    assert disparity.controlled_table(df, "g", MODELS).first()["trips"] == 2
    enough = disparity.controlled_rounded(df, "g", MODELS, min_rows=2).first()
    few = disparity.controlled_rounded(df, "g", MODELS, min_rows=3).first()
    assert enough["enough_rows"] and enough["baseline_oc_pct"] is not None
    assert not few["enough_rows"] and few["baseline_oc_pct"] is None and few["trips"] == 2


def test_improvement_rounds_half_up_and_ignores_small_overcharges(spark):
    rows = [(0.1, 5.0), (-8.0, 2.0), (8.0, 8.2), (2.0, 2.05)]
    table = disparity.improvement(spark.createDataFrame(rows, "b double, f double"), "b", "f")
    assert [r["improvement_pct"] for r in table.collect()] == [0, 75, -2, -2]


def test_ranking_is_a_top_n(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("v"), "id")
    top = ranking.top(df, "v", 3, ["id"])
    assert [r["id"] for r in top.collect()] == [9, 19, 29]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_order_of_income_groups(spark):
    df = spark.createDataFrame([("high",), ("low",), ("medium",), ("other",)], "g string")
    assert [r["g"] for r in disparity.in_order(df, "g").collect()] == ["low", "medium", "high"]


def test_fares_are_never_null_after_cleaning(spark, sf):
    assert fx.valid_trips(spark, sf).filter(F.col("fare_amount").isNull()).count() == 0


@pytest.fixture(scope="module")
def trained(spark, sf):
    return models.train(fx.enriched_trips(spark, sf), ["h"], forest={"numTrees": 8, "maxDepth": 5, "seed": 42})


def test_trained_models(spark, sf, trained, tmp_path):
    scored_rows = trained.score()
    metrics = {r["model"]: r for r in models.regression_metrics(scored_rows, trained.predictions).collect()}
    assert set(metrics) == {"baseline", "fair"}
    for name, row in metrics.items():
        assert row["r2"] <= 1 and row["rmse"] >= row["mae"] >= 0
        for metric in ("rmse", "mae", "r2"):
            assert models.evaluate(scored_rows, trained.predictions[name], metric) == pytest.approx(row[metric])
    assert metrics["baseline"]["r2_delta_pp"] == 0.0
    weights = trained.importances(spark).collect()
    for name in metrics:
        assert sum(r["importance"] for r in weights if r["model"] == name) == pytest.approx(1.0)
    assert "median_income" not in {r["feature"] for r in weights if r["model"] == "fair"}
    assert trained.test.count() + trained.train.count() == models.ml_ready(fx.enriched_trips(spark, sf)).count()
    trained.save(str(tmp_path))
    loaded = models.load_forest(f"{tmp_path}/fair_model")
    assert loaded.getNumTrees == 8
    assert trained.score(fx.enriched_trips(spark, sf)).count() == fx.enriched_trips(spark, sf).count()


@pytest.fixture(scope="module")
def metered_models(spark, sf):
    return models.train(fx.metered(fx.enriched_trips(spark, sf)), ["h"], forest={"numTrees": 7, "maxDepth": 5, "seed": 1})


SCORED_BY_SQL = """
WITH RECURSIVE walk AS (
    SELECT r.h, n.tree, n.node, n.feature, n.shift, n.scale, n.threshold, n."left", n."right", n.value, r.x FROM rows r, nodes n WHERE n.node = 0
    UNION ALL
    SELECT w.h, n.tree, n.node, n.feature, n.shift, n.scale, n.threshold, n."left", n."right", n.value, w.x FROM walk w
    JOIN nodes n ON n.tree = w.tree AND n.node = CASE WHEN (map_extract(w.x, w.feature)[1] - w.shift) * w.scale <= w.threshold THEN w."left" ELSE w."right" END
    WHERE w.feature IS NOT NULL
)
SELECT h, avg(value) AS score FROM walk WHERE feature IS NULL GROUP BY h
"""


@pytest.mark.parametrize("model", ["baseline", "fair"])
def test_node_tables_are_scored_alike_by_mllib_by_expressions_and_by_sql(spark, metered_models, model):
    features = metered_models.feature_sets[model]
    nodes = forest.of_models(metered_models.features, metered_models.forests, metered_models.feature_sets)[model].toArrow()
    scorer = forest.Scorer(spark.createDataFrame(nodes))
    rows = written(metered_models.test.dropDuplicates(["h"]), "rows")
    native = scorer.score({f: F.col(f"x_{f}") for f in features})
    scored = metered_models.forests[model].transform(rows).select("h", F.col(f"predicted_fare_{model}").alias("mllib"), native.alias("native"))
    found = {r["h"]: (r["mllib"], r["native"]) for r in scored.collect()}
    assert len({v[0] for v in found.values()}) > 20 and all(a == pytest.approx(b, abs=1e-12) for a, b in found.values())
    con = duckdb.connect()
    con.register("nodes", nodes)
    con.register("rows", rows.select("h", F.map_from_arrays(F.array(*[F.lit(f) for f in features]), F.array(*[F.col(f"x_{f}") for f in features])).alias("x")).toArrow())
    by_sql = dict(con.execute(SCORED_BY_SQL).fetchall())
    assert (len(by_sql), by_sql.keys()) == (len(found), found.keys())
    assert all(by_sql[h] == pytest.approx(found[h][0], abs=1e-9) for h in found)


def test_scores_by_levels_equal_those_by_nodes_and_need_no_function_of_elements(spark, metered_models, monkeypatch):
    features = metered_models.feature_sets["baseline"]
    scorer = forest.Scorer(forest.of_models(metered_models.features, metered_models.forests, metered_models.feature_sets)["baseline"])
    odd = F.when(F.col("h") % 5 == 0, F.lit(float("nan"))).when(F.col("h") % 5 > 1, F.col("x_trip_distance"))
    rows = metered_models.forests["baseline"].transform(metered_models.test)
    for distance in (F.col("x_trip_distance"), odd):
        values = {f: F.col(f"x_{f}") for f in features} | {"trip_distance": distance}
        both = scorer.with_score(rows, values, "by_level").withColumn("by_node", scorer.score(values))
        assert set(both.columns) == {*rows.columns, "by_level", "by_node"}
        found = both.select("by_level", "by_node", "predicted_fare_baseline").collect()
        assert len({r["by_level"] for r in found}) > 20 and all(r["by_level"] == r["by_node"] for r in found)
    assert sum(r["by_level"] != r["predicted_fare_baseline"] for r in found) > 0
    plan = scorer.with_score(rows, values, "by_level").select("by_level")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    monkeypatch.setattr(forest, "DENSE", scorer.depth - 1)
    sparse = scorer.with_score(rows, values, "by_level").select("by_level")
    assert sorted(r[0] for r in sparse.collect()) == sorted(r["by_level"] for r in found)


def test_forests_grow_from_labels_and_features_of_all_training_rows(spark, sf, monkeypatch):
    fit, seen = models.RandomForestRegressor.fit, []
    monkeypatch.setattr(models.RandomForestRegressor, "fit", lambda self, rows: seen.append((rows.columns, rows.count())) or fit(self, rows))
    trained = models.train(fx.metered(fx.valid_trips(spark, sf)), ["h"], {"few": ["trip_distance", "hour_of_day"]}, forest={"numTrees": 2, "maxDepth": 2, "seed": 1})
    assert seen == [(["fare_amount", "few_features"], trained.train.count())]


def test_importance_by_exchange_equals_its_definition(spark, metered_models):
    features = metered_models.feature_sets["baseline"]
    nodes = forest.of_models(metered_models.features, metered_models.forests, metered_models.feature_sets)["baseline"]
    scorer, rows = forest.Scorer(nodes), metered_models.test
    found = {r["feature"]: r for r in forest.permutation_importance(rows, scorer, features, ["h"], "fare_amount", donors=50).collect()}
    assert set(found) == set(features)
    assert found["trip_distance"]["importance"] > found["median_income"]["importance"] > 0
    donors = sampling.fixed_size(rows.select("h", *[f"x_{f}" for f in features]), ["h"], 50).collect()
    number = F.pmod(F.xxhash64("h", F.lit("median_income")), F.lit(len(donors))).cast("int")
    other = F.get(F.array(*[F.lit(d["x_median_income"]) for d in donors]), number)
    own = {f: F.col(f"x_{f}") for f in features}
    off = [scorer.score(v) - F.col("fare_amount") for v in (own, own | {"median_income": other})]
    mse, exchanged = rows.agg(*[F.avg(o * o) for o in off]).first()
    assert found["median_income"]["importance"] == pytest.approx(exchanged - mse) and found["median_income"]["mse"] == pytest.approx(mse)
    assert forest.permutation_importance(rows.limit(0), scorer, features, ["h"], "fare_amount").collect() == []


def test_odd_node_tables(spark):
    names = "tree int, node int, feature string, shift double, scale double, threshold double, left int, right int, value double"
    stump = spark.createDataFrame([(0, 0, None, None, None, None, None, None, 2.5), (1, 0, "a", 1.0, 2.0, 0.0, 1, 2, 9.0),
                                   (1, 1, None, None, None, None, None, None, 1.0), (1, 2, None, None, None, None, None, None, 4.0)], names)
    rows = spark.createDataFrame([(1.0,), (1.1,), (-7.0,)], "a double")
    assert [r[0] for r in rows.select(forest.Scorer(stump).score({"a": F.col("a")})).collect()] == [1.75, 3.25, 1.75]
    leaf = forest.Scorer(stump.filter("tree = 0"))
    assert [r[0] for r in rows.select(leaf.score({})).collect()] == [2.5] * 3
    with pytest.raises(ValueError):
        forest.Scorer(stump.filter("node != 1"))


def test_odd_node_tables_by_levels(spark):
    names = "tree int, node int, feature string, shift double, scale double, threshold double, left int, right int, value double"
    nodes = spark.createDataFrame([(0, 0, None, None, None, None, None, None, 2.5), (1, 0, "a", 1.0, 2.0, 0.0, 1, 2, 9.0),
                                   (1, 1, None, None, None, None, None, None, 1.0), (1, 2, "a", 1.0, 2.0, 4.0, 3, 4, 5.0),
                                   (1, 3, None, None, None, None, None, None, 4.0), (1, 4, None, None, None, None, None, None, 6.0)], names)
    rows = spark.createDataFrame([(1.0,), (1.1,), (-7.0,), (9.0,), (None,)], "a double")
    scored = forest.Scorer(nodes).with_score(rows, {"a": F.col("a")}, "s")
    assert scored.columns == ["a", "s"] and [r["s"] for r in scored.collect()] == [1.75, 3.25, 1.75, 4.25, 4.25]
    leaf = forest.Scorer(nodes.filter("tree = 0"))
    assert [r["s"] for r in leaf.with_score(rows, {}, "s").collect()] == [2.5] * 5
