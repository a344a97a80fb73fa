"""One query per operator, over whole tables. Each takes the session and a folder of Parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture as fx
from checks.fixture import MODELS
from evenhand import schemas
from evenhand.fixed_values import FAIR_FEATURES, INCOME_CLIP, SIMPLE_FEATURES
from evenhand.functions import columns as C
from evenhand.operators import (
    cleaning, disparity, enrich, fairness, forest, impact, joins, lookup, models, quantiles, ranking, reports, sampling, stats,
)
from evenhand.plans import audit
from evenhand.session import shared_path, tune, written
from evenhand.sources import catalog, files, messages
from evenhand.streaming import live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

INCOME = "income_category"
INCOMES = ("low", "medium", "high")
KEYS = ["trip_id"]
NUMBERS = ["fare_amount", "trip_distance", "trip_duration_minutes", "speed_mph"]


def query(fn: Query) -> Query:
    """Register a query under its function name; settings are applied before its plan is built."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round measures, so that the order of sums does not show."""
    return df.withColumns({c: C.steady_round(F.col(c), digits) for c in columns})


# cleaning and features


@query
def null_critical_drop(spark, sf):
    return cleaning.drop_incomplete(fx.raw_trips(spark, sf)).select("h", "fare_amount", "trip_distance")


@query
def clean_trips(spark, sf):
    return cleaning.clean_trips(fx.raw_trips(spark, sf))


@query
def clean_funnel(spark, sf):
    return cleaning.funnel(fx.raw_trips(spark, sf))


@query
def audit_clean_once(spark, sf):
    """Counts taken while the cleaned trips and the faulty lines are written from one read of the raw files."""
    path = shared_path(spark, "audit")
    h = F.col("h")
    text = fx.raw_trips(spark, sf).withColumns({
        "fare_amount": F.when(h % 41 == 0, "n/a").otherwise(F.col("fare_amount").cast("string")),
        "passenger_count": F.when(h % 43 == 0, "two").otherwise(F.col("passenger_count").cast("string")),
    })
    files.write_trips_csv(text.drop("h"), f"{path}/raw")
    paths = audit.Paths(f"{path}/raw", "", f"{path}/out")
    counts = audit.clean(spark, paths)
    cleaned = audit.cleaned_trips(spark, paths).agg(F.count(F.lit(1)).alias("cleaned_rows"))
    lost = F.col("lost_fields")
    faulty = audit.faulty_lines(spark, paths).agg(
        F.count("faulty_line").alias("faulty_lines"), F.count_if(F.array_contains(lost, "fare_amount")).alias("lost_fares"),
        F.count_if(F.array_contains(lost, "passenger_count")).alias("lost_passengers"),
    )
    return joins.one_row(counts, cleaned, faulty)


@query
def clean_variant_wide_box(spark, sf):
    kept = cleaning.keep_valid_wide(fx.raw_trips(spark, sf))
    return kept.select("h", "fare_amount", "trip_distance", "pickup_latitude", "pickup_longitude")


@query
def typed_normalise(spark, sf):
    h = F.col("h")
    text = fx.raw_trips(spark, sf).select(
        h.cast("string").alias("h"),
        F.when(h % 13 == 0, " \t ").when(h % 17 == 0, "n/a").when(h % 23 == 0, "12d").otherwise(
            F.concat(F.lit("\t "), F.col("passenger_count").cast("double").cast("string"), F.lit("\n"))
        ).alias("passenger_count"),
        F.when(h % 19 == 0, "-").when(h % 29 == 0, "1.5f").when(h % 31 == 0, " +2.5e1\u00a0").otherwise(
            F.col("fare_amount").cast("string")
        ).alias("fare_amount"),
        F.col("pickup_latitude").cast("string").alias("pickup_latitude"),
        F.when(h % 7 == 0, "\t").otherwise(F.concat(F.lit("\t"), "store_and_fwd_flag", F.lit(" \u00a0"))).alias("store_and_fwd_flag"),
    )
    return cleaning.type_fields(text).withColumn("h", F.col("h").cast("bigint"))


@query
def trip_features(spark, sf):
    columns = ["trip_duration_minutes", "speed_mph", "hour_of_day", "day_of_week", "is_rush_hour", "is_weekend", "is_night"]
    return cleaning.with_features(fx.raw_trips(spark, sf)).select("h", *columns)


@query
def rush_weekend_night_counts(spark, sf):
    flags = ["is_rush_hour", "is_weekend", "is_night"]
    return fx.valid_trips(spark, sf).groupBy(*flags).agg(F.count(F.lit(1)).alias("trips"))


@query
def fare_per_mile(spark, sf):
    return cleaning.with_features(fx.raw_trips(spark, sf)).select("h", "trip_distance", "fare_per_mile")


@query
def grid_zone_key(spark, sf):
    featured = cleaning.with_features(fx.raw_trips(spark, sf))
    return featured.groupBy("pickup_zone").agg(F.count(F.lit(1)).alias("trips"))


@query
def trip_id_hash(spark, sf):
    return cleaning.with_features(fx.raw_trips(spark, sf)).select("h", "trip_id")


@query
def describe_numeric(spark, sf):
    return rounded(quantiles.describe(fx.valid_trips(spark, sf), NUMBERS), 4, "mean", "stddev")


@query
def quartiles(spark, sf):
    return rounded(quantiles.exact_quantiles(fx.valid_trips(spark, sf), NUMBERS), 6, "value")


# lookup and enrichment


def _zones_of(spark, sf, **how) -> DataFrame:
    trips = fx.valid_trips(spark, sf).select("h", "pickup_latitude", "pickup_longitude")
    return lookup.first_match(trips, lookup.zone_table(spark), lookup.ZONE_ATTRS, **how)


@query
def zone_lookup_first_match(spark, sf):
    trips = fx.valid_trips(spark, sf).select("h", "pickup_latitude", "pickup_longitude")
    zone = lookup.match_in_list(
        lookup.zone_rows(), lookup.ZONE_ATTRS, F.col("pickup_latitude"), F.col("pickup_longitude")
    )
    return trips.withColumn("zone", zone).select(*trips.columns, *[F.col("zone")[a].alias(a) for a in lookup.ZONE_ATTRS])


@query
def zone_lookup_grid(spark, sf):
    return _zones_of(spark, sf)


@query
def zone_lookup_shuffled(spark, sf):
    return _zones_of(spark, sf, max_cells=1)


@query
def borough_lookup_closed(spark, sf):
    borough = lookup.borough_of("pickup_latitude", "pickup_longitude")
    return fx.raw_trips(spark, sf).select("h", "pickup_latitude", "pickup_longitude", borough.alias("borough"))


@query
def mapped_share(spark, sf):
    return enrich.mapped_share(fx.valid_trips(spark, sf), lookup.zone_table(spark))


@query
def income_by_zip(spark, sf):
    return enrich.income_by_zip(fx.census_text(spark, sf))


@query
def income_by_zip_padded(spark, sf):
    return enrich.income_by_zip(fx.census_text(spark, sf), pad_first=True)


@query
def income_range(spark, sf):
    return enrich.income_range(enrich.income_by_zip(fx.census_text(spark, sf)))


def _with_income(spark, sf, max_rows: int) -> DataFrame:
    zones = lookup.zone_table(spark).withColumnRenamed("zip", "pickup_zip")
    mapped = lookup.first_match(fx.valid_trips(spark, sf), zones, ["pickup_zip"], keep_unmatched=False)
    incomes = enrich.income_by_zip(fx.census_text(spark, sf, sparse=True))
    return enrich.attach_income(mapped.select("h", "pickup_zip"), incomes, max_rows=max_rows)


@query
def enrich_income(spark, sf):
    return _with_income(spark, sf, joins.MAX_BROADCAST_ROWS)


@query
def enrich_income_salted(spark, sf):
    return _with_income(spark, sf, 0)


@query
def enriched_trips(spark, sf):
    return fx.enriched_trips(spark, sf).select(*schemas.ENRICHED_TRIPS.fieldNames())


@query
def income_category_profile(spark, sf):
    measures = {
        "avg_fare": disparity.mean("fare_amount"),
        "avg_distance": disparity.mean("trip_distance"),
        "avg_area_income": disparity.mean("median_income", 0),
    }
    return disparity.profile(fx.enriched_trips(spark, sf), [INCOME], measures).orderBy(INCOME)


@query
def income_bins_right_closed(spark, sf):
    income = C.clip(F.col("income_text").try_cast("double"), *INCOME_CLIP)
    near = F.when(income.between(44000, 46000), 45000.0).when(income.between(74000, 76000), 75000.0).otherwise(income)
    entries = fx.census_text(spark, sf).select(near.alias("income"))
    value = F.col("income")
    band = F.when(value.isNotNull(), C.income_band(value))
    return entries.groupBy(C.income_bin(value).alias("income_bin"), band.alias("income_band")).agg(
        F.count(F.lit(1)).alias("n")
    )


# views and ad hoc reports


def _view(spark, sf, name: str) -> DataFrame:
    catalog.define_views(fx.enriched_trips(spark, sf), fx.predicted_trips(spark, sf))
    return spark.sql(f"SELECT * FROM {name}")


@query
def v_income_fare_summary(spark, sf):
    return _view(spark, sf, "v_income_fare_summary")


@query
def v_borough_stats(spark, sf):
    return _view(spark, sf, "v_borough_stats")


@query
def v_hourly_demand(spark, sf):
    return _view(spark, sf, "v_hourly_demand")


@query
def v_bias_comparison(spark, sf):
    return _view(spark, sf, "v_bias_comparison")


@query
def trips_by_borough(spark, sf):
    return disparity.profile(fx.enriched_trips(spark, sf), ["borough"], {}).orderBy(F.desc("trip_count"), "borough")


@query
def fare_by_income(spark, sf):
    measures = {"avg_fare": disparity.mean("fare_amount", 6)}
    return disparity.profile(fx.enriched_trips(spark, sf), [INCOME], measures, "cnt").orderBy(INCOME)


@query
def fare_per_mile_by_income(spark, sf):
    return rounded(catalog.fare_per_mile_of(INCOME, fx.enriched_trips(spark, sf)), 6, "fare_per_mile")


@query
def similar_distance_overcharge(spark, sf):
    table = disparity.controlled_table(fx.predicted_trips(spark, sf), INCOME, MODELS)
    return table.select(INCOME, "trips", "baseline_pred", "fair_pred", "actual").orderBy(INCOME)


def _trip_profile(spark, sf, by: str) -> DataFrame:
    measures = {"avg_fare": disparity.mean("fare_amount"), "avg_distance": disparity.mean("trip_distance")}
    return disparity.profile(fx.valid_trips(spark, sf), [by], measures).orderBy(by)


@query
def hourly_profile(spark, sf):
    return _trip_profile(spark, sf, "hour_of_day")


@query
def rush_vs_non_rush(spark, sf):
    return _trip_profile(spark, sf, "is_rush_hour")


@query
def weekend_vs_weekday(spark, sf):
    return _trip_profile(spark, sf, "is_weekend")


@query
def fare_by_dow(spark, sf):
    days = fx.valid_trips(spark, sf).groupBy("day_of_week")
    return days.agg(disparity.mean("fare_amount", 6).alias("avg_fare")).orderBy("day_of_week")


@query
def top10_expensive(spark, sf):
    shown = ["trip_id", "fare_amount", "trip_distance", "tpep_pickup_datetime"]
    ties = ["trip_id", "trip_distance", "tpep_pickup_datetime"]
    return ranking.top(fx.valid_trips(spark, sf).select(*shown), "fare_amount", 10, ties)


@query
def top10_neighborhood_overcharge(spark, sf):
    return ranking.worst_places(
        fx.predicted_trips(spark, sf), MODELS["baseline"], "fare_amount", ["neighborhood", "borough"]
    )


@query
def expensive_trip_count(spark, sf):
    return fx.valid_trips(spark, sf).filter(F.col("fare_amount") > 100).agg(F.count(F.lit(1)).alias("trips"))


@query
def sample_rows(spark, sf):
    shown = ["trip_id", "fare_amount", "trip_distance", "borough", "neighborhood", "median_income", INCOME]
    return fx.enriched_trips(spark, sf).select(*shown).orderBy(
        "trip_id", "fare_amount", "trip_distance", "neighborhood"
    ).limit(10)


@query
def category_share(spark, sf):
    return disparity.share_of_total(live.borough_counts(fx.raw_trips(spark, sf)), "borough", "trips")


# disparity


@query
def prediction_columns(spark, sf):
    return fx.predicted_trips(spark, sf).select(*schemas.PREDICTIONS.fieldNames())


@query
def bias_by_income(spark, sf):
    return disparity.bias_table(fx.predicted_trips(spark, sf), INCOME, MODELS)


@query
def bias_by_borough(spark, sf):
    return disparity.place_table(fx.predicted_trips(spark, sf), "borough", MODELS["baseline"])


@query
def bias_controlled_distance(spark, sf):
    return disparity.controlled_table(fx.predicted_trips(spark, sf), INCOME, MODELS)


@query
def bias_summary_wide(spark, sf):
    return disparity.summary_by_income(fx.predicted_trips(spark, sf), MODELS)


@query
def borough_bias_wide(spark, sf):
    return disparity.summary_by_place(fx.predicted_trips(spark, sf), MODELS)


@query
def bias_round_first(spark, sf):
    return disparity.rounded_means_table(fx.predicted_trips(spark, sf), INCOME, MODELS)


@query
def controlled_round_first(spark, sf):
    return disparity.controlled_rounded(fx.predicted_trips(spark, sf), INCOME, MODELS)


@query
def low_high_gap(spark, sf):
    table = disparity.controlled_rounded(fx.predicted_trips(spark, sf), INCOME, MODELS)
    return disparity.low_high_gap(table, INCOME, "baseline")


@query
def chart_summary(spark, sf):
    table = disparity.chart_summary(fx.predicted_trips(spark, sf), INCOME, MODELS)
    return rounded(table, 6, "avg_actual_fare", "avg_predicted_fare")


@query
def model_frames(spark, sf):
    return disparity.model_frames(disparity.summary_by_income(fx.predicted_trips(spark, sf), MODELS))


@query
def error_total_by_borough(spark, sf):
    table = disparity.error_total(fx.predicted_trips(spark, sf), "borough", "baseline_error")
    return rounded(table, 6, "signed_millions", "millions")


@query
def bias_improvement(spark, sf):
    table = disparity.summary_by_income(fx.predicted_trips(spark, sf), MODELS)
    columns = ["baseline_overcharge_pct", "fair_overcharge_pct"]
    return disparity.improvement(table.select(INCOME, *columns), *columns)


@query
def summaries_side_by_side(spark, sf):
    table = written(disparity.bias_table(fx.predicted_trips(spark, sf), INCOME, MODELS), "bias")
    sides = [table.filter(F.col("model") == m) for m in MODELS]
    pairs = disparity.side_by_side(*sides, INCOME, ["overcharge_pct"])
    return disparity.improvement(pairs, "baseline_overcharge_pct", "fair_overcharge_pct")


@query
def bias_reduction(spark, sf):
    table = disparity.summary_by_income(fx.predicted_trips(spark, sf), MODELS)
    return disparity.bias_reduction(table, INCOME, "baseline_overcharge_pct", "fair_overcharge_pct")


# statistics and fairness


def _tests(spark, sf, equal_var: bool, error: str = "baseline_error") -> DataFrame:
    return stats.compare_means(fx.predicted_trips(spark, sf), error, INCOME, equal_var=equal_var)


def _shown_tests(tests: DataFrame) -> DataFrame:
    return rounded(rounded(tests.drop("mean_a", "mean_b"), 4, "t_stat", "cohens_d"), 2, "df")


@query
def welch_t(spark, sf):
    return _shown_tests(_tests(spark, sf, False))


@query
def student_t(spark, sf):
    return _shown_tests(_tests(spark, sf, True))


@query
def cohens_d(spark, sf):
    return rounded(stats.with_effect(_tests(spark, sf, False)), 4, "cohens_d").select("test", "cohens_d", "effect_size")


@query
def welch_p_value(spark, sf):
    tests = stats.with_p_value(_tests(spark, sf, False, "fair_error"))
    shown = rounded(tests, 6, "t_stat", "p_value")
    return shown.select("test", "t_stat", "p_value", "significant", "highly_significant")


def _groups(spark, sf) -> DataFrame:
    return fairness.group_scores(fx.predicted_trips(spark, sf), MODELS)


@query
def demographic_parity(spark, sf):
    table = fairness.demographic_parity(_groups(spark, sf))
    means = {f"{g}_mean": F.col("group_means")[g] for g in INCOMES}
    return rounded(table.withColumns(means).drop("group_means"), 6, "score_pop", "score", *means)


@query
def dp_pairwise_ratio(spark, sf):
    return rounded(fairness.parity_ratios(_groups(spark, sf)), 6, "ratio")


@query
def equalized_odds(spark, sf):
    table = fairness.equalized_odds(_groups(spark, sf))
    errors = {f"{g}_rmse": F.col("group_rmse")[g] for g in INCOMES}
    return rounded(table.withColumns(errors).drop("group_rmse"), 6, "score", "disparity_ratio", *errors)


def _individual(spark, sf, **choices) -> DataFrame:
    pairs = fairness.partner_pairs(fx.predicted_trips(spark, sf), MODELS, KEYS, **choices)
    table = fairness.individual_fairness(pairs, MODELS)
    return rounded(rounded(table, 4, "score"), 6, "max_difference")


@query
def individual_fairness(spark, sf):
    return _individual(spark, sf)


@query
def individual_fairness_sampled(spark, sf):
    return _individual(spark, sf, sample=5000)


@query
def individual_fairness_full(spark, sf):
    """The same scores over many small parts, whose partners mostly lie in other parts."""
    return _individual(spark, sf, rows_per_part=300)


@query
def individual_fairness_wide_band(spark, sf):
    return _individual(spark, sf, tol=0.6)


@query
def violation_examples(spark, sf):
    pairs = fairness.partner_pairs(fx.predicted_trips(spark, sf), MODELS, KEYS)
    return rounded(fairness.violation_examples(pairs, MODELS["baseline"], KEYS), 6, "low_pred", "high_pred", "diff")


@query
def fairness_comparison(spark, sf):
    table = fairness.compare_models(fairness.all_scores(fx.predicted_trips(spark, sf), MODELS, KEYS))
    return rounded(rounded(table, 6, "baseline_score", "fair_score"), 4, "improvement_pct")


@query
def fairness_report(spark, sf):
    report = reports.with_comparison(reports.fairness_report(fx.predicted_trips(spark, sf), MODELS, KEYS))
    gains = {
        "parity_gain": "demographic_parity", "odds_gain": "equalized_odds",
        "individual_gain": "individual_fairness", "overall": "overall",
    }
    return report.select(*[C.steady_round(F.col("comparison")[c], 4).alias(n) for n, c in gains.items()])


@query
def fairness_report_details(spark, sf):
    """Every field of the report's three metrics, a row per model."""
    report = reports.fairness_report(fx.predicted_trips(spark, sf), MODELS, KEYS)
    rows = []
    for model in MODELS:
        parity, odds, pairs = (F.col(metric)[model] for metric in reports.METRICS)
        values = {"parity_score": (parity["score"], 6), "parity_score_pop": (parity["score_pop"], 6), "odds_score": (odds["score"], 6)}
        values |= {"disparity_ratio": (odds["disparity_ratio"], 6), "pair_score": (pairs["score"], 4), "max_difference": (pairs["max_difference"], 6)}
        values |= {f"{g}_mean": (parity["group_means"][g], 6) for g in INCOMES} | {f"{g}_rmse": (odds["group_rmse"][g], 6) for g in INCOMES}
        plain = {"parity_grade": parity["interpretation"], "odds_grade": odds["interpretation"], "pair_grade": pairs["interpretation"]}
        plain |= {"comparisons": pairs["comparisons"], "violation_count": pairs["violation_count"]}
        steady = {n: C.steady_round(c, digits) for n, (c, digits) in values.items()}
        rows.append(F.struct(F.lit(model).alias("model"), *[c.alias(n) for n, c in (steady | plain).items()]))
    return report.select(F.inline(F.array(*rows)))


@query
def bias_report(spark, sf):
    report = reports.bias_report(fx.predicted_trips(spark, sf), MODELS)
    summary = F.col("summary")
    return report.select(
        summary["baseline_low_overcharge_pct"].alias("low_pct"),
        summary["baseline_high_overcharge_pct"].alias("high_pct"),
        summary["fair_low_overcharge_pct"].alias("fair_low_pct"),
        summary["bias_magnitude_pp"].alias("bias_pp"),
        C.steady_round(F.col("financial_impact")["avg_overcharge_per_trip"], 4).alias("overcharge_per_trip"),
        C.steady_round(F.col("financial_impact")["affected_trips_annually"], 0).alias("annual_trips"),
        C.steady_round(F.col("financial_impact")["total_annual_impact_usd"], 0).alias("annual_usd"),
        *[shown for test in ("low_vs_high", "low_vs_medium") for shown in _shown_test(test)],
    )


def _shown_test(test: str):
    values = F.col("statistical_tests")[test]
    for name, digits in (("t_stat", 4), ("p_value", 6), ("cohens_d", 4)):
        yield C.steady_round(values[name], digits).alias(f"{test}_{name}")
    for name in ("significant", "effect_size", "enough_rows"):
        yield values[name].alias(f"{test}_{name}")


# impact


def _impact(spark, sf, part: float) -> DataFrame:
    table = impact.total(fx.predicted_trips(spark, sf), sample_part=part)
    table = rounded(table, 4, "group_share_pct", "avg_overcharge")
    return rounded(table, 0, "annual_trips", "annual_impact_usd", "annual_impact_inr")


@query
def impact_total(spark, sf):
    return _impact(spark, sf, 1.0)


@query
def impact_stage3_scale(spark, sf):
    return _impact(spark, sf, 0.2)


@query
def impact_by_borough(spark, sf):
    return rounded(impact.by_place(fx.predicted_trips(spark, sf)), 0, "annual_impact_usd")


# models and samples


@query
def regression_metrics(spark, sf):
    table = models.regression_metrics(fx.predicted_trips(spark, sf), MODELS)
    return rounded(rounded(table, 6, "rmse", "mae", "r2"), 4, "r2_delta_pp")


@query
def model_evaluators(spark, sf):
    """The three measures by MLlib's evaluator, a model each."""
    scored = fx.predicted_trips(spark, sf)
    rows = [(name, *[models.evaluate(scored, column, metric) for metric in ("rmse", "mae", "r2")]) for name, column in MODELS.items()]
    return rounded(spark.createDataFrame(rows, "model string, rmse double, mae double, r2 double"), 6, "rmse", "mae", "r2")


def _trained(spark, sf, sets=models.FEATURE_SETS) -> models.TrainedModels:
    return models.train(fx.metered(fx.enriched_trips(spark, sf)), ["h"], sets)


BAND_MILES = 2.5


def _sound(trained: models.TrainedModels) -> DataFrame:
    """How far the native score is from MLlib's, and what holds for the errors of a forest that has learned something."""
    scorers = {name: forest.Scorer(nodes) for name, nodes in forest.of_models(trained.features, trained.forests, trained.feature_sets).items()}
    band = F.floor(F.col("trip_distance") / BAND_MILES)
    by_band = trained.train.groupBy(band.alias("band")).agg(F.avg("fare_amount").alias("by_band"))
    native = {name: f"native_{name}" for name in scorers}
    scored = trained.score().select("fare_amount", band.alias("band"), *[f"x_{f}" for f in trained.all_features], *trained.predictions.values())
    for name, s in scorers.items():
        scored = s.with_score(scored, {f: F.col(f"x_{f}") for f in trained.feature_sets[name]}, native[name])
    scored = scored.join(F.broadcast(by_band), "band", "left")  # a row per band
    scored = written(scored.select("fare_amount", F.coalesce("by_band", F.lit(0.0)).alias("by_band"), *native.values(), *trained.predictions.values()), "scored")
    table = models.regression_metrics(scored, {name: f"native_{name}" for name in scorers})
    bands = models.regression_metrics(scored, {"bands": "by_band"}).select(F.col("r2").alias("band_r2"))
    change = [F.max(F.abs(F.col(f"native_{n}") - F.col(p))).alias(n) for n, p in trained.predictions.items()]
    beside = joins.one_row(bands, scored.agg(*change)).first()
    largest = F.coalesce(*[F.when(F.col("model") == n, F.lit(beside[n])) for n in scorers])
    return table.select(
        "model", "n", (F.col("rmse") >= F.col("mae")).alias("rmse_not_below_mae"), (F.col("mae") > 0).alias("has_error"),
        (F.col("r2") <= 1.0).alias("r2_at_most_one"), (F.col("r2") > F.greatest(F.lit(0.0), F.lit(beside["band_r2"]))).alias("r2_above_bands"),
        C.steady_round(largest, 6).alias("native_off_by"),
    )


@query
def rf_baseline_vs_fair(spark, sf):
    return _sound(_trained(spark, sf))


@query
def rf_feature_importance(spark, sf):
    weights = _trained(spark, sf).importances(spark)
    return weights.groupBy("model").agg(
        F.count(F.lit(1)).alias("features"), C.steady_round(F.sum("importance"), 6).alias("total"),
        F.count_if(F.col("feature") == "median_income").alias("income_features"), (F.min("importance") >= 0).alias("none_negative"),
        F.max_by("feature", "importance").alias("first_feature"),
    )


@query
def rf_node_table(spark, sf):
    """Trees, and whether the nodes of every tree hang together: each but the root is the child of one node."""
    trained = _trained(spark, sf)
    tables = forest.of_models(trained.features, trained.forests, trained.feature_sets)
    nodes = reduce(DataFrame.unionByName, [t.withColumn("model", F.lit(name)) for name, t in tables.items()])
    nodes = written(nodes, "nodes")
    children = nodes.filter("feature IS NOT NULL").select("model", "tree", F.explode(F.array("left", "right")).alias("node"))
    owned = children.groupBy("model", "tree", "node").agg(F.count(F.lit(1)).alias("parents"))
    found = nodes.join(owned, ["model", "tree", "node"], "left").groupBy("model").agg(
        F.countDistinct("tree").alias("trees"), F.count_if(F.col("parents").isNull()).alias("roots"), F.max("parents").alias("most_parents"),
        (F.count_if(F.col("feature").isNull()) - F.count("feature")).alias("leaves_beyond_splits"),
        F.count_if(F.col("feature") == "median_income").alias("income_splits"),
    )
    return found.withColumn("income_splits", F.col("income_splits") > 0)


@query
def rf_permutation_importance(spark, sf):
    trained = _trained(spark, sf)
    rows = []
    for name, nodes in forest.of_models(trained.features, trained.forests, trained.feature_sets).items():
        table = forest.permutation_importance(trained.test, forest.Scorer(nodes), trained.feature_sets[name], ["h"], models.LABEL)
        rows.append(table.withColumn("model", F.lit(name)))
    table, income = reduce(DataFrame.unionByName, rows), F.col("feature") == "median_income"
    return table.groupBy("model").agg(
        F.count(F.lit(1)).alias("features"), F.max_by("feature", "importance").alias("first_feature"),
        F.coalesce(F.max(F.when(income, F.col("importance") > 0)), F.lit(False)).alias("income_matters"),
        F.bool_and((F.col("feature") != "trip_distance") | (F.col("importance") > 0)).alias("distance_matters"),
    )


@query
def rf_simple_model(spark, sf):
    return _sound(models.train(fx.metered(fx.valid_trips(spark, sf)), ["h"], {"simple": SIMPLE_FEATURES}))


@query
def enriched_with_predictions(spark, sf):
    trips = fx.enriched_trips(spark, sf).select("trip_id", "fare_amount", INCOME)
    joined = enrich.with_predictions(trips, fx.predicted_trips(spark, sf), list(MODELS.values()))
    return rounded(joined, 6, *MODELS.values())


@query
def hash_split_counts(spark, sf):
    train, test = sampling.hash_split(fx.raw_trips(spark, sf), ["h"])
    parts = train.select(F.lit("train").alias("part")).unionByName(test.select(F.lit("test").alias("part")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query
def hash_sample(spark, sf):
    return sampling.hash_sample(fx.raw_trips(spark, sf), ["h"], 0.05).select("h", "fare_amount", "trip_distance")


@query
def fixed_size_sample(spark, sf):
    return sampling.fixed_size(fx.raw_trips(spark, sf).select("h", "fare_amount", "trip_distance"), ["h"], 5000)


@query
def bernoulli_sample(spark, sf):
    rows = fx.raw_trips(spark, sf).count()
    return sampling.bernoulli(fx.raw_trips(spark, sf), 0.05).agg(F.lit(rows).alias("rows"), _within(F.count(F.lit(1)), rows, 0.05))


def _within(drawn, rows, part: float):
    """Whether a draw has its expected size, up to six standard deviations."""
    rows = F.lit(rows) if isinstance(rows, int) else rows
    return (F.abs(drawn - rows * part) <= 6 * F.sqrt(rows * part * (1 - part)) + 1).alias("size_as_expected")


@query
def stratified_sample(spark, sf):
    parts = {"low": 0.2, "medium": 0.1, "high": 0.05}
    trips = fx.enriched_trips(spark, sf)
    drawn = sampling.stratified(trips, INCOME, parts).groupBy(INCOME).agg(F.count(F.lit(1)).alias("n"))
    both = trips.groupBy(INCOME).agg(F.count(F.lit(1)).alias("rows")).join(drawn, INCOME, "left").fillna(0, ["n"])
    part = F.element_at(F.create_map(*[F.lit(x) for pair in parts.items() for x in pair]), F.col(INCOME))
    return both.select(INCOME, "rows", _within(F.col("n"), F.col("rows"), part))


@query
def random_split_counts(spark, sf):
    rows = fx.raw_trips(spark, sf).count()
    train, test = sampling.random_split(fx.raw_trips(spark, sf))
    parts = train.select(F.lit("train").alias("part")).unionByName(test.select(F.lit("test").alias("part")))
    counts = parts.groupBy().pivot("part", ["train", "test"]).count()
    return counts.select((F.col("train") + F.col("test")).alias("rows"), _within(F.col("train"), rows, 0.8))


# streams, sources and sinks


def _line_stream(spark, sf) -> DataFrame:
    """Trips as a stream; the glob fits a table that is one file as well as a folder of files."""
    schema = fx.read_table(spark, sf, "lineitem").schema
    lines = live.stream_files(spark, f"{sf}/lineitem.parque[t]", schema, "parquet")
    return fx.trips_from_lines(lines)


def _message_stream(spark, sf, *fields: str) -> DataFrame:
    """Trips that went through message encoding and typed decoding."""
    return messages.decode(messages.encode(_line_stream(spark, sf)), fields)


def _summed(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("fare_amount").alias("fares"),
        C.steady_round(F.sum("fare_amount"), 2).alias("fare_sum"),
        C.steady_round(F.sum("trip_distance"), 2).alias("distance_sum"),
        F.min(F.col("tpep_pickup_datetime").cast("timestamp_ntz")).alias("first_pickup"),
        F.max(F.col("tpep_dropoff_datetime").cast("timestamp_ntz")).alias("last_dropoff"),
        C.steady_round(F.sum("pickup_latitude"), 3).alias("latitude_sum"),
    )


@query
def stream_totals(spark, sf):
    path = shared_path(spark, "totals")
    live.drain(live.publish(live.totals(_line_stream(spark, sf)), f"{path}/out", f"{path}/check"))
    return live.published(spark, f"{path}/out")


@query
def stream_borough_counts(spark, sf):
    path = shared_path(spark, "boroughs")
    live.drain(live.publish(live.borough_counts(_line_stream(spark, sf)), f"{path}/out", f"{path}/check"))
    return live.published(spark, f"{path}/out")


def _line_files(spark, sf, path: str) -> str:
    """The lines as several files, for streams of several batches."""
    fx.read_table(spark, sf, "lineitem").repartition(4).write.parquet(f"{path}/lines")
    return f"{path}/lines"


def _append(spark, rows: DataFrame, folder: str) -> int:
    """Write rows to a folder of Parquet files; returns how many files that added."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*")
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = len(system.globStatus(place) or [])
    rows.write.mode("append").parquet(folder)
    return len(system.globStatus(place)) - before


def _batches(spark, sf, path: str) -> DataFrame:
    folder = _line_files(spark, sf, path)
    return fx.trips_from_lines(live.stream_files(spark, folder, spark.read.parquet(folder).schema, "parquet", per_batch=1))


@query
def stream_totals_batches(spark, sf):
    path = shared_path(spark, "totals")
    live.drain(live.publish(live.totals(_batches(spark, sf, path)), f"{path}/out", f"{path}/check"))
    return live.published(spark, f"{path}/out")


@query
def stream_borough_batches(spark, sf):
    path = shared_path(spark, "boroughs")
    counts = live.borough_counts(_batches(spark, sf, path))
    live.drain(live.publish(counts, f"{path}/out", f"{path}/check", "update", keys=["borough"]))
    return live.updated(spark, f"{path}/out", ["borough"])


@query
def stream_reset(spark, sf):
    """Totals of a run of several batches, nothing after a reset, and the totals of the run that starts over."""
    path = shared_path(spark, "reset")
    trips = _batches(spark, sf, path)
    live.drain(live.publish(live.totals(trips), f"{path}/out", f"{path}/check"))
    first = written(live.published(spark, f"{path}/out").withColumn("step", F.lit("before")), "step")
    checkpoint = live.reset(spark, f"{path}/out")
    empty = live.published(spark, f"{path}/out").agg(F.count(F.lit(1)).alias("messages_consumed"))
    empty = written(empty.withColumn("step", F.lit("reset")), "step")
    late = trips.filter(F.col("passenger_count") > 5)
    live.drain(live.publish(live.totals(late), f"{path}/out", checkpoint))
    after = live.published(spark, f"{path}/out").withColumn("step", F.lit("after"))
    return first.unionByName(empty, allowMissingColumns=True).unionByName(after)


RECENT = ["pickup", "h", "fare", "distance"]


@query
def stream_latest20(spark, sf):
    path = shared_path(spark, "latest")
    live.drain(live.keep_latest(live.recent_view(_line_stream(spark, sf), "h"), RECENT, f"{path}/check"))
    return live.latest(spark, f"{path}/check", RECENT)


@query
def stream_latest_restarted(spark, sf):
    """Four batches with a stop in the middle; the rows that are kept come through in the state."""
    path = shared_path(spark, "latest")
    parts = F.col("l_orderkey") % 4
    lines = fx.read_table(spark, sf, "lineitem")
    for half in (0, 2):
        counts = [_append(spark, lines.filter(parts == part), f"{path}/lines") for part in (half, half + 1)]
        # two batches, however many files a part has
        trips = fx.trips_from_lines(live.stream_files(spark, f"{path}/lines", lines.schema, "parquet", per_batch=max(counts)))
        live.drain(live.keep_latest(live.recent_view(trips, "h"), RECENT, f"{path}/check"))
    return live.latest(spark, f"{path}/check", RECENT)


@query
def stream_snapshot(spark, sf):
    path = shared_path(spark, "snapshot")
    trips = _line_stream(spark, sf)
    tables = {"totals": live.totals(trips), "boroughs": live.borough_counts(trips)}
    for name, table in tables.items():
        live.drain(live.publish(table, f"{path}/{name}", f"{path}/{name}-check"))
    shown = live.recent_view(trips, "h")
    live.drain(live.keep_latest(shown, RECENT, f"{path}/latest-check"))
    timed = trips.withColumn("t", F.col("tpep_pickup_datetime").cast("timestamp"))
    # ship dates span years and come in any order, so nothing may count as late
    rates = live.rate(timed, "t", delay="20000 days")
    live.drain(live.publish(rates, f"{path}/rate", f"{path}/rate-check", "update", keys=["window_start"]))
    recent = live.latest(spark, f"{path}/latest-check", RECENT)
    row = live.snapshot(spark, f"{path}/totals", f"{path}/boroughs", recent, f"{path}/rate")
    return row.select(
        "messages_consumed", "fare_sum", "distance_sum", "messages_per_sec",
        F.to_json(F.map_from_entries(F.array_sort(F.map_entries("borough_counts")))).alias("boroughs"),
        F.size("recent_trips").alias("shown"),
        F.col("recent_trips")[0]["pickup"].alias("last_pickup"),
    )


@query
def stream_rate_per_second(spark, sf):
    path = shared_path(spark, "rate")
    schema = fx.read_table(spark, sf, "events").schema
    taken = live.stream_files(spark, f"{sf}/events.parque[t]", schema, "parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    # files come in any order, so the delay spans the whole month
    rates = live.rate(taken, "ts", delay="60 days")
    live.drain(live.publish(rates, f"{path}/out", f"{path}/check", "update", keys=["window_start"]))
    table = live.updated(spark, f"{path}/out", ["window_start"])
    return table.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query
def stream_rate_closed(spark, sf):
    """Four runs of a stream that closes windows; a part of the events arrives a run later than it should."""
    path = shared_path(spark, "rate")
    events = fx.read_table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    due = F.least(F.floor((F.day("ts") - 1) / 8), F.lit(3))
    arrives = F.when(F.col("event_id") % 20 == 0, F.least(due + 1, F.lit(3))).otherwise(due)
    for run in range(4):
        events.filter(arrives == run).write.mode("append").parquet(f"{path}/in")
        taken = live.stream_files(spark, f"{path}/in", events.schema, "parquet")
        live.drain(live.append_rows(live.rate(taken, "ts", "1 minute", "1 hour"), f"{path}/out", f"{path}/check"))
    table = spark.read.parquet(f"{path}/out")
    return table.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _undo(spark, *paths: str) -> None:
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for found in system.globStatus(place) or []:
            system.delete(found.getPath(), True)


@query
def stream_restart(spark, sf):
    """Intake and totals that stop after a batch was written but not yet marked as done, and then go on."""
    path = shared_path(spark, "restart")
    lines = fx.read_table(spark, sf, "lineitem")
    for part in range(3):
        lines.filter(F.col("l_orderkey") % 3 == part).write.mode("append").parquet(f"{path}/lines")
        trips = fx.trips_from_lines(live.stream_files(spark, f"{path}/lines", lines.schema, "parquet"))
        live.drain(live.write_json_lines(cleaning.stamp_ingestion(trips.drop("h")), f"{path}/out", f"{path}/out-check", compression="gzip"))
        live.drain(live.publish(live.totals(trips), f"{path}/totals", f"{path}/totals-check"))
        if part < 2:
            # batch by batch: its files are there, its mark and the pointer to it are not
            marks = [f"{path}/{name}-check/commits/{mark}{part}{crc}" for name in ("out", "totals") for mark, crc in (("", ""), (".", ".crc"))]
            _undo(spark, *marks, f"{path}/totals/pointers/*/place={part}")
    intake = _summed(spark.read.schema(schemas.MESSAGE).json(f"{path}/out"))
    totals = live.published(spark, f"{path}/totals")
    return joins.one_row(intake.select("n", "fare_sum", "distance_sum"), totals.select(
        "messages_consumed", F.col("fare_sum").alias("live_fare_sum"), F.col("distance_sum").alias("live_distance_sum")))


@query
def stream_jsonl_roundtrip(spark, sf):
    path = shared_path(spark, "jsonl")
    taken = cleaning.stamp_ingestion(_line_stream(spark, sf).drop("h"))
    live.drain(live.write_json_lines(taken, f"{path}/out", f"{path}/check", compression="gzip"))
    return _summed(spark.read.schema(schemas.MESSAGE).json(f"{path}/out"))


@query
def message_roundtrip(spark, sf):
    sent = messages.encode(cleaning.stamp_ingestion(fx.raw_trips(spark, sf).drop("h")))
    return _summed(messages.decode(sent))


@query
def csv_roundtrip(spark, sf):
    path = shared_path(spark, "csv")
    files.write_trips_csv(fx.raw_trips(spark, sf).drop("h"), path)
    return _summed(files.read_trips_csv(spark, path))


@query
def parquet_roundtrip(spark, sf):
    path = shared_path(spark, "parquet")
    files.write_parquet(fx.raw_trips(spark, sf), path, files=20)
    return _summed(files.read_parquet(spark, path))


@query
def union_parts(spark, sf):
    train, test = sampling.hash_split(fx.raw_trips(spark, sf), ["h"], 0.5)
    return _summed(train.unionByName(test))


@query
def result_csv_roundtrip(spark, sf):
    path = shared_path(spark, "summary")
    files.write_small_csv(disparity.summary_by_income(fx.predicted_trips(spark, sf), MODELS), path)
    return files.read_result_csv(spark, path, schemas.BIAS_SUMMARY)


@query
def census_csv_roundtrip(spark, sf):
    path = shared_path(spark, "census")
    header = "Households Median Income (Dollars)"
    files.write_rows_csv(fx.census_text(spark, sf).withColumnRenamed("income_text", header), path)
    return enrich.income_by_zip(files.read_census_csv(spark, path))


def _in_database(spark, build) -> DataFrame:
    """What ``build`` makes in a database of its own, written out before the database is dropped again."""
    before, name = spark.catalog.currentDatabase(), f"fare_audit_{uuid.uuid4().hex[:12]}"
    try:
        return written(build(name), "catalog")
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@query
def catalog_tables(spark, sf):
    path = shared_path(spark, "tables")
    files.write_trips_csv(fx.raw_trips(spark, sf).drop("h"), f"{path}/raw")

    def build(name: str) -> DataFrame:
        catalog.create_tables(spark, {"taxi_trips_raw": f"{path}/raw"}, name)
        return _summed(spark.table(f"{name}.taxi_trips_raw"))

    return _in_database(spark, build)


@query
def catalog_all_tables(spark, sf):
    """Rows and fares of all seven external tables, over files that the engine's own sinks wrote."""
    path = shared_path(spark, "tables")
    places = {name: f"{path}/{name}" for name in catalog.TABLES}
    predicted = fx.predicted_trips(spark, sf)
    files.write_trips_csv(fx.raw_trips(spark, sf).drop("h"), places["taxi_trips_raw"])
    census = fx.census_text(spark, sf)
    columns = [F.col(c).alias(f.name) for c, f in zip(census.columns, schemas.CENSUS)]
    files.write_rows_csv(census.select(*columns), places["census_income"])
    files.write_parquet(fx.valid_trips(spark, sf).select(*schemas.CLEAN_TRIPS.fieldNames()), places["taxi_trips_cleaned"])
    files.write_parquet(fx.enriched_trips(spark, sf).select(*schemas.ENRICHED_TRIPS.fieldNames()), places["taxi_trips_enriched"])
    files.write_parquet(predicted.select(*schemas.PREDICTIONS.fieldNames()), places["ml_predictions"])
    files.write_small_csv(disparity.summary_by_income(predicted, MODELS), places["bias_summary"])
    files.write_small_csv(disparity.summary_by_place(predicted, MODELS), places["borough_bias"])
    fares = {"taxi_trips_raw": "fare_amount", "taxi_trips_cleaned": "fare_amount", "taxi_trips_enriched": "fare_amount", "ml_predictions": "fare_amount"}
    fares |= {"bias_summary": "avg_actual_fare", "borough_bias": "avg_actual_fare"}

    def build(name: str) -> DataFrame:
        catalog.create_tables(spark, places, name)
        listed = [t["tableName"] for t in catalog.list_tables(spark).filter("NOT isTemporary").collect()]
        rows = [
            spark.table(f"{name}.{t}").agg(
                F.lit(t).alias("table"), F.count(F.lit(1)).alias("n"),
                (C.steady_round(F.sum(fares[t]), 2) if t in fares else F.lit(None).cast("double")).alias("fare_sum"),
            )
            for t in sorted(listed)
        ]
        return reduce(DataFrame.unionByName, rows)

    return _in_database(spark, build)


@query
def inferred_csv(spark, sf):
    path = shared_path(spark, "inferred")
    files.write_rows_csv(fx.census_text(spark, sf), path)
    table = files.read_inferred_csv(spark, path)
    kinds = {name: kind for name, kind in table.dtypes}
    return table.agg(F.count(F.lit(1)).alias("n"), F.lit(kinds["ZIP"]).alias("code_type"), F.lit(kinds["income_text"]).alias("income_type"))


@query
def file_heads(spark, sf):
    path = shared_path(spark, "heads")
    trips = fx.raw_trips(spark, sf)
    parts = [f"{path}/{i}" for i in range(3)]
    for i, part in enumerate(parts):
        files.write_trips_csv(trips.filter(F.col("h") % 3 == i).drop("h").coalesce(1), part)
    return files.read_heads(spark, parts, 100).agg(F.count(F.lit(1)).alias("n"), F.count("VendorID").alias("vendors"))


@query
def report_json_roundtrip(spark, sf):
    path = shared_path(spark, "report")
    files.write_report_json(reports.bias_report(fx.predicted_trips(spark, sf), MODELS), path)
    report = spark.read.json(path)
    return report.select(
        F.col("summary")["bias_magnitude_pp"].alias("bias_pp"),
        C.steady_round(F.col("financial_impact")["avg_overcharge_per_trip"], 4).alias("overcharge_per_trip"),
    )


@query
def stream_typed(spark, sf):
    """Raw text typed and stamped on a stream."""
    path = shared_path(spark, "typed")
    text = _line_stream(spark, sf)
    text = text.select(*[F.concat(F.lit("\t"), F.col(c).cast("string"), F.lit(" ")).alias(c) for c in text.columns if c != "h"])
    stamped = cleaning.stamp_ingestion(cleaning.type_fields(text))
    live.drain(live.write_json_lines(stamped, f"{path}/out", f"{path}/check"))
    rows = spark.read.schema(schemas.MESSAGE).json(f"{path}/out")
    stamp = F.to_timestamp(F.substring("ingestion_timestamp", 1, 19), "yyyy-MM-dd'T'HH:mm:ss")
    fresh = F.abs(F.unix_timestamp(stamp) - F.unix_timestamp(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))) < 3600
    return rows.agg(
        F.count(F.lit(1)).alias("n"), C.steady_round(F.sum("fare_amount"), 2).alias("fare_sum"), F.count("passenger_count").alias("passengers"),
        F.bool_and(F.col("ingestion_timestamp").endswith("+00:00") & fresh).alias("stamped"),
    )


@query
def model_roundtrip(spark, sf):
    path = shared_path(spark, "models")
    trained = models.train(fx.enriched_trips(spark, sf), ["h"], {"fair": FAIR_FEATURES})
    trained.save(path)
    scored = models.load_forest(f"{path}/fair_model").transform(trained.test).select("h", "predicted_fare_fair")
    kept = trained.forests["fair"].transform(trained.test).select("h", F.col("predicted_fare_fair").alias("kept"))
    change = F.abs(F.col("predicted_fare_fair") - F.col("kept"))
    pairs = scored.groupBy("h").agg(F.avg("predicted_fare_fair").alias("predicted_fare_fair"), F.count(F.lit(1)).alias("rows")).join(
        kept.groupBy("h").agg(F.avg("kept").alias("kept")), "h"
    )
    return pairs.agg(F.sum("rows").alias("n"), C.steady_round(F.max(change), 6).alias("largest_change"))
