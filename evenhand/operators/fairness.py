"""Fairness scores of models over groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.fixed_values import INDIVIDUAL_CUTS, ODDS_CUTS, PARITY_CUTS
from evenhand.functions import columns as C
from evenhand.operators.band import nearest_in_band
from evenhand.operators.sampling import fixed_size
from evenhand.session import written


def group_scores(df: DataFrame, models: Mapping[str, str], group: str = "income_category", label: str = "fare_amount") -> DataFrame:
    """Rows of ``model, group, n, mean_prediction, rmse``; all models and both measures in one aggregation."""
    measures = [F.count(F.lit(1)).alias("n")]
    for name, prediction in models.items():
        error = F.col(prediction) - F.col(label)
        measures += [F.avg(prediction).alias(f"{name}_m"), F.sqrt(F.avg(error * error)).alias(f"{name}_r")]
    rows = [
        F.struct(F.lit(n).alias("model"), F.col(f"{n}_m").alias("mean_prediction"), F.col(f"{n}_r").alias("rmse"))
        for n in models
    ]
    wide = df.groupBy(F.col(group).alias("group_value")).agg(*measures)
    return wide.select("group_value", "n", F.inline(F.array(*rows)))


def demographic_parity(scores: DataFrame) -> DataFrame:
    """Spread of the groups' mean predictions, as population and as sample deviation.

    The label reads the sample deviation, as tabular tools compute it by default.
    """
    return scores.groupBy("model").agg(
        F.stddev_pop("mean_prediction").alias("score_pop"),
        F.stddev_samp("mean_prediction").alias("score"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("group_value", "mean_prediction")))).alias("group_means"),
    ).withColumn("interpretation", C.grade(F.col("score"), PARITY_CUTS))


def equalized_odds(scores: DataFrame) -> DataFrame:
    """Population spread of the groups' RMSE and the ratio of the largest to the smallest."""
    low, high = F.min("rmse"), F.max("rmse")
    return scores.groupBy("model").agg(
        F.stddev_pop("rmse").alias("score"),
        F.when(low > 0, F.try_divide(high, low)).otherwise(F.lit(float("inf"))).alias("disparity_ratio"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("group_value", "rmse")))).alias("group_rmse"),
    ).withColumn("interpretation", C.grade(F.col("score"), ODDS_CUTS))


def parity_ratios(scores: DataFrame) -> DataFrame:
    """Ratio of mean predictions for every two groups in name order; works on the group rows only."""
    pair = F.struct("group_value", "mean_prediction")
    ordered = scores.groupBy("model").agg(F.array_sort(F.collect_list(pair)).alias("g"))
    later = F.transform(
        "g",
        lambda a, i: F.transform(
            F.slice("g", i + 2, F.size("g")),
            lambda b: F.struct(
                a["group_value"].alias("group_a"),
                b["group_value"].alias("group_b"),
                F.try_divide(a["mean_prediction"], b["mean_prediction"]).alias("ratio"),
            ),
        ),
    )
    return ordered.select("model", F.inline(F.flatten(later)))


def partner_pairs(
    df: DataFrame,
    models: Mapping[str, str],
    keys: Sequence[str],
    group: str = "income_category",
    distance: str = "trip_distance",
    tol: float = 0.1,
    max_pairs: int = 5,
    sample: int | None = None,
    low: str = "low",
    high: str = "high",
    **band,
) -> DataFrame:
    """Low-group rows with up to ``max_pairs`` high-group rows of nearly the same distance, a row per pair.

    All rows are compared unless ``sample`` asks for a draw of that many first. ``keys`` order rows and break
    ties. Values of the partner carry the prefix ``high_``.
    """
    columns = list(dict.fromkeys([*keys, group, distance, *models.values()]))
    rows = df.select(*columns)
    if sample is not None:
        rows = fixed_size(rows, keys, sample)
    # the pairing reads its sides several times: narrow rows of the two groups are written once
    rows = written(rows.filter(F.col(group).isin(low, high)), "pairing")
    predictions = list(models.values())
    paired = nearest_in_band(
        rows.filter(F.col(group) == low),
        rows.filter(F.col(group) == high),
        distance,
        [c for c in dict.fromkeys([*keys, *predictions]) if c != distance],
        predictions,
        tol,
        max_pairs,
        **band,
    )
    partner = F.col("_p")
    return paired.withColumn("_p", F.explode("partners")).select(
        *columns, partner[distance].alias(f"high_{distance}"), *[partner[p].alias(f"high_{p}") for p in predictions]
    )


def individual_fairness(pairs: DataFrame, models: Mapping[str, str], threshold: float = 3.0) -> DataFrame:
    """Mean and largest prediction difference within pairs, and how many exceed ``threshold``: a row per model."""
    measures, rows = [F.count(F.lit(1)).alias("comparisons")], []
    for name, prediction in models.items():
        diff = F.abs(F.col(prediction) - F.col(f"high_{prediction}"))
        measures += [
            F.coalesce(F.avg(diff), F.lit(0.0)).alias(f"{name}_s"),
            F.coalesce(F.max(diff), F.lit(0.0)).alias(f"{name}_m"),
            F.count_if(diff > threshold).alias(f"{name}_v"),
        ]
        rows.append(
            F.struct(
                F.lit(name).alias("model"),
                F.col(f"{name}_s").alias("score"),
                F.col(f"{name}_m").alias("max_difference"),
                F.col(f"{name}_v").alias("violation_count"),
            )
        )
    table = pairs.agg(*measures).select("comparisons", F.inline(F.array(*rows)))
    return table.withColumn("interpretation", C.grade(F.col("score"), INDIVIDUAL_CUTS))


def violation_examples(
    pairs: DataFrame, prediction: str, keys: Sequence[str], distance: str = "trip_distance",
    threshold: float = 3.0, n: int = 3,
) -> DataFrame:
    """The first ``n`` pairs over the threshold, in key order."""
    diff = F.abs(F.col(prediction) - F.col(f"high_{prediction}"))
    shown = pairs.select(
        *keys, F.col(distance).alias("distance"), F.col(prediction).alias("low_pred"),
        F.col(f"high_{prediction}").alias("high_pred"), diff.alias("diff"),
    ).filter(F.col("diff") > threshold)
    return shown.orderBy(*keys, "distance", "low_pred", "high_pred").limit(n)


def compare_models(scores: DataFrame, before: str = "baseline", after: str = "fair") -> DataFrame:
    """Improvement per metric and their mean, from rows of ``metric, model, score``."""
    sides = scores.groupBy("metric").agg(
        F.max(F.when(F.col("model") == before, F.col("score"))).alias("baseline_score"),
        F.max(F.when(F.col("model") == after, F.col("score"))).alias("fair_score"),
    )
    each = sides.withColumn("improvement_pct", C.relative_gain(F.col("baseline_score"), F.col("fair_score")))
    overall = F.struct(
        F.lit("overall").alias("metric"),
        F.lit(None).cast("double").alias("baseline_score"),
        F.lit(None).cast("double").alias("fair_score"),
        F.avg("improvement_pct").alias("improvement_pct"),
    )
    # a handful of metric rows, so gathering them is cheap and the scores are computed once
    row = F.struct("metric", "baseline_score", "fair_score", "improvement_pct")
    return each.agg(F.collect_list(row).alias("m"), overall.alias("o")).select(
        F.inline(F.concat("m", F.array("o")))
    )


def all_scores(df: DataFrame, models: Mapping[str, str], keys: Sequence[str], **pairing) -> DataFrame:
    """The three scores of every model as rows of ``metric, model, score``; two reads of the input."""
    pairs = individual_fairness(partner_pairs(df, models, keys, **pairing), models)
    spreads = group_scores(df, models).groupBy("model").agg(
        F.stddev_samp("mean_prediction").alias("demographic_parity"), F.stddev_pop("rmse").alias("equalized_odds")
    )
    long = spreads.unpivot("model", ["demographic_parity", "equalized_odds"], "metric", "score")
    by_pairs = pairs.select(F.lit("individual_fairness").alias("metric"), "model", "score")
    return long.select("metric", "model", "score").unionByName(by_pairs)
